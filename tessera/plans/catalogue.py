"""The query catalogue: each of the workbench's operators over the driver's tables, and SQL with the same rows where SQL has them.

contents stands over documents, evaluation queries over benchmark; what documents don't have (dates, titles, urls,
statuses) is derived from doc_id. All queries read their whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RETRIEVALS
from ..functions import metrics as M
from ..functions import text as X
from ..operators import backup, chunking, contents, embedding, evaluation, generation, postprocess, retrieval, semantic
from ..operators.collections import Store, by_content, indexing_counts, summary, upserted
from ..operators.lexical_index import BlockIndex
from ..operators.vector_index import VectorIndex
from ..sources.shared import shared_dir
from .prepared import COLLECTION, Prepared, prepared

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
SINCE, SOURCE, LIMIT = "2026-06-01", "src2", 25
CHUNK, STEP = 800, 100

CONTENTS_SQL = """c AS (SELECT source || '::' || doc_id AS content_id, doc_id AS newsletter_id, source AS source_key,
  CASE WHEN doc_id % 4 <> 0 THEN CAST(DATE '2026-01-01' + CAST(doc_id % 365 AS INTEGER) AS DATE) END AS content_date, 'Document ' || doc_id AS title, lang AS author,
  CASE WHEN doc_id % 3 <> 0 THEN 'https://example.org/d/' || doc_id END AS url, text AS content_md,
  CASE WHEN doc_id % 2 = 0 THEN 'pending' ELSE 'indexed' END AS vector_status, TIMESTAMP '2026-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) AS stored_at FROM documents)"""
WHITE_SQL = X.WHITE
ITEMS_SQL = f"""{CONTENTS_SQL}, i AS (SELECT content_id, title, author, coalesce(url, '') AS url, source_key, coalesce(strftime(content_date, '%Y-%m-%d'), '') AS content_date, content_md, stored_at
  FROM c WHERE length(regexp_replace(content_md, '^{WHITE_SQL}+|{WHITE_SQL}+$', '', 'g')) >= 50)"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def contents_of(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id")
    return table(spark, d, "documents").select(
        F.concat_ws("::", "source", i.cast("string")).alias("content_id"), i.alias("newsletter_id"), F.col("source").alias("source_key"),
        F.when(i % 4 != 0, F.date_add(F.lit("2026-01-01").cast("date"), (i % 365).cast("int"))).alias("content_date"),
        F.concat(F.lit("Document "), i.cast("string")).alias("title"), F.col("lang").alias("author"),
        F.when(i % 3 != 0, F.concat(F.lit("https://example.org/d/"), i.cast("string"))).alias("url"), F.col("text").alias("content_md"),
        F.when(i % 2 == 0, "pending").otherwise("indexed").alias("vector_status"),
        F.expr("to_timestamp_ntz('2026-01-01 00:00:00') + make_dt_interval(0, 0, cast(doc_id as int))").alias("stored_at"),
    )


def queries_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))


def corpus(spark: SparkSession, d: str) -> DataFrame:
    """Whole contents as a collection, one chunk each."""
    c = contents_of(spark, d)
    chunk = F.struct(F.lit("").alias("heading"), F.lit(0).alias("index"))
    return c.select(F.col("content_id").alias("id"), "content_id", F.coalesce("content_md", F.lit("")).alias("document"), embedding.metadata(chunk).alias("metadata"))


def ready(spark: SparkSession, d: str) -> Prepared:
    return prepared(spark, d, corpus(spark, d))


def _strategy(spark: SparkSession, d: str, spec: str) -> retrieval.Retriever:
    """A strategy over the stored collection, with the lexical index that was written for it."""
    own = ready(spark, d)
    rows = own.collection  # before the index, as what is shuffled for it takes the most disk
    how = {"lexical": own.lexical, "in_step": True} if "hybrid" in spec else {}
    return retrieval.build_strategy(rows, spec, embedding.WHOLE_MODEL, **how)


# --- scans, filters, updates

_COLUMNS = "content_id, source_key, title, author, url, vector_status, stored_at"


def _plain(c: DataFrame) -> DataFrame:
    return c.select(*_COLUMNS.split(", "), F.col("content_date").cast("string").alias("content_date"), F.md5(F.col("content_md").cast("binary")).alias("text_md5"))


_PLAIN_SQL = f"WITH {CONTENTS_SQL} SELECT {_COLUMNS}, CAST(content_date AS VARCHAR) AS content_date, md5(content_md) AS text_md5 FROM c"


@query(_PLAIN_SQL)
def contents_all(spark: SparkSession, d: str) -> DataFrame:
    return _plain(contents.get_contents(contents_of(spark, d)))


@query(f"{_PLAIN_SQL} WHERE source_key = '{SOURCE}'")
def contents_by_source(spark: SparkSession, d: str) -> DataFrame:
    return _plain(contents.get_contents(contents_of(spark, d), source_key=SOURCE))


@query(f"{_PLAIN_SQL} WHERE coalesce(content_date, CAST(stored_at AS DATE)) >= DATE '{SINCE}'")
def contents_since(spark: SparkSession, d: str) -> DataFrame:
    return _plain(contents.get_contents(contents_of(spark, d), since=SINCE))


@query(f"{_PLAIN_SQL} WHERE vector_status = 'pending'")
def contents_by_status(spark: SparkSession, d: str) -> DataFrame:
    return _plain(contents.get_contents(contents_of(spark, d), vector_status="pending"))


@query(f"{_PLAIN_SQL} WHERE source_key = '{SOURCE}' AND vector_status = 'pending' AND coalesce(content_date, CAST(stored_at AS DATE)) >= DATE '{SINCE}'")
def contents_combined(spark: SparkSession, d: str) -> DataFrame:
    return _plain(contents.get_contents(contents_of(spark, d), SOURCE, SINCE, "pending"))


@query("SELECT count(*) AS contents FROM documents")
def contents_count(spark: SparkSession, d: str) -> DataFrame:
    return contents_of(spark, d).agg(F.count(F.lit(1)).alias("contents"))


@query(f"WITH {ITEMS_SQL} SELECT content_id, title, author, url, source_key, content_date, md5(content_md) AS text_md5 FROM i")
def pending_items(spark: SparkSession, d: str) -> DataFrame:
    return contents.work_items(contents_of(spark, d)).withColumn("text_md5", F.md5(F.col("content_md").cast("binary"))).drop("content_md")


@query(f"WITH {ITEMS_SQL} SELECT content_id, title, content_date FROM i ORDER BY stored_at NULLS FIRST, content_id LIMIT {LIMIT}")
def pending_items_limit(spark: SparkSession, d: str) -> DataFrame:
    return contents.work_items(contents_of(spark, d), limit=LIMIT).select("content_id", "title", "content_date")


@query(f"WITH {CONTENTS_SQL} SELECT content_id, CASE WHEN newsletter_id % 5 = 0 THEN 'failed' ELSE vector_status END AS vector_status FROM c")
def set_status(spark: SparkSession, d: str) -> DataFrame:
    c = contents_of(spark, d)
    updates = c.where("newsletter_id % 5 = 0").select("content_id", F.lit("failed").alias("vector_status"))
    return contents.set_vector_status(c, updates).select("content_id", "vector_status")


@query(f"WITH {CONTENTS_SQL} SELECT content_id, CAST(floor((row_number() OVER (ORDER BY content_id) - 1) / 10) AS BIGINT) AS batch, md5(content_md) AS text_md5 FROM c")
def item_batches(spark: SparkSession, d: str) -> DataFrame:
    made = contents.batches(contents_of(spark, d).select("content_id", "content_md"))
    return made.select("content_id", F.col("batch").cast("bigint").alias("batch"), F.md5(F.col("content_md").cast("binary")).alias("text_md5"))


# --- scalar functions


@query(f"WITH {CONTENTS_SQL}, f AS (SELECT content_id, regexp_replace(content_id, '[^a-zA-Z0-9_-]', '_', 'g') AS s FROM (SELECT content_id || CASE WHEN newsletter_id % 7 = 0 THEN repeat('/x', 100) ELSE '' END AS content_id FROM c)) SELECT content_id, CASE WHEN length(s) > 200 THEN substr(s, 1, 180) || '__' || substr(sha256(content_id), 1, 12) ELSE s END AS file_name FROM f")
def safe_filename(spark: SparkSession, d: str) -> DataFrame:
    ids = contents_of(spark, d).select(F.concat("content_id", F.when(F.col("newsletter_id") % 7 == 0, F.repeat(F.lit("/x"), 100)).otherwise("")).alias("content_id"))
    return ids.select("content_id", X.safe_filename(F.col("content_id")).alias("file_name"))


@query("SELECT doc_id, substr(sha256(text), 1, 16) AS hash, CASE WHEN n_chars * 97 < 1024 THEN n_chars * 97 || ' B' WHEN n_chars * 97 < 1048576 THEN printf('%.1f', round(n_chars * 97 / 1024e0, 1)) || ' KB' ELSE printf('%.1f', round(n_chars * 97 / 1048576e0, 1)) || ' MB' END AS size, concat_ws(' > ', source, nullif(lang, 'en')) AS path FROM documents")
def text_functions(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_chars") * 97
    return table(spark, d, "documents").select("doc_id", X.hash_prefix(F.col("text")).alias("hash"), X.human_size(n).alias("size"), X.heading_path(F.col("source"), F.nullif("lang", F.lit("en"))).alias("path"))


@query("SELECT doc_id, len(t)::INTEGER AS tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS t FROM documents)")
def lexical_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = X.tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(t).alias("tokens"), F.md5(F.array_join(t, " ").cast("binary")).alias("tokens_md5"))


_STRATEGIES_SQL = ", ".join(f"('{r}')" for r in RETRIEVALS)


@query(f"SELECT source || '__' || r AS combo, source AS collection, r AS strategy FROM (SELECT DISTINCT source FROM documents WHERE source <> '') CROSS JOIN (VALUES {_STRATEGIES_SQL}) t(r)")
def eval_combos(spark: SparkSession, d: str) -> DataFrame:
    """A collection for each source, under each strategy, and what parsing gives back of their names."""
    names = contents_of(spark, d).where("source_key <> ''").select("source_key").distinct()
    rows = names.select(F.explode(F.array(*(F.concat("source_key", F.lit(f"__{r}")) for r in RETRIEVALS))).alias("combo"))
    return rows.withColumn("p", X.split_combo(F.col("combo"))).select("combo", "p.collection", "p.strategy")


# --- chunking


def _chunks(spark: SparkSession, d: str, strategy: str) -> DataFrame:
    made = chunking.chunk(contents_of(spark, d).select("content_id", "content_md"), strategy, CHUNK, STEP)
    return made.select("content_id", F.explode("chunks").alias("c")).select("content_id", F.col("c.index").alias("chunk_index"), "c.heading", F.md5(F.col("c.text").cast("binary")).alias("text_md5"), F.length("c.text").alias("chars"))


def _windows_sql(units: str, size: int, step: int, cut: str) -> str:
    return f"""WITH {CONTENTS_SQL}, u AS (SELECT content_id, coalesce(content_md, '') AS t, {units} AS u FROM c),
 w AS (SELECT content_id, unnest(range(CASE WHEN len(u) = 0 THEN 0 WHEN len(u) <= {size} THEN 1 ELSE CAST(ceil((len(u) - {size - step}) / {step}.0) AS BIGINT) END)) AS i, u, t FROM u),
 s AS (SELECT content_id, i, regexp_replace({cut}, '^{WHITE_SQL}+|{WHITE_SQL}+$', '', 'g') AS x FROM w)
 SELECT content_id, CAST(row_number() OVER (PARTITION BY content_id ORDER BY i) - 1 AS INTEGER) AS chunk_index, '' AS heading, md5(x) AS text_md5, CAST(length(x) AS INTEGER) AS chars FROM s WHERE x <> ''"""


@query(_windows_sql("t", 4 * CHUNK, 4 * (CHUNK - STEP), f"substr(t, CAST(i * {4 * (CHUNK - STEP)} + 1 AS BIGINT), {4 * CHUNK})").replace("AS t, t AS u", "AS t, coalesce(content_md, '') AS u"))
def chunk_fixed(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d, "fixed")


def _token_sql(pattern: str) -> str:
    return _windows_sql(f"regexp_extract_all(coalesce(content_md, ''), '(?s){pattern}')", CHUNK, CHUNK - STEP, f"array_to_string(u[CAST(i * {CHUNK - STEP} + 1 AS BIGINT):CAST(i * {CHUNK - STEP} + {CHUNK} AS BIGINT)], '')")


@query(_token_sql(chunking.WORD_TOKEN))
def chunk_token(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d, "token")


@query(_token_sql(chunking.PIECE_TOKEN))
def chunk_sentence_transformer_token(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d, "sentence_transformer_token")


@query()
def chunk_recursive(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d, "recursive")


@query()
def chunk_markdown(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d, "markdown")


@query()
def chunk_markdown_syntax(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d, "markdown_syntax")


@query()
def chunk_semantic(spark: SparkSession, d: str) -> DataFrame:
    return _chunks(spark, d, "semantic")


def _chunk_documents(items: DataFrame) -> DataFrame:
    rows = embedding.chunk_rows(chunking.chunk_records(items, "fixed", CHUNK, STEP))
    return rows.select("id", "content_id", F.md5(F.col("document").cast("binary")).alias("document_md5"), "metadata.url")


_CHUNK_DOCUMENTS_SQL = f"""WITH {ITEMS_SQL}, w AS (SELECT content_id, title, author, url, content_md AS t, unnest(range(CASE WHEN length(content_md) <= {4 * CHUNK} THEN 1 ELSE CAST(ceil((length(content_md) - {4 * STEP}) / {4 * (CHUNK - STEP)}.0) AS BIGINT) END)) AS k FROM i),
 s AS (SELECT *, regexp_replace(substr(t, CAST(k * {4 * (CHUNK - STEP)} + 1 AS BIGINT), {4 * CHUNK}), '^{WHITE_SQL}+|{WHITE_SQL}+$', '', 'g') AS x FROM w),
 n AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY k) - 1 AS place FROM s WHERE x <> '')
 SELECT content_id || '::chunk' || place AS id, content_id, md5('Title: ' || title || ' | Author: ' || author || chr(10) || x) AS document_md5, nullif(url, '') AS url FROM n"""


@query(_CHUNK_DOCUMENTS_SQL)
def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    return _chunk_documents(contents.work_items(contents_of(spark, d)))


@query(_CHUNK_DOCUMENTS_SQL)
def chunk_documents_whole(spark: SparkSession, d: str) -> DataFrame:
    """The same rows as chunk_documents, which once left out contents of several chunks."""
    return chunk_documents(spark, d)


@query(f"WITH {ITEMS_SQL} SELECT count(*) AS indexed, CAST(0 AS BIGINT) AS errors, CAST(sum(CASE WHEN length(content_md) <= {4 * CHUNK} THEN 1 ELSE ceil((length(content_md) - {4 * STEP}) / {4 * (CHUNK - STEP)}.0) END) AS BIGINT) AS chunks FROM i")
def index_counts(spark: SparkSession, d: str) -> DataFrame:
    return indexing_counts(chunking.chunk(contents.work_items(contents_of(spark, d)), "fixed", CHUNK, STEP))


@query(f"WITH {ITEMS_SQL} SELECT content_id, substr(title, 1, 60) AS title, source_key, CAST(CASE WHEN length(content_md) <= {4 * CHUNK} THEN 1 ELSE ceil((length(content_md) - {4 * STEP}) / {4 * (CHUNK - STEP)}.0) END AS BIGINT) AS chunks FROM i")
def index_summary(spark: SparkSession, d: str) -> DataFrame:
    items = contents.work_items(contents_of(spark, d))
    return summary(embedding.chunk_rows(chunking.chunk_records(items, "fixed", CHUNK, STEP)), items)


# --- vectors

_COSINE = "list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[])"


@query(f"WITH s AS (SELECT q.vec_id AS query_id, e.vec_id AS id, round({_COSINE}, 12) AS s FROM embeddings q, embeddings e WHERE q.vec_id % 20 = 0) SELECT CAST(query_id AS VARCHAR) AS query_id, id, CAST(r AS INTEGER) AS rank, round(s, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, id) AS r FROM s) WHERE r <= 5")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    queries = e.where("vec_id % 20 = 0").select(F.col("vec_id").cast("string").alias("query_id"), "embedding")
    found = retrieval.vector_topk(e.withColumnRenamed("vec_id", "id"), queries, 5)
    return found.select("query_id", "id", F.col("rank").cast("int").alias("rank"), F.round("score", 6).alias("score"))


@query(ORACLE_SQL["vector_topk"])
def vector_index_topk(spark: SparkSession, d: str) -> DataFrame:
    """The same rows, from an index in files that is written for them."""
    e = table(spark, d, "embeddings")
    index = VectorIndex.build(e.withColumnRenamed("vec_id", "id"), f"{shared_dir(spark)}/vector-index-{uuid.uuid4().hex}")
    found = index.top(e.where("vec_id % 20 = 0").select(F.col("vec_id").cast("string").alias("query_id"), "embedding"), 5)
    return found.select("query_id", "id", "rank", F.round("score", 6).alias("score"))


_TOKENS_SQL = "[\\p{L}\\p{N}_]+"


def _hash_sql(rows: str, key: str, text: str) -> str:
    """key, b (place), n (count), len (length of the vector)."""
    return f"""(SELECT *, sqrt(sum(n * n) OVER (PARTITION BY {key})) AS len FROM (SELECT {key}, CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) % 384 AS b, CAST(count(*) AS DOUBLE) AS n
 FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '{_TOKENS_SQL}')) AS t FROM {rows}) GROUP BY ALL))"""


_SEMANTIC_SQL = f"""WITH {CONTENTS_SQL}, st AS (SELECT content_id, list_filter(string_split(regexp_replace(coalesce(content_md, ''), '([.?!])[\\x09-\\x0d\\x20]+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS ss FROM c),
 sn AS (SELECT content_id, pos, ss[pos] AS s FROM (SELECT content_id, ss, unnest(range(1, len(ss) + 1)) AS pos FROM st)),
 ar AS (SELECT content_id, pos, concat_ws(' ', lag(s) OVER w, s, lead(s) OVER w) AS t FROM sn WINDOW w AS (PARTITION BY content_id ORDER BY pos)),
 hv AS MATERIALIZED {_hash_sql("ar", "content_id, pos", "t")},
 dd AS (SELECT y.content_id, y.pos, sum(x.n / x.len * y.n / y.len) AS dot FROM hv x JOIN hv y ON x.content_id = y.content_id AND x.pos + 1 = y.pos AND x.b = y.b GROUP BY ALL),
 ds AS (SELECT content_id, pos, s, CASE WHEN pos > 1 THEN round(1 - coalesce(dot, 0), {chunking.DIGITS}) END AS d FROM sn LEFT JOIN dd USING (content_id, pos)),
 cu AS (SELECT *, quantile_cont(d, 0.8) OVER (PARTITION BY content_id) AS cut FROM ds),
 gr AS (SELECT *, CAST(sum(CASE WHEN d > cut THEN 1 ELSE 0 END) OVER (PARTITION BY content_id ORDER BY pos) AS INTEGER) AS part FROM cu)
 SELECT content_id, part, md5(string_agg(s, ' ' ORDER BY pos)) AS text_md5, CAST(count(*) AS INTEGER) AS sentences FROM gr GROUP BY content_id, part"""


@query(_SEMANTIC_SQL)
def semantic_parts(spark: SparkSession, d: str) -> DataFrame:
    return semantic.parts(contents_of(spark, d), "content_id").select("content_id", "part", F.md5(F.col("text").cast("binary")).alias("text_md5"), "sentences")


_DENSE_SQL = f"""{CONTENTS_SQL}, q AS (SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark),
 dv AS MATERIALIZED {_hash_sql("c", "content_id", "content_md")}, qv AS MATERIALIZED {_hash_sql("q", "query_id", "query")},
 ds AS (SELECT query_id, content_id AS chunk_id, round(sum(qv.n / qv.len * dv.n / dv.len), 12) AS s FROM qv JOIN dv USING (b) GROUP BY ALL),
 da AS (SELECT q.query_id, c.content_id AS chunk_id, coalesce(s, 0) AS s FROM q CROSS JOIN c LEFT JOIN ds ON ds.query_id = q.query_id AND ds.chunk_id = c.content_id),
 dense AS MATERIALIZED (SELECT query_id, chunk_id, s AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, chunk_id) AS rank FROM da)"""
_BM25_SQL = f"""t AS (SELECT content_id AS chunk_id, regexp_extract_all(lower(content_md), '{_TOKENS_SQL}') AS t FROM c), st AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM t),
 po AS MATERIALIZED (SELECT chunk_id, dl, term, count(*) AS tf FROM (SELECT chunk_id, len(t) AS dl, unnest(t) AS term FROM t) GROUP BY ALL),
 raw AS (SELECT term, count(*) AS df, ln((SELECT n FROM st) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw FROM po GROUP BY term),
 te AS MATERIALIZED (SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raw) ELSE raw END AS idf FROM raw),
 qt AS (SELECT query_id, term, count(*) AS qf FROM (SELECT query_id, unnest(regexp_extract_all(lower(query), '{_TOKENS_SQL}')) AS term FROM q) GROUP BY ALL),
 bs AS (SELECT query_id, chunk_id, sum(qf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / (SELECT avgdl FROM st)))) AS s FROM qt JOIN te USING (term) JOIN po USING (term) GROUP BY ALL),
 ba AS (SELECT q.query_id, t.chunk_id, round(coalesce(s, 0), 9) AS s FROM q CROSS JOIN t LEFT JOIN bs ON bs.query_id = q.query_id AND bs.chunk_id = t.chunk_id),
 sparse AS MATERIALIZED (SELECT query_id, chunk_id, s AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, chunk_id) AS rank FROM ba)"""
_FUSED_SQL = """fu AS (SELECT query_id, chunk_id, sum(1.0 / (60 + rank)) AS s, min(rank) FILTER (src = 0) AS p0, min(rank) FILTER (src = 1) AS p1
  FROM (SELECT query_id, chunk_id, rank, 0 AS src FROM dense WHERE rank <= {n} UNION ALL SELECT query_id, chunk_id, rank, 1 FROM sparse WHERE rank <= {n}) GROUP BY ALL),
 fused AS MATERIALIZED (SELECT query_id, chunk_id, s AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(s, 12) DESC, p0 NULLS LAST, p1 NULLS LAST, chunk_id) AS rank FROM fu)"""
_OUT = "SELECT query_id, chunk_id, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM"


def _out(found: DataFrame) -> DataFrame:
    return found.select("query_id", "chunk_id", F.col("rank").cast("int").alias("rank"), F.round("score", 6).alias("score"))


@query(f"WITH {_DENSE_SQL} {_OUT} dense WHERE rank <= 5")
def retrieve_cosine(spark: SparkSession, d: str) -> DataFrame:
    return _out(_strategy(spark, d, "cosine").retrieve(queries_of(spark, d)))


@query(f"WITH {CONTENTS_SQL}, q AS (SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark), {_BM25_SQL} SELECT term, df, round(idf, 6) AS idf FROM te")
def bm25_idf(spark: SparkSession, d: str) -> DataFrame:
    return ready(spark, d).lexical.terms().select("term", "df", F.round("idf", 6).alias("idf"))


@query(f"WITH {CONTENTS_SQL}, q AS (SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark), {_BM25_SQL} {_OUT} sparse WHERE rank <= 20")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return _out(ready(spark, d).lexical.top(queries_of(spark, d), 20))


_CHANGED_SQL = CONTENTS_SQL.replace("text AS content_md", "CASE WHEN doc_id % 3 = 0 THEN text || ' changed ' || doc_id ELSE text END AS content_md").replace("FROM documents)", "FROM documents WHERE doc_id % 5 <> 0 AND (doc_id % 2 = 0 OR doc_id % 3 = 0))")


@query(f"WITH {_CHANGED_SQL}, q AS (SELECT '' AS query_id, '' AS query), {_BM25_SQL} SELECT term, df, round(idf, 6) AS idf FROM te")
def bm25_idf_after_changes(spark: SparkSession, d: str) -> DataFrame:
    """The statistics of an index of every other content, after some changed or came and some were removed."""
    n = F.substring_index("content_id", "::", -1).cast("long")
    whole = corpus(spark, d).withColumn("n", n).select("id", "content_id", "document", "n")
    index = BlockIndex.build(whole.where("n % 2 = 0"), f"{shared_dir(spark)}/lexical-{uuid.uuid4().hex}")
    index.upsert(whole.where("n % 3 = 0").withColumn("document", F.concat("document", F.lit(" changed "), F.col("n").cast("string"))))
    index.delete(whole.where("n % 5 = 0"))
    return index.terms().select("term", "df", F.round("idf", 6).alias("idf"))


@query(f"WITH {_DENSE_SQL}, {_BM25_SQL}, {_FUSED_SQL.format(n=20)} {_OUT} fused WHERE rank <= 5")
def retrieve_hybrid(spark: SparkSession, d: str) -> DataFrame:
    return _out(_strategy(spark, d, "hybrid").retrieve(queries_of(spark, d)))


_RERANK_SQL = f"""rr AS (SELECT w.query_id, w.chunk_id, w.rank AS inner_rank, list_distinct(regexp_extract_all(lower(q.query), '{_TOKENS_SQL}')) AS qt, regexp_extract_all(lower(c.content_md), '{_TOKENS_SQL}') AS dt
  FROM {{inner}} w JOIN q USING (query_id) JOIN c ON c.content_id = w.chunk_id WHERE w.rank <= 20),
 rs AS (SELECT query_id, chunk_id, inner_rank, CASE WHEN len(qt) = 0 THEN 0 ELSE len(list_intersect(qt, dt)) / len(qt) END AS score FROM rr),
 re AS (SELECT query_id, chunk_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, inner_rank) AS rank FROM rs)"""


@query(f"WITH {_DENSE_SQL}, {_RERANK_SQL.replace('{inner}', 'dense')} {_OUT} re WHERE rank <= 5")
def retrieve_rerank(spark: SparkSession, d: str) -> DataFrame:
    return _out(_strategy(spark, d, "rerank").retrieve(queries_of(spark, d)))


@query(f"WITH {_DENSE_SQL}, {_BM25_SQL}, {_FUSED_SQL.format(n=80)}, {_RERANK_SQL.replace('{inner}', 'fused')} {_OUT} re WHERE rank <= 5")
def retrieve_rerank_hybrid(spark: SparkSession, d: str) -> DataFrame:
    return _out(_strategy(spark, d, "rerank_hybrid").retrieve(queries_of(spark, d)))


_BENCHMARK_Q = "SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark"
_WORDS, _ANSWER, _OTHER = "the of and that in", "an answer to: ", "more about "


@query(f"WITH {_DENSE_SQL.replace(_BENCHMARK_Q, f"SELECT 'q' AS query_id, '{_WORDS}' AS query")} SELECT coalesce(url, '') AS url, coalesce(title, '') AS title, coalesce(author, '') AS author, coalesce(content_md, '') AS chunk, round(1 - score, 6) AS distance FROM dense JOIN c ON content_id = chunk_id WHERE rank <= 5")
def search(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.search(ready(spark, d).collection, _WORDS, 5, embedding.WHOLE_MODEL).withColumn("distance", F.round("distance", 6))


@query(f"WITH {_DENSE_SQL.replace(_BENCHMARK_Q, f"SELECT CAST(item_id AS VARCHAR) AS query_id, '{_ANSWER}' || text AS query FROM benchmark")} {_OUT} dense WHERE rank <= 5")
def retrieve_hyde(spark: SparkSession, d: str) -> DataFrame:
    written = retrieval.HyDE(_strategy(spark, d, "cosine"), lambda q: q.withColumn("query", F.concat(F.lit(_ANSWER), "query")))
    return _out(written.retrieve(queries_of(spark, d)))


_VARIED_Q = f"SELECT '0/' || item_id AS query_id, text AS query FROM benchmark UNION ALL SELECT '1/' || item_id, '{_OTHER}' || text FROM benchmark"


@query(f"""WITH {_DENSE_SQL.replace(_BENCHMARK_Q, _VARIED_Q)}, fu AS (SELECT substr(query_id, 3) AS query_id, chunk_id, sum(1e0 / (60 + rank)) AS score FROM dense WHERE rank <= 20 GROUP BY ALL),
 fr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM fu) {_OUT} fr WHERE rank <= 5""")
def retrieve_fusion(spark: SparkSession, d: str) -> DataFrame:
    def vary(q: DataFrame) -> DataFrame:
        return q.select("query_id", F.posexplode(F.array("query", F.concat(F.lit(_OTHER), "query"))).alias("variant", "query"))

    return _out(retrieval.MultiQuery(_strategy(spark, d, "cosine"), vary).retrieve(queries_of(spark, d)))


# --- after retrieval


@query(f"WITH {_DENSE_SQL} SELECT query_id, chunk_id, CAST(CASE WHEN rank % 2 = 1 THEN (rank + 1) / 2 ELSE 6 - rank / 2 END AS INTEGER) AS rank FROM dense WHERE rank <= 5")
def lost_in_middle(spark: SparkSession, d: str) -> DataFrame:
    return postprocess.lost_in_middle(retrieve_cosine(spark, d)).select("query_id", "chunk_id", "rank")


@query(f"""WITH RECURSIVE {_DENSE_SQL}, dt AS MATERIALIZED (SELECT query_id, chunk_id, score, CAST(rank AS INTEGER) AS rank, list_distinct(regexp_extract_all(lower(coalesce(content_md, '')), '{_TOKENS_SQL}')) AS t FROM dense JOIN c ON content_id = chunk_id WHERE rank <= 10),
 dp AS (SELECT a.query_id, a.rank AS ra, b.rank AS rb, len(list_intersect(a.t, b.t)) AS o, len(a.t) + len(b.t) AS n FROM dt a JOIN dt b ON a.query_id = b.query_id AND a.rank < b.rank),
 da2 AS MATERIALIZED (SELECT dt.query_id, dt.rank, coalesce(list(ra) FILTER (ra IS NOT NULL), []) AS alike FROM dt LEFT JOIN dp ON dp.query_id = dt.query_id AND rb = dt.rank AND CASE WHEN n = 0 THEN 1e0 ELSE o / (n - o) END >= 0.85e0 GROUP BY ALL),
 dk AS (SELECT query_id, 0 AS step, []::INTEGER[] AS kept FROM q UNION ALL SELECT dk.query_id, step + 1, CASE WHEN list_has_any(kept, alike) THEN kept ELSE list_append(kept, rank) END FROM dk JOIN da2 ON da2.query_id = dk.query_id AND da2.rank = dk.step + 1),
 de AS (SELECT query_id, unnest(max_by(kept, step)) AS old, unnest(range(1, len(max_by(kept, step)) + 1)) AS rank FROM dk GROUP BY query_id)
 SELECT de.query_id, dt.chunk_id, CAST(de.rank AS INTEGER) AS rank, round(dt.score, 6) AS score FROM de JOIN dt ON dt.query_id = de.query_id AND dt.rank = de.old""")
def deduplicated_results(spark: SparkSession, d: str) -> DataFrame:
    found = _strategy(spark, d, "cosine").retrieve(queries_of(spark, d), 10)
    return _out(postprocess.deduplicate(found))


_EXPECTED_SQL = "x AS (SELECT q.query_id, q.query, coalesce(list(c.content_id ORDER BY c.content_id) FILTER (c.content_id IS NOT NULL), []) AS expected FROM q LEFT JOIN c ON contains(c.content_md, q.query) GROUP BY ALL), xc AS (SELECT *, CASE WHEN len(expected) = 0 THEN 'negative' WHEN len(expected) = 1 THEN 'easy' ELSE 'cross' END AS category FROM x)"
_METRICS_SQL = f"""{_DENSE_SQL}, {_EXPECTED_SQL}, got AS (SELECT query_id, list(chunk_id ORDER BY rank) AS ids FROM dense WHERE rank <= 5 GROUP BY query_id),
 m AS (SELECT query_id, category, CASE WHEN len(expected) = 0 THEN 0 ELSE len(list_filter(expected, lambda e: list_contains(ids, e))) / len(expected) END AS recall,
  CASE WHEN len(ids) = 0 THEN 0 ELSE len(list_filter(ids, lambda i: list_contains(expected, i))) / len(ids) END AS precision,
  coalesce(1.0 / list_min(list_filter(list_transform(ids, lambda i, p: CASE WHEN list_contains(expected, i) THEN p END), lambda p: p IS NOT NULL)), 0) AS mrr FROM xc JOIN got USING (query_id))"""


def eval_queries(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark passages with the contents that hold them."""
    q = queries_of(spark, d)
    hits = evaluation.holding(contents_of(spark, d), q).groupBy("query_id").agg(F.array_sort(F.collect_list("content_id")).alias("expected"))
    rows = q.join(hits, "query_id", "left").withColumn("expected", F.coalesce("expected", F.array().cast("array<string>")))
    return rows.withColumn("category", F.when(F.size("expected") == 0, "negative").when(F.size("expected") == 1, "easy").otherwise("cross"))


@query(f"WITH {CONTENTS_SQL}, q AS (SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark), {_EXPECTED_SQL} SELECT category, min(CAST(query_id AS BIGINT)) AS first, count(*) AS queries FROM xc GROUP BY category")
def eval_categories(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.categories(eval_queries(spark, d).withColumn("position", F.col("query_id").cast("long")))


@query(f"WITH {_METRICS_SQL} SELECT query_id, category, round(recall, 6) AS recall, round(precision, 6) AS precision, round(mrr, 6) AS mrr FROM m")
def metrics_per_query(spark: SparkSession, d: str) -> DataFrame:
    q = eval_queries(spark, d)
    found = evaluation.per_query(_strategy(spark, d, "cosine").retrieve(queries_of(spark, d)), q)
    return found.select("query_id", "category", *(F.round(c, 6).alias(c) for c in ("recall", "precision", "mrr")))


@query(f"WITH {_METRICS_SQL} SELECT category, count(*) AS queries, round(avg(recall), 6) AS recall, round(avg(precision), 6) AS precision, round(avg(mrr), 6) AS mrr, CAST(grouping(category) AS INTEGER) AS is_overall FROM m GROUP BY GROUPING SETS ((), (category))")
def eval_rollup(spark: SparkSession, d: str) -> DataFrame:
    q = eval_queries(spark, d)
    by_query = evaluation.per_query(_strategy(spark, d, "cosine").retrieve(queries_of(spark, d)), q).withColumn("collection", F.lit("c")).withColumn("strategy", F.lit("cosine"))
    total = evaluation.rollup(by_query)
    return total.select("category", "queries", *(F.round(c, 6).alias(c) for c in ("recall", "precision", "mrr")), F.col("is_overall").cast("int").alias("is_overall"))


@query(f"WITH {_METRICS_SQL} SELECT s.collection, 'cosine' AS strategy, s.status, n AS chunk_count, queries, recall, precision, mrr FROM (SELECT 'contents' AS collection, 'ok' AS status, (SELECT count(*) FROM c) AS n UNION ALL SELECT 'empty', 'empty', 0 UNION ALL SELECT 'unknown', 'not_found', 0) s LEFT JOIN (SELECT 'contents' AS collection, count(*) AS queries, round(avg(recall), 6) AS recall, round(avg(precision), 6) AS precision, round(avg(mrr), 6) AS mrr FROM m) t USING (collection)")
def eval_status(spark: SparkSession, d: str) -> DataFrame:
    """An evaluation over collections in a store, one of them empty and one that isn't there."""
    store = ready(spark, d).store
    if not store.exists("empty"):
        store.replace("empty", store.read(COLLECTION).limit(0))
    combos = [f"{name}__cosine" for name in (COLLECTION, "empty", "unknown")]
    by_query, combined = evaluation.evaluate(store, eval_queries(spark, d), combos, model=lambda _: embedding.WHOLE_MODEL)
    found = evaluation.with_status(combined, evaluation.rollup(by_query))
    return found.select("collection", "strategy", "status", "chunk_count", "queries", *(F.round(c, 6).alias(c) for c in ("recall", "precision", "mrr")))


@query("SELECT conv_id, array_to_string(list(role ORDER BY first), ',') AS roles FROM (SELECT conv_id, role, min(turn) AS first FROM conversations WHERE role <> '' GROUP BY ALL) GROUP BY conv_id")
def unique_ids(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x.role).alias("roles"))
    return turns.select("conv_id", F.array_join(M.unique_ids(F.col("roles")), ",").alias("roles"))


# --- collections, backups, generation


@query(f"WITH {CONTENTS_SQL} SELECT content_id AS id, content_id, CASE WHEN newsletter_id % 3 = 0 THEN 'new' ELSE 'old' END AS document FROM c WHERE newsletter_id % 2 = 0 OR newsletter_id % 3 = 0")
def collection_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = contents_of(spark, d).select(F.col("content_id").alias("id"), "content_id", "newsletter_id")
    old = rows.where("newsletter_id % 2 = 0").select("id", "content_id", F.lit("old").alias("document"))
    return upserted(old, rows.where("newsletter_id % 3 = 0").select("id", "content_id", F.lit("new").alias("document")))


def _own_store(spark: SparkSession) -> Store:
    return Store(spark, f"{shared_dir(spark)}/store-{uuid.uuid4().hex}")


def _stamped(rows: DataFrame, text: str) -> DataFrame:
    return rows.select("id", "content_id", F.concat(F.lit(f"{text}:"), F.md5(F.col("document").cast("binary"))).alias("document"))


_STORED_SQL = f"WITH {CONTENTS_SQL}, o AS (SELECT content_id, newsletter_id AS n, md5(coalesce(content_md, '')) AS m FROM c) SELECT content_id AS id, content_id, CASE WHEN n % 3 = 0 THEN 'new:' ELSE 'old:' END || m AS document FROM o WHERE (n % 2 = 0 OR n % 3 = 0) AND n % 5 <> 0"


def _changed_store(spark: SparkSession, d: str) -> Store:
    """A collection that was written, changed and thinned out; a batch that came again left no trace."""
    store, rows = _own_store(spark), corpus(spark, d).withColumn("n", F.substring_index("content_id", "::", -1).cast("long"))
    store.upsert("a", _stamped(rows.where("n % 2 = 0"), "old"), ("stream", 0))
    store.upsert("a", _stamped(rows.where("n % 2 = 0"), "again"), ("stream", 0))
    store.upsert("a", _stamped(rows.where("n % 3 = 0"), "new"), ("stream", 1))
    store.delete("a", rows.where("n % 5 = 0"))
    return store


@query(_STORED_SQL)
def stored_collection(spark: SparkSession, d: str) -> DataFrame:
    return _changed_store(spark, d).read("a")


@query(f"{_STORED_SQL} AND n % 7 = 0")
def stored_contents(spark: SparkSession, d: str) -> DataFrame:
    """The keyed scan: rows of some contents, by id."""
    wanted = corpus(spark, d).select("content_id").where(F.substring_index("content_id", "::", -1).cast("long") % 7 == 0)
    return by_content(_changed_store(spark, d).read("a"), wanted)


@query(f"SELECT 'a' AS collection, 3 AS version, count(*) AS chunk_count FROM ({_STORED_SQL})")
def stored_listing(spark: SparkSession, d: str) -> DataFrame:
    """What the manifests say: name, version (the batch that came again made none) and number of rows."""
    return _changed_store(spark, d).listing().select("collection", F.col("version").cast("int").alias("version"), "chunk_count")


@query("SELECT 'src' || i AS collection FROM range(30) t(i) WHERE 'src' || i NOT IN (SELECT source FROM documents)")
def missing_collections(spark: SparkSession, d: str) -> DataFrame:
    wanted = spark.range(30).select(F.concat(F.lit("src"), F.col("id").cast("string")).alias("collection"))
    return evaluation.missing(wanted, table(spark, d, "documents").select(F.col("source").alias("collection")))


@query("SELECT source AS source_key, count(*) AS contents FROM documents GROUP BY source")
def collection_counts(spark: SparkSession, d: str) -> DataFrame:
    return contents_of(spark, d).groupBy("source_key").agg(F.count(F.lit(1)).alias("contents"))


@query("SELECT DISTINCT o_orderdate::DATE::VARCHAR AS name FROM orders WHERE o_orderdate::DATE::VARCHAR NOT IN (SELECT DISTINCT o_orderdate::DATE::VARCHAR AS n FROM orders ORDER BY n DESC LIMIT 7)")
def retention_victims(spark: SparkSession, d: str) -> DataFrame:
    return backup.victims(table(spark, d, "orders").select(F.to_date("o_orderdate").cast("string").alias("name")).distinct())


@query("SELECT count(*) FILTER (s = 'ok') AS ok, count(*) FILTER (s <> 'ok') AS not_found, CAST(sum(n) FILTER (s = 'ok') AS BIGINT) AS total_bytes FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN 'not_found' ELSE 'ok' END AS s, n_chars AS n FROM documents)")
def backup_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.when(F.col("doc_id") % 3 == 0, "not_found").otherwise("ok").alias("status"), F.col("n_chars").alias("size_bytes"))
    return backup.backup_summary(rows).drop("total_size")


def _echo(model: str) -> Callable[[list[dict]], str]:
    return lambda said: f"{model}:{len(said)}:{len(said[-1]['content'])}"


@query("SELECT conv_id, turn, 'gpt-4.1-mini:2:' || length(text) AS response FROM conversations")
def llm_generate(spark: SparkSession, d: str) -> DataFrame:
    prompts = table(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("prompt"))
    return generation.generate(prompts, _echo, "be brief").drop("prompt")


@query("SELECT conv_id, turn, CAST(length(text) AS BIGINT) AS chars FROM conversations")
def llm_generate_structured(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import types as T

    prompts = table(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("prompt"))
    schema = T.StructType([T.StructField("chars", T.LongType(), False)])
    return generation.generate_structured(prompts, schema, lambda _: lambda said: f'{{"chars": {len(said[-1]["content"])}}}').select("conv_id", "turn", "result.chars")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Contents to fixed chunks, embedded and searched for every benchmark passage, with recall and MRR by category."""
    items = contents.work_items(contents_of(spark, d))
    rows = embedding.embed_records(chunking.chunk_records(items, "fixed"), embedding.WHOLE_MODEL)
    q = eval_queries(spark, d)
    by_query = evaluation.per_query(retrieval.Cosine(rows, embedding.WHOLE_MODEL).retrieve(queries_of(spark, d)), q).withColumn("collection", F.lit("fixed")).withColumn("strategy", F.lit("cosine"))
    return evaluation.rollup(by_query)
