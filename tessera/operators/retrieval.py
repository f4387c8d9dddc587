"""Retrieval strategies for whole sets of queries at once: (collection, queries, k) to ranked results.

Results are query_id, rank (from 1), chunk_id, content_id, document, score, metadata. Every ranking has a last tie-break
by chunk id, which stands for the order of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.shared import stage
from .embedding import DEFAULT_MODEL, embed
from .lexical_index import BlockIndex
from .vector_index import VectorIndex

K, FACTOR, RRF_K = 5, 4, 60
K1, B, EPSILON = 1.5, 0.75, 0.25
#: Queries that one pass over a collection answers; more take more passes.
PACK = 2048


class Retriever(Protocol):
    name: str

    def retrieve(self, queries: DataFrame, k: int = K) -> DataFrame: ...


def ranked(scored: DataFrame, k: int, *order: Column, by: str = "query_id") -> DataFrame:
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)


# --- dense


def vector_topk(rows: DataFrame, queries: DataFrame, k: int, id_column: str = "id", vector: str = "embedding", query_vector: str = "embedding") -> DataFrame:
    """The k rows nearest to each query by cosine, exactly: query_id, id, score, rank.

    A pass over the rows holds at most PACK query vectors in each worker, multiplies batch by batch and keeps k rows a
    query and task; only those meet in the ranking. Rows or queries of length zero score 0. A query meets the rows whose
    vectors have as many components; vectors that are null or hold a null take no part. Each row of queries has a list of
    its own, whatever its query_id.
    """
    spark = rows.sparkSession
    whole = lambda c: F.coalesce(~F.exists(c, lambda x: x.isNull()), F.lit(False))
    queries = queries.select("query_id", F.col(query_vector).alias("v")).where(whole("v"))
    kind = rows.schema[id_column].dataType.simpleString()
    found = None
    first = queries.limit(PACK + 1).collect()
    packs = 1 if len(first) <= PACK else math.ceil(queries.count() / PACK)
    for p in range(packs):
        got = first if packs == 1 else queries.where(F.pmod(F.xxhash64("query_id"), F.lit(packs)) == p).collect()
        for size in sorted({len(r.v) for r in got}):
            own = [r for r in got if len(r.v) == size]
            named = np.array([f"{p}/{size}/{i}" for i in range(len(own))], dtype=object), np.array([r.query_id for r in own], dtype=object)
            shared = spark.sparkContext.broadcast((*named, unit_rows(np.array([r.v for r in own], dtype=np.float64))))
            alike = rows.select(id_column, vector).where(whole(vector) & (F.size(vector) == size))
            part = alike.mapInArrow(_scan(shared, k), f"q string, query_id string, {id_column} {kind}, score double")
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"query_id string, {id_column} {kind}, score double, rank int")
    return ranked(found, k, F.col("score").desc(), F.col(id_column), by="q").drop("q")


def unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _scan(shared, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, names, q = shared.value
        ids: list = [np.zeros(0, dtype=object)] * len(q)
        scores: list = [np.zeros(0)] * len(q)
        schema = None
        for batch in batches:
            schema = batch.schema
            for a in range(0, batch.num_rows, 4096):
                part = batch.slice(a, 4096)
                v = unit_rows(part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, -1))
                s = np.round(q @ v.T, 12)  # equal vectors score alike wherever they stand in a batch
                own = np.array(part.column(0).to_pylist(), dtype=object)
                for i in range(len(q)):
                    at = np.flatnonzero(s[i] >= scores[i][-1]) if len(scores[i]) == k else np.arange(s.shape[1])
                    if len(at):
                        both, who = np.concatenate([scores[i], s[i][at]]), np.concatenate([ids[i], own[at]])
                        order = sorted(range(len(both)), key=lambda j: (-both[j], who[j]))[:k] if len(both) < 4 * k else _first(both, who, k)
                        scores[i], ids[i] = both[order], who[order]
        if schema is not None:
            n = [len(x) for x in ids]
            named = [pa.array(np.repeat(x, n).tolist(), pa.string()) for x in (keys, names)]
            yield pa.RecordBatch.from_arrays([*named, pa.array(np.concatenate(ids).tolist(), schema.field(0).type), pa.array(np.concatenate(scores))], names=["q", "query_id", schema.field(0).name, "score"])

    return run


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> list[int]:
    edge = np.partition(-scores, k - 1)[k - 1]
    at = np.flatnonzero(-scores <= edge)
    return sorted(at, key=lambda j: (-scores[j], ids[j]))[:k]


def result_columns(top: DataFrame, collection: DataFrame, few: bool = False) -> DataFrame:
    """query_id, rank, chunk_id, score with the document and metadata of the chunk; the collection's embeddings aren't read.

    few: top answers at most PACK queries and all its chunks are in the collection. Then it's broadcast to the scan of the
    collection, and no text is shuffled.
    """
    docs = collection.select(F.col("id").alias("chunk_id"), "content_id", "document", "metadata")
    joined = docs.join(F.broadcast(top), "chunk_id") if few else top.join(docs, "chunk_id", "left")
    return joined.select(
        "query_id", F.col("rank").cast("int").alias("rank"), "chunk_id", F.coalesce("content_id", F.lit("")).alias("content_id"), F.coalesce("document", F.lit("")).alias("document"), "score", "metadata"
    )


def are_few(queries: DataFrame) -> bool:
    return queries.limit(PACK + 1).count() <= PACK


class Cosine:
    """texts: the collection's rows without embeddings, where reading them from the collection would compute these again."""

    name = "cosine"

    def __init__(self, collection: DataFrame, model: str = DEFAULT_MODEL, texts: DataFrame | None = None):
        self.collection, self.model, self.texts = collection, model, collection if texts is None else texts

    def top(self, queries: DataFrame, k: int) -> DataFrame:
        q = embed(queries.select("query_id", "query"), "query", self.model, kind="double")
        return vector_topk(self.collection, q, k).select("query_id", F.col("id").alias("chunk_id"), "score", "rank")

    def retrieve(self, queries: DataFrame, k: int = K) -> DataFrame:
        return result_columns(self.top(queries, k), self.texts, are_few(queries))


class Indexed:
    """Cosine by a vector index, for few queries: only the lists and the collection's buckets that they need are read.

    read: content ids to the collection's rows, as Store.read takes them.
    """

    name = "indexed"

    def __init__(self, index: VectorIndex, read: Callable[[list[str]], DataFrame], model: str = DEFAULT_MODEL):
        self.index, self.read, self.model = index, read, model

    def retrieve(self, queries: DataFrame, k: int = K) -> DataFrame:
        q = embed(queries.select("query_id", "query"), "query", self.model, kind="double")
        top = stage(self.index.top(q, k).withColumnRenamed("id", "chunk_id"), "top")
        if not are_few(queries):
            raise ValueError(f"more than {PACK} queries; a scan of the collection answers them faster")
        contents = [r.content_id for r in top.select("content_id").distinct().collect()]  # at most k a query
        return result_columns(top.drop("content_id"), self.read(contents), True)


# --- lexical


class LexicalIndex:
    """Postings and statistics of a collection, as tables that many queries share.

    postings: term, chunk_id, tf, dl; terms: term, df, idf; stats: one row, joined by scalar subqueries. `write` keeps
    them beside the collection, postings sorted by term, so that a query's scan skips row groups.
    """

    def __init__(self, ids: DataFrame, postings: DataFrame, terms: DataFrame, stats: DataFrame):
        self.ids, self.postings, self.terms, self.stats = ids, postings, terms, stats

    @classmethod
    def build(cls, collection: DataFrame, id_column: str = "id", text_column: str = "document") -> LexicalIndex:
        """Texts are read once: postings are kept (memory, else disk) for the statistics and for all queries that follow."""
        ids = collection.select(F.col(id_column).alias("chunk_id"))
        tokens = collection.select(F.col(id_column).alias("chunk_id"), X.tokens(F.coalesce(text_column, F.lit(""))).alias("t")).withColumn("dl", F.size("t"))
        postings = tokens.select("chunk_id", "dl", F.explode("t").alias("term")).groupBy("term", "chunk_id", "dl").agg(F.count(F.lit(1)).alias("tf")).persist()
        n = ids.agg(F.count(F.lit(1)).alias("n"))
        stats = postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("tokens")).select(n.scalar().alias("n"), F.try_divide("tokens", n.scalar()).alias("avgdl"))
        raw = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")).withColumn("raw", F.ln(stats.select("n").scalar() - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5))
        terms = raw.select("term", "df", F.when(F.col("raw") < 0, F.lit(EPSILON) * raw.agg(F.avg("raw")).scalar()).otherwise(F.col("raw")).alias("idf"))
        return cls(ids, postings, terms, stats)

    def write(self, path: str) -> None:
        self.postings.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/postings")
        for name in ("ids", "terms", "stats"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> LexicalIndex:
        return cls(*(spark.read.parquet(f"{path}/{name}") for name in ("ids", "postings", "terms", "stats")))

    def _parts(self, queries: DataFrame) -> DataFrame:
        """What each term adds to a chunk's score. A repeated query token counts again."""
        wanted = queries.select("query_id", F.explode(X.tokens(F.col("query"))).alias("term")).groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("qf"))
        avgdl = self.stats.select("avgdl").scalar()
        part = F.col("qf") * F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avgdl))
        return wanted.join(self.terms, "term").join(self.postings, "term").select("query_id", "chunk_id", part.alias("part"))

    def scores(self, queries: DataFrame) -> DataFrame:
        """query_id, chunk_id, score of the chunks that share a token with a query."""
        return self._parts(queries).groupBy("query_id", "chunk_id").agg(F.sum("part").alias("score"))

    def top(self, queries: DataFrame, n: int) -> DataFrame:
        """Always n chunks a query where the corpus has them: those without a shared token score 0 and come in corpus order.

        Only the first n chunks of the corpus can fill a list up, so only these get a part of 0, before the one sum.
        """
        first = [r.chunk_id for r in self.ids.orderBy("chunk_id").limit(n).collect()]
        fill = queries.select("query_id", F.explode(F.array(*(F.lit(x) for x in first)) if first else F.array().cast("array<string>")).alias("chunk_id"), F.lit(0.0).alias("part"))
        scored = self._parts(queries).unionByName(fill).groupBy("query_id", "chunk_id").agg(F.round(F.sum("part"), 9).alias("score"))
        return ranked(scored, n, F.col("score").desc(), F.col("chunk_id"))


# --- fusion and reranking


def fuse(rankings: list[DataFrame], k: int, rrf_k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of rankings (query_id, chunk_id, rank). Ties: by place in the first ranking, then the next ones."""
    from functools import reduce

    tagged = [r.select("query_id", "chunk_id", F.col("rank").alias("r"), F.lit(i).alias("source")) for i, r in enumerate(rankings)]
    places = [F.min(F.when(F.col("source") == i, F.col("r"))).alias(f"place_{i}") for i in range(len(rankings))]
    fused = reduce(DataFrame.unionByName, tagged).groupBy("query_id", "chunk_id").agg(F.sum(F.lit(1.0) / (rrf_k + F.col("r"))).alias("score"), *places)
    return ranked(fused, k, F.col("score").desc(), *(F.col(f"place_{i}").asc_nulls_last() for i in range(len(rankings))), F.col("chunk_id")).select("query_id", "chunk_id", "score", "rank")


class Hybrid:
    name = "hybrid"

    def __init__(self, collection: DataFrame, model: str = DEFAULT_MODEL, factor: int = FACTOR, rrf_k: int = RRF_K, lexical: LexicalIndex | BlockIndex | None = None, texts: DataFrame | None = None, in_step: bool = False):
        """in_step: the index that is handed in names no chunk that the collection lacks."""
        self.collection, self.dense, self.factor, self.rrf_k = collection, Cosine(collection, model, texts), factor, rrf_k
        self.own, self.lexical = lexical is None or in_step, lexical or LexicalIndex.build(self.dense.texts)

    def top(self, queries: DataFrame, k: int) -> DataFrame:
        n = self.factor * k
        return fuse([self.dense.top(queries, n), self.lexical.top(queries, n)], k, self.rrf_k)

    def retrieve(self, queries: DataFrame, k: int = K) -> DataFrame:
        return result_columns(self.top(queries, k), self.dense.texts, self.own and are_few(queries))


def lexical_overlap(query: Column, document: Column) -> Column:
    """The share of the query's distinct tokens that the document has; 0 for a query without any."""
    wanted = F.array_distinct(X.tokens(query))
    return F.when(F.size(wanted) == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(wanted, X.tokens(document))) / F.size(wanted))


class Rerank:
    """A wider inner ranking, scored again pair by pair. scorer: (query, document) columns to a double column."""

    def __init__(self, inner: Retriever, scorer: Callable[[Column, Column], Column] = lexical_overlap, factor: int = FACTOR):
        self.inner, self.scorer, self.factor = inner, scorer, factor
        self.name = f"rerank({inner.name})"

    def retrieve(self, queries: DataFrame, k: int = K) -> DataFrame:
        wide = self.inner.retrieve(queries, self.factor * k).withColumnRenamed("rank", "inner_rank")
        scored = wide.join(queries.select("query_id", "query"), "query_id").withColumn("score", self.scorer(F.col("query"), F.col("document")))
        return ranked(scored, k, F.col("score").desc(), F.col("inner_rank")).select("query_id", F.col("rank").cast("int").alias("rank"), "chunk_id", "content_id", "document", "score", "metadata")


class HyDE:
    """Retrieval by a made-up answer: write(queries) must return them with `query` replaced by what a model wrote."""

    def __init__(self, inner: Retriever, write: Callable[[DataFrame], DataFrame] | None = None):
        self.inner, self.write, self.name = inner, write, f"hyde({inner.name})"

    def retrieve(self, queries: DataFrame, k: int = K) -> DataFrame:
        if self.write is None:
            raise NotImplementedError("needs a function that writes the answers")
        return self.inner.retrieve(self.write(queries), k)


class MultiQuery:
    """Rank fusion over variants of each query: vary(queries) must return query_id, variant (int) and query."""

    def __init__(self, inner: Retriever, vary: Callable[[DataFrame], DataFrame] | None = None, rrf_k: int = RRF_K):
        self.inner, self.vary, self.rrf_k, self.name = inner, vary, rrf_k, f"fusion({inner.name})"

    def retrieve(self, queries: DataFrame, k: int = K) -> DataFrame:
        if self.vary is None:
            raise NotImplementedError("needs a function that varies the queries")
        varied = self.vary(queries).withColumn("query_id", F.concat_ws("\x1f", F.col("variant").cast("string"), F.col("query_id")))
        found = self.inner.retrieve(varied, FACTOR * k).withColumn("query_id", F.substring_index(F.col("query_id"), "\x1f", -1))
        one = found.groupBy("query_id", "chunk_id").agg(F.sum(F.lit(1.0) / (self.rrf_k + F.col("rank"))).alias("score"), F.first("content_id").alias("content_id"), F.first("document").alias("document"), F.first("metadata").alias("metadata"))
        return ranked(one, k, F.col("score").desc(), F.col("chunk_id")).select("query_id", F.col("rank").cast("int").alias("rank"), "chunk_id", "content_id", "document", "score", "metadata")


STRATEGIES: dict[str, Callable[..., Retriever]] = {
    "cosine": Cosine,
    "hybrid": Hybrid,
    "rerank": lambda collection, model=DEFAULT_MODEL, **how: Rerank(Cosine(collection, model, **how)),
    "rerank_hybrid": lambda collection, model=DEFAULT_MODEL, **how: Rerank(Hybrid(collection, model, **how)),
}


def build_strategy(collection: DataFrame, spec: str = "cosine", model: str = DEFAULT_MODEL, **how) -> Retriever:  # noqa: ANN003
    if spec not in STRATEGIES:
        raise ValueError(f"Unknown retrieval strategy {spec!r}; there are {', '.join(sorted(STRATEGIES))}")
    return STRATEGIES[spec](collection, model, **how)


def search(collection: DataFrame, query: str, k: int = K, model: str = DEFAULT_MODEL) -> DataFrame:
    """One ad-hoc query: url, title, author, chunk, distance, nearest first."""
    queries = collection.sparkSession.sql("SELECT 'q' AS query_id, :q AS query", args={"q": query})
    found = Cosine(collection, model).retrieve(queries, k)
    return found.orderBy("rank").select(*(F.coalesce(F.col(f"metadata.{c}"), F.lit("")).alias(c) for c in ("url", "title", "author")), F.col("document").alias("chunk"), (1 - F.col("score")).alias("distance"))
