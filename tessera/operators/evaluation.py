"""Evaluation of retrieval results against expected contents, and its roll-ups."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import EVAL_COMBOS, model_of_collection, parse_combo
from ..functions import metrics as M
from .retrieval import K, build_strategy


def preflight(queries: DataFrame, existing: Iterable[str], combos: Iterable[str] = EVAL_COMBOS) -> list[str]:
    """The collections that combos name and that are missing. Without queries, or with all missing, it raises."""
    if queries.isEmpty():
        raise ValueError("there are no evaluation queries")
    wanted = {parse_combo(c)[0] for c in combos}
    missing = sorted(wanted - set(existing))
    if missing and len(missing) == len(wanted):
        raise ValueError(f"none of the collections exists: {', '.join(missing)}")
    return missing


def missing(wanted: DataFrame, existing: DataFrame, name: str = "collection") -> DataFrame:
    """Names that are wanted and not there, each once."""
    return wanted.select(name).distinct().join(existing.select(name).distinct(), name, "left_anti")


def categories(queries: DataFrame, position: str = "position") -> DataFrame:
    """category, first (the least position of its queries) and queries: each category once, to be sorted by first."""
    return queries.groupBy("category").agg(F.min(position).alias("first"), F.count(F.lit(1)).alias("queries"))


def unresolved(queries: DataFrame, contents: DataFrame) -> DataFrame:
    """query_id and content_id of expected contents that aren't there: no retrieval can find these."""
    wanted = queries.select("query_id", F.explode("expected").alias("content_id")).distinct()
    return wanted.join(contents.select("content_id").distinct(), "content_id", "left_anti").select("query_id", "content_id")


#: Bytes of queries' texts that one pass over contents looks for; more take more passes.
NEEDLES = 1 << 24


def holding(contents: DataFrame, queries: DataFrame, text: str = "content_md") -> DataFrame:
    """query_id and content_id wherever a content's text holds the whole text of a query, each pair once.

    A pass reads each text once, whatever the number of queries: an automaton of at most NEEDLES bytes of queries, made
    in each task, finds all of them in linear time. Null texts hold nothing and are held by nothing; an empty query is
    held by every text.
    """
    q = queries.select(F.col("query_id").cast("string").alias("query_id"), "query").where("query_id is not null and query is not null")
    packs = max(1, math.ceil((q.agg(F.sum(F.octet_length("query")).alias("bytes")).first().bytes or 0) / NEEDLES))
    rows = contents.select("content_id", text).where(F.col(text).isNotNull())
    parts = []
    for p in range(packs):
        wanted: dict[str, list[str]] = {}
        for r in q.where(F.pmod(F.xxhash64("query_id"), F.lit(packs)) == p).collect():
            wanted.setdefault(r.query, []).append(r.query_id)
        parts.append(rows.mapInArrow(_found(contents.sparkSession.sparkContext.broadcast(wanted)), "query_id string, content_id string"))
    return reduce(DataFrame.unionByName, parts)


def _found(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        wanted = shared.value
        automaton = ahocorasick.Automaton()
        for t in wanted:
            if t:
                automaton.add_word(t, t)
        automaton.make_automaton()
        for batch in batches:
            ids, held = [], []
            for content, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hits = {t for _, t in automaton.iter(text)} if len(automaton) else set()
                if "" in wanted:
                    hits.add("")
                own = {i for t in hits for i in wanted[t]}
                ids += own
                held += [content] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(held, pa.string())], names=["query_id", "content_id"])

    return run


def per_query(results: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """recall, precision and mrr of each query; one without results gets empty lists.

    Chunks become contents first: repeats go, so fewer than k ids may be left.
    """
    ids = results.groupBy("query_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "content_id"))), lambda x: x.content_id).alias("ids"))
    rows = queries.join(ids, "query_id", "left").withColumn("retrieved", M.unique_ids(F.coalesce("ids", F.array().cast("array<string>"))))
    got, want = F.col("retrieved"), F.col("expected")
    return rows.select("query_id", "query", "category", M.recall_at(got, want, k).alias("recall"), M.precision_at(got, want, k).alias("precision"), M.reciprocal_rank(got, want).alias("mrr"), "retrieved", "expected")


def evaluate(store, queries: DataFrame, combos: Iterable[str] = EVAL_COMBOS, k: int = K, model: Callable[[str], str] = model_of_collection) -> tuple[DataFrame, DataFrame]:  # noqa: ANN001
    """All combos: metrics by query (collection, strategy, ...), and status by combo: ok, not_found or empty.

    Each combo answers all queries in one plan; the plans run as one union. model: the embedder of a collection, by name.
    """
    spark = queries.sparkSession
    status, parts = [], []
    sizes: dict[str, int] = {}
    for combo in combos:
        collection, strategy = parse_combo(combo)
        if not store.exists(collection):
            status.append((collection, strategy, "not_found", 0))
            continue
        rows = store.read(collection)
        if collection not in sizes:
            sizes[collection] = store.count(collection)
        if not sizes[collection]:
            status.append((collection, strategy, "empty", 0))
            continue
        status.append((collection, strategy, "ok", sizes[collection]))
        found = build_strategy(rows, strategy, model(collection)).retrieve(queries, k)
        parts.append(per_query(found, queries, k).withColumn("collection", F.lit(collection)).withColumn("strategy", F.lit(strategy)))
    combos_df = spark.createDataFrame(status, "collection string, strategy string, status string, chunk_count long")
    if not parts:
        empty = "query_id string, query string, category string, recall double, precision double, mrr double, retrieved array<string>, expected array<string>, collection string, strategy string"
        return spark.createDataFrame([], empty), combos_df
    return reduce(DataFrame.unionByName, parts), combos_df


def rollup(by_query: DataFrame) -> DataFrame:
    """Means over all queries (category null) and over each category, for every combo, from one pass."""
    sets = [["collection", "strategy"], ["collection", "strategy", "category"]]
    grouped = by_query.groupingSets([[F.col(c) for c in s] for s in sets], F.col("collection"), F.col("strategy"), F.col("category"))
    return grouped.agg(F.count(F.lit(1)).alias("queries"), *(F.avg(c).alias(c) for c in ("recall", "precision", "mrr")), F.grouping("category").alias("is_overall"))


def with_status(combos: DataFrame, totals: DataFrame) -> DataFrame:
    """Every combo with its status; metrics only for those that ran."""
    return combos.join(totals.where("is_overall = 1").drop("is_overall", "category"), ["collection", "strategy"], "left")
