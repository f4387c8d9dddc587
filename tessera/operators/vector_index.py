"""A vector index in files, searched list by list with an exact stop.

    <path>/centres   list, dim, centre, low, high, n: a row for each list, at most LISTS of them
    <path>/heads     list, ring, number, low, high, n: a row for each block
    <path>/blocks    list= folders of blocks: ids, contents and vectors of about BLOCK rows

Vectors at length 1 belong to the list with the nearest centre (fitted on a bounded sample; centres place rows and change
no result) and, by their distance from it, to one of its rings; a ring's rows are dealt to blocks. Lists, rings and blocks know
their least and largest distance. By the triangle inequality a vector whose distance from the centre is d is at least
|gap - d| away from a query which is gap away from the centre, and by that a list or block has a highest cosine.

A query first reads the lists nearest to it that hold k rows. Of all others only blocks are read whose highest
cosine reaches the kth that it has then, so nothing that could be among its k is left out. Queries stay rows: they meet the
centres (at most LISTS rows in each worker), then heads, then blocks, in packs by block. The driver sees only the numbers of
the lists that anyone asks for, so that the scan of blocks opens these lists' files and no others.

Vectors without length have a list of their own, with cosine 0 to everything; so has a query without length, which so
reads all lists. A query meets vectors of its own length; vectors that are null, empty, or hold a null take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import stage, unstage

LISTS, SAMPLE, ROUNDS, SEED = 1024, 8192, 6, 5
BLOCK, RINGS, PACK = 1024, 32, 256
#: More than rounding can take from a cosine.
SLACK = 1e-9
KEYS = ("list", "ring", "number")


def unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def fitted(sample: np.ndarray, lists: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(ROUNDS):
        own = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        n = np.bincount(own, minlength=len(centres))[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)


def matrix(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype="<f8").reshape(len(cells), -1)


def whole(column: str):  # noqa: ANN201
    return F.coalesce(~F.exists(column, lambda x: x.isNull()) & (F.size(column) > 0), F.lit(False))


def highest(gap, low, high):  # noqa: ANN001, ANN201
    """The highest cosine of a query with rows whose distances from a centre are between low and high, as a column."""
    away = F.greatest(gap - high, low - gap, F.lit(0.0))
    return 1 - away * away / 2


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.centres, self.heads, self.blocks = (spark.read.parquet(f"{self.path}/{name}") for name in ("centres", "heads", "blocks"))

    @classmethod
    def build(cls, rows: DataFrame, path: str, lists: int | None = None, id_column: str = "id", vector: str = "embedding") -> VectorIndex:
        """rows: an id, an array of numbers, and content_id where there is one. lists: a number for a sample's share, else by the number of rows."""
        spark, path = rows.sparkSession, path.rstrip("/")
        content = F.col("content_id") if "content_id" in rows.columns else F.lit(None).cast("string")
        good = stage(rows.where(whole(vector)).select(F.col(id_column).alias("id"), content.alias("content_id"), F.col(vector).cast("array<double>").alias("v")), "vectors")
        n = good.count()
        lists = min(LISTS, lists or max(1, int(n**0.5 / 2)))
        chosen = [np.array(r.v) for r in good.orderBy(F.xxhash64("id")).limit(SAMPLE).select("v").collect()]
        centres: dict[int, np.ndarray] = {}
        for dim in sorted({len(v) for v in chosen}):
            sample = unit_rows(np.array([v for v in chosen if len(v) == dim], dtype=np.float64))
            sample = sample[sample.any(axis=1)]
            if len(sample):
                centres[dim] = fitted(sample, max(1, lists * len(sample) // len(chosen)))
        first, at = {}, 0
        for dim, own in centres.items():
            first[dim], at = at, at + len(own)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """list, ring and distance; -1 for rows without length, -2 for those of a length that has no centre."""
            for batch in batches:
                ends, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(zero_copy_only=False)
                dims = np.diff(ends).astype(np.int32)
                own, away = np.full(len(dims), -2, dtype=np.int32), np.zeros(len(dims))
                data = [flat[a:z].astype("<f8").tobytes() for a, z in zip(ends[:-1], ends[1:], strict=True)]
                for dim in np.unique(dims):
                    at = np.flatnonzero(dims == dim)
                    u = unit_rows(matrix([data[i] for i in at]))
                    if dim in centres:
                        near = nearest(u, centres[dim])
                        own[at], away[at] = near + first[dim], np.sqrt(((u - centres[dim][near]) ** 2).sum(axis=1))
                    own[at[~u.any(axis=1)]], away[at[~u.any(axis=1)]] = -1, 0
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(dims), pa.array(own), pa.array(away), pa.array(data, pa.binary())], names=["id", "content_id", "dim", "list", "away", "v"])

        kind = good.schema["id"].dataType.simpleString()
        placed = good.mapInArrow(place, f"id {kind}, content_id string, dim int, list int, away double, v binary")
        placed = stage(placed.withColumn("ring", F.least(F.floor(F.col("away") * (RINGS / 2)), F.lit(RINGS)).cast("int")), "placed")
        # at most RINGS + 1 rows for each list and length
        sizes = placed.groupBy("dim", "list", "ring").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
        dealt = placed.join(F.broadcast(sizes), ["dim", "list", "ring"]).withColumn("number", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        ends = (F.min("away").alias("low"), F.max("away").alias("high"), F.count(F.lit(1)).alias("n"))
        blocks = dealt.groupBy("dim", *KEYS).agg(F.collect_list(F.struct("id", "content_id", "v")).alias("rows"), *ends)
        blocks.repartition("list").write.mode("overwrite").partitionBy("list").parquet(f"{path}/blocks")
        written = spark.read.parquet(f"{path}/blocks").select("dim", *KEYS, "low", "high", "n")
        written.coalesce(8).write.mode("overwrite").parquet(f"{path}/heads")
        known = [(first[dim] + i, [float(x) for x in c]) for dim, own in centres.items() for i, c in enumerate(own)]
        made = spark.createDataFrame(known, "list int, centre array<double>")
        spans = written.groupBy("dim", "list").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        spans.join(F.broadcast(made), "list", "left").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")
        unstage(good, placed)
        return cls(spark, path)

    def _gaps(self, queries: DataFrame) -> DataFrame:
        """queries (q, dim, v) with each list of their length, and how far its centre is (null: a list without one, or a query without length)."""
        known: dict[int, list[tuple[int, list[float] | None]]] = {}
        for r in self.centres.collect():  # at most LISTS rows, and two for each length
            known.setdefault(r.dim, []).append((r.list, r.centre))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for q, dim, v in zip(*batch.columns, strict=True):
                    own = known.get(dim.as_py(), [])
                    u = unit_rows(matrix([v.as_py()]))
                    have = [i for i, (_, c) in enumerate(own) if c is not None and u.any()]
                    gap: list[float | None] = [None] * len(own)
                    if have:
                        for i, g in zip(have, np.sqrt(((np.array([own[i][1] for i in have]) - u) ** 2).sum(axis=1)), strict=True):
                            gap[i] = float(g)
                    yield pa.RecordBatch.from_arrays([pa.array([q.as_py()] * len(own), pa.int64()), pa.array([dim.as_py()] * len(own), pa.int32()), pa.array([n for n, _ in own], pa.int32()), pa.array(gap, pa.float64())], names=["q", "dim", "list", "gap"])

        return queries.select("q", "dim", "v").mapInArrow(run, "q long, dim int, list int, gap double").join(F.broadcast(self.centres.drop("centre")), ["dim", "list"])

    def _read(self, lists: list[int]) -> DataFrame:
        """The blocks in these lists' folders; no other folder is opened."""
        return self.blocks.where(F.col("list").isin(lists))

    def _scored(self, visits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
        """q, id, content_id and score: for each visit (q, KEYS) at most k rows."""
        lists = sorted(r.list for r in visits.select("list").distinct().collect())  # at most LISTS + 2 numbers
        kind = dict(self.blocks.select("rows.id").dtypes)["id"].removeprefix("array<").removesuffix(">")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for pack, block in zip(*batch.columns, strict=True):
                    p, b = pack.values, block.values
                    scores = np.round(unit_rows(matrix(p.field("v").to_pylist())) @ unit_rows(matrix(b.field("v").to_pylist())).T, 12)
                    ids = b.field("id").to_pylist()
                    order = sorted(range(len(ids)), key=ids.__getitem__)
                    top = np.argsort(-scores[:, order], axis=1, kind="stable")[:, :k]
                    rows = np.array(order)[top]
                    q = np.repeat(p.field("q").to_numpy(), rows.shape[1])
                    at = pa.array(rows.ravel())
                    yield pa.RecordBatch.from_arrays([pa.array(q), b.field("id").take(at), b.field("content_id").take(at), pa.array(np.take_along_axis(scores, rows, axis=1).ravel())], names=["q", "id", "content_id", "score"])

        asked = visits.join(queries.select("q", "dim", "v"), "q").withColumn("pack", F.pmod(F.xxhash64("q"), F.lit(max(1, -(-queries.count() // PACK)))))
        packs = asked.groupBy("dim", *KEYS, "pack").agg(F.collect_list(F.struct("q", "v")).alias("queries"))
        met = packs.join(self._read(lists).select("dim", *KEYS, "rows"), ["dim", *KEYS])
        return met.select("queries", "rows").mapInArrow(run, f"q long, id {kind}, content_id string, score double")

    def top(self, queries: DataFrame, k: int, query_vector: str = "embedding") -> DataFrame:
        """query_id, id, content_id, score and rank: the k rows nearest to each row of queries by cosine, ties by id."""
        asked = queries.where(whole(query_vector)).select("query_id", F.col(query_vector).cast("array<double>").alias("a"))
        asked = asked.withColumn("q", F.monotonically_increasing_id()).withColumn("dim", F.size("a"))
        asked = stage(asked.mapInArrow(_as_bytes, "query_id string, q long, dim int, v binary"), "queries")
        best = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
        ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        gaps = stage(self._gaps(asked), "gaps")
        nearer = Window.partitionBy("q").orderBy(F.col("gap").asc_nulls_last(), "list").rowsBetween(Window.unboundedPreceding, -1)
        close = gaps.withColumn("before", F.coalesce(F.sum("n").over(nearer), F.lit(0))).where(F.col("before") < k).select("q", "dim", "list")
        first = stage(ranked(self._scored(close.join(self.heads, ["dim", "list"]).select("q", *KEYS), asked, k)), "first")
        floors = first.where(F.col("rank") == k).select("q", F.col("score").alias("floor"))
        reach = F.coalesce("floor", F.lit(-2.0)) - SLACK
        cosine = F.when(F.col("gap").isNull() & (F.col("list") != -2), F.lit(0.0)).when(F.col("gap").isNull(), F.lit(1.0)).otherwise(highest(F.col("gap"), F.col("low"), F.col("high")))
        rest = gaps.join(close, ["q", "dim", "list"], "left_anti").join(floors, "q", "left").where(cosine >= reach).drop("low", "high", "n")
        rest = stage(rest.join(self.heads, ["dim", "list"]).where(cosine >= reach).select("q", *KEYS), "rest")
        found = first.drop("rank") if rest.isEmpty() else first.drop("rank").unionByName(self._scored(rest, asked, k))
        return ranked(found).join(asked.select("q", "query_id"), "q").select("query_id", "id", "content_id", "score", F.col("rank").cast("int").alias("rank"))


def _as_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends, flat = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy(zero_copy_only=False)
        data = [flat[a:z].astype("<f8").tobytes() for a, z in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(data, pa.binary())], names=["query_id", "q", "dim", "v"])
