"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors are turned into integers and dealt into document ranges: first by their length and the nearest of a few centres
(fitted on a bounded sample, only to bring like vectors together), then into shelves of SHELF vectors, each in blocks of
BLOCK. A block keeps a forward index, its vectors as one matrix, and each dimension's largest and smallest value. For a
query these give a bound on every score in the block: the sum over dimensions of the query's weight times the extreme
that its sign picks. Queries visit blocks from the highest bound down and stop where bounds fall below their kth score;
a bound that equals it is still visited, as ties go to the smaller id.

How it runs: blocks are packed into shelves, one binary row each. Every query is first scored on its own shelf, where it
stands already, which gives it a kth score early. The blocks' extremes, BLOCK / 2 times smaller than the vectors, are a
table of their own, in pages of PAGE shelves; queries in packs of PACK meet each page and ask for those shelves of which a
block's bound reaches their kth score. Only these queries are sent, and only to these shelves, again in packs; Python
with numpy scores a pack and a shelf in a few matrix products. Each pair gives at most k scores a query; the last ranking
takes the best k. No task holds more than one shelf or page and one pack.

Vectors that are null, empty, or hold a null or a non-finite component take no part, as query or candidate. Vectors of
several lengths are ranked each among their own length; a product of others isn't defined. Components so large that
1024 times them, or a score, is no 64-bit integer raise an error; sums that need more than doubles are added as integers
of any size. Rows with equal vec_id count as separate candidates, but a query's own vec_id is never its candidate. An
empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

SCALE, K, QUERY_STEP = 1024, 10, 100
BLOCK, SHELF, PACK, PAGE = 128, 2048, 256, 64
#: Vectors that centres are fitted on, and the most centres.
SAMPLE, CENTRES, ROUNDS, SEED = 4096, 256, 8, 3
#: Stands for no kth score.
LOWEST = -(1 << 63)
KEYS = ("dim", "centre", "number")


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and v array<bigint> of the vectors that take part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(True)))
    whole = lambda x: F.when(F.abs(x) * float(scale) < float(1 << 62), F.floor(x * F.lit(float(scale)))).otherwise(F.raise_error(F.lit("a component is too large")).cast("long"))
    return rows.select("vec_id", F.transform("v", whole).alias("v"))


def fit_centres(sample: np.ndarray, n: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centres = sample[rng.permutation(len(sample))[:n]].astype(np.float64)
    for _ in range(ROUNDS):
        own = nearest(sample, centres)
        for c in range(len(centres)):
            if (own == c).any():
                centres[c] = sample[own == c].mean(axis=0)
    return centres


def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (vectors @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)


def matrix(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype="<i8").reshape(len(cells), -1)


def bounds_of(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Queries x blocks: no score in a block is larger."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def kind_for(queries: np.ndarray, most: int) -> type:
    """The numbers in which products with components up to `most` and their sums are exact."""
    size = most * largest(queries) * queries.shape[1]
    return np.float64 if size < 1 << 53 else np.int64 if size < 1 << 62 else object


class Shelf:
    """Some vectors in blocks, with each block's extremes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int | None = None):
        block = block or BLOCK
        # like vectors side by side: by the dimension that varies most
        order = np.argsort(vectors[:, vectors.std(axis=0).argmax()], kind="stable") if len(ids) > block else np.arange(len(ids))
        self.ids, self.vectors, self.block = ids[order], vectors[order], block
        self.starts = np.arange(0, len(ids), block)
        self.high = np.maximum.reduceat(self.vectors, self.starts)
        self.low = np.minimum.reduceat(self.vectors, self.starts)
        self.largest = largest(vectors)
        self.forms: dict[type, tuple] = {np.int64: (self.vectors, self.high, self.low)}

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query at most k (ids, scores), best first; scores below floor may be missing."""
        kind = kind_for(queries, self.largest)
        if kind not in self.forms:
            self.forms[kind] = tuple(x.astype(kind) for x in (self.vectors, self.high, self.low))
        queries, (vectors, high, low) = queries.astype(kind), self.forms[kind]
        bounds = bounds_of(queries, high, low)
        best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in queries]
        kth = floor.astype(vectors.dtype)
        order = np.argsort(-bounds, axis=1, kind="stable")
        for step in range(bounds.shape[1]):
            # every query's next block; queries that meet the same block share one product
            at = order[:, step]
            open_ = bounds[np.arange(len(queries)), at] >= kth
            if not open_.any():
                break
            for b in np.unique(at[open_]):
                who = np.flatnonzero(open_ & (at == b))
                a, z = self.starts[b], min(self.starts[b] + self.block, len(self.ids))
                scores = queries[who] @ vectors[a:z].T
                for i, row in zip(who, scores, strict=True):
                    hit = np.flatnonzero((row >= kth[i]) & (self.ids[a:z] != query_ids[i]))
                    if len(hit):
                        ids = np.concatenate([best[i][0], self.ids[a:z][hit]])
                        own = np.concatenate([best[i][1], row[hit].astype(np.int64)])
                        keep = np.lexsort((ids, -own))[:k]
                        best[i] = ids[keep], own[keep]
                        if len(keep) == k:
                            kth[i] = max(kth[i], own[keep[-1]])
        return best


def largest(vectors: np.ndarray) -> int:
    return int(np.abs(vectors).max(initial=0))


def _found_rows(keys: np.ndarray, ids: np.ndarray, found: list) -> pa.RecordBatch:
    n = [len(x) for x, _ in found]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(keys, n)), pa.array(np.repeat(ids, n)), pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([s for _, s in found]))],
        names=["key", "query_id", "vec_id", "score"],
    )


FOUND = "key long, query_id long, vec_id long, score long"


def _at_home(shelves: DataFrame, k: int, step: int) -> DataFrame:
    """The k best of its own shelf for each query: rows of FOUND."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                row = cell.values
                ids, keys = (row.field(n).to_numpy(zero_copy_only=False) for n in ("vec_id", "key"))
                who = np.flatnonzero(ids % step == 0)
                if len(who):
                    vectors = matrix(row.field("v").to_pylist())
                    yield _found_rows(keys[who], ids[who], Shelf(ids, vectors).search(ids[who], vectors[who], np.full(len(who), LOWEST), k))

    return shelves.select("row").mapInArrow(run, FOUND)


def _extremes(shelves: DataFrame) -> DataFrame:
    """KEYS, blocks, high and low (their extremes, one matrix each) of every shelf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Shelf(np.arange(len(cell.values)), matrix(cell.values.field("v").to_pylist())) for cell in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array([x.astype("<i8").tobytes() for x in side], pa.binary()) for side in ([f.high for f in found], [f.low for f in found]))], names=[*KEYS, "high", "low"])

    return shelves.select(*KEYS, "row").mapInArrow(run, "dim int, centre int, number int, high binary, low binary")


def _asks(meetings: DataFrame) -> DataFrame:
    """meetings: dim, query (a pack) and page (shelves with their extremes). key, KEYS for each shelf that a query has to visit beside its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, pack, page in zip(*batch.columns, strict=True):
                q, p = pack.values, page.values
                queries = matrix(q.field("v").to_pylist())
                high, low = (np.frombuffer(b"".join(p.field(n).to_pylist()), dtype="<i8").reshape(-1, dim.as_py()) for n in ("high", "low"))
                starts = np.concatenate([[0], np.cumsum([len(x) // 8 // dim.as_py() for x in p.field("high").to_pylist()])[:-1]])
                kind = kind_for(queries, max(largest(high), largest(low)))
                bounds = np.maximum.reduceat(bounds_of(queries.astype(kind), high.astype(kind), low.astype(kind)), starts, axis=1)
                own = np.ones((len(queries), len(starts)), dtype=bool)
                for name in KEYS[1:]:
                    own &= q.field(name).to_numpy(zero_copy_only=False)[:, None] == p.field(name).to_numpy(zero_copy_only=False)[None]
                who, where = np.nonzero((bounds >= q.field("floor").to_numpy(zero_copy_only=False)[:, None]) & ~own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q.field("key").to_numpy(zero_copy_only=False)[who]), pa.array(np.full(len(who), dim.as_py(), dtype=np.int32)), *(pa.array(p.field(n).to_numpy(zero_copy_only=False)[where]) for n in KEYS[1:])],
                    names=["key", *KEYS],
                )

    return meetings.select("dim", "query", "page").mapInArrow(run, "key long, dim int, centre int, number int")


def _away(visits: DataFrame, k: int) -> DataFrame:
    """visits: query (a pack) and row (a shelf). At most k rows of FOUND for each query of a visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, shelf in zip(*batch.columns, strict=True):
                q, r = pack.values, shelf.values
                own = Shelf(r.field("vec_id").to_numpy(zero_copy_only=False), matrix(r.field("v").to_pylist()))
                keys, ids, floor = (q.field(n).to_numpy(zero_copy_only=False) for n in ("key", "vec_id", "floor"))
                yield _found_rows(keys, ids, own.search(ids, matrix(q.field("v").to_pylist()), floor, k))

    return visits.select("query", "row").mapInArrow(run, FOUND)


def deal(table: DataFrame, scale: int) -> DataFrame:
    """vec_id, key, v (bytes) and KEYS, the shelf, of every vector that takes part."""
    vectors = stage(integer_vectors(table, scale), "vectors")
    n = vectors.count()
    chosen = vectors.orderBy(F.xxhash64("vec_id", "v")).limit(SAMPLE).collect()
    centres: dict[int, np.ndarray] = {}
    for dim in sorted({len(r.v) for r in chosen}):
        sample = np.array([r.v for r in chosen if len(r.v) == dim], dtype=np.float64)
        centres[dim] = fit_centres(sample, max(1, min(CENTRES, n * len(sample) // (len(chosen) * 4 * SHELF))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ends, flat = batch.column(1).offsets.to_numpy(), batch.column(1).values.to_numpy(zero_copy_only=False)
            dims = np.diff(ends)
            centre = np.zeros(len(dims), dtype=np.int32)
            for dim in np.unique(dims):
                if dim in centres:
                    rows = np.flatnonzero(dims == dim)
                    centre[rows] = nearest(flat[ends[rows][:, None] + np.arange(dim)], centres[dim])
            data = [flat[a:z].astype("<i8").tobytes() for a, z in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims.astype(np.int32)), pa.array(centre), pa.array(data, pa.binary())], names=["vec_id", "dim", "centre", "v"])

    # one key a row, so that repeated ids stay apart; the placement that follows from it changes no result
    dealt = stage(vectors.mapInArrow(assign, "vec_id long, dim int, centre int, v binary").withColumn("key", F.monotonically_increasing_id()), "dealt")
    sizes = dealt.groupBy("dim", "centre").agg(F.ceil(F.count(F.lit(1)) / SHELF).alias("shelves"))
    # a row for each centre of a length
    return dealt.join(F.broadcast(sizes), ["dim", "centre"]).withColumn("number", F.pmod(F.xxhash64("key"), F.col("shelves")).cast("int")).drop("shelves")


def search(table: DataFrame, k: int = K, query_step: int = QUERY_STEP, scale: int = SCALE) -> DataFrame:
    """The k best candidates of each row whose vec_id is divisible by query_step: query_id, rank, vec_id, score."""
    dealt = deal(table, scale)
    shelves = stage(dealt.groupBy(*KEYS).agg(F.collect_list(F.struct("vec_id", "key", "v")).alias("row")), "shelves")

    def rank(found: DataFrame) -> DataFrame:
        best = Window.partitionBy("key").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    near = stage(rank(_at_home(shelves, k, query_step)), "near")
    floors = near.where(F.col("rank") == k).select("key", F.col("score").alias("floor"))
    queries = dealt.where(F.col("vec_id") % query_step == 0).join(floors, "key", "left").withColumn("floor", F.coalesce("floor", F.lit(LOWEST)))
    total = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / PACK).alias("packs"))
    queries = stage(queries.join(F.broadcast(total), "dim").withColumn("pack", F.pmod(F.xxhash64("key", F.lit("pack")), F.col("packs")).cast("int")).drop("packs"), "queries")
    packs = queries.groupBy("dim", "pack").agg(F.collect_list(F.struct("key", "centre", "number", "v", "floor")).alias("query"))
    extremes = stage(_extremes(shelves), "extremes")
    pages = extremes.join(F.broadcast(extremes.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / PAGE).alias("pages"))), "dim").withColumn("leaf", F.pmod(F.xxhash64(*KEYS), F.col("pages")).cast("int"))
    pages = pages.groupBy("dim", "leaf").agg(F.first("pages").alias("pages"), F.collect_list(F.struct("centre", "number", "high", "low")).alias("page"))
    # every pack meets every page of its length: the bounds are small, the vectors stay where they are
    count = pages.select("dim", "pages").distinct()
    meetings = packs.join(F.broadcast(count), "dim").withColumn("leaf", F.explode(F.sequence(F.lit(0), (F.col("pages") - 1).cast("int")))).join(pages.drop("pages"), ["dim", "leaf"])
    asks = stage(_asks(meetings), "asks")
    visits = asks.join(queries.select("key", "pack", "vec_id", "v", "floor"), "key").groupBy(*KEYS, "pack").agg(F.collect_list(F.struct("key", "vec_id", "v", "floor")).alias("query")).join(shelves, list(KEYS))
    return rank(near.select("key", "query_id", "vec_id", "score").unionByName(_away(visits, k))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v, row_number() OVER () AS r FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, q.r AS q_r, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
k AS (SELECT query_id, row_number() OVER (PARTITION BY q_r ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 10
"""
