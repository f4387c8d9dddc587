"""Hard negatives for anchors and their positives by dual-tree search, exactly.

A row's score is its inner product with an anchor. An anchor's positives are the rows of its label with the highest
scores; a positive's hard negatives are the rows of other labels with the highest scores in a window below the
positive's score.

Trees. Vectors are placed by the nearest of a few centres (fitted on a bounded sample; they place vectors and change no result)
and by label: a cell is one label at one centre. Cells are dealt into leaves of LEAF vectors, and their anchors into packs of PACK.
A node knows a ball around its vectors, leaves and packs also the box of their extremes; both give an interval that
holds every inner product between two nodes. The search goes down both trees at once: cells of anchors meet cells of
candidates (for negatives all labels at a centre are one node), then packs meet leaves, in pages of PAGE. A pair of
nodes is left, for all its anchors at once, if its interval lies beyond what any of them still looks for. The FIRST leaves
of highest bound are scored first; what they give raises the floors that all other leaves have to reach. Pairs of packs
and leaves that remain are scored exactly, in one matrix product.

How it runs. Nodes and packs are rows; each step of the descent is a join of narrow rows, so no task holds more than a
pack and a page, or a pack and a leaf. What many rows ask for is dealt out in copies (`jaccard_join.attach`). Equal vectors of a label are
one anchor, searched once, and of equal candidates only those with the smallest ids can be among an anchor's first, so a
vector that a third of all rows share costs as much as any other; its anchors get their own positives at the end.
Only the sample and a table of products of centres reach the driver; tables between steps are in the shared folder.

Rows with a null vec_id or label, and vectors that are null, empty, or hold a null or a non-finite component, take no part; nor do
vectors of a length of 2 ** 30 or more after scaling, whose scores might be no 64-bit integers. Vectors of several
lengths are ranked each among their own length. Rows that repeat a vec_id are rows of their own; an anchor is never its
own positive. A score below zero has an empty window, one of zero the window of zero. An empty table gives an empty
result; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import jaccard_join as J
from .common import literal_table, stage, unstage
from .topk_search import fit_centres, nearest

SCALE, ANCHOR_STEP, POSITIVES, NEGATIVES = 256, 50, 5, 3
#: A negative's score in percent of the positive's.
LOW, HIGH = 50, 95
LEAF, PACK, PAGE, FIRST = 1024, 256, 64, 4
SAMPLE, CENTRES = 4096, 64
#: Vectors from this length on take no part. Bounds of all scores.
LONGEST = float(1 << 30)
LEAST, MOST = -(1 << 61), 1 << 61


def relabelled(table: DataFrame) -> DataFrame:
    """table with the labels that the task asks for: rows whose vec_id is divisible by 7 have the next one's, of ten."""
    return table.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def integer_rows(table: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and v array<int> of the rows that take part."""
    v = F.transform("embedding", lambda x: x.cast("double") * float(scale))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v")).where("vec_id is not null and label is not null and size(v) > 0")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))  # null, NaN or infinite where a component is
    return rows.where(F.coalesce(length < LONGEST, F.lit(False)) & ~F.isnan(length)).select("vec_id", "label", F.transform("v", lambda x: F.floor(x).cast("int")).alias("v"))


def matrix(cells: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype="<i4").reshape(len(cells), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors; none is beyond 2 ** 60."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


# --- nodes


def node_of(vectors: np.ndarray) -> bytes:
    """Mean, highest and lowest components, and the largest distance from the mean."""
    x = vectors.astype(np.float64)
    mean = x.mean(axis=0)
    return np.concatenate([mean, x.max(axis=0), x.min(axis=0), [np.sqrt(((x - mean) ** 2).sum(axis=1).max())]]).tobytes()


def intervals(node: bytes, others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each of the others the bounds of all inner products between its vectors and the node's."""
    a, b = np.frombuffer(node), np.frombuffer(b"".join(others)).reshape(len(others), -1)
    d = len(a) // 3
    (mean, high, low), (means, highs, lows) = (np.split(x[..., :-1], 3, axis=-1) for x in (a, b))
    length, lengths = np.sqrt((mean**2).sum()), np.sqrt((means**2).sum(axis=1))
    spread = length * b[:, -1] + a[-1] * lengths + a[-1] * b[:, -1]
    middle = means @ mean
    corners = np.stack([high * highs, high * lows, low * highs, low * lows])
    slack = 1 + 1e-12 * d * (length + a[-1]) * (lengths + b[:, -1])  # more than rounding can take
    return np.maximum(middle - spread, corners.min(axis=0).sum(axis=1)) - slack, np.minimum(middle + spread, corners.max(axis=0).sum(axis=1)) + slack


def _name(*parts: Column | str) -> Column:
    return F.concat_ws("/", *(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts))


class Forest:
    """Placed vectors: anchors (one for each label and vector), leaves of candidates, and what is known of cells and leaves."""

    def __init__(self, table: DataFrame, scale: int, anchor_step: int, same: int):
        """same: how many of equal candidates of a label stay, those with the smallest ids."""
        vectors = stage(integer_rows(table, scale), "vectors")
        n = vectors.count()
        chosen = vectors.orderBy(F.xxhash64("vec_id", "label", "v")).limit(SAMPLE).collect()
        self.centres: dict[int, np.ndarray] = {}
        for dim in sorted({len(r.v) for r in chosen}):
            sample = np.array([r.v for r in chosen if len(r.v) == dim], dtype=np.float64)
            self.centres[dim] = fit_centres(sample, max(1, min(CENTRES, n // (4 * LEAF)) * len(sample) // len(chosen)))
        placed = stage(vectors.mapInArrow(self._assign(), "vec_id long, label long, dim int, centre int, v binary").withColumn("key", F.monotonically_increasing_id()), "placed")
        rep = F.sha2(F.concat(F.col("label").cast("string").cast("binary"), F.lit(":").cast("binary"), "v"), 256)
        placed = placed.withColumn("rep", rep).withColumn("cell", _name("dim", "label", "centre"))
        self.anchors = placed.where(F.col("vec_id") % anchor_step == 0).select("key", "vec_id", "rep")
        of_rep = Window.partitionBy("rep").orderBy("vec_id", "key")  # limits before it shuffles
        kept = placed.withColumn("at", F.row_number().over(of_rep)).where(F.col("at") <= same).drop("at")
        self.leaves = self._grouped(kept, "leaf", LEAF, F.struct("vec_id", "key", "v"))
        one = placed.where(F.col("vec_id") % anchor_step == 0).withColumn("at", F.row_number().over(of_rep)).where("at = 1").drop("at")
        self.packed = stage(self._dealt(one, "pack", PACK).select("pack", "cell", "dim", "label", "centre", "rep", "v"), "packed")
        self.nodes = stage(self.leaves.mapInArrow(self._known(), "leaf string, cell string, dim int, label long, centre int, node binary, reach double"), "nodes")
        unstage(vectors)

    def _assign(self):  # noqa: ANN202
        centres = self.centres

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                ends, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(zero_copy_only=False)
                dims = np.diff(ends)
                centre = np.zeros(len(dims), dtype=np.int32)
                for dim in np.unique(dims):
                    if dim in centres:
                        rows = np.flatnonzero(dims == dim)
                        centre[rows] = nearest(flat[ends[rows][:, None] + np.arange(dim)], centres[dim])
                data = [flat[a:z].astype("<i4").tobytes() for a, z in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(dims.astype(np.int32)), pa.array(centre), pa.array(data, pa.binary())], names=["vec_id", "label", "dim", "centre", "v"])

        return run

    @staticmethod
    def _dealt(rows: DataFrame, name: str, size: int) -> DataFrame:
        """rows with the name of the part of their cell that they are dealt to, about `size` rows each."""
        counts = stage(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("c"), F.ceil(F.count(F.lit(1)) / size).alias("parts")), "counts")
        return J.join_by(rows, counts, "cell").withColumn(name, _name(F.col("cell"), F.pmod(F.xxhash64("rep", "key", F.lit(name)), F.col("parts")))).drop("parts")

    def _grouped(self, rows: DataFrame, name: str, size: int, content: Column) -> DataFrame:
        return stage(self._dealt(rows, name, size).groupBy(name, "cell", "dim", "label", "centre").agg(F.collect_list(content).alias("l")), name)

    def _known(self):  # noqa: ANN202
        centres = self.centres

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                nodes, reach = [], []
                for dim, centre, cell in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), batch.column(5), strict=True):
                    x = matrix(cell.values.field("v").to_pylist())
                    around = centres[dim][centre] if dim in centres else np.zeros(dim)
                    nodes.append(node_of(x))
                    reach.append(float(np.sqrt(((x - around) ** 2).sum(axis=1).max())))
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(nodes, pa.binary()), pa.array(reach)], names=["leaf", "cell", "dim", "label", "centre", "node", "reach"])

        return run

    def centre_products(self) -> DataFrame:
        """dim, a_centre, b_centre, dot and both lengths: at most CENTRES squared rows for all lengths that the sample has."""
        rows = [[dim, i, j, float(c[i] @ c[j]), float(np.sqrt(c[i] @ c[i])), float(np.sqrt(c[j] @ c[j]))] for dim, c in self.centres.items() for i in range(len(c)) for j in range(len(c))]
        return literal_table(self.nodes.sparkSession, rows, "dim int, a_centre int, b_centre int, dot double, a_length double, b_length double")


# --- the search


def packs_of(forest: Forest, windows: DataFrame) -> DataFrame:
    """A row for each pack with anchors that look for something. windows: rep, slot, lo, hi."""
    wanted = windows.groupBy("rep").agg(F.collect_list(F.struct("slot", "lo", "hi")).alias("windows"))  # one for each slot
    rows = forest.packed.join(wanted, "rep")
    lo, hi = F.array_min(F.transform("windows", lambda w: w.lo)), F.array_max(F.transform("windows", lambda w: w.hi))
    grouped = rows.withColumn("lo", lo).withColumn("hi", hi).groupBy("pack", "cell", "dim", "label", "centre")
    return stage(grouped.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list(F.struct("rep", "v", "windows")).alias("p")), "packs")


def _pack_nodes(packs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [node_of(matrix(cell.values.field("v").to_pylist())) for cell in batch.column(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(nodes, pa.binary())], names=["pack", "cell", "label", "lo", "hi", "node"])

    return packs.select("pack", "cell", "label", "lo", "hi", "p").mapInArrow(run, "pack string, cell string, label long, lo long, hi long, node binary")


def descend(forest: Forest, packs: DataFrame, same_label: bool) -> DataFrame:
    """pack, leaf and upper, the pair's largest possible score, of all that the packs' windows don't rule out."""
    by = ("dim", "label") if same_label else ("dim",)
    above = forest.nodes.withColumn("above", _name(*by, "centre"))
    tops = above.groupBy("above", *by, "centre").agg(F.max("reach").alias("b_reach")).withColumnRenamed("centre", "b_centre")
    cells = packs.groupBy("cell", "dim", "label", "centre").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).withColumnRenamed("centre", "a_centre")
    cells = cells.join(forest.nodes.groupBy("cell").agg(F.max("reach").alias("a_reach")), "cell")
    met = cells.join(tops, list(by)).join(F.broadcast(forest.centre_products()), ["dim", "a_centre", "b_centre"], "left")
    none = lambda c: F.coalesce(c, F.lit(0.0))  # noqa: E731  a length of vectors that the sample lacks has the centre 0
    a, b = none("a_length"), none("b_length")
    spread = (a * F.col("b_reach") + F.col("a_reach") * b + F.col("a_reach") * F.col("b_reach")) * (1 + 1e-9) + 1
    pairs = met.where((none("dot") + spread >= F.col("lo")) & (none("dot") - spread <= F.col("hi"))).select("cell", "above")
    sizes = above.groupBy("above").agg(F.ceil(F.count(F.lit(1)) / PAGE).alias("pages"))
    pages = J.join_by(above, stage(above.groupBy("above").agg(F.count(F.lit(1)).alias("c"), F.ceil(F.count(F.lit(1)) / PAGE).alias("pages")), "sizes"), "above")
    pages = pages.withColumn("page", _name(F.col("above"), F.pmod(F.xxhash64("leaf"), F.col("pages")))).groupBy("page").agg(F.collect_list(F.struct("leaf", "label", "node")).alias("leaves"))
    nodes = stage(_pack_nodes(packs), "pack-nodes")
    paged = pairs.join(sizes, "above").withColumn("page", F.explode(F.transform(F.sequence(F.lit(0), (F.col("pages") - 1).cast("int")), lambda i: _name(F.col("above"), i)))).select("cell", "page")
    rows = stage(nodes.join(paged, "cell").drop("cell"), "pairs")
    asks = stage(_asks(J.attach(rows, "page", "pack", stage(pages, "pages"), rows), same_label), "asks")
    unstage(nodes, rows)
    return asks


def _asks(meetings: DataFrame, same_label: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packs, leaves, upper = [], [], []
            for pack, label, lo, hi, node, cell in zip(*(batch.column(i) for i in range(6)), strict=True):
                page = cell.values
                low, high = intervals(node.as_py(), page.field("node").to_pylist())
                fits = (high >= lo.as_py()) & (low <= hi.as_py()) & ((page.field("label").to_numpy() == label.as_py()) == same_label)
                at = np.flatnonzero(fits)
                packs += [pack.as_py()] * len(at)
                leaves += page.field("leaf").take(pa.array(at)).to_pylist()
                upper.append(high[at])
            yield pa.RecordBatch.from_arrays([pa.array(packs, pa.string()), pa.array(leaves, pa.string()), pa.array(np.concatenate(upper) if upper else np.zeros(0))], names=["pack", "leaf", "upper"])

    return meetings.select("pack", "label", "lo", "hi", "node", "leaves").mapInArrow(run, "pack string, leaf string, upper double")


def _scores(asks: DataFrame, packs: DataFrame, leaves: DataFrame, take: int) -> DataFrame:
    """rep, slot, vec_id, key, score: for each window at most `take` of a leaf's highest scores inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, leaf in zip(*batch.columns, strict=True):
                p, c = pack.values, leaf.values
                ids, keys = (c.field(n).to_numpy() for n in ("vec_id", "key"))
                order = np.lexsort((keys, ids))
                ids, keys = ids[order], keys[order]
                scores = products(matrix(p.field("v").to_pylist()), matrix(c.field("v").to_pylist())[order])
                w = p.field("windows")
                ends = w.offsets.to_numpy()
                slot, lo, hi = (w.values.field(n).to_numpy() for n in ("slot", "lo", "hi"))
                reps, found = p.field("rep").to_pylist(), []
                for i, own in enumerate(scores):
                    a, z = ends[i], ends[i + 1]
                    at = np.flatnonzero((own >= lo[a:z].min()) & (own <= hi[a:z].max()))
                    at = at[np.argsort(-own[at], kind="stable")]  # ties by id
                    down = -own[at]
                    starts, stops = np.searchsorted(down, -hi[a:z], "left"), np.searchsorted(down, -lo[a:z], "right")
                    for j, (s, e) in enumerate(zip(starts, np.minimum(stops, starts + take), strict=True)):
                        if e > s:
                            found.append((reps[i], slot[a + j], at[s:e], own[at[s:e]]))
                n = [len(x[2]) for x in found]
                rows = np.concatenate([x[2] for x in found]) if found else np.zeros(0, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([x[0] for x in found], dtype=object), n).tolist(), pa.string()), pa.array(np.repeat(np.array([x[1] for x in found], dtype=np.int32), n)), pa.array(ids[rows]), pa.array(keys[rows]), pa.array(np.concatenate([x[3] for x in found]) if found else np.zeros(0, dtype=np.int64))],
                    names=["rep", "slot", "vec_id", "key", "score"],
                )

    visits = J.attach(J.attach(asks, "pack", "leaf", packs.select("pack", "p"), asks), "leaf", "pack", leaves.select("leaf", "l"), asks)
    return visits.select("p", "l").mapInArrow(run, "rep string, slot int, vec_id long, key long, score long")


def first_in_windows(forest: Forest, windows: DataFrame, take: int, same_label: bool) -> DataFrame:
    """rep, slot, rank, vec_id, key, score: for each window the `take` highest scores inside it, of candidates of the anchor's label or of all others."""

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("rep", "slot").orderBy(F.col("score").desc(), "vec_id", "key")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= take)

    packs = packs_of(forest, windows)
    asks = descend(forest, packs, same_label)
    ahead = Window.partitionBy("pack").orderBy(F.col("upper").desc(), "leaf")
    early = stage(asks.withColumn("at", F.row_number().over(ahead)).where(F.col("at") <= FIRST).drop("at"), "early")
    found = stage(best(_scores(early, packs, forest.leaves, take)), "found")
    floors = found.where(F.col("rank") == take).select("rep", "slot", F.col("score").alias("floor"))
    raised = windows.join(floors, ["rep", "slot"], "left").select("rep", "slot", F.coalesce("floor", "lo").alias("lo"), "hi")
    again = packs_of(forest, raised)
    late = stage(asks.join(early.select("pack", "leaf"), ["pack", "leaf"], "left_anti").join(again.select("pack", "lo"), "pack").where(F.col("upper") >= F.col("lo")).drop("lo"), "late")
    out = stage(best(found.drop("rank").unionByName(_scores(late, again, forest.leaves, take))), "best")
    unstage(packs, again, asks, early, late, found)
    return out


def percent_of(score: Column, percent: int, up: bool) -> Column:
    """percent of 100 of a score, rounded up or down, without a product beyond 64 bits."""
    rest = F.pmod(score, F.lit(100))
    part = F.ceil(rest * percent / 100.0 - 1e-9) if up else F.floor(rest * percent / 100.0 + 1e-9)
    return F.expr("(_s - pmod(_s, 100L)) div 100") * percent + part


def mine(table: DataFrame, anchor_step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, by the labels that table has."""
    same = positives + 1  # an anchor may be among the first itself
    forest = Forest(table, scale, anchor_step, same)
    every = forest.packed.select("rep", F.lit(0).alias("slot"), F.lit(LEAST).alias("lo"), F.lit(MOST).alias("hi"))
    near = first_in_windows(forest, every, same, True)
    lists = stage(near.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "key", "score"))).alias("near")), "lists")
    anchors = stage(forest.anchors, "anchors")
    # every anchor's own list: the first that are other rows
    of_anchor = J.attach(anchors.withColumnRenamed("vec_id", "anchor_id").withColumnRenamed("key", "anchor_key"), "rep", "anchor_key", lists, anchors)
    own = F.slice(F.filter("near", lambda x: x.key != F.col("anchor_key")), 1, positives)
    pairs = of_anchor.select("rep", "anchor_id", "anchor_key", F.posexplode(own).alias("slot", "x")).select("rep", "anchor_id", "anchor_key", "slot", F.col("x.vec_id").alias("positive_id"), F.col("x.score").alias("positive_score"))
    pairs = stage(pairs, "positives")
    # anchors of one vector have positives of the same scores
    windows = pairs.groupBy("rep", "slot").agg(F.max("positive_score").alias("_s")).select("rep", "slot", percent_of(F.col("_s"), low, True).alias("lo"), percent_of(F.col("_s"), high, False).alias("hi")).where("lo <= hi")
    found = first_in_windows(forest, stage(windows, "windows"), negatives, False)
    hard = found.groupBy("rep", "slot").agg(F.collect_list(F.struct("rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))).alias("hard"))
    name = lambda df: df.withColumn("name", _name("rep", "slot")).drop("slot")
    rows = stage(name(pairs), "pairs")
    out = J.attach(rows, "name", "anchor_key", stage(name(hard).drop("rep"), "hard"), rows)
    return out.select("anchor_id", "positive_id", F.inline("hard"), "positive_score").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = """
WITH v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS a, a.r AS ar, b.vec_id AS b, b.r AS br, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS s FROM v a JOIN v b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY s DESC, b, br) AS k FROM s WHERE same),
n AS (SELECT p.a AS anchor_id, p.b AS positive_id, s.b AS negative_id, p.s AS positive_score, s.s AS negative_score, row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.s DESC, s.b, s.br)::INTEGER AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s WHERE p.k <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
