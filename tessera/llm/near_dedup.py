"""Near duplicates by SuperMinHash: signatures, bands, verification on whole sets, groups by union-find.

A document's set holds the hashes of its distinct k-word shingles (`jaccard_join.Shingler`). Two documents link when
their sets' Jaccard similarity reaches the threshold (in percent).

Signature. Every shingle shuffles the signature's places by a permutation of its own, drawn from its hash: on level j
it stands at its permutation's place j with the value j + r, r from [0, 1), and a place of the signature keeps the least
value. As a shingle visits each place once, places depend on each other, which makes the estimate of a similarity vary
less than that of independent hashes. Values of a level are below those of all later levels, so a set is done as soon
as no place is empty: a long text after its first level. All shingles of a batch of sets take a level together.

Bands. The places are cut into BANDS bands of ROWS; sets that agree in a whole band meet in its bucket. Sets of
similarity 0.8 miss each other in all 40 bands once in eight million times; every pair that meets is decided exactly.

Links. A bucket isn't expanded into its pairs. In each of ROUNDS rounds every bucket has a pivot (the least set by the
round's hash), and every set is compared with that one of its buckets' pivots which it shares most buckets with, so a
round compares each set once. Sets that link are one group, known to be connected. Buckets that hold several groups
after that are packed by group, and packs of a bucket meet unless both are of one and the same group, so a group of
thousands meets the few other sets of its buckets and not itself. Pairs of different groups, each in the first of its bands only,
are candidates where sizes and parity sketches don't rule them out. They are looked through twice. The first time two packs
give each group's most alike candidate only, of which one a group is verified: sets that belong to a large group
mostly join it by that one comparison instead of one with each of its sets. Then, with the groups that this makes, all
candidates that are left are verified.

How it runs. Texts are read as Arrow batches and never shuffled: once for the sets' hashes and signatures, and once for
the whole sets of those that are compared in a round. Equal sets are one from the first task on, so a group of exact copies that
holds a third of all rows adds one signature a task. Counts of buckets are partial sums before they are shuffled; buckets
of very many sets are joined by broadcast, at most MOST_LONG of them, and whole sets that many pairs ask for are dealt out in
copies, so no key's rows come together in one task. Groups come from contraction over tables in the shared folder. Only
sets whose short hashes clash and a bitmap of bounded size reach the driver.

A null, empty or blank text has an empty set, links with nothing and is kept; fewer than k words make one shingle of the
whole. A row without doc_id takes its group's smallest id and is kept only where the group has none. Rows that share a
doc_id share its fate. Empty tables give empty results, other columns don't matter, texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jaccard_join as J
from .common import stage, unstage

SHINGLE, PERCENT = 4, 80
BANDS, ROWS, ROUNDS = 40, 5, 2
EMPTY = np.uint64((1 << 64) - 1)
#: Shingles that go through the levels together.
CHUNK = 1 << 15
_LOW, _HALF = np.uint64((1 << 32) - 1), np.uint64(32)
_STEP = 0x9E3779B97F4A7C15


def draws(shingles: np.ndarray, level: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle: with which place, from level on, it swaps this level's, and its value there."""
    u = J.mix(shingles + np.uint64((level + 1) * _STEP % (1 << 64)))
    swap = ((u & _LOW) * np.uint64(places - level) >> _HALF).astype(np.int64) + level
    return swap, np.uint64(level) << _HALF | u >> _HALF


def signatures(sets: list[np.ndarray], places: int = BANDS * ROWS) -> np.ndarray:
    """A row for each set, none of them empty: for each place the least value of all shingles."""
    out = np.full((len(sets), places), EMPTY, dtype=np.uint64)
    ends = np.cumsum([len(s) for s in sets])
    at = 0
    while at < len(sets):
        until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
        _levels(sets[at:until], out[at:until], places)
        at = until
    return out


def _levels(sets: list[np.ndarray], out: np.ndarray, places: int) -> None:
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = out.reshape(-1)
    swap, value = draws(shingles, 0, places)
    np.minimum.at(flat, owner * places + swap, value)
    open_ = (out == EMPTY).any(axis=1)
    if not open_.any():
        return
    keep = open_[owner]
    shingles, owner, swap = shingles[keep], owner[keep], swap[keep]
    rows = np.arange(len(shingles))
    order = np.tile(np.arange(places, dtype=np.uint16), (len(shingles), 1))
    order[rows, swap] = 0
    order[:, 0] = swap
    for level in range(1, places):
        swap, value = draws(shingles, level, places)
        place = order[rows, swap]
        order[rows, swap] = order[:, level]
        order[:, level] = place
        np.minimum.at(flat, owner * places + place, value)
        if level % 4 == 3:
            still = (out == EMPTY).any(axis=1)
            keep = still[owner]
            if not keep.all():
                if not keep.any():
                    return
                shingles, owner, order = shingles[keep], owner[keep], order[keep]
                rows = np.arange(len(shingles))


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A key of 64 bits for each band of each signature."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * np.uint64(_STEP), parts.shape[:2])
    for i in range(rows):
        key = J.mix(J.mix(key + np.uint64(i)) ^ J.mix(parts[:, :, i]))
    return key.view(np.int64)


def scan(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, mark, n, set, check and, once for each set of a task, its bands and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, none = J.Shingler(k), set(), np.zeros(0, dtype=np.int64)
        for batch in J.parts(batches):
            n, ids, checks, new, sketches = [], [], [], [], []
            for s in own.sets(batch.column(1)):
                both = J.set_hash(s)
                fresh = len(s) > 0 and both not in seen
                seen.add(both)
                n.append(len(s))
                ids.append(both[0])
                checks.append(both[1])
                new.append(s if fresh else none)
                sketches.append(J.sketch(s) if fresh else none)
            made = iter(band_keys(signatures([s for s in new if len(s)])) if any(map(len, new)) else [])
            bands = [next(made) if len(s) else none for s in new]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int32()), pa.array(ids, pa.int64()), pa.array(checks, pa.int64()), J._arrays(bands), J._arrays(sketches)],
                names=["doc_id", "mark", "n", "set", "check", "bands", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(run, f"doc_id {kind}, mark long, n int, set long, check long, bands array<long>, sketch array<long>")


def verified(docs: DataFrame, k: int, percent: int, pairs: DataFrame, moved: J.Moved, name: str) -> DataFrame:
    """Those pairs (a, b, n, m), each there once, that link, as a and b."""
    pairs = stage(pairs, f"{name}-pairs")
    many = pairs.count()
    if not many:  # no text is read for it
        return pairs.select("a", "b")
    sets = stage(J.whole_sets(docs, k, pairs.select(F.col("a").alias("set")).union(pairs.select("b")), 2 * many, moved), f"{name}-sets")
    left, right = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    both = J.attach(J.attach(pairs, "b", "a", right, pairs), "a", "b", left, pairs)
    found = stage(both.where(F.size(F.array_intersect("x", "y")) >= J.needed(F.col("n"), F.col("m"), percent)).select("a", "b"), name)
    unstage(pairs, sets)
    return found


def alike(n: str, m: str, percent: int):  # noqa: ANN201
    """Whether sets of n and m shingles are near enough in size to link."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def stars(lists: DataFrame, labels: DataFrame, percent: int, turn: int) -> DataFrame:
    """a (pivot), b, n, m: for each set that pivot of another group of its buckets which it shares most buckets with. lists: band, set, n."""
    known = lists.join(labels, "set", "left").withColumn("group", F.coalesce("group", "set"))
    pivot = F.min(F.struct(F.xxhash64("set", F.lit(turn)).alias("h"), F.col("set").alias("a"), F.col("n").alias("a_n"), F.col("group").alias("a_group")))
    pivots = known.groupBy("band").agg(F.count(F.lit(1)).alias("c"), pivot.alias("p"), F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high")
    pivots = stage(pivots.select("band", "c", "p.a", "p.a_n", "p.a_group"), "pivots")
    met = J.join_by(known, pivots, "band").where((F.col("group") != F.col("a_group")) & alike("n", "a_n", percent))
    shared = met.groupBy("a", F.col("set").alias("b"), F.col("a_n").alias("n"), F.col("n").alias("m")).agg(F.count(F.lit(1)).alias("c"))
    best = shared.groupBy("b", "m").agg(F.max(F.struct("c", "a", "n")).alias("best"))
    return best.select("best.a", "b", "best.n", "m")


def rest_pairs(lists: DataFrame, labels: DataFrame, signed: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """a, b, n, m, apart (bits between sketches) and both groups of all pairs of different groups that share a bucket, each once, but for those that sizes or sketches rule out.

    nearest: of two packs only each group's pair of the fewest bits.
    """
    known = lists.join(labels, "set", "left").select(F.col("band").alias("token"), "set", F.coalesce("group", "set").alias("group"))
    rows = J.dealt_by_group(known).join(signed.select("set", "n", "sketch", "bands"), "set")
    packs = stage(rows.groupBy("pack", "token", "own").agg(F.collect_list(F.struct("set", "n", "group", "sketch", "bands")).alias("sets")), "packs")
    met = stage(J.pack_pairs(packs), "met")
    sides = [packs.select(F.col("pack").alias(c), F.col("sets").alias(f"{c}_sets")) for c in ("p", "q")]
    visits = J.attach(J.attach(met, "p", "q", sides[0], met), "q", "p", sides[1], met)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, same, x, y in zip(*batch.columns, strict=True):
                a, b = _Sets(x.values), _Sets(y.values)
                i, j, apart = _near(a, b, same.as_py(), percent)
                # a pair comes from the first of its bands
                first = (a.bands[i] == b.bands[j]).argmax(axis=1)
                new = a.bands[i, first] == band.as_py()
                i, j, apart = i[new], j[new], apart[new]
                if nearest:
                    order = np.argsort(apart, kind="stable")
                    i, j, apart = i[order], j[order], apart[order]
                    one = np.union1d(*(np.unique(g, return_index=True)[1] for g in (a.groups[i], b.groups[j])))
                    i, j, apart = i[one], j[one], apart[one]
                swap = a.sets[i] > b.sets[j]
                pick = lambda p, q: pa.array(np.where(swap, q, p))  # noqa: B023, E731
                both = [c for x, y in ((a.sets, b.sets), (a.n, b.n), (a.groups, b.groups)) for c in (pick(x[i], y[j]), pick(y[j], x[i]))]
                yield pa.RecordBatch.from_arrays([*both, pa.array(apart)], names=["a", "b", "n", "m", "a_group", "b_group", "apart"])

    return visits.select("token", (F.col("p") == F.col("q")).alias("same"), "p_sets", "q_sets").mapInArrow(run, "a long, b long, n int, m int, a_group long, b_group long, apart long")


def nearest_pairs(lists: DataFrame, labels: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """a, b, n, m: for each group that one of its rest_pairs whose sketches are most alike."""
    pairs = rest_pairs(lists, labels, signed, percent, nearest=True)
    ends = pairs.select(F.explode(F.array("a_group", "b_group")).alias("group"), F.struct("apart", "a", "b", "n", "m").alias("best"))
    return ends.groupBy("group").agg(F.min("best").alias("best")).select("best.a", "best.b", "best.n", "best.m").distinct()


class _Sets:
    """A pack's sets as arrays."""

    def __init__(self, rows: pa.StructArray):
        self.sets, self.n, self.groups = (rows.field(c).to_numpy() for c in ("set", "n", "group"))
        self.sketch, self.bands = (rows.field(c).flatten().to_numpy().reshape(len(self.sets), -1) for c in ("sketch", "bands"))


def _near(a: _Sets, b: _Sets, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs of different groups that their sizes and sketches let link, and bits between sketches; of one pack, each pair once."""
    n, m = a.n.astype(np.int64)[:, None], b.n.astype(np.int64)[None]
    fits = (a.groups[:, None] != b.groups[None]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * percent)
    if same:
        fits &= np.arange(len(n))[:, None] < np.arange(m.shape[1])[None]
    i, j = np.nonzero(fits)
    n, m = a.n.astype(np.int64)[i], b.n.astype(np.int64)[j]
    apart = np.bitwise_count(a.sketch[i].view(np.uint64) ^ b.sketch[j].view(np.uint64)).sum(axis=1, dtype=np.int64)
    near = apart <= n + m - 2 * -(-percent * (n + m) // (100 + percent))
    return i[near], j[near], apart[near]


def links(docs: DataFrame, first: DataFrame, k: int, percent: int, moved: J.Moved) -> DataFrame:
    """a and b: links between different sets, enough of them that all linked sets that share a band are connected."""
    one = first.where(F.size("bands") > 0).groupBy("set").agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    signed = stage(one, "signed")
    entries = signed.select(F.explode("bands").alias("band"), "set", "n")
    several = stage(entries.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "several")
    lists = stage(J.join_by(entries, several, "band").select("band", "set", "n"), "lists")
    found = docs.sparkSession.createDataFrame([], "a long, b long")
    labels = docs.sparkSession.createDataFrame([], "set long, group long")
    for turn in range(ROUNDS + 1):
        pairs = stars(lists, labels, percent, turn) if turn < ROUNDS else nearest_pairs(lists, labels, signed, percent)
        new = verified(docs, k, percent, pairs, moved, f"round{turn}")
        found = stage(found.unionByName(new), "links")
        labels = J.groups(found)
    last = verified(docs, k, percent, rest_pairs(lists, labels, signed, percent).select("a", "b", "n", "m"), moved, "rest")
    unstage(signed, several, lists)
    return found.unionByName(last)


def components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, mark, n, set, component and group of every row (see `jaccard_join.by_links`)."""
    first, moved = J.told_apart(stage(scan(docs, k), "first"))
    return J.by_links(first, links(docs, first, k, percent, moved))


def deduplicate(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id of the row's group) and kept (whether it is the row's) of every row."""
    rows = components(docs, k, percent)
    return rows.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc_id").eqNullSafe(F.col("component")).alias("kept"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS i, len(w) AS n FROM d),
g AS (SELECT r, n, list(x) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS s, i FROM p),
s AS MATERIALIZED (SELECT DISTINCT r, s FROM g WHERE len(s) = 4 OR (n < 4 AND i = 0)),
c AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM o JOIN c x ON x.r = a JOIN c y ON y.r = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
t AS (SELECT r AS a, r AS b FROM d UNION SELECT t.a, l.b FROM t JOIN l ON t.b = l.a)
SELECT d.doc_id, coalesce(c.n, 0)::BIGINT AS n_shingles, m.component_id, m.component_id = d.doc_id AS kept
FROM d LEFT JOIN c USING (r) JOIN (SELECT t.a, min(e.doc_id) AS component_id FROM t JOIN d e ON e.r = t.b GROUP BY t.a) m ON m.a = d.r
"""
