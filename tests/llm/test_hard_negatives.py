from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tessera.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows: list[tuple]) -> list[tuple]:
    good = []
    for at, (i, e, label) in enumerate(rows):
        if i is None or label is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in e]
        if math.sqrt(sum(x * x for x in v)) < H.LONGEST:
            good.append((i, at, (label + 1) % 10 if i % 7 == 0 else label, v))
    out = []
    for a, at, label, v in good:
        if a % 50:
            continue
        score = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, j, other) for i, j, other, w in good if j != at and len(w) == len(v)]
        for s, p, *_ in sorted(x for x in score if x[3] == label)[:5]:
            hard = sorted(x for x in score if x[3] != label and -50 * s <= -100 * x[0] <= -95 * s)
            out += [(a, p, rank + 1, n, -s, -t) for rank, (t, n, *_) in enumerate(hard[:3])]
    return sorted(out)


def mined(spark, rows: list[tuple]) -> list[tuple]:
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", rep string, rank int").repartition(5)
    return sorted(tuple(r) for r in H.mine(H.relabelled(table)).collect())


@pytest.fixture
def small_nodes(monkeypatch):
    for name, value in (("LEAF", 16), ("PACK", 4), ("PAGE", 3), ("FIRST", 2)):
        monkeypatch.setattr(H, name, value)


def test_same_as_brute_force_on_clusters(spark, small_nodes):
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(6, 8)) * 2
    rows = [(i, [float(x) for x in middle[i % 6] + rng.normal(size=8) * 0.6], (i % 6 + (i % 11 == 0)) % 10) for i in range(1200)]
    expected = plain(rows)
    assert len(expected) > 100
    assert mined(spark, rows) == expected


def test_odd_rows_copies_and_ties(spark, small_nodes):
    rng = random.Random(4)
    rows: list[tuple] = [(i, [float(rng.randrange(-2, 3)) / 2 for _ in range(3)], rng.randrange(3)) for i in range(300)]
    rows += [(1000 + i, [1.0, 0.5, 0.5], 1) for i in range(250)] + [(2000 + i, [0.5, 0.5, 0.5], 2) for i in range(60)]  # copies, anchors among them
    rows += [(4000 + i, [0.25 * (i % 5), 1.0], i % 2) for i in range(51)]  # vectors of another length
    rows += [rows[0], rows[50], (50, [0.0, 0.0, 1.0], 0), (100, [3e6, 0.0, 0.0], 1), (150, [1e30, 0.0, 0.0], 1)]
    rows += [(None, [1.0, 1.0, 1.0], 1), (200, None, 1), (250, [1.0, None, 0.0], 1), (5000, [1.0, float("nan"), 0.0], 1), (5050, [float("inf"), 0.0, 0.0], 1), (5100, [1.0, 0.0, 0.0], None), (5150, [], 1)]
    assert mined(spark, rows) == plain(rows)


def test_empty_and_single_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0, 2.0], 3)]) == []


def test_intervals_hold_all_products():
    rng = np.random.default_rng(0)
    sets = [rng.integers(-300, 300, (n, 12)) + rng.integers(-500, 500, 12) for n in (1, 5, 40, 200)]
    for a in sets:
        low, high = H.intervals(H.node_of(a), [H.node_of(b) for b in sets])
        for b, lo, hi in zip(sets, low, high, strict=True):
            s = a @ b.T
            assert lo <= s.min() and s.max() <= hi


def test_far_cells_and_leaves_are_never_scored(spark, small_nodes, monkeypatch):
    rng = np.random.default_rng(1)
    middle = np.eye(4) * 30
    rows = [(i, [float(x) for x in middle[i % 4] + rng.normal(size=4) * 0.1], i % 4) for i in range(800)]
    forest = H.Forest(spark.createDataFrame(rows, SCHEMA), 256, 50, 6)
    windows = forest.packed.selectExpr("rep", "0 AS slot", f"{H.LEAST} AS lo", f"{H.MOST} AS hi")
    packs = H.packs_of(forest, windows)
    # a window just below the products within a cluster: only the own cluster's leaves can reach it
    near = packs.withColumn("lo", H.F.lit(256 * 256 * 800).cast("long"))
    asks = H.descend(forest, near, True)
    leaves = forest.leaves.count()
    assert 0 < asks.count() < packs.count() * leaves / 3
    assert H.descend(forest, near, False).count() == 0


def test_percentages_are_exact(spark):
    scores = [0, 1, 7, 19, 20, 99, 101, 12345, 10**15 + 37, (1 << 60) - 1]
    got = spark.createDataFrame([(s,) for s in scores], "_s long").select("_s", H.percent_of(H.F.col("_s"), 50, True).alias("lo"), H.percent_of(H.F.col("_s"), 95, False).alias("hi")).collect()
    assert [(r["_s"], r.lo, r.hi) for r in got] == [(s, -(-50 * s // 100), 95 * s // 100) for s in scores]
