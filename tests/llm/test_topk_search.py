from __future__ import annotations

import math

import numpy as np
import pytest

from tessera.llm import topk_search as T


def brute(rows: list[tuple], k: int, step: int) -> list[tuple]:
    good = [(i, [math.floor(1024 * x) for x in np.asarray(v, dtype=np.float64).tolist()]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % step == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(v) == len(w))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **how) -> list[tuple]:
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(tuple(r) for r in T.search(table, **how).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:  # many centres, shelves and packs
        for name, value in (("SHELF", 40), ("PACK", 7), ("BLOCK", 8), ("PAGE", 3)):
            monkeypatch.setattr(T, name, value)
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(5, 12))
    v = np.float32(centres[rng.integers(0, 5, 900)] + rng.normal(scale=0.3, size=(900, 12)))
    v[100:400] = v[100]  # a third of all rows is one vector
    rows = [(int(i), x.tolist()) for i, x in enumerate(v)]
    assert run(spark, rows, k=10, query_step=50) == brute(rows, 10, 50)


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (100, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [-1.0, -1.0]), (200, [0.0, 0.0]), (1, [1.0, 0.0]), (300, None)]
    assert run(spark, rows) == brute(rows, 10, 100)
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0])]) == []
    assert run(spark, [(1, [1.0])]) == []


def test_vectors_of_several_lengths_and_clashing_columns(spark):
    rng = np.random.default_rng(2)
    rows = [(i, np.float32(rng.normal(size=(3, 5, 5, 1)[i % 4])).tolist(), i, "x", 1.0, 7) for i in range(200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, key long, v string, score double, dim int")
    assert sorted(map(tuple, T.search(table, query_step=10).collect())) == brute([r[:2] for r in rows], 10, 10)


def test_only_shelves_that_can_matter_are_visited(spark, monkeypatch):
    for name, value in (("SHELF", 50), ("BLOCK", 10), ("PAGE", 4)):
        monkeypatch.setattr(T, name, value)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16)) * 5
    rows = [(i, np.float32(centres[i % 3] + rng.normal(scale=0.1, size=16)).tolist()) for i in range(1200)]
    asked = []
    plain = T._asks
    monkeypatch.setattr(T, "_asks", lambda m: asked.append(plain(m)) or asked[-1])
    assert run(spark, rows, query_step=20) == brute(rows, 10, 20)
    shelves = T.deal(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 1024).select(*T.KEYS).distinct().count()
    assert 0 < asked[0].count() < 60 * (shelves - 1) / 2


def test_sums_beyond_64_bits_are_exact_and_larger_scores_raise(spark):
    rows = [(0, [2.0**45, 0.0])] + [(i, [(i - 3) * 2.0**-10, 2.0**45]) for i in range(1, 8)]
    assert run(spark, rows) == brute(rows, 10, 100)
    with pytest.raises(Exception):  # noqa: B017
        run(spark, [(0, [2.0**50, 0.0]), (1, [2.0**50, 0.0])])
    with pytest.raises(Exception):  # noqa: B017
        run(spark, [(0, [2.0**70, 0.0]), (1, [1.0, 0.0])])


def test_large_components_stay_exact(spark):
    rows = [(i, [float(1e6 + i), -1e6]) for i in range(4)]
    assert run(spark, rows, query_step=2) == brute(rows, 10, 2)


def test_bounds_prune():
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.integers(-10, 10, (400, 4)) + c for c in ([500, 0, 0, 0], [-500, 0, 0, 0])])
    shelf = T.Shelf(np.arange(800), vectors, 50)
    q = np.array([[100, 1, 1, 1]])
    bounds = np.maximum(q, 0) @ shelf.high.T + np.minimum(q, 0) @ shelf.low.T
    scores = shelf.vectors @ q[0]
    assert all(scores[a : a + 50].max() <= b for a, b in zip(shelf.starts, bounds[0], strict=True))
    ids, best = shelf.search(np.array([-1]), q, np.array([-(1 << 62)]), 5)[0]
    order = np.lexsort((shelf.ids, -scores))[:5]
    assert ids.tolist() == shelf.ids[order].tolist() and best.tolist() == scores[order].astype(int).tolist()
