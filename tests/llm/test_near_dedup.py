from __future__ import annotations

import random

import numpy as np
import pytest

from tessera.llm import jaccard_join as J
from tessera.llm import near_dedup as N

from .conftest import WORDS, odd_rows, prose
from .test_jaccard_join import brute, edited


def one_by_one(shingles: np.ndarray, places: int) -> list[int]:
    """The signature of one set, a shingle after the other, each until the largest level that a place still holds."""
    best, level_of, held = [int(N.EMPTY)] * places, [places - 1] * places, [0] * (places - 1) + [places]
    highest = places - 1
    for x in shingles:
        order, level = list(range(places)), 0
        while level <= highest:
            (swap,), (value,) = N.draws(np.array([x], dtype=np.uint64), level, places)
            order[level], order[swap] = order[swap], order[level]
            p = order[level]
            if int(value) < best[p]:
                best[p] = int(value)
                if level < level_of[p]:
                    held[level_of[p]] -= 1
                    held[level] += 1
                    level_of[p] = level
                    while not held[highest]:
                        highest -= 1
            level += 1
    return best


@pytest.mark.parametrize("places", [8, 200])
def test_signatures_are_those_of_the_plain_algorithm(places):
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 2, 7, 40, 150, 600)]
    assert N.signatures(sets, places).tolist() == [one_by_one(s, places) for s in sets]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(60):
        x = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        a, b = N.signatures([x[:120], x[30:]])
        off.append((a == b).mean() - 0.6)
    assert abs(np.mean(off)) < 0.02 and np.std(off) < np.sqrt(0.6 * 0.4 / 200)


def test_bands_miss_few_pairs_at_the_threshold():
    assert (1 - 0.8**N.ROWS) ** N.BANDS < 1 / 5_000_000


@pytest.mark.parametrize(("k", "percent"), [(4, 80), (2, 90)])
def test_components_match_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(J, "PACK", 8)
    rng = random.Random(k)
    passage = prose(60, 13).split()
    rows: list[tuple] = []
    for group in range(10):
        base = [rng.choice(WORDS) + str(rng.randrange(200)) for _ in range(rng.choice((4, 9, 40, 120, 300)))]
        if group % 3 == 0:
            base[2:2] = passage
        rows += [(len(rows) + i, " ".join(edited(rng, base, rng.randrange(9)))) for i in range(25 if group else 80)]
    rows += [(5000 + i, " ".join(passage + [rng.choice(WORDS) + str(rng.randrange(999)) for _ in range(3 + i % 15)])) for i in range(60)]
    rng.shuffle(rows)
    got = N.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), k, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, k, percent))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_pairs_near_the_threshold(spark):
    rng = random.Random(3)
    rows: list[tuple] = []
    for i in range(150):
        n = rng.randrange(20, 160)
        words = [f"w{i}x{j}" for j in range(n)]
        gone = max(1, (n - 3) // 5 - rng.randrange(3) + 1)
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[gone:] if i % 2 else words[:-gone]))]
    expected = brute(rows, 4, 80)
    assert 30 < sum(c != d for d, _, c in expected) < 150
    got = N.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(expected)


def test_a_group_meets_another_by_its_most_alike_pair_first(spark):
    """A set that shares buckets with a large group was compared with each set of it."""
    sets = [(i, 100, list(range(N.BANDS)), [(1 << i % 3) - 1] * J.SKETCH) for i in range(1, 41)] + [(100, 100, list(range(N.BANDS)), [3] * J.SKETCH)]
    signed = spark.createDataFrame(sets, "set long, n int, bands array<long>, sketch array<long>")
    lists = signed.select(N.F.explode("bands").alias("band"), "set", "n")
    labels = spark.createDataFrame([(i, 1) for i in range(1, 41)], "set long, group long")
    assert N.rest_pairs(lists, labels, signed, 80).count() == 40
    assert N.rest_pairs(lists, labels, signed, 80, nearest=True).count() == 1
    ((a, b, n, m),) = N.nearest_pairs(lists, labels, signed, 80).collect()
    assert b == 100 and a % 3 == 2 and n == m == 100


def test_odd_rows(spark, odd, empty):
    key = lambda r: tuple(str(x) for x in r)
    got = N.deduplicate(odd).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute([r[:2] for r in odd_rows()], 4, 80), key=key)
    assert {r.doc_id: r.kept for r in got if r.doc_id in (3, 4, 5)} == {3: True, 4: True, 5: True}
    assert N.deduplicate(empty).count() == 0
