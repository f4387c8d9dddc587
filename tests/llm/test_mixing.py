from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from tessera.llm import mixing


def brute_targets(sizes: dict, weights=(3, 1, 2), share=1.5, most=2.0) -> dict:
    """Water filling by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        w = sum(weight[s] for s in open_)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in open_ if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 50, "c": 10, None: 5}, {"a": 1, "b": 1000}, {"a": 0, "b": 10, "c": 0}, {"x": 7}, {f"s{i:02}": (i * 37) % 91 + 1 for i in range(40)}])
def test_targets_match_brute_force(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_odd_rows(odd):
    rows = mixing.mix_documents(odd).collect()
    assert len(rows) == odd.count()
    words = Counter((r.doc_id, len((r.text or "").split())) for r in odd.collect())
    assert Counter((r.doc_id, r.size) for r in rows) == words
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_documents(odd.repartition(5)).collect()))


def test_sampling_is_near_the_targets(spark):
    docs = spark.sql("SELECT id AS doc_id, repeat('w ', cast(1 + (id * 7919) % 300 AS int)) AS text, CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 7) END AS source FROM range(6000)")
    taken, target = defaultdict(int), {}
    for r in mixing.mix_documents(docs).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) < 0.01 * target[s] for s in target)


def test_take_gives_each_row_its_copies(odd):
    mixed = Counter()
    for r in mixing.mix_documents(odd).collect():
        mixed[r.doc_id, r.source, r.size] += r.copies
    took = mixing.take(odd)
    assert took.columns == odd.columns
    found = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in took.collect())
    rows = Counter((r.doc_id, r.source, len((r.text or "").split())) for r in odd.collect())
    for key, n in rows.items():
        assert found[key] == mixed[key] if n == 1 else abs(found[key] - mixed[key]) < n


def test_take_meets_the_number_among_rows_of_one_key(spark):
    texts = [f"a{i} b c d e" for i in range(999)] + ["same in three rows"] * 3
    # a fourth word makes the repeated ones a group of their own
    rows = [(None, "s", t) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    decided = defaultdict(int)
    for r in mixing.mix_documents(docs, share=0.55).collect():
        decided[r.size] += r.copies
    got = [Counter(r.text for r in mixing.take(docs.repartition(n), share=0.55).collect()) for n in (1, 5)]
    assert got[0] == got[1]
    for size in (4, 5):
        assert sum(n for t, n in got[0].items() if len(t.split()) == size) == decided[size]
    assert max(n for t, n in got[0].items() if t != "same in three rows") == 1


def test_empty_table(empty):
    assert mixing.mix_documents(empty).count() == 0
    assert mixing.take(empty).count() == 0
