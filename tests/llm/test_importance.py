from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tessera.llm import importance

from .conftest import SCHEMA, odd_rows, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows: list[tuple], target: list[str], orders: int = 2, percent: int = 25) -> list[tuple]:
    """doc_id, n_features, weight, score, rank by loops; rank is left out where equal keys make it ambiguous."""

    def features(text):
        words = WORD.findall((text or "").translate(LOWER))
        return len(words), [" ".join(words[i : i + n]) for n in range(1, orders + 1) for i in range(len(words) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % 10_000

    own = [(r[0], *features(r[1])) for r in rows]
    s, t = Counter(bucket(f) for _, _, fs in own for f in fs), Counter(bucket(f) for x in target for f in features(x)[1])
    total, wanted = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((float(t[b] + 1) * float(total + 10_000)) / (float(n + 1) * float(wanted + 10_000)))) for b, n in s.items()}
    out = []
    for doc, n, fs in own:
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    enough = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = enough[: percent * len(enough) // 100]
    ranked = [(d, n, w, sc, i + 1) for i, (d, _, n, w, sc) in enumerate(drawn)]
    rest = Counter(out) - Counter(drawn)
    return sorted(map(str, ranked + [(d, n, w, sc, None) for d, _, n, w, sc in rest.elements()]))


def rows_of(df) -> list[str]:
    return sorted(str(tuple(r)) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("block", [importance.BLOCK, 3])
def test_same_as_loops(spark, odd, monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK", block)
    target = [prose(60, 5, 3), "ΣΑΣ naïve Ünïcode", "", None]
    got = importance.resample(odd, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string"))
    assert rows_of(got) == plain(odd_rows(), target)


def test_three_words_a_feature(spark, odd):
    got = importance.resample(odd, spark.createDataFrame([("alpha0 theta1 omicron4",)], "text string"), orders=3)
    assert rows_of(got) == plain(odd_rows(), ["alpha0 theta1 omicron4"], orders=3)


def test_many_equal_scores_are_spread_over_ranges(spark):
    rows = [(None, prose(25), "en", "a", 0)] * 300 + [(i, prose(25, 3, i), "en", "a", 0) for i in range(200)]
    got = importance.resample(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(prose(9),)], "text string"))
    assert rows_of(got) == plain(rows, [prose(9)])
    drawn = sorted(r.rank for r in got.collect() if r["rank"])
    assert drawn == list(range(1, 126))


def test_the_target_draws_its_kind(spark):
    rows = [(i, ("stars and planets shine " if i % 2 else "bread and butter taste ") * 8 + prose(10, 3, i), "en", "a", 0) for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = importance.select_documents(docs, spark.createDataFrame([("planets and stars shine " * 60,), ("the stars shine " * 60,)], "text string"))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and len(ids) == 100 and sum(i % 2 for i in ids) > 70


def test_empty_tables(spark, empty, odd):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(empty, none).count() == 0
    assert rows_of(importance.resample(odd, none)) == plain(odd_rows(), [])


def test_the_window_adds_no_exchange_to_the_blocks(spark, odd):
    plan = importance.feature_rows(odd.select("doc_id", "text").withColumnRenamed("doc_id", "row"), ["row"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "Arrow" not in plan
