from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.config import EVAL_COMBOS, get_strategy, model_of_collection, parse_combo
from tessera.functions import metrics as M
from tessera.functions import text as X
from tessera.functions import vectors as V


def one(spark, column, **values):
    """The value of a column expression over one row of SQL literals."""
    return spark.range(1).select(*(F.expr(v).alias(k) for k, v in values.items())).select(column.alias("r")).first().r


@pytest.mark.parametrize("text", ["a", "", " \t x　 ", "\u0085\x1c y  ", "  ", "²‿ x"])
def test_strip_is_python_s(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(X.strip(F.col("t")).alias("r")).first().r
    assert got == text.strip()


def test_tokens(spark):
    rows = spark.createDataFrame([("Café, 日本 x_1 ‿ ² don't",), ("",)], "t string").select(X.tokens(F.col("t")).alias("r")).collect()
    assert [r.r for r in rows] == [["café", "日本", "x_1", "²", "don", "t"], []]


def test_safe_filenames(spark):
    ids = ["a/b:c", "x" * 200, "y" * 201, "ü"]
    got = [r.r for r in spark.createDataFrame([(i,) for i in ids], "i string").select(X.safe_filename(F.col("i")).alias("r")).collect()]
    assert got[0] == "a_b_c" and got[1] == "x" * 200 and got[2].startswith("y" * 180 + "__") and len(got[2]) == 194 and got[3] == "_"


@pytest.mark.parametrize(("n", "text"), [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1536, "1.5 KB"), (5 * 1024 * 1024, "5.0 MB")])
def test_human_size(spark, n, text):
    assert one(spark, X.human_size(F.col("n")), n=f"{n}L") == text


def test_combos(spark):
    assert parse_combo("a__b") == ("a", "b") and parse_combo("a__b__c") == ("a", "b__c")
    for bad in ("ab", "a__", "__b", ""):
        with pytest.raises(ValueError):
            parse_combo(bad)
        with pytest.raises(Exception):  # noqa: B017
            one(spark, X.split_combo(F.col("c")), c=f"'{bad}'")
    assert tuple(one(spark, X.split_combo(F.col("c")), c="'a__b__c'")) == ("a", "b__c")
    assert len(EVAL_COMBOS) == 16 and all(model_of_collection(parse_combo(c)[0]) for c in EVAL_COMBOS)
    with pytest.raises(ValueError):
        get_strategy("none")
    with pytest.raises(ValueError):
        model_of_collection("none")


def python_metrics(got: list[str], want: list[str], k: int) -> tuple:
    top = got[:k]
    recall = sum(e in top for e in want) / len(want) if want else 0.0
    precision = sum(g in want for g in top) / len(top) if top else 0.0
    return recall, precision, next((1 / (i + 1) for i, g in enumerate(got) if g in want), 0.0)


def test_metrics_match_python(spark):
    import random

    rng = random.Random(0)
    rows = [([rng.choice("abcdef") for _ in range(rng.randrange(8))], [rng.choice("abcxyz") for _ in range(rng.randrange(4))]) for _ in range(200)]
    got = spark.createDataFrame(rows, "g array<string>, w array<string>").select("g", "w", M.recall_at(F.col("g"), F.col("w"), 3).alias("r"), M.precision_at(F.col("g"), F.col("w"), 3).alias("p"), M.reciprocal_rank(F.col("g"), F.col("w")).alias("m"))
    for r in got.collect():
        assert (r.r, r.p, r.m) == pytest.approx(python_metrics(r.g, r.w, 3))


@pytest.mark.parametrize(("ids", "order"), [([], []), (["a"], ["a"]), (["a", "b"], ["a", "b"]), (list("abcde"), list("acedb")), (list("abcdef"), list("acefdb"))])
def test_middle_last(spark, ids, order):
    rows = spark.createDataFrame([(ids,)], "i array<string>")
    assert rows.select(M.middle_last(F.col("i")).alias("r")).first().r == order


def test_unique_ids_keep_first_places(spark):
    assert one(spark, M.unique_ids(F.col("i")), i="array('b', '', 'a', 'b', 'c', 'a')") == ["b", "a", "c"]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=3, max_size=3), st.lists(st.floats(-5, 5), min_size=3, max_size=3))
def test_cosine(a, b):
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    got = spark.createDataFrame([(a, b)], "a array<double>, b array<double>").select(V.cosine_similarity(F.col("a"), F.col("b")).alias("r")).first().r
    norm = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
    if norm > 1e-6:
        assert got == pytest.approx(sum(x * y for x, y in zip(a, b, strict=True)) / norm, abs=1e-6)


def test_null_and_empty_defaults(spark):
    assert one(spark, X.default(F.col("t"), "d"), t="''") == "d" == one(spark, X.default(F.col("t"), "d"), t="cast(null as string)")
    assert one(spark, X.iso_date(F.col("t")), t="cast(null as date)") == "" and one(spark, X.iso_date(F.col("t")), t="date'2026-03-01'") == "2026-03-01"
    assert one(spark, X.heading_path(F.col("a"), F.col("b"), F.col("c")), a="'A'", b="''", c="'C'") == "A > C"
