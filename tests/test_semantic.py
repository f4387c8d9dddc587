from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import chunking as C
from tessera.operators import embedding, semantic


def texts(n: int = 60) -> list[tuple[int, str | None]]:
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    made = [" ".join(rng.choice(words) + rng.choice(["", "", ".", "!", "?\n"]) for _ in range(rng.randint(0, 300))) for _ in range(n)]
    odd = [None, "", "  \n ", "One.", "same. same. same. same.", "no end " * 500, "... ... !? x", "Größe ist 😀. Ja.  Nein?\t\nЖук."]
    return list(enumerate(made + odd))


@pytest.mark.parametrize("sizes", [(800, 100), (20, 3)])
def test_plan_gives_the_kernels_chunks(spark, sizes):
    df = spark.createDataFrame(texts(), "id long, content_md string").repartition(3)
    got = {r.id: [(c.text, c["index"]) for c in r.chunks] for r in semantic.chunk(df, "id", *sizes).collect() if r.chunks}
    expected = {i: [(c, n) for n, c in enumerate(C.semantic(t or "", C.Sizes(4 * sizes[0], 4 * sizes[1])))] for i, t in texts()}
    assert got == {i: found for i, found in expected.items() if found}
    assert max(map(len, got.values())) > 10


def test_one_shuffle_of_sentences(spark):
    df = spark.createDataFrame(texts(5), "id long, content_md string")
    plan = semantic.chunk(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "around" not in plan[plan.index("Window") : plan.index("Exchange hashpartitioning")]


def test_distances_across_batches(spark, monkeypatch):
    df = spark.createDataFrame([(i, " ".join(f"a{j} b{j % 3}." for j in range(50))) for i in range(4)], "id long, content_md string").coalesce(1)
    rows = lambda: semantic.distances(semantic.sentence_rows(df, "id", "content_md"), "id", "hashing").orderBy("id", "pos").collect()
    at_once = rows()
    monkeypatch.setattr(embedding, "BATCH", 7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        assert rows() == at_once
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.pos for r in at_once if r.distance is None] == [0] * 4


def _picky() -> embedding.Embedder:
    def embed(given: list[str]) -> np.ndarray:
        if any("poison" in t for t in given):
            raise ValueError("can't")
        return embedding.hashed_vectors(given, 64)

    return embed


def test_a_failing_sentence_is_its_texts_error(spark, monkeypatch):
    monkeypatch.setitem(embedding.MODELS, "picky", _picky)
    df = spark.createDataFrame([(1, "A b. C d. E f."), (2, "A b. poison. E f.")], "id long, content_md string")
    one, two = semantic.chunk(df, "id", model="picky").orderBy("id").collect()
    assert one.error is None and one.chunks and two.error == "ValueError: can't" and two.chunks == []


def test_keys(spark):
    df = spark.createDataFrame([(1, "A b. C d."), (1, "A b. C d.")], "id long, content_md string")
    with pytest.raises(PySparkException, match="a key of several texts: 1"):
        semantic.parts(df, "id").collect()
    null = spark.createDataFrame([(None, "A b.", 1)], "id long, content_md string, part int")  # a null key, a clashing column
    assert [(r.id, r.part, r.text) for r in semantic.parts(null, "id").collect()] == [(None, 0, "A b.")]
    assert semantic.chunk(df.where(F.lit(False)), "id").count() == 0
    with pytest.raises(ValueError, match="Unknown embedding model"):
        semantic.parts(df, "id", model="none")
