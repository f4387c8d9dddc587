"""Embedders: kept by worker, and one bad text beside many good ones."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.config import Strategy
from tessera.operators import embedding
from tessera.operators.collections import Store
from tessera.plans import indexing

from .test_workbench import raw


def poisonous(calls=None):
    def embed(texts):
        if calls is not None:
            calls.append(len(texts))
        if any("poison" in t for t in texts):
            raise ValueError("can't read it")
        return np.array([[len(t), 1.0] for t in texts])

    return embed


def test_a_failing_batch_is_halved_until_the_bad_text_stands_alone():
    calls = []
    texts = ["good"] * 10_000
    texts[7311] = "poison"
    vectors, errors = embedding.isolated(poisonous(calls), texts, np.float64)
    assert sum(v is not None for v in vectors) == 9_999 and [i for i, e in enumerate(errors) if e] == [7311] and errors[7311] == "ValueError: can't read it"
    assert len(calls) <= 2 * 14 + 1
    assert embedding.isolated(lambda texts: np.zeros((1, 2)), ["a", "b"], np.float64)[1] == [None, None]  # one row a text is asked for


@pytest.fixture
def model(monkeypatch):
    monkeypatch.setattr(embedding, "MODELS", dict(embedding.MODELS))
    embedding.register("poisonous", poisonous)
    return "poisonous"


def test_errors_stand_in_a_column(spark, model):
    rows = spark.range(10_000).select("id", F.when(F.col("id") == 4321, "poison").otherwise("text").alias("t")).repartition(3)
    got = embedding.embed(rows, "t", model, error="error")
    assert got.where("error is null and size(embedding) = 2").count() == 9_999
    assert [tuple(r) for r in got.where("error is not null").select("id", "embedding", "error").collect()] == [(4321, None, "ValueError: can't read it")]
    with pytest.raises(Exception, match="can't read it"):
        embedding.embed(rows, "t", model).count()


def test_indexing_goes_on_without_a_bad_chunk(spark, tmp_path, model):
    store, strategy = Store(spark, str(tmp_path / "store")), Strategy("s", "a", "fixed", model, 20, 5)
    contents = raw(spark).withColumn("content_md", F.when(F.col("content_id") == "c2", F.concat(F.lit("poison "), F.repeat(F.lit("more text "), 30))).otherwise(F.col("content_md")))
    indexing.build_index(store, contents, strategy)
    assert store.count("a") > 0 and store.read("a").where("document like '%poison%'").count() == 0
    assert {(r.content_id, r.id, r.error) for r in indexing.indexing_errors(contents, strategy).collect()} == {("c2", "c2::chunk0", "ValueError: can't read it")}


def test_a_worker_makes_a_model_once(spark, monkeypatch):
    monkeypatch.setattr(embedding, "MODELS", dict(embedding.MODELS))
    embedding.register("counted", poisonous)
    loads = spark.sparkContext.accumulator(0)
    rows = spark.range(0, 400, 1, 40).select(F.col("id").cast("string").alias("t"))
    for _ in range(3):
        assert embedding.embed(rows, "t", "counted", loads=loads).where("size(embedding) = 2").count() == 400
    assert 1 <= loads.value <= 8  # 120 tasks, four workers at a time


def test_a_worker_keeps_few_models(monkeypatch):
    from collections import OrderedDict

    monkeypatch.setattr(embedding, "_kept", OrderedDict())
    made = []
    for name in ("a", "b", "a", "c", "a", "b"):
        embedding._model(name, "", lambda name=name: made.append(name) or poisonous(), None)
    assert made == ["a", "b", "c", "b"] and len(embedding._kept) == embedding.KEPT_MODELS


def test_tokens_that_were_forgotten_keep_their_places(monkeypatch):
    texts = [" ".join(f"w{i * j}" for i in range(40)) for j in (1, 3, 7)] + ["", "W7 w7 İ _a 漢字"]
    monkeypatch.setattr(embedding._Places, "KEPT", 3)
    for dim, most in ((384, None), (97, None), (97, 5)):
        embedding._places.cache_clear()
        for t, v in zip(texts, embedding.hashed_vectors(texts, dim, most), strict=True):
            expected = [0.0] * dim
            for w in re.findall(r"\w+", t.lower().replace("̇", " "))[:most]:
                expected[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dim] += 1
            assert np.allclose(v, np.array(expected) / max(1e-9, np.linalg.norm(expected)))
    assert len(embedding._places(97)) <= 3
