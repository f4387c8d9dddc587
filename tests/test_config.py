"""Strategies from files, and chunkers that users add."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tessera import config
from tessera.operators import chunking

FOUND = {
    "index_strategies": {
        "one": {"collection_name": "a", "chunking": "fixed", "embedding_model": "hashing", "chunk_size": 50, "chunk_overlap": 5, "description": "some\n  words"},
        "two": {"collection_name": "b", "chunking": "semantic", "embedding_model": "all-MiniLM-L6-v2"},
    },
    "retrieval_strategies": {"cosine": {"description": "x"}},
    "eval_combos": ["b__cosine", "a__rerank_hybrid", "c__cosine"],
}


def test_a_file_has_its_own_strategies_and_combinations(tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(FOUND))
    found = config.load(tmp_path / "s.json")
    assert found.strategy("one") == config.Strategy("one", "a", "fixed", "hashing", 50, 5, "some words")
    assert found.strategy("two").chunk_size == config.SIZE and found.combos == ("b__cosine", "a__rerank_hybrid", "c__cosine")
    assert found.model_of("b") == "all-MiniLM-L6-v2"
    for bad in (lambda: found.model_of("c"), lambda: found.strategy("three")):
        with pytest.raises(ValueError):
            bad()
    (tmp_path / "n.json").write_text(json.dumps({"index_strategies": FOUND["index_strategies"]}))
    assert config.load(tmp_path / "n.json").combos[:5] == ("a__cosine", "a__rerank", "a__hybrid", "a__rerank_hybrid", "b__cosine")
    for wrong in ({"index_strategies": {"x": {"collection_name": "a"}}}, {"eval_combos": ["nothing"]}):
        (tmp_path / "w.json").write_text(json.dumps(wrong))
        with pytest.raises(ValueError):
            config.load(tmp_path / "w.json")


def test_yaml(tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "s.yaml").write_text("# names\n" + yaml.safe_dump(FOUND))
    (tmp_path / "s.json").write_text(json.dumps(FOUND))
    assert config.load(tmp_path / "s.yaml") == config.load(tmp_path / "s.json")


def test_added_chunkers(spark, monkeypatch):
    monkeypatch.setattr(chunking, "KERNELS", dict(chunking.KERNELS))
    monkeypatch.setattr(chunking, "ADDED", {})

    def halves(text, sizes):
        if "bad" in text:
            raise ValueError("no")
        return [(text[: len(text) // 2], "first"), text[len(text) // 2 :]]

    chunking.register("halves", halves)
    chunking.register("lines", column=lambda text, sizes: F.split(text, "\n"))
    rows = spark.createDataFrame([("a", "one two"), ("b", "x\n\n y "), ("c", "bad"), ("d", None)], "content_id string, content_md string")
    got = {r.content_id: ([(c.text, c.heading, c["index"]) for c in r.chunks], r.error) for r in chunking.chunk(rows, "halves").collect()}
    assert got["a"] == ([("one", "first", 0), (" two", "", 1)], None) and got["c"] == ([], "ValueError: no")
    got = {r.content_id: [c.text for c in r.chunks] for r in chunking.chunk(rows, "lines").collect()}
    assert got == {"a": ["one two"], "b": ["x", "y"], "c": ["bad"], "d": []}
    assert {"halves", "lines", "fixed"} <= set(chunking.strategies())
    with pytest.raises(ValueError):
        chunking.register("both", halves, lambda text, sizes: text)
    with pytest.raises(ValueError, match="halves"):
        chunking.chunk(rows, "unknown")
