"""Curated evaluation sets, from the file to the report."""

from __future__ import annotations

import json

import pytest

from tessera.operators import embedding, evaluation
from tessera.operators.collections import Store
from tessera.plans import report
from tessera.sources import evaluation_set

YAML = """
version: v7
queries:
  - query: red apples
    expected_content_ids: [s::1, s::1, s::9]
    category: zebra
  - {query: blue whales, expected_content_ids: [s::2]}
  - {query: nothing of this, category: negative, id: last}
  - {query: green pears, expected_content_ids: [s::3], category: zebra}
"""


def test_a_file_is_read_in_its_order(spark, tmp_path):
    (tmp_path / "q.yaml").write_text(YAML)
    queries, version = evaluation_set.load(spark, tmp_path / "q.yaml")
    assert version == "v7"
    assert [(r.query_id, r.expected, r.category) for r in queries.orderBy("position").collect()] == [
        ("1", ["s::1", "s::9"], "zebra"), ("2", ["s::2"], "easy"), ("last", [], "negative"), ("4", ["s::3"], "zebra")]
    assert [(r.category, r.queries) for r in evaluation.categories(queries).orderBy("first").collect()] == [("zebra", 2), ("easy", 1), ("negative", 1)]
    contents = spark.createDataFrame([("s::1",), ("s::2",), ("s::3",), (None,)], "content_id string")
    assert [tuple(r) for r in evaluation.unresolved(queries, contents).collect()] == [("1", "s::9")]


@pytest.mark.parametrize("bad", [[{"query": " "}], [{"expected_content_ids": ["a"]}], ["text"], [{"query": "a", "expected_content_ids": "s::1"}], [{"query": "a", "id": 2}, {"query": "b"}]])
def test_bad_files(spark, tmp_path, bad):
    (tmp_path / "q.json").write_text(json.dumps({"queries": bad}))
    with pytest.raises(ValueError):
        evaluation_set.load(spark, tmp_path / "q.json")


def test_empty_sets_are_told_before_an_evaluation(spark, tmp_path):
    (tmp_path / "q.json").write_text("{}")
    queries, version = evaluation_set.load(spark, tmp_path / "q.json")
    assert version == "" and queries.count() == 0
    with pytest.raises(ValueError, match="no evaluation queries"):
        evaluation.preflight(queries, ["a"], ["a__cosine"])


def test_the_report_keeps_the_order_of_categories(spark, tmp_path):
    (tmp_path / "q.yaml").write_text(YAML)
    queries, version = evaluation_set.load(spark, tmp_path / "q.yaml")
    rows = spark.createDataFrame([(f"s::{i}::chunk0", f"s::{i}", "s", t) for i, t in ((1, "red apples"), (2, "blue whales"), (3, "green pears"))], "id string, content_id string, source_key string, document string")
    empty = "struct<title:string,author:string,content_date:string,url:string,content_id:string,chunk_index:int,heading:string>"
    store = Store(spark, f"{tmp_path}/store")
    store.replace("a", embedding.embed(rows, "document", "hashing").selectExpr("*", f"from_json('{{}}', '{empty}') AS metadata"))
    found, _ = report.run(store, queries, tmp_path / "out", version, ["a__cosine"], model=lambda _: "hashing", lone=1)
    made = json.loads(found.read_text())
    own = made["combos"]["a__cosine"]
    assert made["query_set_version"] == "v7" and made["num_queries"] == 4 and list(own["by_category"]) == ["zebra", "easy", "negative"]
    assert own["by_category"]["easy"]["recall"] == 1 and own["by_category"]["zebra"]["recall"] == 0.75
