"""Every catalogue query against its SQL, over the smallest of the driver's tables where they are there."""

from __future__ import annotations

import hashlib
import math
import os

import pytest

import __spark_entry__ as entry
from tessera.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
needs_tables = pytest.mark.skipif(not os.path.exists(f"{SF}/documents.parquet"), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows) -> list[tuple]:
    return sorted(tuple("null" if v is None or isinstance(v, float) and math.isnan(v) else str(v) for v in r) for r in rows)


@needs_tables
@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    found = duck.execute(f"SELECT {', '.join(columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    assert plain(got.select(*columns).collect()) == plain(found)


@needs_tables
@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_queries_without_sql_have_rows(spark, name):
    assert catalogue.QUERIES[name](spark, SF).count() > 0


def test_search_reads_texts_to_their_end(spark, tmp_path):
    rows = [(1, "s", "en", "filler " * 400 + "the of and that in " * 400), (2, "s", "en", "filler " * 400)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "the of and that in")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r.distance < 0.5 for r in catalogue.QUERIES["search"](spark, str(tmp_path)).collect()] == [True, False]
    assert [r.score > 0.5 for r in catalogue.QUERIES["deduplicated_results"](spark, str(tmp_path)).orderBy("rank").collect()] == [True, False]


@pytest.mark.parametrize("spec", ["hybrid", "rerank_hybrid"])
def test_the_collection_is_made_while_there_is_no_index(spark, monkeypatch, spec):
    """What is shuffled for the collection takes the most disk; the index used to stand beside it."""
    made = []
    rows = spark.createDataFrame([], "id string, content_id string, document string, embedding array<double>, metadata string")

    class Own:
        collection = property(lambda self: made.append("collection") or rows)
        lexical = property(lambda self: made.append("lexical"))

    monkeypatch.setattr(catalogue, "ready", lambda spark, d: Own())
    catalogue._strategy(spark, "", spec)
    assert made == ["collection", "lexical"]


def test_documents_of_all_chunks(spark, tmp_path):
    texts = {i: " ".join(f"word{i}x{j}" for j in range(n)) for i, n in ((1, 20), (2, 300), (3, 900), (4, 2000))}
    spark.createDataFrame([(i, "s", "en", t) for i, t in texts.items()], "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = set()
    for i, t in texts.items():
        for k in range(1 if len(t) <= 3200 else math.ceil((len(t) - 400) / 2800)):
            document = f"Title: Document {i} | Author: en\n{t[2800 * k : 2800 * k + 3200].strip()}"
            expected.add((f"s::{i}::chunk{k}", f"s::{i}", hashlib.md5(document.encode()).hexdigest(), f"https://example.org/d/{i}" if i % 3 else None))
    got = [tuple(r) for r in catalogue.QUERIES["chunk_documents_whole"](spark, str(tmp_path)).collect()]
    assert len(got) == len(expected) > 10 and set(got) == expected


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.QUERIES) <= set(entry.queries())
