"""Indexes in files: what they find, and what of them is read."""

from __future__ import annotations

import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import lexical_index, retrieval, vector_index
from tessera.operators.lexical_index import BlockIndex
from tessera.operators.vector_index import VectorIndex
from tessera.sources.shared import Conflict

ROWS = "id string, content_id string, embedding array<float>"


def clustered(spark, clusters: int = 40, each: int = 30, dim: int = 16, seed: int = 3):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dim))
    rows = [(f"r{c:02}x{i:03}", f"c{c}", [float(x) for x in middle[c] + rng.normal(size=dim) * 0.05]) for c in range(clusters) for i in range(each)]
    return spark.createDataFrame(rows, ROWS), middle


def same(found, expected) -> None:
    key = lambda df: sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())
    assert key(found) == key(expected)


@pytest.mark.parametrize(("lists", "block"), [(1, 1024), (40, 8)])
def test_vector_index_finds_what_a_whole_scan_finds(spark, tmp_path, monkeypatch, lists, block):
    monkeypatch.setattr(vector_index, "BLOCK", block)
    rows, middle = clustered(spark)
    odd = [("z1", "z", [0.0] * 16), ("z2", "z", [0.0] * 16), ("n", "n", None), ("m", "m", [1.0, None]), ("e", "e", []), ("s1", "s", [1.0, 2.0]), ("s2", "s", [2.0, 1.0])]
    copies = [(f"k{i}", "k", [1.0] * 16) for i in range(30)]
    rows = rows.unionByName(spark.createDataFrame([*odd, *copies], ROWS))
    wanted = [(f"q{i}", [float(x) for x in m]) for i, m in enumerate(middle[::4])] + [("ones", [1.0] * 16), ("none", [0.0] * 16), ("two", [1.0, 1.0]), ("null", None), ("five", [1.0] * 5)]
    queries = spark.createDataFrame(wanted, "query_id string, embedding array<double>")
    index = VectorIndex.build(rows, str(tmp_path / "index"), lists)
    for k in (1, 45):
        same(index.top(queries, k), retrieval.vector_topk(rows, queries, k))


def test_a_lone_query_reads_few_files(spark, tmp_path, monkeypatch):
    rows, middle = clustered(spark, 60, 40)
    index = VectorIndex.build(rows, str(tmp_path / "index"), 60)
    opened, read = set(), VectorIndex._read

    def noted(self, lists):
        opened.update(lists)
        return read(self, lists)

    monkeypatch.setattr(VectorIndex, "_read", noted)
    query = spark.createDataFrame([("q", [float(x) for x in middle[7]])], "query_id string, embedding array<double>")
    found = index.top(query, 5)
    same(found, retrieval.vector_topk(rows, query, 5))
    files = [int(f.split("list=")[1].split("/")[0]) for f in index.blocks.inputFiles()]
    assert len(files) >= 40 and sum(n in opened for n in files) * 10 < len(files)
    # the numbers are filters on folders, and reach the scan as such
    assert re.search(r"PartitionFilters: \[[^\]]*list#\d+", read(index, [1, 2])._jdf.queryExecution().executedPlan().toString())


def test_queries_of_one_id_have_a_list_each(spark, tmp_path):
    rows, middle = clustered(spark, 5, 10)
    queries = spark.createDataFrame([("q", [float(x) for x in middle[i]]) for i in (0, 1)], "query_id string, embedding array<double>")
    found = VectorIndex.build(rows, str(tmp_path / "index")).top(queries, 2).collect()
    assert len(found) == 4 and {r.content_id for r in found} == {"c0", "c1"}


def texts(spark, rows):
    return spark.createDataFrame(rows, "id string, content_id string, document string")


def asked(spark, *words):
    return spark.createDataFrame([(f"q{i}", w) for i, w in enumerate(words)], "query_id string, query string")


def corpus(n: int = 300, seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(400)]
    weights = 1 / np.arange(1, 401)
    rows = []
    for i in range(n):
        t = [words[j] for j in rng.choice(400, int(rng.integers(0, 60)), p=weights / weights.sum())] + [f"own{i % 50}"] * (i % 4)
        rows.append((f"c{i // 2}::chunk{i % 2}", f"c{i // 2}", " ".join(t)))
    return rows


QUESTIONS = ("w1 w7 own3", "own3 own3 own4 w200", "w0", "W350 w399 w2", "nothing here", "", "own49 w0 w1 w2 w3")


def test_block_index_ranks_as_a_whole_scan(spark, tmp_path):
    rows = texts(spark, corpus())
    index = BlockIndex.build(rows, str(tmp_path / "i"))
    plain = retrieval.LexicalIndex.build(rows)
    opened = BlockIndex(spark, str(tmp_path / "i"))
    for n in (5, 400):
        key = lambda df: sorted((r.query_id, r["rank"], r.chunk_id, round(r.score, 7)) for r in df.collect())
        assert key(opened.top(asked(spark, *QUESTIONS), n)) == key(plain.top(asked(spark, *QUESTIONS), n))
    terms = lambda df: sorted((r.term, r.df, round(r.idf, 9)) for r in df.collect())
    assert terms(index.terms()) == terms(plain.terms)
    # a third of the ranges at most is scored for a rare term's best chunks
    queries = asked(spark, "own3 w200", "own7 w1").withColumn("q", F.col("query_id").substr(2, 9).cast("long"))
    _, counts = opened.search(queries.select("q", "query"), 2)
    assert all(0 < r.visited < r.ranges for r in counts.collect())


def test_changes_leave_the_statistics_of_an_index_built_anew(spark, tmp_path):
    rows = corpus(120)
    index = BlockIndex.build(texts(spark, rows), str(tmp_path / "i"))
    new = [("c3::chunk0", "c3", "w1 fresh words"), ("c900::chunk0", "c900", "w1 w2 fresh"), ("c901::chunk0", "c901", "")]
    index.upsert(texts(spark, new))
    index.delete(spark.createDataFrame([("c5",), ("c6",), ("unknown",)], "content_id string"))
    index.upsert(texts(spark, [("c5::chunk7", "c5", "back again w1")]))
    living = [r for r in rows if r[1] not in ("c3", "c5", "c6")] + new + [("c5::chunk7", "c5", "back again w1")]
    plain = retrieval.LexicalIndex.build(texts(spark, living))
    terms = lambda df: sorted((r.term, r.df, round(r.idf, 9)) for r in df.collect())
    key = lambda df: sorted((r.query_id, r["rank"], r.chunk_id, round(r.score, 7)) for r in df.collect())
    questions = asked(spark, *QUESTIONS, "fresh", "again")
    for compacted in (False, True):
        if compacted:
            BlockIndex(spark, str(tmp_path / "i")).compact()
        opened = BlockIndex(spark, str(tmp_path / "i"))
        assert len(opened.state.segments) == (1 if compacted else 4)
        assert terms(opened.terms()) == terms(plain.terms)
        assert key(opened.top(questions, 6)) == key(plain.top(questions, 6))
    with pytest.raises(Conflict):  # the index was compacted since this one was opened
        index.delete(spark.createDataFrame([("c1",)], "content_id string"))


def test_an_index_without_chunks(spark, tmp_path):
    index = BlockIndex.build(texts(spark, []), str(tmp_path / "i"))
    assert index.top(asked(spark, "a b"), 3).count() == 0 and index.terms().count() == 0
    index.upsert(texts(spark, [("a", "a", "one two")]))
    assert [tuple(r)[:2] for r in index.top(asked(spark, "two"), 3).collect()] == [("q0", "a")]


def test_a_lexical_index_is_smaller_than_its_texts(spark, tmp_path):
    """Ids and lengths used to stand in every entry, and each chunk's terms in a table of their own."""
    rng = random.Random(5)
    rows = [(f"source{i % 20}::{i:08}", f"c{i}", " ".join(f"{rng.choice('bcdfg')}word{int(rng.paretovariate(0.6)) % 50_000}" for _ in range(150))) for i in range(2000)]
    texts(spark, rows).write.parquet(str(tmp_path / "texts"))
    BlockIndex.build(spark.read.parquet(str(tmp_path / "texts")), str(tmp_path / "i"))
    size = lambda name: sum(p.stat().st_size for p in (tmp_path / name).rglob("*.parquet"))
    assert size("i") < size("texts")


def test_packs_hold_each_token_once(monkeypatch):
    monkeypatch.setattr(lexical_index, "PACK", 7)
    monkeypatch.setattr(lexical_index, "TOKENS", 60)
    monkeypatch.setattr(lexical_index, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    rng = random.Random(2)
    chunks = [(f"{rng.random()}", f"c{i}", [f"w{rng.randrange(9)}" for _ in range(rng.choice((0, 1, 12, 90)))]) for i in range(60)]
    schema = pa.schema([("chunk_id", pa.string()), ("content_id", pa.string()), ("t", pa.list_(pa.string())), ("dl", pa.int32())])
    batches = [pa.RecordBatch.from_arrays([*(pa.array(x) for x in list(zip(*chunks[a : a + 11], strict=True))[:2]), pa.array([c[2] for c in chunks[a : a + 11]], schema.field(2).type), pa.nulls(len(chunks[a : a + 11]), pa.int32())], schema=schema) for a in range(0, 60, 11)]
    rows = pa.Table.from_batches(lexical_index._pack(iter(batches))).to_pylist()
    heads = {r["pack"]: r for r in rows if r["term"] is None}
    assert len(heads) > 60 / 7 and all(len(h["dls"]) <= 7 and h["chunk_ids"] == sorted(h["chunk_ids"]) and (sum(h["dls"]) <= 60 or len(h["dls"]) == 1) for h in heads.values())
    found = {(heads[r["pack"]]["chunk_ids"][s], r["term"]): tf for r in rows if r["term"] for s, tf in zip(r["slots"], r["tfs"], strict=True)}
    assert found == {(i, w): n for i, _, t in chunks for w, n in Counter(t).items()} and len(found) == sum(len(r["slots"] or ()) for r in rows)
    assert sorted((i, c, n) for h in heads.values() for i, c, n in zip(h["chunk_ids"], h["content_ids"], h["dls"], strict=True)) == sorted((i, c, len(t)) for i, c, t in chunks)


def test_copies_of_an_id_as_long_as_each_other_are_one_chunk(spark, tmp_path):
    rows = texts(spark, [("a", "a", "one two two"), ("a", "a", "two three one"), ("a", "a", "one"), ("b", "b", "one four"), ("b", "b", "five six")])
    terms = lambda df: sorted((r.term, r.df, round(r.idf, 9)) for r in df.collect())
    assert terms(BlockIndex.build(rows, str(tmp_path / "i")).terms()) == terms(retrieval.LexicalIndex.build(rows).terms)


def test_a_search_keeps_no_table_that_grows_with_the_ranges(spark, tmp_path, monkeypatch):
    """A row for each query and range, and one for each entry scored, used to be written between the steps."""
    index, kept = BlockIndex.build(texts(spark, corpus(600)), str(tmp_path / "i")), []
    plain = lexical_index.stage

    def counted(df, name):
        out = plain(df, name)
        kept.append(out.count())
        return out

    monkeypatch.setattr(lexical_index, "stage", counted)
    assert index.top(asked(spark, *QUESTIONS), 5).count() == 5 * len(QUESTIONS)
    assert sum(kept) <= len(QUESTIONS)


@pytest.mark.parametrize("queries", [2048, 2])
def test_equal_scores_come_in_the_order_of_ids(spark, tmp_path, monkeypatch, queries):
    """Over many packs, some chunks of which are gone, and over several passes."""
    monkeypatch.setattr(lexical_index, "QUERIES", queries)
    rows = [(f"c{i:03}", f"c{i:03}", ("same words here", "same words", "all other")[i % 3]) for i in range(240)]
    random.Random(1).shuffle(rows)
    index = BlockIndex.build(texts(spark, rows).repartition(9), str(tmp_path / "i"))
    index.delete(spark.createDataFrame([(f"c{i:03}",) for i in (0, 3, 1, 100, 239)], "content_id string"))
    living = [r for r in rows if r[1] not in ("c000", "c003", "c001", "c100", "c239")]
    words = ("same", "here words", "here all", "absent", "other other here")
    key = lambda df: sorted((r.query_id, r["rank"], r.chunk_id, round(r.score, 7)) for r in df.collect())
    for n in (7, 90):
        assert key(index.top(asked(spark, *words), n)) == key(retrieval.LexicalIndex.build(texts(spark, living)).top(asked(spark, *words), n))


def test_scores_below_nothing(spark, tmp_path):
    """Of terms that most chunks have, in a corpus with few others, the mean idf is negative, and so are scores."""
    rows = texts(spark, [(f"c{i}", f"c{i}", "in all of them" + " rare" * (i == 3)) for i in range(9)])
    key = lambda df: sorted((r.query_id, r["rank"], r.chunk_id, round(r.score, 7)) for r in df.collect())
    for n in (2, 20):
        assert key(BlockIndex.build(rows, str(tmp_path / f"{n}")).top(asked(spark, "all", "all rare"), n)) == key(retrieval.LexicalIndex.build(rows).top(asked(spark, "all", "all rare"), n))
