from __future__ import annotations

import json
import sqlite3
from datetime import UTC, date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.config import Strategy
from tessera.model import COLLECTION, CONTENTS
from tessera.operators import backup, chunking, contents, embedding, evaluation, generation, postprocess, retrieval
from tessera.operators.collections import Store, by_content, upserted
from tessera.plans import indexing, report
from tessera.sources import files, sqlite
from tessera.streaming import incremental

DDL = """CREATE TABLE contents (content_id TEXT PRIMARY KEY, newsletter_id INTEGER, source_key TEXT, content_date TEXT, title TEXT, author TEXT, url TEXT, content_md TEXT,
 scrape_status TEXT DEFAULT 'full', fetch_tier TEXT, fetch_attempts INTEGER DEFAULT 0, vector_status TEXT DEFAULT 'pending', stored_at TEXT)"""


@pytest.fixture
def database(tmp_path):
    path = tmp_path / "raw.db"
    con = sqlite3.connect(path)
    con.execute(DDL)
    rows = [
        ("leaf:42", 3, "garden", "", "Of leaves", None, "", "green " * 15, "pending", "2025-11-30T23:59:59"),
        ("süd/7", 8, "garden", "2024-02-29", None, "N. N.", None, "tiny", "indexed", "2025-12-05T00:00:00"),
        ("gap", None, "field", None, "", "", None, None, None, None),
    ]
    con.executemany("INSERT INTO contents (content_id, newsletter_id, source_key, content_date, title, author, url, content_md, vector_status, stored_at) VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?, ?)", rows)
    con.commit()
    con.close()
    return path


def raw(spark, n: int = 6):
    rows = [(f"c{i}", i, f"s{i % 2}", date(2026, 1, 1 + i) if i % 3 else None, f"T{i}", "A", None, f"Topic{i} alpha beta gamma. " * 12, "full", None, 0, "pending", datetime(2026, 2, 1 + i)) for i in range(n)]
    return spark.createDataFrame(rows, CONTENTS)


def test_sqlite_contents(spark, database):
    sqlite.register(spark)
    table = spark.read.format("sqlite").option("path", str(database)).option("table", "contents").load()
    rows = contents.decode(table)
    assert contents.count_contents(rows) == 3
    assert [r.content_id for r in contents.in_scan_order(rows).collect()] == ["gap", "leaf:42", "süd/7"]
    assert {r.content_id for r in contents.get_contents(rows, vector_status="pending").collect()} == {"gap", "leaf:42"}
    one = rows.where("content_id = 'süd/7'").first()
    assert one.title == "" and one.scrape_status == "full" and one.content_date == date(2024, 2, 29) and one.stored_at == datetime(2025, 12, 5)
    done = contents.set_vector_status(rows, spark.createDataFrame([("leaf:42", "indexed"), ("none", "x")], "content_id string, vector_status string"))
    assert contents.get_contents(done, vector_status="indexed").count() == 2
    assert [r.content_id for r in contents.get_contents(rows, since="2025-11-30").collect()] == ["leaf:42"] and contents.get_contents(rows, source_key="other").count() == 0
    assert [r.content_id for r in contents.work_items(rows).collect()] == ["leaf:42"]
    assert table.where("newsletter_id = 8 and content_id = 'süd/7'").count() == 1 and table.count() == 3
    own = spark.read.format("sqlite").option("path", str(database)).option("where", "vector_status = 'pending'").load()
    assert [r.content_id for r in own.collect()] == ["leaf:42"]


def test_json_records(spark, tmp_path):
    records = chunking.chunk_records(contents.work_items(raw(spark)), "fixed", 20, 5)
    path = str(tmp_path / "chunks")
    files.write_records(records, path, "s1")
    files.write_records(records.where("content_id = 'c1'"), path, "s2")
    files.write_records(records.where("content_id <> 'c0'"), path, "s1")
    assert {r.content_id for r in files.read_chunks(spark, path, "s1").collect()} == {f"c{i}" for i in range(1, 6)}
    assert files.read_chunks(spark, path, "s2").count() == 1 and files.read_chunks(spark, path, "none").count() == 0
    rows = embedding.embed_records(files.read_chunks(spark, path, "s1"))
    files.write_records(files.embedding_records(rows), str(tmp_path / "vectors"), "s1")
    back = files.read_embeddings(spark, str(tmp_path / "vectors"), "s1").where("content_id = 'c1'").first()
    assert [c.metadata.chunk_index for c in back.chunks] == list(range(len(back.chunks))) and len(back.chunks[0].embedding) == 384
    assert back.chunks[0].id == "c1::chunk0" and back.chunks[0].document.startswith("Title: T1 | Author: A\n")
    first = json.loads(next((tmp_path / "vectors" / "strategy=s1").glob("*.json")).read_text().splitlines()[0])
    assert "url" not in first["metadata_base"]
    names = {r["name"] for r in files.listing(spark, str(tmp_path / "chunks" / "strategy=s2")).collect()}
    hashes = {r["name"]: r["hash"] for r in files.content_hashes(spark, str(tmp_path / "chunks" / "strategy=s2")).collect()}
    assert names >= set(hashes) and all(h == backup.hash_file(tmp_path / "chunks" / "strategy=s2" / n) for n, h in hashes.items())


def test_collections(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.names() == [] and not store.exists("a") and store.read("a").count() == 0
    strategy = Strategy("s", "a", "fixed", embedding.DEFAULT_MODEL, 20, 5)
    indexing.build_index(store, raw(spark), strategy)
    n = store.read("a").count()
    indexing.build_index(store, raw(spark), strategy)
    assert store.names() == ["a"] and store.read("a").count() == n > 6
    shorter = raw(spark).where("content_id = 'c2'").withColumn("content_md", F.substring("content_md", 1, 60))
    indexing.build_index(store, shorter, strategy)
    assert by_content(store.read("a"), shorter).count() == 1 and by_content(store.read("a"), raw(spark)).count() < n
    twice = store.read("a").limit(1)
    assert upserted(store.read("a").limit(0), twice.unionByName(twice)).count() == 1


def plain_bm25(docs: dict[str, str], query: str) -> dict[str, float]:
    import math
    import re

    t = {k: re.findall(r"\w+", v.lower()) for k, v in docs.items()}
    n, avg = len(t), sum(map(len, t.values())) / len(t)
    df = {}
    for ws in t.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - f + 0.5) - math.log(f + 0.5) for w, f in df.items()}
    low = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: low if v < 0 else v for w, v in idf.items()}
    return {k: sum(idf.get(w, 0) * ws.count(w) * 2.5 / (ws.count(w) + 1.5 * (0.25 + 0.75 * len(ws) / avg)) for w in re.findall(r"\w+", query.lower())) for k, ws in t.items()}


DOCS = {"a": "the cat sat on the mat", "b": "the dog sat", "c": "a bird, a plane, a bird", "d": "", "e": "the the the cat"}


def collection(spark):
    rows = [(k, k, v, [float(x) for x in embedding.hashed_vectors([v], 384)[0]], None) for k, v in DOCS.items()]
    return spark.createDataFrame(rows, COLLECTION)


def queries(spark, *texts):
    return spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)], "query_id string, query string")


def test_bm25_matches_plain_python(spark, tmp_path):
    texts = ["cat cat bird", "the sat", "nothing here", ""]
    index = retrieval.LexicalIndex.build(collection(spark))
    found = index.top(queries(spark, *texts), 5).collect()
    index.write(str(tmp_path / "lexical"))
    again = retrieval.LexicalIndex.read(spark, str(tmp_path / "lexical"))
    assert sorted(again.top(queries(spark, *texts), 5).collect()) == sorted(found)
    for i, t in enumerate(texts):
        want = sorted(plain_bm25(DOCS, t).items(), key=lambda x: (-x[1], x[0]))
        got = [(r.chunk_id, r.score) for r in sorted((r for r in found if r.query_id == f"q{i}"), key=lambda r: r["rank"])]
        assert [k for k, _ in got] == [k for k, _ in want] and [s for _, s in got] == pytest.approx([s for _, s in want])


def test_rrf_values(spark):
    make = lambda rows: spark.createDataFrame(rows, "query_id string, chunk_id string, rank int")
    fused = retrieval.fuse([make([("q", "x", 1), ("q", "y", 2), ("q", "z", 3)]), make([("q", "x", 1), ("q", "w", 2), ("q", "z", 10)])], 10).orderBy("rank").collect()
    assert [(r.chunk_id, round(r.score, 4)) for r in fused] == [("x", 0.0328), ("z", round(1 / 63 + 1 / 70, 4)), ("y", 0.0161), ("w", 0.0161)]


def test_strategies(spark):
    rows, q = collection(spark), queries(spark, "cat sat", "bird")
    for name in retrieval.STRATEGIES:
        found = retrieval.build_strategy(rows, name).retrieve(q, 3).collect()
        assert sorted((r.query_id, r["rank"]) for r in found) == [(f"q{i}", k) for i in (0, 1) for k in (1, 2, 3)]
        assert {r.chunk_id for r in found if r["rank"] == 1} == {"a", "c"} or name != "cosine"
    assert retrieval.build_strategy(rows.limit(0), "cosine").retrieve(q, 3).count() == 0
    assert retrieval.build_strategy(rows, "rerank").name == "rerank(cosine)"
    with pytest.raises(ValueError):
        retrieval.build_strategy(rows, "none")
    with pytest.raises(NotImplementedError):
        retrieval.HyDE(retrieval.Cosine(rows)).retrieve(q)
    with pytest.raises(NotImplementedError):
        retrieval.MultiQuery(retrieval.Cosine(rows)).retrieve(q)
    vary = lambda d: d.select("query_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("variant"), "query")
    assert retrieval.MultiQuery(retrieval.Cosine(rows), vary).retrieve(q, 2).count() == 4
    assert retrieval.HyDE(retrieval.Cosine(rows), lambda d: d.withColumn("query", F.lit("bird"))).retrieve(q, 1).select("chunk_id").distinct().count() == 1
    assert retrieval.search(rows, "dog", 1).first().chunk == DOCS["b"]


def test_topk_in_packs_matches_numpy(spark, monkeypatch):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(300, 8))
    v[50:80] = v[50]
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, embedding array<double>").repartition(4)
    q = rows.where("id % 10 = 0").select(F.col("id").cast("string").alias("query_id"), "embedding")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.round(u @ u.T, 12)
    want = {(str(i), int(j), r + 1) for i in range(0, 300, 10) for r, j in enumerate(sorted(range(300), key=lambda j: (-s[i, j], j))[:7])}
    for pack in (2048, 7):
        monkeypatch.setattr(retrieval, "PACK", pack)
        assert {(r.query_id, r.id, r["rank"]) for r in retrieval.vector_topk(rows, q, 7).collect()} == want


def test_postprocessing(spark):
    rows = [("q", r, f"c{r}", d) for r, d in enumerate(["a b c", "a b c d", "x y", "x y", "z"], 1)]
    results = spark.createDataFrame(rows, "query_id string, rank int, chunk_id string, document string")
    assert [r.chunk_id for r in postprocess.lost_in_middle(results).orderBy("rank").collect()] == ["c1", "c3", "c5", "c4", "c2"]
    assert [(r.chunk_id, r["rank"]) for r in postprocess.deduplicate(results, 0.75).orderBy("rank").collect()] == [("c1", 1), ("c3", 2), ("c5", 3)]


def test_evaluation_and_report(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.upsert("baseline", collection(spark))
    store.replace("bge", collection(spark).limit(0))
    q = spark.createDataFrame([("q0", "cat", ["a"], "easy"), ("q1", "bird plane", ["c", "b"], "cross"), ("q2", "nothing", [], "negative")], "query_id string, query string, expected array<string>, category string")
    assert evaluation.preflight(q, store.names()) == ["recursive_minilm", "semantic_minilm"]
    with pytest.raises(ValueError):
        evaluation.preflight(q, [])
    with pytest.raises(ValueError):
        evaluation.preflight(q.limit(0), store.names())
    combos = ("baseline__cosine", "baseline__hybrid", "bge__cosine", "recursive_minilm__rerank")
    by_query, status = evaluation.evaluate(store, q, combos, 3)
    assert {(r.collection, r.strategy): r.status for r in status.collect()} == {("baseline", "cosine"): "ok", ("baseline", "hybrid"): "ok", ("bge", "cosine"): "empty", ("recursive_minilm", "rerank"): "not_found"}
    rows = {(r.strategy, r.query_id): r for r in by_query.collect()}
    assert rows["cosine", "q0"].recall == 1 and rows["cosine", "q2"].recall == 0 and rows["cosine", "q1"].mrr == 1
    totals = evaluation.rollup(by_query)
    assert totals.count() == 2 * 4
    assert evaluation.with_status(status, totals).count() == 4
    found = report.report(status, totals, "v1", 3, {"baseline__cosine": 2.5}, datetime(2026, 1, 1, tzinfo=UTC))
    text = report.markdown(found)
    assert "| bge__cosine | empty | — |" in text and "| 2ms |" in text and "## baseline__hybrid" in text
    a, b = report.write_report(found, tmp_path / "out")
    assert json.loads(a.read_text())["combos"]["baseline__cosine"]["overall"]["recall"] == pytest.approx(2 / 3) and b.read_text() == text
    assert f"{0.0625:.3f}" == "0.062"
    c, d = report.run(store, q, tmp_path / "whole", "v1", combos, 3)
    whole = json.loads(c.read_text())
    assert {n: x["status"] for n, x in whole["combos"].items()} == {n: x["status"] for n, x in found["combos"].items()} and "| v" not in d.read_text()
    for name, x in whole["combos"].items():
        if x["status"] == "ok":
            assert x["overall"]["latency_ms"] > 0 and x["overall"]["recall"] == found["combos"][name]["overall"]["recall"]
    with pytest.raises(ValueError):
        report.run(store, q, tmp_path / "none", "v1", ["recursive_minilm__cosine"])


def test_evaluation_keeps_fewer_contents_than_chunks(spark):
    results = spark.createDataFrame([("q", r, c) for r, c in enumerate(["a", "a", "", "b"], 1)], "query_id string, rank int, content_id string")
    q = spark.createDataFrame([("q", "x", ["b"], "easy"), ("p", "y", ["b"], "easy")], "query_id string, query string, expected array<string>, category string")
    rows = {r.query_id: r for r in evaluation.per_query(results, q).collect()}
    assert rows["q"].retrieved == ["a", "b"] and rows["q"].precision == 0.5 and rows["q"].mrr == 0.5 and rows["p"].precision == 0


def test_backups(spark, database, tmp_path):
    target = tmp_path / "backups"
    for day in range(1, 10):
        found = backup.back_up(spark, database.parent, target, ["raw.db", "none.db"], datetime(2026, 1, day, tzinfo=UTC))
    assert {r["name"]: r.status for r in found.collect()} == {"raw.db": "ok", "none.db": "not_found"}
    assert backup.backup_summary(found).first().ok == 1
    gone = backup.clean_up(spark, target)
    assert gone == ["2026-01-01T00-00-00Z", "2026-01-02T00-00-00Z"] and len(list(target.iterdir())) == 7
    assert backup.clean_up(spark, target) == [] and backup.clean_up(spark, tmp_path / "none") == []
    made = backup.snapshot(database, tmp_path / "snap" / "copy.db")
    assert made["row_count"] == 3 and made["corpus_hash"] == backup.hash_file(tmp_path / "snap" / "copy.db")
    with pytest.raises(FileNotFoundError):
        backup.snapshot(tmp_path / "none.db", tmp_path / "x.db")
    assert ("raw.db", database.stat().st_size) in backup.list_files(database.parent) and backup.list_files(tmp_path / "none") == []


def echo(model):
    return lambda said: json.dumps({"name": model, "n": len(said)})


def test_generation(spark):
    from pyspark.sql import types as T

    prompts = spark.createDataFrame([(1, "p"), (2, None)], "i int, prompt string")
    assert generation.messages("p") == [{"role": "user", "content": "p"}] and len(generation.messages("p", "s")) == 2
    assert {json.loads(r.response)["n"] for r in generation.generate(prompts, echo).collect()} == {1}
    schema = T.StructType([T.StructField("name", T.StringType(), False), T.StructField("n", T.IntegerType())])
    assert [tuple(r.result) for r in generation.generate_structured(prompts, schema, echo, model="m").collect()] == [("m", 2), ("m", 2)]
    wanting = T.StructType([T.StructField("missing", T.StringType(), False)])
    for bad, kind in ((echo, wanting), (lambda _: lambda said: "no json", schema)):
        with pytest.raises(Exception):  # noqa: B017
            generation.generate_structured(prompts, kind, bad).collect()


def test_stream_is_idempotent(spark, tmp_path):
    source = str(tmp_path / "in")
    raw(spark, 3).write.parquet(source)
    store = Store(spark, str(tmp_path / "store"))
    strategy = Strategy("s", "a", "fixed", embedding.DEFAULT_MODEL, 20, 5)
    for more in (None, 5):
        if more:
            raw(spark, more).write.mode("append").parquet(source)
        incremental.index_stream(incremental.contents_stream(spark, source), store, strategy, str(tmp_path / "check")).awaitTermination()
    assert {r.content_id for r in store.read("a").select("content_id").distinct().collect()} == {f"c{i}" for i in range(5)}
    assert store.read("a").count() == store.read("a").select("id").distinct().count()


def test_batches_are_slices_in_key_order(spark):
    rows = spark.range(95).selectExpr("printf('k%03d', id) AS content_id").repartition(4)
    got = {r.content_id: r.batch for r in contents.batches(rows).collect()}
    assert all(got[f"k{i:03}"] == i // 10 for i in range(95))


@pytest.mark.parametrize("bytes_a_pass", [1 << 24, 8])
def test_contents_that_hold_a_query(spark, monkeypatch, bytes_a_pass):
    monkeypatch.setattr(evaluation, "NEEDLES", bytes_a_pass)
    texts = {"a": "one two three", "b": "xtwo thr", "c": "", "d": None, "e": "drei zwölf 🙂 two"}
    wanted = {"1": "two", "2": "two th", "3": "", "4": None, "5": "two", "6": "zwölf 🙂", "7": "not there"}
    contents_df = spark.createDataFrame(list(texts.items()), "content_id string, content_md string")
    found = evaluation.holding(contents_df, spark.createDataFrame(list(wanted.items()), "query_id string, query string"))
    assert sorted(map(tuple, found.collect())) == sorted((q, c) for q, w in wanted.items() for c, t in texts.items() if w is not None and t is not None and w in t)
    assert evaluation.holding(contents_df, spark.createDataFrame([], "query_id string, query string")).count() == 0


def test_vectors_of_other_lengths_and_nulls_take_no_part(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, None]), (4, [1.0, 0.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0])], "id long, embedding array<double>")
    q = spark.createDataFrame([("x", [1.0, 0.0]), ("y", [0.0, 1.0, 0.0]), ("z", None), ("w", [None, 1.0])], "query_id string, embedding array<double>")
    found = retrieval.vector_topk(rows, q, 5).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.id, r.score) for r in found] == [("x", 1, 1.0), ("x", 5, 0.0), ("y", 4, 0.0)]
    assert retrieval.vector_topk(rows, q.where("query_id = 'z'"), 5).count() == 0
    twice = spark.createDataFrame([("x", [1.0, 0.0]), ("x", [0.0, 1.0]), (None, [1.0, 0.0])], "query_id string, embedding array<double>")
    assert sorted((str(r.query_id), r.id) for r in retrieval.vector_topk(rows, twice, 1).collect()) == [("None", 1), ("x", 1), ("x", 5)]


def test_an_index_of_chunks_that_went_keeps_its_places(spark):
    index = retrieval.LexicalIndex.build(spark.createDataFrame([("gone", "cat")], "id string, document string"))
    found = retrieval.Hybrid(collection(spark), lexical=index).retrieve(queries(spark, "cat"), 9)
    assert found.where("chunk_id = 'gone' and document = '' and content_id = ''").count() == 1


def test_batches_lose_no_rows_whatever_the_shuffle_is_cut_to(spark):
    rows = spark.range(4000).select(F.format_string("c%05d", F.col("id")).alias("content_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), (F.col("id") % 40).cast("int")).alias("content_md"))
    for size in ("16k", "1m", "64m"):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
        try:
            got = contents.batches(rows).collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        assert sorted((r.content_id, r.batch) for r in got) == [(f"c{i:05d}", i // 10) for i in range(4000)]
        assert all(len(r.content_md) == 64 * (int(r.content_id[1:]) % 40) for r in got)
