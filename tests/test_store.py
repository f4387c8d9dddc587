"""Collections: buckets, manifests, two writers, streams."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from tessera.config import Strategy
from tessera.operators import collections, embedding
from tessera.operators.collections import Conflict, Store
from tessera.streaming import incremental

from .test_workbench import raw

SCHEMA = "id string, content_id string, document string"


def rows_for(spark, contents, text: str, chunks: int = 2):
    return spark.createDataFrame([(f"c{c}::chunk{i}", f"c{c}", f"{text}{i}") for c in contents for i in range(chunks)], SCHEMA)


def held(store: Store, **how) -> dict[str, str]:
    return {r.id: r.document for r in store.read("a", **how).collect()}


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), 8)


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, store):
    assert store.upsert("a", rows_for(spark, range(40), "old"))
    before = store.manifest("a")
    assert store.upsert("a", rows_for(spark, [3], "new", 1))
    after = store.manifest("a")
    changed = {b for b in after.parts if after.parts[b] != before.parts[b]}
    assert len(before.parts) == 8 and len(changed) == 1 and after.version == 2
    assert held(store) == {f"c{c}::chunk{i}": f"old{i}" for c in range(40) for i in range(2) if c != 3} | {"c3::chunk0": "new0"}
    assert store.count("a") == 79 and store.listing().collect()[0][:3] == ("a", 2, 79)
    assert len(held(store, version=1)) == 80  # readers of the old version still have it
    one = store.read("a", ["c3", "c5"])
    assert {r.id for r in one.collect()} == {"c3::chunk0", "c5::chunk0", "c5::chunk1"} and len({f.split("bucket=")[1].split("/")[0] for f in one.inputFiles()}) <= 2
    assert store.read("a", []).count() == 0


def test_deleting_and_replacing(spark, store):
    assert not store.delete("a", rows_for(spark, [1], ""))
    store.upsert("a", rows_for(spark, range(5), "x"))
    assert store.delete("a", rows_for(spark, [1, 99], ""))
    assert {i.split("::")[0] for i in held(store)} == {"c0", "c2", "c3", "c4"}
    assert store.delete("a", rows_for(spark, range(5), "")) and held(store) == {} and store.count("a") == 0
    store.replace("a", rows_for(spark, [7], "y", 1))
    assert held(store) == {"c7::chunk0": "y0"} and store.versions("a") == [1, 2, 3, 4]


def test_of_equal_ids_the_greatest_row_stays(spark, store):
    rows = spark.createDataFrame([("i", "c", "b"), ("i", "c", "d"), ("i", "c", "a"), ("j", "c", None), ("j", "c", "a")], SCHEMA)
    for n in (1, 5):
        store.replace("a", rows.repartition(n))
        assert held(store) == {"i": "d", "j": "a"}


def test_writers_at_the_same_time_lose_nothing(spark, store):
    store.upsert("a", rows_for(spark, range(20), "old"))
    failed = []

    def write(which: int) -> None:
        try:
            store.upsert("a", rows_for(spark, range(which * 5, which * 5 + 5), f"w{which}-", 1))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and store.versions("a") == [1, 2, 3, 4]
    assert held(store) == {f"c{c}::chunk0": f"w{c // 5}-0" for c in range(15)} | {f"c{c}::chunk{i}": f"old{i}" for c in range(15, 20) for i in range(2)}


def test_a_writer_that_is_overtaken_takes_over_or_starts_again(spark, store, monkeypatch):
    store.upsert("a", rows_for(spark, range(10), "old", 1))
    publish, write, writes = Store._publish, Store._write, []
    monkeypatch.setattr(Store, "_write", lambda *a: writes.append(1) or write(*a))

    def overtaken(contents):
        def once(self, *args):
            monkeypatch.setattr(Store, "_publish", publish)
            store.upsert("a", rows_for(spark, contents, "other", 1))
            writes.clear()
            publish(self, *args)

        monkeypatch.setattr(Store, "_publish", once)

    by_bucket = {r.content_id: r.bucket for r in rows_for(spark, range(10), "").select("content_id", collections.bucket_of(8)).collect()}
    elsewhere = next(c for c in range(1, 10) if by_bucket[f"c{c}"] != by_bucket["c0"])
    overtaken([elsewhere])
    store.upsert("a", rows_for(spark, [0], "mine", 1))
    assert not writes  # what it had written is published on top of the other's
    overtaken([0])
    store.upsert("a", rows_for(spark, [0], "again", 1))
    assert len(writes) == 1
    assert held(store) == {f"c{c}::chunk0": "again0" if c == 0 else "other0" if c == elsewhere else "old0" for c in range(10)}


def test_nothing_is_published_twice(spark, store):
    store.upsert("a", rows_for(spark, [0], "x"))
    with pytest.raises(Conflict):
        store._publish("{}", f"{store.root}/a/manifests/{1:012d}.json")
    assert store.manifest("a").rows == 2


def test_cleaning_keeps_what_readers_need(spark, store):
    for i in range(4):
        store.upsert("a", rows_for(spark, range(6), f"v{i}-", 1))
    store._fs.mkdirs(store._path(f"{store.root}/a/data/unfinished"))
    assert store.clean("a", keep=2) == 2 and store.versions("a") == [3, 4]
    assert held(store, version=3)["c0::chunk0"] == "v2-0" and held(store)["c0::chunk0"] == "v3-0"
    assert store.clean("a", keep=1, abandoned=-1) == 2 and held(store)["c0::chunk0"] == "v3-0"


def test_a_stream_takes_in_every_batch_once(spark, tmp_path, store, monkeypatch):
    assert store.upsert("a", rows_for(spark, [1], "x"), ("s", 0)) and not store.upsert("a", rows_for(spark, [1], "y"), ("s", 0))
    assert held(store)["c1::chunk0"] == "x0" and store.versions("a") == [1]
    source, strategy = str(tmp_path / "in"), Strategy("s", "b", "fixed", embedding.DEFAULT_MODEL, 20, 5)
    raw(spark, 3).write.parquet(source)

    def run():
        incremental.index_stream(incremental.contents_stream(spark, source), store, strategy, str(tmp_path / "check")).awaitTermination()

    publish = Store._publish
    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            run()
    assert not store.exists("b")  # written, but not published
    with monkeypatch.context() as m:  # published, but Spark doesn't get to know

        def lost(*args):
            publish(*args)
            raise RuntimeError("lost afterwards")

        m.setattr(Store, "_publish", lost)
        with pytest.raises(Exception, match="lost afterwards"):
            run()
    assert store.versions("b") == [1]
    run()
    assert store.versions("b") == [1] and {r.content_id for r in store.read("b").select("content_id").distinct().collect()} == {"c0", "c1", "c2"}
    raw(spark, 5).write.mode("append").parquet(source)
    run()
    assert store.versions("b") == [1, 2] and store.read("b").select(F.count_distinct("content_id")).first()[0] == 5


def test_replacing_shuffles_rows_once_and_keeps_no_copy(spark, store, monkeypatch):
    """All rows used to be shuffled by id, kept as a table, and shuffled again by bucket."""
    plain, kept, wide = collections.stage, [], []

    def counted(df, name):
        out = plain(df, name)
        kept.append(out.count())
        return out

    monkeypatch.setattr(collections, "stage", counted)
    monkeypatch.setattr(collections, "one_of_each_id", lambda rows: wide.append(rows))
    store.replace("a", rows_for(spark, range(40), "x"))
    assert not any(kept) and not wide and len(held(store)) == 80


def test_equal_ids_of_several_contents_and_null_ids(spark, store, tmp_path):
    rows = [("i", f"c{i}", f"d{i}") for i in range(20)] + [(None, "c", "x"), (None, "d", "y"), ("k", "c", "z")]
    store.replace("a", spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert held(store) == {"i": "d9", None: "y", "k": "z"} and store.count("a") == 3
    assert len(store._list(f"{store.root}/a/data")) == 1  # the first writing is gone
