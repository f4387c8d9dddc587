"""Vector collections as bucketed tables with a manifest for each version.

    <root>/<name>/manifests/<version>.json   what a version consists of
    <root>/<name>/data/<write>/bucket=<b>/   rows of one write, by the hash of their content

A manifest names, for each bucket, the folders with its rows and how many there are. A writer reads the newest manifest,
writes whole new buckets beside the old ones, and publishes the next manifest under a name that must not exist yet. If
another writer was faster, it takes over what that one did to other buckets, or does its own work again where both
touched the same. Readers hold a manifest and so see one version, whatever is written meanwhile. A write that belongs to a
stream carries its batch number into the manifest, so a batch that comes again writes nothing.

Manifests are small: one entry a bucket. Files are reached through Hadoop's file system, so root may be in any store that
Spark writes and in which a rename fails where the target exists.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..model import COLLECTION
from ..sources.shared import Conflict, Files, stage, tidy, unstage

#: Buckets of a new collection, and how often a writer tries to publish.
BUCKETS, TRIES = 32, 20
#: Folders of writes that never got into a manifest are left alone for so many seconds.
ABANDONED = 24 * 3600


@dataclass(frozen=True)
class Manifest:
    version: int
    buckets: int
    schema: str
    #: For each bucket that has rows: its folder, below the collection's, and its number of rows.
    parts: dict[int, tuple[str, int]] = field(default_factory=dict)
    #: The last batch of each stream that is in.
    streams: dict[str, int] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(n for _, n in self.parts.values())

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "buckets": self.buckets, "schema": self.schema, "parts": {str(b): list(p) for b, p in self.parts.items()}, "streams": self.streams})

    @classmethod
    def of(cls, text: str) -> Manifest:
        found = json.loads(text)
        return cls(found["version"], found["buckets"], found["schema"], {int(b): (p[0], p[1]) for b, p in found["parts"].items()}, found["streams"])


class Store(Files):
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        super().__init__(spark, root)
        self.buckets = buckets

    # --- reading

    def versions(self, name: str) -> list[int]:
        return self._versions(f"{self.root}/{name}/manifests")

    def manifest(self, name: str, version: int | None = None) -> Manifest | None:
        """A version of the collection, the newest one unless it's stated; None where there's none."""
        known = self.versions(name)
        if version is None:
            version = max(known, default=None)
        return None if version not in known else Manifest.of(self._read(f"{self.root}/{name}/manifests/{version:012d}.json"))

    def names(self) -> list[str]:
        return [name for name in self._list(self.root) if self.versions(name)]

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def count(self, name: str) -> int:
        """Rows of the newest version, from its manifest."""
        found = self.manifest(name)
        return found.rows if found else 0

    def listing(self) -> DataFrame:
        """collection, version, chunk_count and buckets of all collections; one row each."""
        rows = [(n, m.version, m.rows, m.buckets) for n in self.names() if (m := self.manifest(n))]
        return self.spark.createDataFrame(rows, "collection string, version long, chunk_count long, buckets int")

    def read(self, name: str, content_ids: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The collection's rows; none where it doesn't exist yet. content_ids: only these contents' rows, from their buckets."""
        found = self.manifest(name, version)
        if found is None:
            return self.spark.createDataFrame([], COLLECTION)
        if content_ids is None:
            return self._rows(name, found, found.parts)
        ids = list(content_ids)
        wanted = self.spark.createDataFrame([(i,) for i in ids], "content_id string")
        buckets = {r.bucket for r in wanted.select(bucket_of(found.buckets)).distinct().collect()}
        return self._rows(name, found, buckets).where(F.col("content_id").isin(ids) if ids else F.lit(False))

    def _rows(self, name: str, found: Manifest, buckets: Iterable[int]) -> DataFrame:
        folders = [f"{self.root}/{name}/{found.parts[b][0]}" for b in sorted(buckets) if b in found.parts]
        schema = StructType.fromJson(json.loads(found.schema))
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    # --- writing

    def upsert(self, name: str, rows: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """All rows of the contents in `rows` are replaced by theirs; other contents stay, their buckets aren't even read.

        Of rows with equal ids one stays (`one_of_each_id`). batch: a stream's name and the number of its batch; if the
        collection has that batch already nothing is written. Returns whether anything was.
        """
        return self._change(name, rows, rows.select("content_id"), batch)

    def delete(self, name: str, contents: DataFrame) -> bool:
        """Removes all rows of the contents given."""
        found = self.manifest(name)
        if found is None:
            return False
        return self._change(name, self._rows(name, found, ()), contents.select("content_id"), None)

    def replace(self, name: str, rows: DataFrame) -> None:
        """The collection has these rows only, and of rows with equal ids one (`one_of_each_id`).

        Rows are shuffled once, by bucket. Only if ids turn out to be equal their rows are compared, and the rest written again.
        """
        written = self._write(name, rows.withColumn("bucket", bucket_of(self.buckets)))
        found = self._rows(name, Manifest(0, self.buckets, rows.schema.json(), written), written)
        twice = stage(found.groupBy("id").count().where("count > 1").select(F.col("id").alias("again")), "twice")
        if not twice.isEmpty():
            same = F.col("id").eqNullSafe(F.col("again"))
            kept = found.join(twice, same, "left_anti").unionByName(one_of_each_id(found.join(twice, same, "left_semi")))
            first, written = written, self._write(name, kept.withColumn("bucket", bucket_of(self.buckets)))
            for folder in {p.rpartition("/")[0] for p, _ in first.values()}:
                self._fs.delete(self._path(f"{self.root}/{name}/{folder}"), True)
        unstage(twice)
        self._commit(name, lambda old: Manifest((old.version if old else 0) + 1, self.buckets, rows.schema.json(), written, old.streams if old else {}))

    def _change(self, name: str, rows: DataFrame, gone: DataFrame, batch: tuple[str, int] | None) -> bool:
        old = self.manifest(name)
        number = old.buckets if old else self.buckets
        if batch and old and old.streams.get(batch[0], -1) >= batch[1]:
            return False
        # read once, as what is behind them may take long to make
        new = stage(one_of_each_id(rows).withColumn("bucket", bucket_of(number)), "upsert")
        ids = stage(gone.where("content_id is not null").distinct().withColumn("bucket", bucket_of(number)), "upsert-ids")
        touched = {r.bucket for r in ids.select("bucket").union(new.select("bucket")).distinct().collect()}  # at most one a bucket
        written: dict[int, tuple[str, int]] = {}
        seen: Manifest | None = None

        def next_one(now: Manifest | None) -> Manifest | None:
            nonlocal written, seen
            if now and batch and now.streams.get(batch[0], -1) >= batch[1]:
                return None
            if now and now.buckets != number:
                raise RuntimeError(f"{name} was made anew with other buckets")
            first = seen is None and not written
            if first or {b: now.parts.get(b) for b in touched if now} != {b: seen.parts.get(b) for b in touched if seen}:
                before = self._rows(name, now, touched) if now else self.spark.createDataFrame([], rows.schema)
                kept = before.join(ids.select("content_id"), "content_id", "left_anti").withColumn("bucket", bucket_of(number))
                written = self._write(name, kept.unionByName(new, allowMissingColumns=True)) if touched else {}
                seen = now
            parts = {b: p for b, p in (now.parts if now else {}).items() if b not in touched} | written
            streams = (now.streams if now else {}) | (dict([batch]) if batch else {})
            schema = now.schema if now else rows.schema.json()
            return Manifest((now.version if now else 0) + 1, number, schema, parts, streams)

        done = self._commit(name, next_one)
        unstage(new, ids)
        return done

    def _write(self, name: str, rows: DataFrame) -> dict[int, tuple[str, int]]:
        """Writes rows (with bucket) as a folder of their own; returns each bucket's folder and number of rows."""
        folder = f"data/{uuid.uuid4().hex}"
        path = f"{self.root}/{name}/{folder}"
        # large buckets are split over tasks and small ones share one
        with tidy(self.spark):
            rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(path)
        if not any(f.startswith("bucket=") for f in self._list(path)):
            return {}
        counts = self.spark.read.parquet(path).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        return {r.bucket: (f"{folder}/bucket={r.bucket}", r.n) for r in counts}

    def _commit(self, name: str, next_one: Callable[[Manifest | None], Manifest | None]) -> bool:
        for _ in range(TRIES):
            made = next_one(self.manifest(name))
            if made is None:
                return False
            try:
                self._publish(made.to_json(), f"{self.root}/{name}/manifests/{made.version:012d}.json")
            except Conflict:
                continue
            return True
        raise Conflict(f"{name} was changed {TRIES} times meanwhile")

    def clean(self, name: str, keep: int = 2, abandoned: float = ABANDONED) -> int:
        """Deletes all versions but the newest `keep`, with the files that none of these has. Returns how many writes' files went.

        Readers of older versions must be done. Files that no manifest names are a running writer's or a failed one's:
        they go when they are older than `abandoned` seconds.
        """
        known = sorted(self.versions(name))
        old, kept = known[:-keep] if keep else known, known[-keep:] if keep else []
        folders = lambda v: {p.split("/")[1] for p, _ in m.parts.values()} if (m := self.manifest(name, v)) else set()
        needed = set().union(*(folders(v) for v in kept))
        named = set().union(*(folders(v) for v in known))
        going = []
        for write in self._list(f"{self.root}/{name}/data"):
            status = self._fs.getFileStatus(self._path(f"{self.root}/{name}/data/{write}"))
            if write not in needed and (write in named or time.time() - status.getModificationTime() / 1000 > abandoned):
                going.append(write)
        for v in old:
            self._fs.delete(self._path(f"{self.root}/{name}/manifests/{v:012d}.json"), False)
        for write in going:
            self._fs.delete(self._path(f"{self.root}/{name}/data/{write}"), True)
        return len(going)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("content_id"), F.lit(buckets)).cast("int").alias("bucket")


def one_of_each_id(rows: DataFrame) -> DataFrame:
    """Of rows with equal ids the one whose other columns come last, compared one after the other as text, null first; reruns agree."""
    others = [o for c in rows.columns if c != "id" for o in (F.col(c).isNull(), F.to_json(F.struct(c)).desc())]
    return rows.withColumn("_at", F.row_number().over(Window.partitionBy("id").orderBy(*others))).where("_at = 1").drop("_at")


def upserted(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """existing with all rows of the contents in `rows` replaced by theirs, as Store.upsert does it, as one plan."""
    new = one_of_each_id(rows)
    return existing.join(new.select("content_id").distinct(), "content_id", "left_anti").unionByName(new, allowMissingColumns=True)


def by_content(collection: DataFrame, contents: DataFrame) -> DataFrame:
    """The rows of the contents given."""
    return collection.join(contents.select("content_id").distinct(), "content_id", "left_semi")


def summary(collection: DataFrame, contents: DataFrame) -> DataFrame:
    """For each content: title (60 characters), source and number of chunks."""
    n = collection.groupBy("content_id").agg(F.count(F.lit(1)).alias("chunks"))
    return contents.join(n, "content_id").select("content_id", F.substring("title", 1, 60).alias("title"), "source_key", "chunks")


def indexing_counts(records: DataFrame) -> DataFrame:
    """records: chunks and error. One row: contents indexed, errors, chunks."""
    good = F.col("error").isNull() & (F.size("chunks") > 0)
    return records.agg(F.count_if(good).alias("indexed"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.coalesce(F.sum(F.when(good, F.size("chunks"))), F.lit(0)).cast("bigint").alias("chunks"))
