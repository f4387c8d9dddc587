"""Tables between steps, in the folder that the driver and all executors share, and files that are published in one step."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes an execution's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the cluster names it.

    Only where spark.checkpoint.dir is unset and Spark runs in one process, a temporary folder takes its place.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="tessera-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """What is shuffled for an execution within goes as soon as that ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table into the shared folder and reads it again: later jobs don't repeat the work, and a lost executor loses nothing.

    What was shuffled for it goes as soon as it's written. The files go with `unstage`, or when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    with tidy(spark):
        df.write.parquet(path)
    files, where = files_of(spark, path)
    files.deleteOnExit(where)
    out = spark.read.schema(schema).parquet(path)
    _paths[out] = path
    return out


def unstage(*tables: DataFrame) -> None:
    """Deletes staged tables that nothing will read any more."""
    for table in tables:
        if path := _paths.pop(table, None):
            files, where = files_of(table.sparkSession, path)
            files.delete(where, True)


def files_of(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system for a path, and the path as it names it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


class Conflict(Exception):  # noqa: N818
    """Another writer has published this version."""


class Files:
    """A folder in any file system that Hadoop reaches, with numbered manifests."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list[str]:
        where = self._path(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def _read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _versions(self, folder: str) -> list[int]:
        return [int(f.removesuffix(".json")) for f in self._list(folder) if f.endswith(".json") and not f.startswith(".")]

    def _publish(self, text: str, path: str) -> None:
        """Makes a file that must not exist yet, in one step: nobody sees a part of it, and of two writers one gets a Conflict."""
        jvm = self.spark._jvm
        folder = path.rpartition("/")[0]
        self._fs.mkdirs(self._path(folder))
        draft = self._path(f"{folder}/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._fs.getScheme() == "file":  # where a rename would replace the target
                os.link(urlparse(draft.toString()).path, urlparse(path).path)
            else:
                options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
                options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, self._path(path), options)
        except Exception as e:
            if self._fs.exists(self._path(path)):
                raise Conflict(path) from e
            raise
        finally:
            self._fs.delete(draft, False)
