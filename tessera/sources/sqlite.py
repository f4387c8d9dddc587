"""A Python data source for SQLite tables: spark.read.format("sqlite").option("path", ...).option("table", ...).load().

The option `where` holds a condition in SQLite's own SQL that the database applies. (Filters aren't taken over from plans:
Spark 4.1 keeps what one query has pushed for later queries of the same DataFrame, which then lack rows.) The file is read
in `partitions` ranges of rowid. Meant for the workbench's own databases, on one machine or a shared mount; bulk
data belongs into parquet.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

_KINDS = (("INT", "BIGINT"), ("CHAR", "STRING"), ("CLOB", "STRING"), ("TEXT", "STRING"), ("REAL", "DOUBLE"), ("FLOA", "DOUBLE"), ("DOUB", "DOUBLE"), ("BLOB", "BINARY"))


def connect(path: str) -> sqlite3.Connection:
    con = sqlite3.connect(f"file:{path}?mode=ro", uri=True, timeout=5)
    con.execute("PRAGMA foreign_keys = ON")
    return con


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class Rows(InputPartition):
    low: int
    high: int


class SQLiteReader(DataSourceReader):
    def __init__(self, path: str, table: str, names: list[str], ranges: int, where: str):
        self.path, self.table, self.names, self.ranges, self.where = path, table, names, ranges, where

    def partitions(self) -> list[InputPartition]:
        con = connect(self.path)
        try:
            low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        finally:
            con.close()
        if low is None:
            return [Rows(0, 0)]
        step = -(-(high - low + 1) // self.ranges)
        return [Rows(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition: Rows) -> Iterator[tuple]:
        con = connect(self.path)
        try:
            columns = ", ".join(map(_quoted, self.names))
            yield from con.execute(f"SELECT {columns} FROM {_quoted(self.table)} WHERE rowid >= ? AND rowid < ? AND ({self.where})", [partition.low, partition.high])
        finally:
            con.close()


class SQLiteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _columns(self) -> list[tuple[str, str]]:
        con = connect(self.options["path"])
        try:
            found = con.execute(f"PRAGMA table_info({_quoted(self.options.get('table', 'contents'))})").fetchall()
        finally:
            con.close()
        if not found:
            raise ValueError(f"no table {self.options.get('table', 'contents')} in {self.options['path']}")
        return [(r[1], next((kind for part, kind in _KINDS if part in (r[2] or "").upper()), "STRING")) for r in found]

    def schema(self) -> str:
        return ", ".join(f"`{n}` {k}" for n, k in self._columns())

    def reader(self, schema) -> SQLiteReader:  # noqa: ANN001
        return SQLiteReader(self.options["path"], self.options.get("table", "contents"), [f.name for f in schema.fields], int(self.options.get("partitions", "4")), self.options.get("where", "1"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SQLiteSource)
