"""Snapshots of database files with retention. File work of a few files stays on the driver; the reports are DataFrames."""

from __future__ import annotations

import hashlib
import shutil
import sqlite3
from collections.abc import Iterable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X

STAMP = "%Y-%m-%dT%H-%M-%SZ"
KEEP = 7


def hash_file(path: str | Path, length: int = 16) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()[:length]


def list_files(folder: str | Path) -> list[tuple[str, int]]:
    """Names and sizes, by name; a missing folder has none."""
    folder = Path(folder)
    return [(p.name, p.stat().st_size) for p in sorted(folder.iterdir()) if p.is_file()] if folder.is_dir() else []


def copy_database(source: str | Path, target: str | Path) -> None:
    """A consistent copy, even while others write."""
    if not Path(source).is_file():
        raise FileNotFoundError(str(source))
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    with sqlite3.connect(f"file:{source}?mode=ro", uri=True) as a, sqlite3.connect(target) as b:
        a.backup(b)
    a.close()
    b.close()


def snapshot(source: str | Path, target: str | Path, table: str = "contents") -> dict:
    copy_database(source, target)
    con = sqlite3.connect(target)
    try:
        (rows,) = con.execute(f'SELECT count(*) FROM "{table}"').fetchone()
    finally:
        con.close()
    return {"size_bytes": Path(target).stat().st_size, "row_count": rows, "corpus_hash": hash_file(target), "source": str(source)}


def back_up(spark: SparkSession, source_dir: str | Path, backup_dir: str | Path, names: Iterable[str], now: datetime | None = None) -> DataFrame:
    """All files into one folder of the time. name, status (ok, not_found), size_bytes."""
    stamp = (now or datetime.now(UTC)).strftime(STAMP)
    rows = []
    for name in names:
        source = Path(source_dir) / name
        if not source.is_file():
            rows.append((name, "not_found", 0))
            continue
        target = Path(backup_dir) / stamp / name
        copy_database(source, target)
        rows.append((name, "ok", target.stat().st_size))
    return spark.createDataFrame(rows, "name string, status string, size_bytes long")


def victims(folders: DataFrame, keep: int = KEEP) -> DataFrame:
    """folders: name, which sorts as time does. The names beyond the newest `keep`."""
    newest = folders.orderBy(F.col("name").desc()).limit(keep)
    return folders.join(newest, "name", "left_anti").select("name")


def clean_up(spark: SparkSession, backup_dir: str | Path, keep: int = KEEP) -> list[str]:
    folder = Path(backup_dir)
    names = [(p.name,) for p in folder.iterdir() if p.is_dir()] if folder.is_dir() else []
    gone = sorted(r.name for r in victims(spark.createDataFrame(names, "name string"), keep).collect())
    for name in gone:
        shutil.rmtree(folder / name)
    return gone


def backup_summary(results: DataFrame) -> DataFrame:
    """ok, not_found, total_bytes and their readable size."""
    total = F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("size_bytes"))), F.lit(0)).cast("bigint")
    return results.agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "not_found").alias("not_found"), total.alias("total_bytes")).withColumn("total_size", X.human_size(F.col("total_bytes")))

