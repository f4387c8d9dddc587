"""Scans and filters over the contents relation."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.shared import stage

MIN_CHARS = 50


def decode(raw: DataFrame) -> DataFrame:
    """Raw rows as contents: empty and null text fields become their defaults, dates and times are parsed."""
    c = F.col
    return raw.select(
        "content_id", c("newsletter_id").cast("bigint").alias("newsletter_id"), "source_key",
        F.to_date(F.nullif(c("content_date").cast("string"), F.lit(""))).alias("content_date"),
        X.default(c("title"), "").alias("title"), X.default(c("author"), "").alias("author"), "url", X.default(c("content_md"), "").alias("content_md"),
        X.default(c("scrape_status"), "full").alias("scrape_status"), "fetch_tier", F.coalesce(c("fetch_attempts").cast("int"), F.lit(0)).alias("fetch_attempts"),
        X.default(c("vector_status"), "pending").alias("vector_status"),
        F.to_timestamp_ntz(F.nullif(c("stored_at").cast("string"), F.lit(""))).alias("stored_at"),
    )


def get_contents(contents: DataFrame, source_key: str | None = None, since: date | str | None = None, vector_status: str | None = None) -> DataFrame:
    """Rows that meet every condition given, unordered. since: the content's date, or else the day it was stored.

    The conditions are plain comparisons of columns, so the source takes over what it can.
    """
    parts: list[Column] = []
    if source_key is not None:
        parts.append(F.col("source_key") == source_key)
    if since is not None:
        parts.append(F.coalesce("content_date", F.to_date("stored_at")) >= F.lit(str(since)).cast("date"))
    if vector_status is not None:
        parts.append(F.col("vector_status") == vector_status)
    return contents.where(reduce(lambda a, b: a & b, parts)) if parts else contents


def in_scan_order(contents: DataFrame) -> DataFrame:
    """By time of storing, rows without one first. Ties: by id."""
    return contents.orderBy(F.col("stored_at").asc_nulls_first(), "content_id")


def count_contents(contents: DataFrame) -> int:
    return contents.count()


def set_vector_status(contents: DataFrame, updates: DataFrame) -> DataFrame:
    """updates: content_id, vector_status. The last status wins where an id has several by text order; unknown ids do nothing."""
    new = updates.groupBy("content_id").agg(F.max("vector_status").alias("_new"))
    return contents.join(new, "content_id", "left").withColumn("vector_status", F.coalesce("_new", "vector_status")).drop("_new").select(*contents.columns)


def long_enough(text: Column, least: int = MIN_CHARS) -> Column:
    return F.coalesce(F.length(X.strip(text)) >= least, F.lit(False))


def work_items(contents: DataFrame, least: int = MIN_CHARS, limit: int = 0) -> DataFrame:
    """What is to be indexed: contents with enough text, as work items. limit: the first so many in scan order; 0: all.

    Without a limit nothing is sorted: a top-k is all that the order is for.
    """
    rows = contents.where(long_enough(F.col("content_md"), least))
    if limit:
        rows = in_scan_order(rows).limit(limit)
    return rows.select("content_id", "title", "author", F.coalesce("url", F.lit("")).alias("url"), "source_key", X.iso_date(F.col("content_date")).alias("content_date"), "content_md")


def batches(items: DataFrame, key: str = "content_id", size: int = 10) -> DataFrame:
    """items with batch, slices of `size` rows in key order; every row is there once.

    The rows are written once, by ranges of the key, each with the number of its range. Ranges are counted and numbered
    on that table, so both sides of the join agree however the shuffle was cut, and no task sees all rows.
    """
    parts = stage(items.repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id()), "batches")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))  # a row for each range
    place = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return parts.withColumn("_place", place).join(F.broadcast(offsets), "_part").withColumn("batch", F.floor((F.col("_offset") + F.col("_place")) / size)).drop("_part", "_place", "_offset")
