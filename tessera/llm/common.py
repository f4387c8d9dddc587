"""What several of the training-data operators share."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import stage, unstage

__all__ = ["SPACES", "SPACE_CLASS", "WORD_PATTERN", "literal_array", "literal_table", "stage", "table", "trimmed", "unstage", "word_count", "words"]

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: The same as a regular expression for Spark (Java) and DuckDB (RE2).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal_table(spark: SparkSession, rows: list[list], schema: str) -> DataFrame:
    """A small table made of SQL literals only. schema: like "a int, b string"."""
    names = [c.split()[0] for c in schema.split(",")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")))


def literal_array(values: list, kind: str) -> Column:
    """An array of constants that the optimizer folds to one value."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def trimmed(text: Column) -> Column:
    """text without outer white space; null: empty."""
    return F.coalesce(F.btrim(text, F.lit(SPACES)), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, an empty array for none or null."""
    inner = trimmed(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")
