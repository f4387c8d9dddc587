"""Bounded samples of labelled texts for the classifiers, and words as they see them."""

from __future__ import annotations

import zlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Values that a label may have.
MOST_VALUES = 32
#: Bytes of text that a sample brings to the driver at most, in equal shares for the label's values.
MOST_BYTES = 64 << 20
#: A text of more than this part of its share isn't learnt from.
LARGEST_PART = 16
#: Characters that don't count at a word's ends.
OUTER = ".,;:!?\"'()[]{}«»„“”‚‘’…¿¡-–—*_#|<>/\\"


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_value: int, held_out_fold: bool, most_bytes: int = MOST_BYTES) -> list[tuple[str, int]]:
    """At most per_value texts and most_bytes of text, as (text, label), chosen and ordered by a hash of doc_id.

    Each value of the label has its share of the bytes: texts are taken in order until it is spent, and texts of more than
    a LARGEST_PART of it are left out. held_out_fold: rows whose crc32(doc_id as text) mod 5 is 0 are left out. Repeated
    labels of a document: the largest. Ids are chosen first, from the narrow labels table; the driver sees the lengths of
    their texts and then reads the texts that fit.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    if held_out_fold:
        rows = rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    rows = rows.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("h", F.xxhash64("doc_id", F.lit(label)))
    values = [r.y for r in rows.groupBy("y").count().orderBy("y").limit(MOST_VALUES + 1).collect()]
    if len(values) > MOST_VALUES:
        raise ValueError(f"{label} has more than {MOST_VALUES} values")
    if not values:
        return []
    chosen = reduce(DataFrame.unionByName, (rows.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_value) for y in values))
    # at most per_value ids for each value of the label
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y", "h").agg(F.max("text").alias("text"))
    found = stage(found.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0))), "sample")
    share, spent, last = most_bytes // len(values), dict.fromkeys(values, 0), dict.fromkeys(values, -(1 << 63))
    for r in sorted(found.where(F.col("bytes") <= share // LARGEST_PART).select("y", "h", "bytes").collect(), key=lambda r: r.h):
        spent[r.y] += r.bytes
        if spent[r.y] <= share:
            last[r.y] = r.h
    fits = reduce(lambda a, b: a | b, ((F.col("y") == y) & (F.col("h") <= last[y]) for y in values))
    texts = found.where(fits & (F.col("bytes") <= share // LARGEST_PART)).collect()
    return [(r.text or "", r.y) for r in sorted(texts, key=lambda r: (r.h, r.doc_id))]


def bucket(feature: str, buckets: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % buckets


def core(word: str) -> str:
    """A lower-cased word without outer punctuation; the word itself where nothing else is left."""
    return word.strip(OUTER) or word
