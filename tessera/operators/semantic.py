"""The semantic chunker as a plan: sentences as rows, distances of neighbours, an exact percentile and groups between cuts.

What `chunking.semantic` does text by text, with any registered embedding model. Sentences are embedded in batches across texts where
they stand; only their distances leave the workers, no vector. One shuffle follows, of sentences by the text's key, which
percentile, groups and the chunk list share. Keys must be unique: a key held by two rows fails the job. Texts without a
sentence (null, empty, white space) have no row. A text with a sentence that the model can't embed has no chunks, and an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import embedding
from .chunking import BREAK_PERCENTILE, CHARS_PER_TOKEN, DIGITS, OVERLAP, SENTENCE_END, SIZE, Sizes, _kernel_chunks, cut_long


def sentence_rows(df: DataFrame, key: str, column: str) -> DataFrame:
    """key, pos (from 0), sentence, around (the sentence with its neighbours); a text's rows follow each other."""
    n = F.size("sentence")
    listed = df.select(key, F.filter(F.split(F.coalesce(column, F.lit("")), SENTENCE_END.pattern), lambda s: s != "").alias("sentence"))
    sides = listed.where(n > 0).select(
        key, "sentence", F.concat(F.array(F.lit(None).cast("string")), F.slice("sentence", 1, n - 1)).alias("before"), F.slice("sentence", 2, n).alias("after")
    )
    rows = sides.select(key, F.posexplode(F.arrays_zip("sentence", "before", "after")).alias("pos", "s"))
    return rows.select(key, "pos", "s.sentence", F.concat_ws(" ", "s.before", "s.sentence", "s.after").alias("around"))


def distances(rows: DataFrame, key: str, model: str) -> DataFrame:
    """`sentence_rows` with distance (1 - cosine) to the sentence before, null for a text's first, and the model's error."""
    if model not in embedding.MODELS:
        raise ValueError(f"Unknown embedding model {model!r}; there are {', '.join(sorted(embedding.MODELS))}")
    make, version = embedding.MODELS[model], embedding._versions.get(model, "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tessera.operators.embedding import _model as kept_model  # the worker's own module, not a copy in this function

        own, last = kept_model(model, version, make, None), None
        for batch in batches:
            for a in range(0, batch.num_rows, embedding.BATCH):
                part = batch.slice(a, embedding.BATCH)
                vectors, errors = embedding.isolated(own, part.column(3).to_pylist(), np.float64)
                found = []
                for pos, v in zip(part.column(1).to_pylist(), vectors, strict=True):
                    length = 0.0 if v is None or last is None or pos == 0 else float(np.sqrt((v @ v) * (last @ last)))
                    known = pos > 0 and v is not None and last is not None
                    found.append(round(1 - (float(v @ last) / length if length else 0.0), DIGITS) if known else None)
                    last = v
                columns = [*part.columns[:3], pa.array(found, pa.float64()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "pos", "sentence", "distance", "error"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, pos int, sentence string, distance double, error string")


def parts(df: DataFrame, key: str, column: str = "content_md", model: str = embedding.WHOLE_MODEL, percentile: float = BREAK_PERCENTILE) -> DataFrame:
    """key, part (from 0), text, sentences, error: runs of sentences between distances above the text's percentile."""
    whole = Window.partitionBy(key)
    cut = F.percentile("distance", F.lit(percentile / 100)).over(whole)
    firsts = F.count(F.when(F.col("pos") == 0, 1)).over(whole)
    rows = distances(sentence_rows(df, key, column), key, model).withColumns({"cut": cut, "firsts": firsts})
    rows = rows.where(F.when(F.col("firsts") == 1, True).otherwise(F.raise_error(F.concat(F.lit("a key of several texts: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).cast("boolean")))
    part = F.sum(F.when(F.col("distance") > F.col("cut"), 1).otherwise(0)).over(whole.orderBy("pos")).cast("int")
    held = F.array_sort(F.collect_list(F.struct("pos", "sentence")))
    found = rows.withColumn("part", part).groupBy(key, "part").agg(held.alias("held"), F.min("error").alias("error"))
    return found.select(key, "part", F.concat_ws(" ", "held.sentence").alias("text"), F.size("held").alias("sentences"), "error")


def chunk(df: DataFrame, key: str, chunk_size: int = SIZE, chunk_overlap: int = OVERLAP, column: str = "content_md", model: str = embedding.WHOLE_MODEL) -> DataFrame:
    """key, chunks, error: the parts of each text as chunks, those above the size cut by coarse to fine separators."""
    sizes = Sizes(chunk_size * CHARS_PER_TOKEN, chunk_overlap * CHARS_PER_TOKEN)
    found = parts(df, key, column, model).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("part", "text"))).alias("held"), F.min("error").alias("failed"))
    texts = F.when(F.col("failed").isNull(), F.col("held.text")).otherwise(F.array().cast("array<string>"))
    made = _kernel_chunks(found.select(key, texts.alias("texts"), "failed"), "texts", lambda given, s: [(c, "") for t in given for c in cut_long(t, s)], sizes)
    return made.select(key, "chunks", F.coalesce("failed", "error").alias("error"))
