"""Indexing new contents as they arrive: a file stream, the batch plan on each micro-batch, and upserts that know their batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Strategy
from ..model import CONTENTS
from ..operators.collections import Store
from ..plans.indexing import build_index


def contents_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(CONTENTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def index_stream(contents: DataFrame, store: Store, strategy: Strategy, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Takes in all that is there and ends. Each micro-batch is in the collection once.

    Its number is published in the same manifest as its rows, so a batch that Spark runs again after a failure finds itself
    and writes nothing; one that failed before that left no trace that readers see. name: stands for the stream in
    manifests, its checkpoint folder unless it's stated; a stream that starts anew under an old name takes up behind it.
    """
    own = name or checkpoint.rstrip("/")
    take = lambda batch, number: build_index(store, batch, strategy, batch=(own, number))
    return contents.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
