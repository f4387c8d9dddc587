"""From contents to a collection: scan, filter, chunk, embed, upsert, as one lazy plan up to the write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Strategy
from ..operators import chunking, contents, embedding
from ..operators.collections import Store


def collection_rows(raw: DataFrame, strategy: Strategy, limit: int = 0, error: str | None = None) -> DataFrame:
    """raw: contents. The rows that the strategy's collection gets. error: a column with what went wrong with a chunk's embedding."""
    items = contents.work_items(raw, limit=limit)
    records = chunking.chunk_records(items, strategy.chunking, strategy.chunk_size, strategy.chunk_overlap)
    return embedding.embed_records(records, strategy.model, error).drop("source_key")


def build_index(store: Store, raw: DataFrame, strategy: Strategy, limit: int = 0, batch: tuple[str, int] | None = None) -> bool:
    """batch: a stream's name and its batch's number; False if the collection has that batch already.

    Chunks that can't be embedded are left out; `indexing_errors` tells which they are.
    """
    rows = collection_rows(raw, strategy, limit, "error").where("error is null").drop("error")
    return store.upsert(strategy.collection, rows, batch)


def indexing_errors(raw: DataFrame, strategy: Strategy) -> DataFrame:
    """content_id, id and error: contents whose chunking failed (id is null), and chunks whose embedding failed."""
    chunked = chunking.chunk(contents.work_items(raw), strategy.chunking, strategy.chunk_size, strategy.chunk_overlap)
    failed = chunked.where("error is not null").select("content_id", F.lit(None).cast("string").alias("id"), "error")
    return failed.unionByName(collection_rows(raw, strategy, error="error").where("error is not null").select("content_id", "id", "error"))
