"""Tables in files: parquet, JSON lines, and chunk and embedding records as partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import CHUNK_RECORD, EMBEDDING_RECORD


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where))


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON records of a folder; none where it's missing. The schema is given, so nothing is read to infer it."""
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def in_file_order(records: DataFrame) -> DataFrame:
    return records.orderBy(F.input_file_name())


def write_records(records: DataFrame, path: str, strategy: str) -> None:
    """A strategy's records as JSON, replacing all it had: no record of an earlier run stays behind."""
    records.withColumn("strategy", F.lit(strategy)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("strategy").json(path)


def read_chunks(spark: SparkSession, path: str, strategy: str) -> DataFrame:
    return read_json(spark, f"{path}/strategy={strategy}", CHUNK_RECORD)


def read_embeddings(spark: SparkSession, path: str, strategy: str) -> DataFrame:
    return read_json(spark, f"{path}/strategy={strategy}", EMBEDDING_RECORD)


def embedding_records(rows: DataFrame) -> DataFrame:
    """Collection rows as one record a content, the shape that is exchanged as JSON."""
    base = F.struct(*(F.first(f"metadata.{c}").alias(c) for c in ("title", "author", "content_date", "url")))
    chunk = F.struct("id", "document", "embedding", "metadata")
    return rows.groupBy("content_id", "source_key").agg(base.alias("metadata_base"), F.array_sort(F.collect_list(chunk), lambda a, b: a.metadata.chunk_index - b.metadata.chunk_index).alias("chunks"))


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """name and size of the files in a folder, without reading them."""
    rows = spark.read.format("binaryFile").load(folder).select("path", "length")
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size_bytes"))


def content_hashes(spark: SparkSession, folder: str, length: int = 16) -> DataFrame:
    rows = spark.read.format("binaryFile").load(folder)
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.substring(F.sha2("content", 256), 1, length).alias("hash"))
