"""Text generation over a table of prompts through a client that the caller hands in.

A client is a function messages -> text, messages being [{"role", "content"}, ...]; `make_client` makes it in the worker,
by model name. Nothing here opens a connection.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MODEL = "gpt-4.1-mini"
Client = Callable[[list[dict]], str]


def messages(prompt: str, system: str = "") -> list[dict]:
    return [*([{"role": "system", "content": system}] if system else []), {"role": "user", "content": prompt}]


def generate(prompts: DataFrame, make_client: Callable[[str], Client], system: str = "", model: str = DEFAULT_MODEL) -> DataFrame:
    """prompts (prompt and other columns) with response."""
    names = prompts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client(model)
        for batch in batches:
            said = [client(messages(p or "", system)) for p in batch.column(names.index("prompt")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.string())], names=[*names, "response"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in prompts.schema.fields)
    return prompts.mapInArrow(run, f"{fields}, response string")


def generate_structured(prompts: DataFrame, schema: T.StructType, make_client: Callable[[str], Client], system: str = "", model: str = DEFAULT_MODEL) -> DataFrame:
    """prompts with result, the response read by the schema. A response that isn't JSON, or lacks a required field, fails the job."""
    hint = f"{system}\nAnswer with one JSON object of this schema: {json.dumps(schema.jsonValue())}".strip()
    said = generate(prompts, make_client, hint, model)
    read = F.from_json("response", schema, {"mode": "FAILFAST"})
    needed = [f.name for f in schema.fields if not f.nullable]
    result = F.col("_read")
    for name in needed:
        result = F.when(F.col(f"_read.{name}").isNull(), F.raise_error(F.concat(F.lit(f"the response lacks {name}: "), "response")).cast(schema)).otherwise(result)
    return said.withColumn("_read", read).withColumn("result", result).drop("_read", "response")
