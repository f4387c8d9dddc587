"""Embedding functions, by name, and the records that hold embedded chunks.

Without model weights at hand the default is feature hashing: a token's place is the first 8 hex digits of its MD5
modulo the dimension, counts are brought to length 1. The registered models differ in how many tokens they read; the
whole model reads all.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

_token = regex.compile(r"[\p{L}\p{N}_]+")


class _Places(dict):
    """The places of tokens. Those of at most KEPT are remembered, and then all are forgotten."""

    KEPT = 200_000

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, token: str) -> int:
        if len(self) >= self.KEPT:
            self.clear()
        place = self[token] = int(hashlib.md5(token.encode("utf-8", "surrogatepass")).hexdigest()[:8], 16) % self.dim
        return place


#: A worker's places, by dimension.
_places = lru_cache(maxsize=4)(_Places)


def hashed_vectors(texts: list[str], dim: int, max_tokens: int | None = None) -> np.ndarray:
    out, place = np.zeros((len(texts), dim)), _places(dim).__getitem__
    for i, t in enumerate(texts):
        t = (t or "").lower()
        found = _token.findall(t) if max_tokens is None else [m[0] for m in islice(_token.finditer(t), max_tokens)]
        if found:
            counts = np.bincount(np.fromiter(map(place, found), np.int64, len(found)), minlength=dim)
            out[i] = counts / np.sqrt((counts * counts).sum())
    return out


Embedder = Callable[[list[str]], np.ndarray]
#: By model name: a function that makes the embedder in the worker that uses it.
MODELS: dict[str, Callable[[], Embedder]] = {
    "all-MiniLM-L6-v2": lambda: lambda texts: hashed_vectors(texts, 384, 256),
    "BAAI/bge-small-en-v1.5": lambda: lambda texts: hashed_vectors(texts, 384, 512),
    "hashing": lambda: lambda texts: hashed_vectors(texts, 384),
}
DEFAULT_MODEL, WHOLE_MODEL = "all-MiniLM-L6-v2", "hashing"
#: Texts that a model gets at once, and models that a worker keeps.
BATCH, KEPT_MODELS = 2000, 2
#: A worker's models by name and version, the one used last at the end. Spark's workers live on from task to task.
_kept: OrderedDict[tuple[str, str], Embedder] = OrderedDict()
_versions: dict[str, str] = {}


def register(name: str, make: Callable[[], Embedder]) -> None:
    """make must be importable where executors run; it's called once in a worker, which keeps what it makes for later tasks."""
    MODELS[name] = make
    _versions[name] = uuid.uuid4().hex


def _model(name: str, version: str, make: Callable[[], Embedder], loads: Accumulator | None) -> Embedder:
    own = _kept.pop((name, version), None)
    if own is None:
        while len(_kept) >= KEPT_MODELS:
            _kept.popitem(last=False)
        own = make()
        if loads is not None:
            loads.add(1)
    _kept[name, version] = own
    return own


def _vectors(own: Embedder, texts: list[str], kind: type) -> list[np.ndarray]:
    made = np.asarray(own(texts), dtype=kind)
    if made.ndim != 2 or len(made) != len(texts):
        raise ValueError(f"the model gave {made.shape} for {len(texts)} texts")
    return list(made)


def isolated(own: Embedder, texts: list[str], kind: type) -> tuple[list[np.ndarray | None], list[str | None]]:
    """The vectors of texts, and why one has none. A batch that fails is halved until the texts that fail stand alone."""
    try:
        return list(_vectors(own, texts, kind)), [None] * len(texts)
    except Exception as e:  # noqa: BLE001  what a text does to a model mustn't end the job
        if len(texts) == 1:
            return [None], [f"{type(e).__name__}: {e}"]
        half = len(texts) // 2
        left, right = isolated(own, texts[:half], kind), isolated(own, texts[half:], kind)
        return left[0] + right[0], left[1] + right[1]


def embed(df: DataFrame, column: str, model: str = DEFAULT_MODEL, to: str = "embedding", kind: str = "float", error: str | None = None, loads: Accumulator | None = None) -> DataFrame:
    """df with the embedding of a text column, as floats for storing or as doubles.

    error: the name of a column that says why a text has no embedding; without it a text that fails ends the job. loads:
    an accumulator that counts how often a worker made the model.
    """
    if model not in MODELS:
        raise ValueError(f"Unknown embedding model {model!r}; there are {', '.join(sorted(MODELS))}")
    make, version, names = MODELS[model], _versions.get(model, ""), df.columns
    number = np.float32 if kind == "float" else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tessera.operators.embedding import _model as kept_model  # the worker's own module, not a copy in this function

        own = kept_model(model, version, make, loads)
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH):
                part = batch.slice(a, BATCH)
                texts = [t or "" for t in part.column(names.index(column)).to_pylist()]
                if error is None:
                    vectors, errors = _vectors(own, texts, number), []
                else:
                    vectors, errors = isolated(own, texts, number)
                made = [v for v in vectors if v is not None]
                ends = pa.array(np.cumsum([0, *(0 if v is None else len(v) for v in vectors)], dtype=np.int32), mask=np.array([*(v is None for v in vectors), False]))
                out = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(made) if made else np.zeros(0, dtype=number)))
                columns, more = ([pa.array(errors, pa.string())], [error]) if error else ([], [])
                yield pa.RecordBatch.from_arrays([*part.columns, out, *columns], names=[*names, to, *more])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{to}` array<{kind}>" + (f", `{error}` string" if error else ""))


def metadata(chunk: Column) -> Column:
    """A chunk's metadata; an empty url is left out when it's written as JSON."""
    return F.struct(
        F.col("title").alias("title"), F.col("author").alias("author"), F.col("content_date").alias("content_date"), F.nullif(F.col("url"), F.lit("")).alias("url"),
        F.col("content_id").alias("content_id"), chunk["index"].alias("chunk_index"), chunk["heading"].alias("heading"),
    )


def chunk_rows(records: DataFrame) -> DataFrame:
    """One row a chunk of chunk records: id, content_id, source_key, document, metadata."""
    c = F.col("c")
    return records.select("*", F.explode("chunks").alias("c")).select(
        X.chunk_id(F.col("content_id"), c["index"]).alias("id"), "content_id", "source_key",
        X.titled_document(F.col("title"), F.col("author"), c["text"]).alias("document"), metadata(c).alias("metadata"),
    )


def embed_records(records: DataFrame, model: str = DEFAULT_MODEL, error: str | None = None) -> DataFrame:
    """Collection rows of chunk records: the embedding is a column of the chunk's own row. error: as in `embed`."""
    columns = ["id", "content_id", "source_key", "document", "embedding", "metadata", *([error] if error else [])]
    return embed(chunk_rows(records), "document", model, error=error).select(*columns)
