"""Chunkers: a text to an array of struct<text, heading, index>, index from 0. No chunker shuffles: a text is chunked where it stands.

fixed, token and sentence_transformer_token are column expressions. markdown, markdown_syntax, recursive and semantic
need a scan with a state and run as Python over Arrow batches. Sizes of character chunkers are given in tokens and stand
for CHARS_PER_TOKEN characters each.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .embedding import hashed_vectors

SIZE, OVERLAP, CHARS_PER_TOKEN = 800, 100, 4
CHUNKS = "array<struct<text:string,heading:string,index:int>>"
#: Separators, coarse to fine; the empty one cuts anywhere.
PLAIN = ("\n\n", "\n", " ", "")
MARKDOWN = (re.compile(r"\n#{1,6} "), re.compile(r"```\n"), re.compile(r"\n\*\*\*+\n"), re.compile(r"\n---+\n"), re.compile(r"\n___+\n"), "\n\n", "\n", " ", "")
LEVELS = {"#": 1, "##": 2, "###": 3}
_WHITE = X.WHITE_CHARACTERS
SENTENCE_END = re.compile(r"(?<=[.?!])[\x09-\x0d\x20]+")
#: Distances are rounded, so that equal ones stay equal however they are summed.
BREAK_PERCENTILE, DIGITS = 80, 9
#: Tokens for the two token chunkers: together they make up the whole text.
WORD_TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]"
PIECE_TOKEN = r"[\p{L}\p{N}_]{1,6}|[^\p{L}\p{N}_]"


@dataclass(frozen=True)
class Sizes:
    size: int
    overlap: int

    def __post_init__(self) -> None:
        if self.size <= 0 or not 0 <= self.overlap < self.size:
            raise ValueError("a chunk needs a positive size and an overlap below it")


# --- column expressions


def _listed(parts: Column) -> Column:
    kept = F.filter(F.transform(parts, X.strip), lambda t: t != "")
    return F.transform(kept, lambda t, i: F.struct(t.alias("text"), F.lit("").alias("heading"), i.alias("index")))


def _windows(length: Column, sizes: Sizes, cut: Callable[[Column], Column]) -> Column:
    """cut(start) for each window; none of an empty text."""
    step = sizes.size - sizes.overlap
    n = F.when(length <= sizes.size, F.lit(1)).otherwise(F.ceil((length - sizes.overlap) / F.lit(step)).cast("int"))
    return F.when(length > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: cut(i * step))).otherwise(F.array().cast("array<string>"))


def fixed(text: Column, sizes: Sizes) -> Column:
    body = F.coalesce(text, F.lit(""))
    return _listed(_windows(F.length(body), sizes, lambda start: F.substr(body, start + 1, F.lit(sizes.size))))


def by_tokens(text: Column, sizes: Sizes, pattern: str) -> Column:
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))
    return _listed(_windows(F.size(tokens), sizes, lambda start: F.array_join(F.slice(tokens, start + 1, F.lit(sizes.size)), "")))


# --- kernels in Python


def _cut(text: str, separator: str | re.Pattern) -> list[str]:
    """text in pieces, each separator at its piece's start."""
    if separator == "":
        return list(text)
    spots = [m.start() for m in re.finditer(re.escape(separator) if isinstance(separator, str) else separator, text)]
    edges = sorted({0, *spots, len(text)})
    return [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _joined(pieces: list[str], sizes: Sizes) -> list[str]:
    """Pieces put together up to the size; the next chunk starts with as many of the last pieces as the overlap holds."""
    out: list[str] = []
    held: list[str] = []
    total = 0

    def give() -> None:
        if chunk := "".join(held).strip(_WHITE):
            out.append(chunk)

    for piece in pieces:
        if held and total + len(piece) > sizes.size:
            give()
            while held and (total > sizes.overlap or total + len(piece) > sizes.size):
                total -= len(held.pop(0))
        held.append(piece)
        total += len(piece)
    give()
    return out


def recursive(text: str, sizes: Sizes, separators: tuple = PLAIN) -> list[str]:
    """The coarsest separator that occurs cuts the text; pieces still too long are cut by finer ones."""
    at = next((i for i, s in enumerate(separators) if s == "" or (s in text if isinstance(s, str) else s.search(text))), None)
    if at is None:
        return [c] if (c := text.strip(_WHITE)) else []
    out: list[str] = []
    small: list[str] = []
    for piece in _cut(text, separators[at]):
        if len(piece) < sizes.size or at == len(separators) - 1:
            small.append(piece)
            continue
        out += _joined(small, sizes)
        small = []
        out += recursive(piece, sizes, separators[at + 1 :])
    return out + _joined(small, sizes)


def sections(text: str) -> list[tuple[tuple[str, str, str], str]]:
    """Header path and body of each part of a markdown text. Headers stay in the body; fences hide what looks like one."""
    found: list[tuple[tuple[str, str, str], str]] = []
    path = ["", "", ""]
    lines: list[str] = []
    fence = ""

    def flush() -> None:
        body = "\n".join(lines)
        lines.clear()
        if not body:
            return
        key = (path[0], path[1], path[2])
        if found and found[-1][0] == key:
            found[-1] = key, found[-1][1] + "  \n" + body
        else:
            found.append((key, body))

    for raw in text.split("\n"):
        line = raw.strip(_WHITE)
        marker = line[:3]
        if fence:
            lines.append(line)
            if marker == fence:
                fence = ""
            continue
        if marker in ("```", "~~~") and line.count(marker) == 1:
            fence = marker
            lines.append(line)
            continue
        sign, _, title = line.partition(" ")
        if sign in LEVELS:
            flush()
            level = LEVELS[sign]
            path[level - 1 :] = [title.strip(_WHITE), *[""] * (3 - level)]
            lines.append(line)
        elif line:
            lines.append(line)
        else:
            flush()
    flush()
    return found


def markdown(text: str, sizes: Sizes) -> list[tuple[str, str]]:
    return [(chunk, " > ".join(h for h in path if h)) for path, body in sections(text) for chunk in recursive(body, sizes)]


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE_END.split(text) if s]


def distances(parts: list[str], dim: int = 384) -> np.ndarray:
    """1 - cosine of neighbouring sentences, each with its own neighbours."""
    if len(parts) < 2:
        return np.zeros(0)
    around = [" ".join(parts[max(0, i - 1) : i + 2]) for i in range(len(parts))]
    v = hashed_vectors(around, dim)
    return np.round(1 - (v[:-1] * v[1:]).sum(axis=1), DIGITS)


def cut_long(text: str, sizes: Sizes) -> list[str]:
    """A text up to the size as it is, a longer one cut recursively; none of white space."""
    return [c for c in (recursive(text, sizes) if len(text) > sizes.size else [text.strip(_WHITE)]) if c]


def semantic(text: str, sizes: Sizes) -> list[str]:
    """Cuts after sentences whose distance to the next is above the text's 80th percentile; long parts are cut recursively."""
    parts = sentences(text)
    d = distances(parts)
    breaks = np.flatnonzero(d > np.percentile(d, BREAK_PERCENTILE)) + 1 if len(d) else []
    edges = [0, *breaks, len(parts)]
    joined = [" ".join(parts[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    return [c for t in joined for c in cut_long(t, sizes)]


KERNELS: dict[str, Callable[[str, Sizes], list[tuple[str, str]]]] = {
    "markdown": markdown,
    "markdown_syntax": lambda t, s: [(c, "") for c in recursive(t, s, MARKDOWN)],
    "recursive": lambda t, s: [(c, "") for c in recursive(t, s)],
    "semantic": lambda t, s: [(c, "") for c in semantic(t, s)],
}
#: Chunkers that users add: by name, (text column, size and overlap in tokens) to an array of chunk texts.
ADDED: dict[str, Callable[[Column, Sizes], Column]] = {}


def register(name: str, chunker: Callable[[str, Sizes], list[str]] | None = None, column: Callable[[Column, Sizes], Column] | None = None) -> None:
    """Adds a strategy: a function of a text, or an expression over the text column, which needs no Python worker.

    chunker: (text, sizes in characters) to chunks, each a text or a pair of text and heading; it must be importable where
    executors run, and an error of it is the row's. column: (text column, sizes in tokens) to an array of texts.
    """
    if (chunker is None) == (column is None):
        raise ValueError("a chunker is either a function of texts or an expression")
    KERNELS.pop(name, None)
    ADDED.pop(name, None)
    if column is not None:
        ADDED[name] = column
    else:
        KERNELS[name] = lambda t, s: [c if isinstance(c, tuple) else (c, "") for c in chunker(t, s)]


def strategies() -> tuple[str, ...]:
    """The names that `chunk` takes."""
    return (*KERNELS, "fixed", *TOKENIZED, *ADDED)


TOKENIZED = {"token": WORD_TOKEN, "sentence_transformer_token": PIECE_TOKEN}


def _kernel_chunks(df: DataFrame, column: str, kernel: Callable, sizes: Sizes) -> DataFrame:
    names = df.columns
    kind = pa.list_(pa.struct([("text", pa.string()), ("heading", pa.string()), ("index", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks, errors = [], []
            for text in batch.column(names.index(column)):
                try:
                    chunks.append([{"text": t, "heading": h, "index": i} for i, (t, h) in enumerate(kernel(text.as_py() or "", sizes))])
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  one bad text doesn't end the job; the row says why
                    chunks.append([])
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunks, kind), pa.array(errors, pa.string())], names=[*names, "chunks", "error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, chunks {CHUNKS}, error string")


def chunk(df: DataFrame, strategy: str, chunk_size: int = SIZE, chunk_overlap: int = OVERLAP, column: str = "content_md") -> DataFrame:
    """df with chunks and error (null where chunking went well)."""
    if strategy not in strategies():
        raise ValueError(f"Unknown chunking strategy {strategy!r}; there are {', '.join(sorted(strategies()))}")
    if strategy in ADDED:
        made = _listed(ADDED[strategy](F.coalesce(column, F.lit("")), Sizes(chunk_size, chunk_overlap)))
    elif strategy in TOKENIZED:
        made = by_tokens(F.col(column), Sizes(chunk_size, chunk_overlap), TOKENIZED[strategy])
    else:
        sizes = Sizes(chunk_size * CHARS_PER_TOKEN, chunk_overlap * CHARS_PER_TOKEN)
        if strategy in KERNELS:
            return _kernel_chunks(df, column, KERNELS[strategy], sizes)
        made = fixed(F.col(column), sizes)
    return df.withColumns({"chunks": made.cast(CHUNKS), "error": F.lit(None).cast("string")})


def chunk_records(items: DataFrame, strategy: str, chunk_size: int = SIZE, chunk_overlap: int = OVERLAP) -> DataFrame:
    """Work items with their chunks; those without any are left out."""
    return chunk(items, strategy, chunk_size, chunk_overlap).where(F.size("chunks") > 0).drop("content_md", "error")
