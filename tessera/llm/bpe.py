"""BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word's symbols are the leaves' owners: leaf i holds the rank of the pair that starts at symbol i, with i below it, so
the root is the leftmost pair of the lowest rank. A merge changes three leaves (the pair's own, its left neighbour's and
the swallowed symbol's), each in logarithmic time, until no pair can be merged. A word of n bytes takes O(n log n) even
where it is a whole long text without a space.

The vocabulary file is a tokenizer description for byte-level BPE with word ends: special strings are cut out first, the
rest is brought to NFC and lower case, split by the file's pattern, and each piece's bytes are merged. Decoding joins
the tokens with one space each, as a description without decoder asks for; `to_text` gives readable text.

It runs as Python over Arrow batches: a row needs nothing but itself, a word's result is kept for the next time it comes
(at most 2 * CACHE words a worker), and no row is shuffled. The driver reads the file and broadcasts its bytes, so executors
need no copy; their size is the vocabulary's.

A null text is an empty one: no tokens, empty decoded text. Long texts are encoded whole. Repeated rows, empty tables
and other columns need no care: the columns named are read, extra ones are carried only by `encode`.
"""

from __future__ import annotations

import contextlib
import gc
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: New words after which a worker drops the results that it hasn't used since.
CACHE = 160_000
NONE = 1 << 62
_LATER_SCRIPTS = regex.compile("[^\\x00-\u052f]").search


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return [chr(hidden.get(b, b)) for b in range(256)]


class Kept(dict):
    """Results by word. When `most` new ones have come, those not asked for since the last such time go."""

    def __init__(self, make: Callable[[str], tuple[bytes, str]], most: int):
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, word: str) -> tuple[bytes, str]:
        found = self.older.get(word) or self.make(word)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Codec:
    def __init__(self, description: bytes, cache: int = CACHE):
        d = json.loads(description)
        model = d["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.special).items()}
        self.merges: dict[int, tuple[int, int]] = {}  # left << 32 | right: rank << 32, merged
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[self.vocab[left] << 32 | self.vocab[right]] = rank << 32, self.vocab[left + right]
        symbols = byte_symbols()
        self.inner = [self.vocab.get(s) for s in symbols]
        self.last = [self.vocab.get(s + self.end) for s in symbols]
        self.bytes_of = {s: b for b, s in enumerate(symbols)}
        (split,) = [p for p in d["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.pattern = split["pattern"]["Regex"]
        self.pieces = regex.compile(self.pattern).findall
        self.careful_pieces = None
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        self.kept = Kept(self._made, cache)

    def merge(self, word: str) -> list[int]:
        """The ids of one piece."""
        data = word.encode()
        ids = [self.inner[b] for b in data[:-1]]
        ids.append(self.last[data[-1]])
        if None in ids:
            ids = [i for i in ids if i is not None]
        n = len(ids)
        if n < 2:
            return ids
        find = self.merges.get
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # the tree: leaves from `size` on, the parent of node p is p // 2
        size = 1 << (n - 2).bit_length()
        at = [NONE] * (2 * size)
        for i in range(n - 1):
            if found := find(ids[i] << 32 | ids[i + 1]):
                at[size + i] = found[0] | i
        for p in range(size - 1, 0, -1):
            low, high = at[2 * p], at[2 * p + 1]
            at[p] = low if low < high else high
        while (top := at[1]) != NONE:
            i = top & 0xFFFFFFFF
            j = following[i]
            k = following[i] = following[j]
            ids[i] = find(ids[i] << 32 | ids[j])[1]
            ids[j] = -1
            changed = [(j, NONE)] if j < n - 1 else []
            found = None
            if k < n:
                before[k] = i
                found = find(ids[i] << 32 | ids[k])
            changed.append((i, found[0] | i if found else NONE))
            if (h := before[i]) >= 0:
                found = find(ids[h] << 32 | ids[i])
                changed.append((h, found[0] | h if found else NONE))
            for p, value in changed:
                p += size
                at[p] = value
                while p > 1:
                    p >>= 1
                    low, high = at[2 * p], at[2 * p + 1]
                    if high < low:
                        low = high
                    if at[p] == low:
                        break
                    at[p] = low
        return [i for i in ids if i >= 0]

    def _made(self, word: str) -> tuple[bytes, str]:
        ids = self.merge(word)
        return array("I", ids).tobytes(), " ".join([self.names[i] for i in ids])

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # each character by itself: no final sigma

    def split(self, text: str) -> list[str]:
        """The pieces of a normal text.

        The regex module may know letters and numbers of a later Unicode version than the tokenizers library; beyond
        the oldest scripts those that Python's own tables lack are therefore taken out of both classes.
        """
        if text.isascii() or not _LATER_SCRIPTS(text):
            return self.pieces(text)
        if self.careful_pieces is None:
            every = "".join(chr(c) for c in range(0x530, 0x110000) if not 0xD800 <= c < 0xE000)
            new = "".join(f"\\U{ord(c):08x}" for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")
            strict = self.pattern.replace("[^\\s\\p{L}\\p{N}]", "(?:[^\\s\\p{L}\\p{N}]|[NEW])").replace("[\\p{L}]", "[\\p{L}--[NEW]]").replace("[\\p{N}]", "[\\p{N}--[NEW]]")
            self.careful_pieces = regex.compile("(?V1)" + strict.replace("NEW", new)).findall if new else self.pieces
        return self.careful_pieces(text)

    def encode(self, text: str) -> tuple[bytes, str]:
        """The ids as native unsigned 32-bit integers, and the decoded text."""
        ids, tokens = [], []
        for i, part in enumerate(self.cut(text) if self.cut and "<" in text else (text,)):
            if i % 2:
                ids.append(array("I", [self.special[part]]).tobytes())
                tokens.append(part)
            elif words := self.split(self.normal(part)):
                found = list(map(self.kept.__getitem__, words))
                ids.append(b"".join([made for made, _ in found]))
                tokens.append(" ".join([named for _, named in found]))
        return b"".join(ids), " ".join(tokens)

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.names[i] for i in ids)

    def to_text(self, ids: list[int]) -> str:
        """Readable text: bytes put together, word ends as spaces."""
        out = bytearray()
        for i in ids:
            name = self.names[i]
            if i in self.special.values():
                out += name.encode() + b" "
                continue
            ends = bool(self.end) and name.endswith(self.end)
            out += bytes(self.bytes_of[c] for c in (name[: -len(self.end)] if ends else name))
            out += b" " * ends
        return out.decode("utf-8", "replace").rstrip(" ")


@contextlib.contextmanager
def no_cycles() -> Iterator[None]:
    """Without the collector of reference cycles: the work makes none, and it would walk all kept results again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_codecs: dict[str, Codec] = {}


def codec(description: bytes) -> Codec:
    """This worker's codec for a description."""
    key = hashlib.sha256(description).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(description)
    return _codecs[key]


def little_endian(ids: bytes) -> bytes:
    values = array("I", ids)
    if values.itemsize != 4:
        raise TypeError("unsigned int isn't 32 bits wide here")
    if memoryview(array("H", [1])).tobytes()[0] != 1:
        values.byteswap()
    return values.tobytes()


def read_description(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode(docs: DataFrame, description: bytes) -> DataFrame:
    """docs with ids array<int> and decoded string, in place of columns of those names."""
    docs = docs.drop("ids", "decoded")
    shared = docs.sparkSession.sparkContext.broadcast(description)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            with no_cycles():
                found = [own.encode(t or "") for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            ids = pa.array([array("I", x).tolist() for x, _ in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array([x for _, x in found], pa.string())], names=[*names, "ids", "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, ids array<int>, decoded string")


def digest_documents(docs: DataFrame, description: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text: only digests leave the workers."""
    shared = docs.sparkSession.sparkContext.broadcast(description)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(shared.value)
        for batch in batches:
            n, ids_sha, text_sha = [], [], []
            with no_cycles():
                for text in batch.column(1):
                    ids, decoded = own.encode(text.as_py() or "")
                    n.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(little_endian(ids)).hexdigest())
                    text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def digest_by_file(docs: DataFrame, path: str | None = None) -> DataFrame:
    return digest_documents(docs, read_description(path or default_path()))
