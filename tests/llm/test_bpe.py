from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def pair():
    path = bpe.default_path()
    return bpe.Codec(bpe.read_description(path)), tokenizers.Tokenizer.from_file(path)


def ids(codec: bpe.Codec, text: str) -> list[int]:
    data, _ = codec.encode(text)
    return list(struct.unpack(f"{len(data) // 4}I", data))


@pytest.mark.parametrize("text", ["", " \n\t", "Hello  WORLD don't we'll", "<|endoftext|>a<|startoftext|> <|endoftext", "a" * 20_000, "abcdefghij" * 2_000, "...!!!???" * 500, "ΟΔΟΣ ΣΑΣ ς", "İẞ ǅ ﬁ", "é é", "日本語 한국어 עברית", "🙂👩‍👩‍👧", "1234567890", "\x00\x01 x\x85y z"])
def test_matches_the_library(pair, text):
    own, library = pair
    found = library.encode(text, add_special_tokens=False)
    assert ids(own, text) == found.ids
    assert own.encode(text)[1] == library.decode(found.ids, skip_special_tokens=False) == own.decode(found.ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs", "Cn"), max_codepoint=0xFFFF), max_size=60))
def test_matches_the_library_on_any_text(text):
    path = bpe.default_path()
    own, library = bpe.codec(bpe.read_description(path)), _library(path)
    if any(unicodedata.category(c) == "Cn" for c in text) or any(0x1C89 <= ord(c) <= 0x1C8A or 0xA7CB <= ord(c) <= 0xA7DC for c in text):
        return  # of a later Unicode version than Python's tables
    assert ids(own, text) == library.encode(text, add_special_tokens=False).ids


def _library(path: str, kept: dict = {}):  # noqa: B006
    if path not in kept:
        kept[path] = tokenizers.Tokenizer.from_file(path)
    return kept[path]


def test_cache_that_overflows_changes_nothing(pair):
    small = bpe.Codec(bpe.read_description(bpe.default_path()), 3)
    text = "one two three four five six seven one two three eight"
    assert small.encode(text) == pair[0].encode(text) == small.encode(text)


def test_readable_text(pair):
    assert pair[0].to_text(ids(pair[0], "Naïve <|endoftext|> it's ok")) == "naïve <|endoftext|> it 's ok"


def test_leftmost_of_equal_ranks():
    vocab = {t: i for i, t in enumerate(["a", "b", "a</w>", "b</w>", "aa", "aa</w>", "aaa</w>"])}
    model = {"type": "BPE", "vocab": vocab, "merges": [["a", "a"], ["aa", "a</w>"], ["a", "a</w>"]], "end_of_word_suffix": "</w>"}
    codec = bpe.Codec(json.dumps({"added_tokens": [], "model": model, "pre_tokenizer": {"pretokenizers": [{"type": "Split", "pattern": {"Regex": r"\S+"}}]}}).encode())
    assert codec.encode("aaaa")[1] == "aa aa</w>" and codec.encode("aaa")[1] == "aaa</w>" and codec.encode("aba")[1] == "a b a</w>"


def test_query_rows(pair, odd, empty):
    rows = bpe.digest_by_file(odd).collect()
    want = []
    for r in odd.collect():
        found = pair[1].encode(r.text or "", add_special_tokens=False)
        text = pair[1].decode(found.ids, skip_special_tokens=False)
        want.append((r.doc_id, len(found.ids), hashlib.sha256(struct.pack(f"<{len(found.ids)}I", *found.ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in rows))) == sorted(map(str, want))
    assert bpe.digest_by_file(empty).count() == 0


def test_encoding_keeps_columns(pair, odd):
    out = bpe.encode(odd.withColumnRenamed("word", "ids"), bpe.read_description(bpe.default_path()))
    assert out.columns == [c for c in odd.columns if c != "word"] + ["ids", "decoded"]
    assert all(r.ids == ids(pair[0], r.text or "") for r in out.collect())
