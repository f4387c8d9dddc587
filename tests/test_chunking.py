from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import chunking as C

MARKDOWN = """# Guide

Some words before the parts.

## First part

It has a paragraph with several sentences. Here is one more. And another one, for length.

```python
# no header
def f():
    return 1
```

## Second part

### Deep

""" + "This text repeats itself to be long enough. " * 30
SHORT = "One short line."


def chunks(spark, text, strategy, size=800, overlap=100):
    rows = spark.createDataFrame([(text,)], "content_md string")
    return C.chunk(rows, strategy, size, overlap).select("chunks").first().chunks


@pytest.mark.parametrize("strategy", C.strategies())
def test_what_all_chunkers_agree_on(spark, strategy):
    found = chunks(spark, MARKDOWN, strategy, 200, 20)
    assert found and all(c.text.strip() == c.text != "" for c in found)
    assert [c["index"] for c in found] == list(range(len(found)))
    if strategy != "semantic":
        assert len(chunks(spark, SHORT, strategy)) == 1
    assert chunks(spark, "", strategy) == [] == chunks(spark, None, strategy)
    assert len(chunks(spark, MARKDOWN, strategy, 50, 10)) > len(chunks(spark, MARKDOWN, strategy, 400, 50)) or strategy == "semantic"


def test_markdown_headings(spark):
    found = chunks(spark, MARKDOWN, "markdown", 100, 10)
    assert {c.heading for c in found} >= {"Guide", "Guide > First part", "Guide > Second part > Deep"}
    assert any("# no header" in c.text for c in found) and not any("no header" in c.heading for c in found)
    assert found[0].text.startswith("# Guide")


def test_header_rules():
    parts = C.sections("before\n# A\n\n### C\nx\n## B\n#nohead\n# A2\n~~~\n# in\n~~~")
    assert [p for p, _ in parts] == [("", "", ""), ("A", "", ""), ("A", "", "C"), ("A", "B", ""), ("A2", "", "")]
    assert C.sections("# A\none\n\ntwo")[0][1] == "# A\none  \ntwo"


def test_recursive_sizes_and_overlap():
    text = " ".join(f"word{i}" for i in range(400))
    found = C.recursive(text, C.Sizes(100, 30))
    assert all(len(c) <= 100 for c in found)
    for a, b in zip(found, found[1:], strict=False):
        assert set(a.split()) & set(b.split())  # the overlap holds whole words
    assert list(dict.fromkeys(w for c in found for w in c.split())) == text.split()
    assert "".join(C.recursive("x" * 950, C.Sizes(100, 0))) == "x" * 950


def test_coarse_separators_come_first():
    assert C.recursive("aaa bbb\n\nccc ddd", C.Sizes(9, 0)) == ["aaa bbb", "ccc ddd"]


@pytest.mark.parametrize(("n", "count"), [(0, 0), (1, 1), (3200, 1), (3201, 2), (6000, 2), (6001, 3)])
def test_fixed_windows(spark, n, count):
    found = chunks(spark, "x" * n, "fixed")
    assert len(found) == count and (not found or len(found[0].text) == min(n, 3200))


def test_token_windows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    found = [c.text for c in chunks(spark, text, "token", 20, 4)]
    assert found[0].split() == [f"t{i}" for i in range(10)] and found[1].split()[0] == "t8"


def test_semantic_cuts_where_topics_change(spark):
    text = "Cats purr. Cats sleep. Cats eat. Cats purr again. Rockets fly high. Rockets burn fuel. Rockets land. Rockets fly again."
    found = [c.text for c in chunks(spark, text, "semantic")]
    assert len(found) >= 2 and any(c.startswith("Cats") and "Rockets" not in c for c in found)
    assert C.sentences("A b. C? D!\nE") == ["A b.", "C?", "D!", "E"]


def test_errors_stay_in_their_row(spark, monkeypatch):
    monkeypatch.setitem(C.KERNELS, "recursive", lambda t, s: [(str(1 // (len(t) - 1)), "")])
    rows = C.chunk(spark.createDataFrame([("x",), ("xyz",)], "content_md string"), "recursive").orderBy(F.length("content_md")).collect()
    assert rows[0].error.startswith("ZeroDivisionError") and rows[0].chunks == [] and rows[1].error is None


def test_unknown_names_and_sizes(spark):
    with pytest.raises(ValueError, match="Unknown chunking strategy"):
        C.chunk(spark.createDataFrame([("x",)], "content_md string"), "none")
    with pytest.raises(ValueError):
        C.Sizes(10, 10)
