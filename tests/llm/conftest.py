from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(n: int, step: int = 7, start: int = 0) -> str:
    """n words without a repeated run of five."""
    return " ".join(f"{WORDS[(start + i * step) % 24]}{(start + i * i) % 97}" + ("." if i % 9 == 8 else "") for i in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in each column, empty, blank and long texts, ties and repeated rows."""
    texts = [prose(40), prose(40), prose(40, 5, 3), "", " \t\n ", None, "one", "two words", prose(5000, 11), "line a b\nline a b\n" * 40, "🙂 naïve Ünïcode — ΣΑΣ " * 9, "# | " * 80]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    return [*rows, (None, prose(40), None, None, None), (None, None, None, None, None), rows[0], rows[0], (100, prose(40), "de", None, 7), (101, prose(12, 3), None, "src0", None)]


@pytest.fixture
def odd(spark):
    """With columns whose names the operators use inside."""
    rows = [(*r, 1, "x", 2.0, "y", 3) for r in odd_rows()]
    return spark.createDataFrame(rows, SCHEMA + ", size long, shard string, score double, word string, n int")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
