from __future__ import annotations

import math
from collections import defaultdict

import pytest

from tessera.llm import url_filter as U

CASES = [
    ("https://a.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/fr/2", "example.net", "/fr/2", "net/", "block"),
    ("http://NET/", "net", "/", "net/", "block"),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("http://x.example.com/de/3", "x.example.com", "/de/3", "example.com/de/", "block"),
    ("http://foo.org/fr/", "foo.org", "/fr/", "org/fr/", "allow"),
    ("http://foo.org/FR/", "foo.org", "/FR/", None, None),
    ("http://foo.net", "foo.net", "", None, None),
    ("http://foo.net?x/y", "foo.net", "", None, None),
    ("http://foo.net#/en/", "foo.net", "", None, None),
    ("foo.net/en/", "", "", None, None),
    ("", "", "", None, None),
    (None, "", "", None, None),
    ("a://b://c/d", "b:", "//c/d", None, None),
    ("http://u:p@foo.net:80/en/", "u:p@foo.net:80", "/en/", None, None),
    ("HTTP://ÄB.org/fr/ß", "Äb.org", "/fr/ß", "org/fr/", "allow"),
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, 1.0, "x") for i, u in enumerate(urls)], "page_id long, url string, score double, g string")


def test_hosts_paths_and_rules(spark):
    rows = U.judge_pages(pages(spark, [c[0] for c in CASES])).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in rows] == [c[1:4] for c in CASES]
    assert all(r.verdict == c[4] if c[4] else r.verdict in ("allow", "block") for r, c in zip(rows, CASES, strict=True))


def code(c: str) -> int:
    c = c.lower()
    return ord(c) - 96 if "a" <= c <= "z" else 27 if "0" <= c <= "9" else 28 + U.SIGNS.index(c) if c in U.SIGNS else U.KINDS - 1


class Brute:
    def __init__(self, texts):
        self.counts = [defaultdict(lambda: defaultdict(int)) for _ in range(U.ORDER + 1)]
        for t in texts:
            c = [0] * U.ORDER + [code(x) for x in t]
            for i in range(U.ORDER, len(c)):
                for o in range(U.ORDER + 1):
                    self.counts[o][tuple(c[i - o : i])][c[i]] += 1

    def p(self, context: tuple, kind: int) -> float:
        out = 1 / (U.KINDS - 1)
        for o in range(U.ORDER + 1):
            seen = self.counts[o][context[len(context) - o :]]
            n, t = sum(seen.values()), len(seen)
            out = (seen.get(kind, 0) + t * out) / (n + t) if n else out
        return out

    def log(self, text: str) -> float:
        c = [0] * U.ORDER + [code(x) for x in text]
        return sum(math.log(self.p(tuple(c[i - U.ORDER : i]), c[i])) for i in range(U.ORDER, len(c))) / max(1, len(text))


def test_scores_match_brute_force(spark):
    urls = [f"http://{a}.example.{t}/{lang}/{i * 37}{e}" for i, (a, t, lang, e) in enumerate((a, t, lang, e) for a in ("news", "m.shop", "ü") for t in ("net", "com", "org") for lang in ("en", "de", "fr") for e in ("", ".html"))]
    rows = U.judge_pages(pages(spark, [*urls, None, ""])).collect()
    ruled = {v: Brute([r.host + r.path for r in rows if r.rule and r.verdict == v]) for v in ("allow", "block")}
    for r in rows:
        assert r.score == pytest.approx(ruled["allow"].log(r.host + r.path) - ruled["block"].log(r.host + r.path) if r.host else 0.0)
    scored = [(r.verdict, r.score) for r in rows if r.rule]
    cuts = sorted({math.floor(s / U.STEP) * U.STEP for _, s in scored})
    share = lambda v, c: sum(s >= c - 1e-12 for w, s in scored if w == v) / sum(w == v for w, _ in scored)
    best = max(share("allow", c) - share("block", c) for c in cuts)
    cut = U.best_cut(spark.createDataFrame(scored, "verdict string, score double"))
    assert share("allow", cut) - share("block", cut) == pytest.approx(best)
    assert all(r.verdict == ("allow" if r.score >= cut else "block") for r in rows if not r.rule)


def test_few_or_no_ruled_pages(spark):
    assert {r.verdict for r in U.judge_pages(pages(spark, ["http://a.io/", None])).collect()} == {"allow"}
    assert U.judge_pages(pages(spark, ["x"]).limit(0)).count() == 0
    rows = U.judge_pages(pages(spark, ["http://a.net/"] * 3 + ["http://a.io/" + "y" * 50_000])).collect()
    assert [r.verdict for r in rows].count("block") >= 3
