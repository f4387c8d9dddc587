from __future__ import annotations

import os
import random
import re
import time
import tracemalloc
from html.parser import HTMLParser

import pytest

from tessera.llm import html_extract
from tessera.llm.html_extract import content_paths, extract, extract_pages, leaves

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

ARTICLE = "<article><h1>Title</h1><p>First &amp; second, with a  long\n sentence.</p><p>Short.</p><ul><li>One<li>Two</ul></article>"
TEXT = "Title\nFirst & second, with a long sentence.\nShort.\nOne\nTwo"
PARTS = {
    "menu": "<nav><ul><li><a href='/x'>Home</a></li></ul></nav>",
    "header": "<header><h1>The site, of all sites.</h1></header>",
    "footer": "<footer>&copy; someone, somewhere.</footer>",
    "sidebar": "<aside><p>Other things, also long, and with marks; many.</p></aside>",
    "sidebar by class": "<div class='left-sidebar'><p>Other things, also long, and with marks; many of them.</p></div>",
    "advert": "<div class='ad'>Buy this, now! Really, do buy it, today.</div>",
    "notice": "<div id='cookie-notice'><p>We use cookies, and so on, and so forth.</p></div>",
    "form": "<form><label>Name</label><textarea>Text, of a form.</textarea><button>Go</button></form>",
    "script": "<script>var t = '</p> a < b';</script><style>p{margin:0}</style>",
    "comments": "<section id='comments'><article class='comment'><p>A reader says, at length, that this is so, so good.</p></article></section>",
    "comment in markup": "<!-- <p>Not to be seen, at all, by anyone.</p> -->",
    "hidden": "<div style='display: none'><p>Hidden text, long, with marks.</p></div><p hidden>Hidden.</p>",
}


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("body", [ARTICLE, ARTICLE.replace("article>", "main>"), "<div class='wrap'><div class='post-body'>" + ARTICLE[9:-10] + "</div></div>", "<div><div class='x'>" + ARTICLE[9:-10] + "</div></div>"])
def test_only_the_article(part, body):
    for page in (PARTS[part] + body, body + PARTS[part]):
        assert extract(f"<html><head><title>T, t.</title></head><body>{page}</body></html>") == TEXT


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain, text", "plain, text"), ("<p>a<b>b</b>c</p><p>d", "abc\nd"), ("<p>a<br>b</p>", "a b"), ("<p>5 < 6 &lt; 7 &#x41;&nbsp;B</p>", "5 < 6 < 7 A B"),
    ("<p>cut <b", "cut"), ("</div></p><p>x.</p></b>", "x."), ("<P CLASS=A>x.</P>", "x."), ("<p title='a > b'>x.</p>", "x."), ("<p title='open>x.</p>", "x."), ("<article></article>", ""), ("<script>x", ""), ("<![CDATA[raw, text.]]>", "raw, text."),
])
def test_broken_and_small_pages(page, text):
    assert extract(page) == text


def test_very_long_and_deep_pages():
    assert extract("<article>" + "<p>word, word.</p>" * 20_000 + "</article>").count("\n") == 19_999
    assert extract("<div>" * 20_000 + "deep, text.") == "deep, text."
    assert extract("<b>" * 5_000 + "x" * 1_000_000) == "x" * 1_000_000


def test_paths_with_little_text_fall_below_the_threshold():
    page = "<div class='a'>" + "<p>Much text, with marks, and more of it; indeed, much more.</p>" * 5 + "</div><div class='b'>" + "<span>x</span>" * 30 + "</div>"
    paths, found = leaves(page)
    chosen, _ = content_paths(paths, found)
    assert {text for path, _, text, _ in found if path in chosen} == {"Much text, with marks, and more of it; indeed, much more."}
    assert "x" not in extract(page).split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("alpha beta gamma, delta epsilon; zeta eta theta iota".split()) for _ in range(n)).capitalize() + "."


def unnamed_page(rng: random.Random) -> tuple[str, str]:
    """A page of divs whose classes say nothing, and its article's text."""
    links = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(rng.randrange(3, 12)))
    body = [sentence(rng, rng.randrange(25, 70)) for _ in range(rng.randrange(3, 8))]
    body.insert(rng.randrange(1, len(body)), sentence(rng, 2))
    rest = "".join(f"<span>{w}</span> " for w in ("Share it", "Print", "Mail"))
    page = f"<div class='k1'><ul>{links}</ul></div><div class='k2'>{rest}</div><div class='k3'><h1>A title</h1>{''.join(f'<p>{x}</p>' for x in body)}</div><div class='k4'>Since 2001</div>"
    return f"<html><body>{page}</body></html>", "\n".join(["A title", *body])


def test_ratios_alone_find_the_article_of_unnamed_parts(monkeypatch):
    rng = random.Random(4)
    pages = [unnamed_page(rng) for _ in range(40)]
    assert [extract(p) for p, _ in pages] == [t for _, t in pages]
    constant_ratios(monkeypatch)
    assert not any(extract(p) == t for p, t in pages)


def constant_ratios(monkeypatch):
    plain = html_extract.ratios
    monkeypatch.setattr(html_extract, "ratios", lambda paths, found: (plain(paths, found)[0], dict.fromkeys(plain(paths, found)[0], 1.0)))


@pytest.mark.skipif(not os.path.exists(f"{SF}/pages.parquet"), reason="no tables")
def test_without_evidence_ratios_decide_most_pages(monkeypatch):
    import pyarrow.parquet as pq

    for name in ("OTHER_TAGS", "OTHER_WORDS", "CONTENT_WORDS", "FORMS"):
        monkeypatch.setattr(html_extract, name, frozenset())
    pages = [p.replace("article>", "div>").replace("header>", "div>") for p in pq.read_table(f"{SF}/pages.parquet")["html"].to_pylist()]
    got = [extract(p) for p in pages]
    constant_ratios(monkeypatch)
    assert sum(extract(p) != g for p, g in zip(pages, got, strict=True)) > len(pages) / 2


LONG = "".join(f"<p>Long paragraph {i}, with commas, and so on; it goes on for a while, and then it ends.</p>" for i in range(10))


@pytest.mark.parametrize("start", [
    "<div class='site right-sidebar'>", "<div id='page' class='no-sidebar'><main>", "<form id='aspnetForm'>", "<div class='post comments-open'>", "<div class='post-body share-enabled'>", "<div class='content toc-enabled'>",
    "<div class='promo-free'>", "<div class='legal-news'>", "<div id='social-policy'>", "<div class='widget'>", "<fieldset>", "<div class='menu'><div class='related'>",
])
def test_a_frame_around_the_article_doesnt_wipe_it(start):
    end = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", start)))
    rest = "<nav><ul><li><a href='/'>Home</a></li><li><a>News</a></li></ul></nav>", "<footer>Copyright someone, 2020. All rights reserved.</footer>"
    expected = "\n".join(["Title", *(f"Long paragraph {i}, with commas, and so on; it goes on for a while, and then it ends." for i in range(10))])
    assert extract(f"<body>{rest[0]}{start}<h1>Title</h1>{LONG}{end}{rest[1]}</body>") == expected
    assert extract(f"<body>{start}{rest[0]}<h1>Title</h1>{LONG}{rest[1]}{end}</body>") == expected


def test_many_comments_beside_an_article_go():
    comments = "".join(f"<article class='comment'><p>{sentence(random.Random(i), 40)}</p></article>" for i in range(30))
    assert extract(f"<body><article><h1>Title</h1><p>One sentence, which is short.</p></article><section id='comments'>{comments}</section></body>") == "Title\nOne sentence, which is short."
    assert extract("<body><nav><a>Home</a><a>News</a></nav><footer>Us, 2001</footer></body>") == ""


def test_evidence_alone_decides_nothing():
    long = "".join(f"<p>{sentence(random.Random(i), 60)}</p>" for i in range(6))
    # strong ratios overrule a label, and a content label doesn't lift a path without text ratios
    assert extract(f"<body><div class='box'><p>Hi</p></div><div class='share-story'>{long}</div></body>").count("\n") >= 5
    assert "Next" not in extract(f"<body><div class='x'>{long}</div><div class='text'><span>Next</span></div></body>")


@pytest.mark.parametrize("page", ["<div>x " * 8_000, "<div>x " * 140_000, "<ul>" + "<div>" * 60_000 + "<li></li>" * 60_000, "<div class=a>x, y. <p>" * 50_000, "<a '" * 200_000])
def test_nested_and_broken_pages_take_time_and_memory_in_proportion(page):
    tracemalloc.start()
    began = time.perf_counter()
    extract(page)
    took, (_, peak) = time.perf_counter() - began, tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert took < 60 and peak < 2e6 + 600 * len(page)


class Plain(HTMLParser):
    """Leaves of well-formed pages as (labels, block, text, article), labels as (tag, first class or id, evidence), by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.block, self.out, self.count = [], 0, [], 0

    def handle_starttag(self, tag, attrs):
        own = dict(attrs)
        if tag not in html_extract.INLINE and tag != "br":
            self.block += 1
        if tag == "br":
            self.out.append((self.labels(), self.block, " ", self.article()))
        if tag in html_extract.VOID:
            return
        name = own.get("class") or own.get("id") or ""
        said = set(" ".join((own.get("class") or "", own.get("id") or "")).lower().split())
        stated = tag in ("article", "main")
        scoped = any(x[3] for x in self.stack)
        named = {w for x in said for w in x.split("-")}
        bad = {"comment", "comments"} if stated else html_extract.OTHER_WORDS
        share = 0.5 if tag == "form" else 0.1 if tag in html_extract.OTHER_TAGS or (tag == "header" and not scoped) else 0
        share = 0.1 if said & bad else share or (0.5 if named & bad else 0)
        points = -share if share else 3 if stated else 1 if named & html_extract.CONTENT_WORDS else 0  # below zero: the share that has to be outside
        self.count += 1
        self.stack.append((tag, (name.split() or [""])[0], points, stated, self.count))

    def handle_endtag(self, tag):
        if tag not in html_extract.INLINE:
            self.block += 1
        self.stack.pop()

    def labels(self):
        return tuple(x[:3] for x in self.stack)

    def article(self):
        return next((x[4] for x in reversed(self.stack) if x[3]), 0)

    def handle_data(self, data):
        self.out.append((self.labels(), self.block, data, self.article()))


def plain_extract(page: str) -> str:
    """The method once more, over tuples of labels."""
    reader = Plain()
    reader.feed(page)
    reader.close()
    rows = [r for r in reader.out if not any(t in ("script", "style", "title", "button") for t, _, _ in r[0])]

    def home(labels):
        while labels and labels[-1][0] in html_extract.TEXT_TAGS and labels[-1][2] >= 0:
            labels = labels[:-1]
        return labels

    def is_other(labels):
        """Whether the last label names another part and isn't a frame around the content."""
        return labels[-1][2] < 0 and labels not in frames

    def evidence(labels):
        points = 0
        for i, x in enumerate(labels):
            points = max(-8, min(4, points + (-8 if is_other(labels[: i + 1]) else max(0, x[2]))))
        return points

    def since_article(labels):
        at = max((i for i, x in enumerate(labels) if x[0] in ("article", "main")), default=0)
        return sum(is_other(labels[: i + 1]) for i in range(at, len(labels)))

    texts = {}
    for labels, _, text, _ in rows:
        if text.split():
            texts.setdefault(labels, []).append(" ".join(text.split()) if text.split() else "")
    marks = {}
    for labels, _, text, _ in rows:
        if text.split():
            marks[labels] = marks.get(labels, 0) + len(re.findall(r"[.,;:!?…]", text))
    order = list(texts)
    ratio = {p: (sum(map(len, texts[p])) / len(texts[p]), marks[p] / len(texts[p])) for p in order}
    plain = {}
    for i, p in enumerate(order):
        near = [(q, 1 if q == p else 0.5) for q in order[max(0, i - 1) : i + 2] if home(q) == home(p)]
        a, b = (sum(ratio[q][k] * w for q, w in near) / sum(w for _, w in near) for k in (0, 1))
        plain[p] = a * (b + 0.1)
    size = {p: sum(map(len, texts[p])) for p in order}
    level = sum(plain[p] * size[p] for p in order) / sum(size.values()) if order else 0
    selected = [p for p in order if plain[p] >= level / 2]
    frames = set()
    for labels in {p[:n] for p in order for n in range(1, len(p) + 1) if p[n - 1][2] < 0}:
        within = [p for p in order if p[: len(labels)] == labels]
        beyond = [p for p in order if p[: len(labels)] != labels]
        few = sum(size[p] for p in beyond if p in selected) < -labels[-1][2] * sum(size[p] for p in selected) and sum(size[p] for p in beyond) < 0.4 * sum(size.values())
        if few and not any(x[0] in ("article", "main") for p in beyond for x in p) and any(p in selected and ratio[p][0] >= 40 and ratio[p][1] >= 1 for p in within):
            frames.add(labels)
    fused = {p: plain[p] * 2.0 ** evidence(p) for p in order}
    good = [p for p in order if evidence(p) >= 0 and not since_article(p)]
    mean = sum(fused[p] * size[p] for p in good) / sum(size[p] for p in good) if good else float("inf")
    chosen = {p for p in order if fused[p] >= mean / 2}
    inner = {home(p) for p in order if fused[p] >= mean / 8}
    held = {home(p) for p in chosen}
    articles = {a for labels, _, text, a in rows if labels in chosen and text.strip()} - {0}

    def inside(labels):
        for n in range(len(labels), -1, -1):
            if labels[:n] in held:
                return True
            if n and is_other(labels[:n]) and since_article(labels[:n]):
                return False
        return False

    blocks = {}
    for labels, block, text, article in rows:
        scoped = any(x[0] in ("article", "main") for x in labels)
        if labels in chosen or home(labels) in held or (not scoped and inside(labels) and home(labels) in inner) or (article in articles and not since_article(labels)):
            blocks.setdefault(block, []).append(text)
    return "\n".join(x for x in (" ".join("".join(b).split()) for b in blocks.values()) if x)


def some_page(rng: random.Random) -> str:
    """A well-formed page of random parts."""

    def part(depth: int) -> str:
        kind = rng.randrange(9)
        if depth > 3 or kind < 4:
            return f"<p>{sentence(rng, rng.randrange(1, 50))}</p>"
        if kind == 4:
            return "<ul>" + "".join(f"<li><a href='#'>{sentence(rng, 1)}</a></li>" for _ in range(rng.randrange(1, 6))) + "</ul>"
        tag = rng.choice(("div", "div", "div", "section", "article", "main", "nav", "aside", "footer", "header", "form"))
        name = rng.choice(("", " class='a b'", " class='post'", " id='comments'", " class='share'", " class='k'", " class='no-sidebar x'"))
        return f"<{tag}{name}>" + "".join(part(depth + 1) for _ in range(rng.randrange(1, 5))) + f"</{tag}>"

    return "<html><head><title>T</title></head><body>" + "".join(part(0) for _ in range(rng.randrange(1, 6))) + "</body></html>"


def test_matches_a_plain_second_implementation():
    rng = random.Random(9)
    pages = [some_page(rng) for _ in range(300)] + [unnamed_page(rng)[0] for _ in range(20)]
    got = [extract(p) for p in pages]
    assert got == [plain_extract(p) for p in pages]
    assert sum(t == "" for t in got) < 60 and len(set(got)) > 250


@pytest.mark.skipif(not os.path.exists(f"{SF}/pages.parquet"), reason="no tables")
@pytest.mark.parametrize("tag", ["article", "div"])
def test_every_page_of_the_table_gives_its_article(tag):
    import html

    import pyarrow.parquet as pq

    for page in pq.read_table(f"{SF}/pages.parquet")["html"].to_pylist():
        inner = page[page.index("<article>") + 9 : page.index("</article>")]
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", inner)]
        assert extract(page.replace("article>", f"{tag}>")) == "\n".join(x for x in lines if x)


def test_all_containers_of_a_stated_article():
    body = "".join(f"<p>Long paragraph {i}, with commas, and so on; it goes on for a while, and then it ends.</p>" for i in range(8))
    article = f"<article><header><h1>Title</h1></header><div class='lead'><p>Short lead</p></div><div class='text-part'>{body}</div><section class='end'><p>The end</p></section></article>"
    got = extract(f"<html><body><main>{article}<article><div class='teaser'>Other</div></article></main></body></html>").split("\n")
    assert got[:2] == ["Title", "Short lead"] and got[-1] == "The end" and len(got) == 11


def test_query_rows(spark):
    rows = [(1, "u", f"<body>{ARTICLE}</body>", 0), (1, "u", f"<body>{ARTICLE}</body>", 0), (2, None, None, 1), (None, "v", "", 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = sorted((tuple(r) for r in extract_pages(pages).collect()), key=str)
    assert got == sorted([(1, "u", TEXT, len(TEXT)), (1, "u", TEXT, len(TEXT)), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert extract_pages(pages.limit(0)).count() == 0
