"""Main text of web pages by tag-path ratios.

A page is read once into text leaves. Each leaf stands at the end of a tag path, the labels (tag and first class or id)
from the root down; paths are numbered as they come, each with its parent's number, so a page takes time and memory in
proportion to its length however deep it is nested. Each path gathers its leaves' number, text length and punctuation.
The length ratio (characters a leaf) and the punctuation ratio (marks a leaf) are smoothed over neighbouring paths of a
container in page order and fused by multiplication. Paths are content that reach half of the page's mean, weighted by characters.

Labels are evidence: they shift a path's ratio by a power of two, at most 16 times for it and 256 times against it.
Labels that name content add to it, labels that name navigation, notices, adverts, forms or comments take from it. Whether
such a name is believed is up to the ratios, too: where an element holds all but a tenth of what the ratios alone
select (half of it, if the name is only a part of a longer one, as in "no-sidebar", or a form) and no article or main
element stands outside of it, it's a frame around the content and its name means something else.

Content paths then fix what belongs to them. What stands in the same container (the path without its inner text tags)
is content, so are headings, short paragraphs and list items however short. Where a chosen path stands in an article or
main element, all that has this same element as its nearest one is content; elsewhere, a container inside a chosen one
is content if it reaches a quarter of the threshold. In both cases labels that name other parts in between rule it out.

It runs as Python over Arrow batches, a page at a time, so memory is bounded by a batch and nothing is shuffled.

A null page is an empty one; a page without content gives an empty text, so does one of nothing but links, notices and the
like without running text. Broken markup never fails: unknown and unclosed tags, stray end tags and a cut end are read as browsers would
roughly read them. Elements whose content is no page text (scripts, styles, controls, hidden parts) have no leaves. The
whole page is read, however long. Equal rows give equal results; the columns page_id, url and html are read, others
don't matter.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes noembed xmp svg math object audio video canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
#: Tags of running text: they don't make a container.
TEXT_TAGS = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody tfoot tr td th figure figcaption address hgroup center details summary".split())
#: Elements, beside RAW, whose content is no text of the page.
CONTROLS = frozenset("head button select option datalist".split())
#: An open p ends where one of these starts.
ENDS_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: An open element of the first set ends where this one starts, unless one of the second set stands in between.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Tags, and words in a class, an id or a role, that name parts which are no content; and those that name content.
OTHER_TAGS = frozenset("nav footer aside form fieldset menu dialog label".split())
FORMS = frozenset(("form", "fieldset"))
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promos promotion sidebar sidebars widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar"
    " cookie cookies consent gdpr notice notices alert alerts notification popup modal overlay subscribe subscription newsletter signup signin login search share sharing social related recommended recommendations"
    " comment comments reply replies respond disqus discussion pagination pager toolbar skip copyright legal disclaimer outbrain taboola paywall contentinfo complementary hidden toc".split()
)
CONTENT_WORDS = frozenset("article content main post entry story body text".split())
#: What a label adds to the evidence (a power of two), and the most and least that a path may have.
STATED, TOLD, OTHER, MOST, LEAST = 3, 1, -8, 4, -8
#: A frame leaves less than this share of what ratios select outside: of a whole word's, and of a part of a name's; and less of all text. Characters and marks a leaf of running text.
WORD_FRAME, PART_FRAME, FRAME = 0.1, 0.5, 0.4
RUNNING, RUNNING_MARKS = 40, 1
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？¿¡]")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Paths to each side that smoothing reads; the shares of the mean from which paths, and containers inside chosen ones, are content.
WIDTH, THRESHOLD, INNER = 1, 0.5, 0.125


def name_words(*names: str) -> set[str]:
    return {w.lower() for n in names for w in NAME_WORD.findall(n)}


class Paths:
    """The tag paths of a page, numbered in page order; 0 is the root."""

    def __init__(self) -> None:
        self.number: dict[tuple, int] = {}
        self.parent, self.container, self.scope = [0], [0], [0]
        self.frame = [0.0]  # for labels that name other parts: the share outside from which they're believed; else 0
        self.adds = [0]  # evidence of labels that name content
        self.hidden = [False]
        self.stated = [False]
        # once the page is read (`settle`)
        self.other = [False]  # whether the label names another part and is believed
        self.points = [0]  # evidence
        self.others = [0]  # labels that name other parts, since the nearest article or main

    def below(self, parent: int, tag: str, rest: str) -> int:
        """The number of the path that an element with these attributes makes below parent."""
        key = parent, tag, rest
        known = self.number.get(key)
        if known is None:
            known = self._add(parent, tag, rest)
            self.number[key] = known
        return known

    def _add(self, parent: int, tag: str, rest: str) -> int:
        found: dict[str, str] = {}
        if rest and not rest.isspace() and rest != "/":
            for m in ATTRIBUTE.finditer(rest):
                found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        kind, own, role = found.get("class", ""), found.get("id", ""), found.get("role", "")
        first = (kind.split() or [own])[0]
        named = name_words(kind, own, role) if kind or own or role else set()
        whole = {w.lower() for w in f"{kind} {own} {role}".split()}
        stated = tag in ("article", "main") or role == "main"
        hidden = self.hidden[parent] or tag in CONTROLS or "hidden" in found or found.get("aria-hidden") == "true" or bool(HIDDEN_STYLE.search(found.get("style", "")))
        outside = not self.scope[parent]
        words = OTHER_WORDS | {"header"} if outside else OTHER_WORDS
        if stated:
            words = {"comment", "comments", "reply", "replies"}
        frame = WORD_FRAME if tag in OTHER_TAGS - FORMS or (tag == "header" and outside) else PART_FRAME if tag in FORMS else 0.0
        if tag not in ("html", "body"):
            if whole & words:
                frame = WORD_FRAME
            elif named & words and not frame:
                frame = PART_FRAME
        adds = 0 if frame else STATED if stated else TOLD if named & CONTENT_WORDS and tag not in ("html", "body") else 0
        label = parent, tag, first, frame, adds, hidden, stated
        known = self.number.get(label)
        if known is not None:
            return known
        new = self.number[label] = len(self.parent)
        self.parent.append(parent)
        self.container.append(self.container[parent] if tag in TEXT_TAGS and not frame else new)
        self.scope.append(new if stated else self.scope[parent])
        self.frame.append(frame)
        self.adds.append(adds)
        self.hidden.append(hidden)
        self.stated.append(stated)
        return new

    def settle(self, selected: dict[int, int], running: set[int], held: dict[int, int]) -> None:
        """Decides which labels are believed. By path: selected, the characters that ratios alone select; running: those of running text; held: all characters."""
        n = len(self.parent)
        mass, runs, said, every = [0] * n, [0] * n, [0] * n, [0] * n
        for p, chars in held.items():
            mass[p], runs[p], said[p], every[p] = selected.get(p, 0), int(p in running), chars if self.scope[p] else 0, chars
        for p in range(n - 1, 0, -1):  # children have higher numbers
            for sums in (mass, runs, said, every):
                sums[self.parent[p]] += sums[p]
        for p in range(1, n):
            up = self.parent[p]
            around = runs[p] > 0 and said[p] == said[0] and mass[0] - mass[p] < self.frame[p] * mass[0] and every[0] - every[p] < FRAME * every[0]
            other = self.frame[p] > 0 and not around
            self.other.append(other)
            self.points.append(max(LEAST, min(MOST, self.points[up] + (OTHER if other else self.adds[p]))))
            self.others.append(int(other) if self.stated[p] else self.others[up] + int(other))


#: A leaf: the number of its path, its block, its text, and which article or main element is its nearest one (0: none).
Leaf = tuple[int, int, str, int]


def leaves(page: str) -> tuple[Paths, list[Leaf]]:
    """The page's paths, and its texts in order."""
    paths, out, block, at = Paths(), [], 0, 0
    stack: list[tuple[str, int, int]] = [("", 0, 0)]  # open elements: tag, path, nearest article or main
    open_at: dict[str, list[int]] = defaultdict(list)  # where in the stack a tag is open

    def cut(size: int) -> None:
        while len(stack) > size:
            open_at[stack.pop()[0]].pop()

    def text(upto: int) -> None:
        if upto > at and not paths.hidden[stack[-1][1]]:
            found = page[at:upto]
            out.append((stack[-1][1], block, html.unescape(found) if "&" in found else found, stack[-1][2]))

    end = len(page)
    position = 0
    while position < end and (m := TOKEN.search(page, position)):
        text(m.start())
        at = position = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            if m[0].startswith("<![CDATA["):
                at, stop = m.start() + 9, m.end() - 3 * m[0].endswith("]]>")
                text(stop)
                at = m.end()
            continue
        tag = tag.lower()
        if tag not in INLINE and tag != "br":
            block += 1
        if m["end"] or m["end2"]:
            if open_at[tag]:
                cut(open_at[tag][-1])
            continue
        rest = m["rest"] or m["rest2"] or ""
        if tag == "br":
            if not paths.hidden[stack[-1][1]]:
                out.append((stack[-1][1], block, " ", stack[-1][2]))
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            if not (tag in ("svg", "math") and rest.rstrip().endswith("/")):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, position)
                at = position = close.end() if close else end
            continue
        if tag in ENDS_P and open_at["p"]:
            cut(open_at["p"][-1])
        elif tag in SIBLINGS:
            same, bounds = ([open_at[t][-1] for t in tags if open_at[t]] for tags in SIBLINGS[tag])
            if tag == "tr":
                same = [open_at["tr"][-1]] if open_at["tr"] else same
            if same and max(same) > max(bounds, default=-1):
                cut(max(same))
        open_at[tag].append(len(stack))
        path = paths.below(stack[-1][1], tag, rest)
        stack.append((tag, path, position if paths.scope[path] == path else stack[-1][2]))
    text(end)
    return paths, out


def ratios(paths: Paths, found: list[Leaf]) -> tuple[dict[int, list[int]], dict[int, float]]:
    """By path its leaves' number, length and punctuation, and the smoothed length ratio times the smoothed punctuation ratio."""
    stats: dict[int, list[int]] = {}
    for path, _, text, _ in found:
        n = len(" ".join(text.split()))
        if n:
            s = stats.setdefault(path, [0, 0, 0])
            s[0] += 1
            s[1] += n
            s[2] += len(PUNCTUATION.findall(text))
    order = list(stats)
    home = [paths.container[p] for p in order]

    def smooth(values: list[float]) -> list[float]:
        out = []
        for i in range(len(values)):
            near = [(values[k], 0.5 ** abs(i - k)) for k in range(max(0, i - WIDTH), min(len(values), i + WIDTH + 1)) if home[k] == home[i]]
            out.append(sum(v * w for v, w in near) / sum(w for _, w in near))
        return out

    length = smooth([stats[p][1] / stats[p][0] for p in order])
    marks = smooth([stats[p][2] / stats[p][0] for p in order])
    return stats, {p: a * (b + 0.1) for p, a, b in zip(order, length, marks, strict=True)}


def mean_of(values: dict[int, float], stats: dict[int, list[int]], basis: list[int]) -> float:
    """Weighted by characters; infinity of nothing."""
    chars = sum(stats[p][1] for p in basis)
    return sum(values[p] * stats[p][1] for p in basis) / chars if chars else float("inf")


def fused_ratios(paths: Paths, found: list[Leaf]) -> tuple[dict[int, float], float]:
    """By path the ratio with its evidence, and the mean of those without evidence against them. The paths' labels are settled by the ratios before."""
    stats, plain = ratios(paths, found)
    least = THRESHOLD * mean_of(plain, stats, list(plain))
    selected = {p: stats[p][1] for p, v in plain.items() if v >= least}
    running = {p for p in selected if stats[p][1] >= RUNNING * stats[p][0] and stats[p][2] >= RUNNING_MARKS * stats[p][0]}
    paths.settle(selected, running, {p: s[1] for p, s in stats.items()})
    fused = {p: v * 2.0 ** paths.points[p] for p, v in plain.items()}
    return fused, mean_of(fused, stats, [p for p in fused if not paths.others[p] and paths.points[p] >= 0])


def content_paths(paths: Paths, found: list[Leaf]) -> tuple[set[int], set[int]]:
    """The paths that reach the threshold, and those that reach what a container inside a chosen one needs."""
    fused, mean = fused_ratios(paths, found)
    return {p for p, f in fused.items() if f >= THRESHOLD * mean}, {p for p, f in fused.items() if f >= INNER * mean}


def accepted(paths: Paths, chosen: set[int], inner: set[int]) -> list[bool]:
    """For each path whether its leaves are content, wherever they stand."""
    n = len(paths.parent)
    held = {paths.container[p] for p in chosen}
    inner_held = {paths.container[p] for p in inner}
    inside = [0 in held] + [False] * (n - 1)  # below a chosen container, no label of another part in between
    out = []
    for p in range(n):
        up = paths.parent[p]
        clean = not paths.other[p] or paths.others[p] == 0
        if p:
            inside[p] = p in held or inside[up] and clean
        home = paths.container[p]
        out.append(p in chosen or home in held or (not paths.scope[p] and inside[p] and home in inner_held))
    return out


def extract(page: str | None) -> str:
    """The page's main text: blocks in page order, joined by line feeds."""
    paths, found = leaves(page or "")
    chosen, inner = content_paths(paths, found)
    keep = accepted(paths, chosen, inner)
    articles = {article for path, _, text, article in found if path in chosen and text.strip()} - {0}
    blocks: list[str] = []
    parts: list[str] = []
    last = None
    for path, block, text, article in found:
        if not (keep[path] or article in articles and not paths.others[path]):
            continue
        if block != last and parts:
            blocks.append(" ".join("".join(parts).split()))
            parts = []
        last = block
        parts.append(text)
    if parts:
        blocks.append(" ".join("".join(parts).split()))
    return "\n".join(b for b in blocks if b)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
