"""Main text of HTML pages: flat text blocks, classified by a decision tree.

A page is read once into a flat list of text blocks: text between the tags of block elements,
tolerant of tags that are never closed. A block has its number of words, its link density (share
of words in links), the same of its neighbours, whether it is a heading, and one feature for its container: from the article
over containers that say nothing to elements that can't be the article (navigation, footer, comments, ...). A decision tree, grown
(Gini impurity) on the labelled blocks of the small pages below, decides which blocks are main text.

Time is in proportion to the page's length, however odd its tags. Defined cases: null or empty HTML gives an empty text; text without
tags is one block; comments, scripts, styles and templates have no text, closed or not; of quotes that never end only the first few
are looked for, then a tag ends at the next >; a page without main text gives an empty text; equal rows have equal
results; an empty table gives an empty result; extra columns stay.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, small_batches

# Names of elements, roles and usual class names.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED_TAGS = frozenset("script style noscript template svg math iframe object canvas audio video head title select textarea button datalist".split())
RAW_TAGS = frozenset("script style title textarea noscript iframe".split())
BOILER_TAGS = frozenset("nav footer aside menu dialog search".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs byline copyright cookie cookies consent dialog disclaimer footer gdpr login masthead menu menubar modal nav navbar navigation "
    "newsletter notice notification overlay pager pagination popup privacy promo promoted promotion recommendations recommended related search share sharebar sharing sidebar signin signup skip social sponsor sponsored subscribe subscription "
    "tagcloud toolbar topbar trending widget widgets".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies respond responses".split())
HEADER_NAMES = frozenset("header heading hero".split())
CONTENT_NAMES = frozenset("article articlebody content entry main maincontent post story".split())
# Words of class names that say where something is or what it is made of, not what it is.
PLACE_NAMES = frozenset("site page top bottom left right list box area block container wrapper wrap section inner outer links link posts articles stories items item text bar buttons button primary secondary global sub".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())
SCOPES = frozenset("article aside blockquote body div figure footer form header html main nav section table td th ul ol dl".split())

_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_PLAIN_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
#: Tags whose quotes never end, after which a page's quotes are no longer looked at.
MOST_UNENDED = 16
_ATTR = re.compile(r"([A-Za-z_:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Containers, from the article to what can't be it: the article (or main part); named like one; says nothing; named like something
#: else; beside the page's article; an element, role or comment list that is something else.
CONTAINERS = "amxnob"
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "container", "heading")

#: Labelled blocks of small pages, in page order: container, words, then /linked words (or l: all of them), h for a heading, + for main text.
LABELLED = (
    "b1l b1l b2l b1l b3l o14 a9h+ a3+ a45+ a62+ a18/2+ a70+ a5h+ a38+ a2+ b9",
    "b1l b1l b1l b1l b1l o8 a6h+ a1+ a2+ b12/2",
    "b1l b2l o21 a8h+ a30+ n3 a55+ a12+ n17 a40+ n4l o35 o28 o60 o5 b7",
    "b3h b1l b1l n18 a4h+ n2 a6+ a2+ a1+ a2/1+ b2 n1 b20 n17 b2",
    "b2l b2l a7h+ a25+ a4+ a6+ a3l+ a5l+ a40+ a6/3+ o3h o6l o7l o5l b11",
    "o12 a11h+ a150+ a90/9+ a200+ n30 a80+ o3h o45 o70 o9 o33 b15/3",
    "b1l b1l b1l m8h+ m40+ m55+ m9+ m33+ n12 n20 b8",
    "x1l x2l x1l m6h+ m12+ m7+ m15+ n5 n14 m3l m4l m3l b6",
    "n18 m5h+ m60+ m35/4+ m80+ m6+ m28+ n22 n9 n3l n2l n4l b12/1",
    "x1l x1l x2l x1l x6h+ x40+ x75+ x22+ x60+ x7 x1l x2l",
    "x1l x1l x1l x5h+ x12+ x9+ x14+ x11+ x10+ x6",
    "x2 x3l x2l x4l x30+ x18+ x24/3+ x41+ x8/4 x3l x5l x9",
    "x1l x1l x8h+ x50+ x3+ x60+ x4+ x45+ x12+ x35+ x5",
    "n25 x2l x1l x9h+ x35+ x50+ x28+ n25 n14 n40 n60 n3l n3l b9",
    "x3 x1l x1l x2l x13+ x16+ x11+ x20+ x2l x3l x8",
    "x3l x4l x12/11 x14/13 x10l x9l x3h x2l x3l x2l x4",
    "x4h x3l x5l x2l x6h+ x26+ x70+ x5h+ x33+ x19+ x7",
    "b1l b2l a4h+ a20+ a6+", "a8+", "a2+", "b3l a5h+ a30+ a5+", "a7h+ a1+", "a4h+ a3l+", "m4h+ m30+ m9+", "m6+",
    "x45+", "x400+", "x3+", "x7+", "x5+", "x10+", "x15+", "x1l x300+", "x2l x8+ x12+", "x6h+ x24+", "x5h+ x9+ x13+",
)


def rows_of(blocks: list[tuple[int, int, int, int]]) -> list[tuple[int, ...]]:
    """Features of a page's blocks (words, linked words, container, heading), in page order."""
    flat = [(0, 0), *((w, round(100 * linked / w)) for w, linked, _, _ in blocks), (0, 0)]
    return [(*flat[i + 1], *flat[i], *flat[i + 2], container, heading) for i, (_, _, container, heading) in enumerate(blocks)]


def labelled_rows() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled blocks."""
    x, y = [], []
    for page in LABELLED:
        parts = [re.fullmatch(r"([a-z])(\d+)(?:/(\d+)|(l))?(h?)(\+?)", b).groups() for b in page.split()]
        x += rows_of([(int(w), int(w) if every else int(linked or 0), CONTAINERS.index(c), int(bool(h))) for c, w, linked, every, h, _ in parts])
        y += [int(bool(main)) for *_, main in parts]
    return np.array(x, float), np.array(y)


@dataclass(frozen=True)
class Node:
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None
    label: int = 0


def grow(x: np.ndarray, y: np.ndarray, depth: int = 8) -> Node:
    """CART: the split of least Gini impurity, ties to the first feature and the lowest cut."""
    if depth == 0 or y.min() == y.max():
        return Node(label=int(2 * y.sum() >= len(y)))
    best = (1e9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[:-1] + values[1:]) / 2:
            low = y[x[:, f] <= cut]
            high = y[x[:, f] > cut]
            impurity = sum(len(s) * s.mean() * (1 - s.mean()) for s in (low, high))
            if impurity < best[0] - 1e-12:
                best = (impurity, f, float(cut))
    if best[1] < 0:
        return Node(label=int(2 * y.sum() >= len(y)))
    left = x[:, best[1]] <= best[2]
    return Node(best[1], best[2], grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1))


@lru_cache(maxsize=1)
def tree() -> Node:
    return grow(*labelled_rows())


def classify(node: Node, row: tuple) -> bool:
    while node.feature >= 0:
        node = node.low if row[node.feature] <= node.cut else node.high
    return bool(node.label)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    where: Where
    heading: bool


@dataclass(frozen=True)
class Where:
    """What is known of the place of a block: strong (it can't be the article), named (m or n, or nothing), in an article, in the main part, only headings count."""

    strong: bool = False
    named: str = ""
    article: bool = False
    main: bool = False
    heading_only: bool = False


def _named(value: str) -> str:
    """What class names say: c for comments, n for something else than the article, h for a header, m for the article; nothing if a name holds words of another sort or of both."""
    found = ""
    for name in value.split():
        words = {x.lower() for x in _NAME.findall(name)} - PLACE_NAMES
        boiler, content = words & BOILER_NAMES, words & CONTENT_NAMES
        if words and words <= COMMENT_NAMES | BOILER_NAMES | HEADER_NAMES and words & COMMENT_NAMES:
            return "c"
        if boiler and words <= BOILER_NAMES | HEADER_NAMES:
            found = "n"
        elif words and words <= HEADER_NAMES:
            found = found or "h"
        elif content and not boiler:
            found = found or "m"
    return found


def _container(tag: str, attributes: str, outer: Where) -> Where:
    """The place within an element that stands in an outer one."""
    if tag in ("html", "body") or outer.strong:
        return outer
    says, role, hidden = "", "", False
    if attributes.strip(" /"):
        for m in _ATTR.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                found = _named(value)
                says = found if found in ("c", "n") or not says else says
            elif name == "role":
                role = value.strip().lower()
            hidden = hidden or name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None)
    if says == "c" or hidden:
        return replace(outer, strong=True)
    if tag == "article" or role == "article":
        return Where(article=True, main=outer.main)
    if tag == "main" or role == "main":
        return Where(article=outer.article, main=True)
    if tag in BOILER_TAGS or role in BOILER_ROLES:
        return replace(outer, strong=True)
    if tag == "header" or says == "h":
        return replace(outer, heading_only=True) if outer.article or outer.main else replace(outer, strong=True) if tag == "header" else replace(outer, named="n")
    if tag == "form" or says == "n":
        return replace(outer, named="n")
    return replace(outer, named="m") if says == "m" and not outer.named else outer


def _tag_at(page: str, at: int, unended: list[int]) -> re.Match | None:
    """The next tag or comment from `at` on."""
    while (at := page.find("<", at)) >= 0:
        found = _TAG.match(page, at) if len(unended) < MOST_UNENDED else None
        if found:
            return found
        if (following := page[at + 1 : at + 2]) and (following.isalpha() or following in "/!?"):
            if len(unended) < MOST_UNENDED:
                unended.append(at)
            found = _PLAIN_TAG.match(page, at) if following not in "!?" else _TAG.match(page, at)
            if found:
                return found
            if page.find(">", at) < 0:
                return None  # cut off by the page's end
        at += 1
    return None


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in page order."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, Where]] = []
    opened: dict[str, int] = {}
    unended: list[int] = []
    skipping = links = headings = at = 0
    state = Where()

    def flush() -> None:
        if parts:
            words = "".join(parts).split()
            if words:
                out.append(Block(" ".join(words), len(words), len(" ".join(linked).split()), state, headings > 0))
            parts.clear()
            linked.clear()

    def add(raw: str) -> None:
        if raw and not skipping:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                linked.append(text)

    def count(tag: str, by: int) -> None:
        nonlocal skipping, links, headings
        opened[tag] = opened.get(tag, 0) + by
        skipping += by * (tag in SKIPPED_TAGS)
        links += by * (tag == "a")
        headings += by * (len(tag) == 2 and tag[0] == "h" and tag[1].isdigit())

    def pop_to(i: int) -> None:
        nonlocal state
        for tag, _ in stack[i:]:
            count(tag, -1)
        state = stack[i][1]
        del stack[i:]

    end, m = len(page), _tag_at(page, 0, unended)
    while m:
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if tag and not m[1]:
            if tag == "br":
                add(" ")
            block = tag in BLOCK_TAGS
            if block:
                flush()
            if tag in CLOSED_BY_SAME and opened.get(tag) or block and opened.get("p"):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag and tag in CLOSED_BY_SAME or stack[i][0] == "p" and block:
                        pop_to(i)
                        break
                    if stack[i][0] in SCOPES:
                        break
            if tag not in VOID_TAGS and not m[3].endswith("/"):
                stack.append((tag, state))
                state = _container(tag, m[3], state)
                count(tag, 1)
                if tag in RAW_TAGS:
                    close = re.compile(f"</{re.escape(tag)}\\s*>", re.I).search(page, at)
                    at = close.start() if close else end
        elif tag:
            if tag in BLOCK_TAGS:
                flush()
            if opened.get(tag):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        pop_to(i)
                        break
                    if tag not in BLOCK_TAGS and stack[i][0] in SCOPES:
                        break  # an inline end tag doesn't close a block
        m = _tag_at(page, at, unended)
    rest = page[at:]
    cut = re.search(r"<[/!?A-Za-z]", rest)  # a tag that the page's end cuts off
    add(rest[: cut.start()] if cut else rest)
    flush()
    return out


def container_of(b: Block, with_article: bool) -> int:
    """The block's container, as a place in CONTAINERS; with_article: whether the page has an article."""
    w = b.where
    if w.strong or w.heading_only and not b.heading:
        return CONTAINERS.index("b")
    if with_article and not w.article and not w.main:
        return CONTAINERS.index("o")
    if w.named == "n":
        return CONTAINERS.index("n")
    if w.article or w.main and not with_article:
        return CONTAINERS.index("a")
    return CONTAINERS.index("m" if w.main or w.named == "m" else "x")


def text_of(page: str | None, root: Node) -> str:
    """Blocks that the tree takes for main text, joined by newlines."""
    found = blocks(page) if page else []
    with_article = any(b.where.article and not b.where.strong for b in found)
    rows = rows_of([(b.words, b.linked, container_of(b, with_article), int(b.heading)) for b in found])
    return "\n".join(b.text for b, row in zip(found, rows, strict=True) if classify(root, row))


def main_text(page: str | None) -> str:
    return text_of(page, tree())


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with main_text."""
    small_batches(pages.sparkSession)
    root = tree()  # travels in the task; a cached function would be looked up by name in the worker

    @F.pandas_udf("string")
    def read(raw: pd.Series) -> pd.Series:
        return pd.Series([text_of(x, root) for x in raw], dtype=object)

    return pages.withColumn(free_name(pages, "main_text"), read(F.col(html_col).cast("string")))
