"""Operator 4: main text of web pages by tag-path ratios.

Text length and punctuation are summed per tag path (the tags and first class
from the root to a block).  Both ratios, per visit of the path, are smoothed
over the page's blocks in order, fused into one score per path, and the blocks of
paths above the threshold are content.  To them come their neighbours: what else
stands in the elements that hold content (headings, lists, captions), and in an
``article`` or ``main`` that holds most of it.  Blocks outside such elements are taken by their score alone.

Every step is linear in the page: elements are visited once, in page order,
and what they inherit (path, boilerplate, article) is passed down.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeforge.llm.common import ROW, text_of, wrap

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>", re.S
)
#: one attribute: its name, and its value with or without quotes
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|"[^"]*"?|'[^']*'?|[=/]""")
_SPACE = re.compile(r"\s+")
_PUNCT = re.compile(r"[.,;:!?。，、；：！？…]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: tags that do not break a block
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
BOILER_TAGS = frozenset(
    "nav footer aside form script style noscript template button select option textarea iframe svg canvas object audio video dialog menu head title fieldset input label".split()
)
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: class and id names that mark boilerplate: alone, or before a hyphen or underscore ("comment-list"); and behind "site-"
BOILER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead topbar comment comments commentlist disqus reply replies discussion respond cookie cookies consent gdpr notice notices alert banner popup "
    "modal overlay share sharing social related recommended newsletter subscribe subscription signup login search widget toolbar pagination pager skip copyright disclaimer".split()
)
_PART = re.compile(r"[-_]+")
#: headings of a page's own, not of the site: a header inside one of these is content
ARTICLE = frozenset(("article", "main"))
#: tags whose short blocks belong to the text that they stand beside
NEIGHBOURS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd blockquote pre figcaption caption td th summary address hr center details ol ul dl table tbody tr article main".split())
# an opening tag of the first kind closes open ones of the second
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass(eq=False)
class Element:
    tag: str
    path: int
    parent: Element | None
    boiler: bool = False  # by its tag, role or hidden, or an ancestor's
    named: Element | None = None  # nearest element that a class or id name marks, itself included
    article: Element | None = None  # outermost article or main around it
    text: int = 0  # of an element marked by name: characters and blocks inside
    blocks: int = 0
    home: bool = False  # it, or an ancestor, holds content


@dataclass(eq=False)
class Block:
    owner: Element
    text: str
    linked: int
    marks: int = 0


def attributes(text: str) -> dict[str, str]:
    """Names and values, lower-cased; the first of a name counts."""
    out: dict[str, str] = {}
    for m in _ATTR.finditer(text):
        if m[1]:
            out.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return out


def marks_boilerplate(names: str) -> bool:
    """Whether one of the white-space separated class or id names is that of boilerplate."""
    for name in names.split():
        parts = [p for p in _PART.split(name) if p]
        if parts and (parts[0] in BOILER_NAMES or len(parts) == 2 and parts[0] == "site" and (parts[1] in BOILER_NAMES or parts[1] == "header")):
            return True
    return False


class Page:
    """Elements and text blocks of a page, both in page order."""

    def __init__(self):
        self.paths: dict[tuple[int, str, str], int] = {}
        self.root = Element("", 0, None)
        self.elements: list[Element] = []
        self.blocks: list[Block] = []

    def element(self, tag: str, attrs: str, parent: Element) -> Element:
        boiler = parent.boiler or tag in BOILER_TAGS or tag == "header" and parent.article is None
        name, marked = "", False
        if attrs:
            has = attributes(attrs)
            boiler = boiler or "hidden" in has or has.get("aria-hidden") == "true" or has.get("role") in BOILER_ROLES
            classes = has.get("class", "")
            name = classes.split()[0] if classes.split() else ""
            marked = tag not in ("html", "body", "article", "main") and marks_boilerplate(f"{classes} {has.get('id', '')}")
            if tag == "article" and marks_boilerplate(classes):
                marked = True  # a reader's comment, a sponsored teaser
        path = self.paths.setdefault((parent.path, tag, name), len(self.paths) + 1)
        made = Element(tag, path, parent, boiler, parent.named, parent.article)
        if marked:
            made.named = made
        if made.article is None and tag in ARTICLE and not marked:
            made.article = made
        self.elements.append(made)
        return made


def parse(page: str) -> Page:
    made = Page()
    root = top = made.root
    open_: Counter[str] = Counter()  # tags from the root to the top
    text: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                made.blocks.append(Block(top, whole, min(linked, len(whole)), len(_PUNCT.findall(whole))))
            text.clear()
        linked = 0

    def close() -> None:
        nonlocal top
        open_[top.tag] -= 1
        top = top.parent

    at, last = 0, page.rfind(">")
    while True:
        m = _MARKUP.search(page, at) if at <= last or "<!" in page[at:] or "<?" in page[at:] else None
        if m and m.end() > last + 1 and page[m.start() + 1] not in "!?":
            m = None  # no tag ends behind the last ">"
        piece = page[at : m.start()] if m else page[at:]
        if piece:
            text.append(piece)
            if links:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attrs = bool(m[1] or m[4]), m[3] or m[6] or ""
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            elif tag in ("br", "img"):
                text.append(" ")
            continue
        flush()
        links = 0
        if closing:
            if open_[tag]:
                while top.tag != tag:
                    close()
                close()
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        closes = CLOSES.get(tag)
        if closes and top.tag in closes:
            close()
        if top.tag == "p":  # a block ends an open paragraph
            close()
        top = made.element(tag, attrs, top)
        open_[tag] += 1
        if attrs.endswith("/") and tag in ("svg", "path", "object"):
            close()
    flush()
    return made


def _smooth(values: list[float], radius: int = 1) -> list[float]:
    weights = [math.exp(-(k**2) / 2) for k in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        near = [(weights[k + radius], values[i + k]) for k in range(-radius, radius + 1) if 0 <= i + k < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def _live(page: Page) -> list[Block]:
    """Blocks that neither a tag nor a name takes for boilerplate.

    A name alone does not take most of a page away: without an ``article`` or
    ``main`` that has text, an element that it marks counts as content when it holds three
    blocks or more and over three quarters of the text that tags leave.
    """
    blocks = [b for b in page.blocks if not b.owner.boiler]
    total, article = 0, False
    for b in blocks:
        total += len(b.text)
        if b.owner.named is not None:
            b.owner.named.text += len(b.text)
            b.owner.named.blocks += 1
        elif b.owner.article is not None:
            article = True
    if article:
        return [b for b in blocks if b.owner.named is None]
    marked = [e for e in page.elements if e.named is e]
    for e in reversed(marked):  # children before parents
        if e.parent.named is not None:
            e.parent.named.text += e.text
            e.parent.named.blocks += e.blocks
    kept: set[Element] = set()
    for e in marked:
        if 4 * e.text > 3 * total and e.blocks > 2 and (e.parent.named is None or e.parent.named in kept):
            kept.add(e)
    return [b for b in blocks if b.owner.named is None or b.owner.named in kept]


def scores(live: list[Block]) -> dict[int, float]:
    """Smoothed text and punctuation ratios of each path, fused."""
    sums: dict[int, list[float]] = {}
    for b in live:
        s = sums.setdefault(b.owner.path, [0, 0, 0])
        s[0] += len(b.text) - b.linked
        s[1] += b.marks
        s[2] += 1
    size = _smooth([sums[b.owner.path][0] / sums[b.owner.path][2] for b in live])
    mark = _smooth([(1 + sums[b.owner.path][1]) / sums[b.owner.path][2] for b in live])
    fused: dict[int, list[float]] = {}
    for b, x, y in zip(live, size, mark):
        fused.setdefault(b.owner.path, []).append(math.sqrt(x * y))
    return {p: sum(v) / len(v) for p, v in fused.items()}


def content(page: Page, threshold: float = 0.5) -> list[Block]:
    """The blocks of the article."""
    live = _live(page)
    if not live:
        return []
    score = scores(live)
    # the mean over the page's text: paths that hold much text weigh more
    total = sum(len(b.text) for b in live)
    limit = threshold * sum(score[b.owner.path] * len(b.text) for b in live) / total
    chosen = {b for b in live if score[b.owner.path] >= limit and 2 * b.linked <= len(b.text)}
    inside = sum(len(b.text) for b in chosen if b.owner.article is not None)
    marked = 2 * inside > sum(len(b.text) for b in chosen)
    if marked:
        homes = {b.owner.article for b in chosen if b.owner.article is not None}
    else:  # the elements that paragraphs stand in; a block that is no paragraph is its own
        homes = {b.owner.parent if b.owner.tag in NEIGHBOURS and b.owner.parent is not None else b.owner for b in chosen}
    page.root.home = page.root in homes
    for e in page.elements:
        e.home = e.parent.home or e in homes

    def beside(b: Block) -> bool:
        if not b.owner.home or b.linked > 0.6 * len(b.text) and b.owner.tag not in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
            return False
        return marked or b.owner.tag in NEIGHBOURS  # in a marked article everything that is not links

    return [b for b in live if beside(b) or b in chosen and not marked]


def extract(page: str | None) -> str:
    """The main text: blocks in page order, joined by one newline; empty if none."""
    if not page:
        return ""
    return "\n".join(b.text for b in content(parse(page)))


@F.pandas_udf(StringType())
def _extract_column(pages: pd.Series) -> pd.Series:
    return pages.map(extract)


def main_text(pages: DataFrame, source: str = "html") -> DataFrame:
    """The caller's columns (one struct) and ``main``: the article of each page.

    A page is worked on whole, in its own task; nothing is shuffled.  Null or
    empty html, and pages without text outside boilerplate, give an empty text.
    Malformed markup is read as text flow.  Repeated rows get equal texts; an
    empty table gives an empty result.
    """
    return wrap(pages, source).select(ROW, _extract_column(text_of(source)).alias("main"))
