"""Main text of web pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks.  A block's features are its word
count and link density, those of the blocks before and after it, and where it
stands (inside an article, inside a part that is named as page furniture, and
which share of the page's plain words the article has).  A small decision tree, grown here from the labelled table ``LABELLED``, tells
main text from the rest.

Pages are worked on where they are read; nothing is shuffled.

An element is furniture by its tag, by a class or id that names it so alone or with
words for containers (``comment-list``), and, where the name has other words too
(``no-sidebar``), unless the element holds most of the page's plain words.

Cases: a null or empty page, or one without main text, gives an empty text.
Broken markup is read as far as it goes: an unclosed element ends with its
parent, an unclosed comment or script at the end of the page, an unclosed button or option where the next block begins.  Repeated rows
and repeated or null ids keep a row each; other columns are not read.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blocks, bounded_batches

# Elements of HTML by their part in a page.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style noscript template textarea title iframe svg math object select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("nav header footer aside form menu dialog fieldset figcaption".split())
MAIN = frozenset("article main".split())
FURNITURE_NAMES = (
    "ad ads adsense advert advertisement alert banner breadcrumb breadcrumbs byline comment comments consent cookie cookies copyright disqus "
    "dropdown footer header hidden login masthead menu modal nav navbar navigation newsletter notice overlay pager pagination popup promo "
    "recommended related replies reply search share sidebar signup skip social sponsor sponsored subscribe tags toc toolbar widget"
).split()
# What a part of a page is called beside its kind: "comment-list" holds comments, "sidebar-left" may be a page's layout.
CONTAINERS = frozenset("area block box container group inner item items list outer panel section thread widget wrap wrapper".split())
# Controls: their text ends where a block begins or the next one starts, closed or not.
_CONTROL_END = re.compile(r"<(?:/?(?:button|option|optgroup|select|datalist)\b[^>]*>|(?=/?(?:address|article|aside|blockquote|body|div|dl|fieldset|figure|footer|form|h[1-6]|header|hr|html|main|nav|ol|p|pre|section|table|ul)\b))", re.I)
# Elements that may stay open: what a start tag ends, up to the first of some elements around it.
_ROWS = (frozenset(("tr", "td", "th")), frozenset(("table",)))
_CELLS = (frozenset(("td", "th")), frozenset(("tr", "table")))
_TERMS = (frozenset(("dt", "dd")), frozenset(("dl", "article", "section", "main", "aside", "table")))
ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "article", "section", "main", "aside", "table"))), "dt": _TERMS, "dd": _TERMS,
    "tr": _ROWS, "td": _CELLS, "th": _CELLS, "tbody": _ROWS, "thead": _ROWS, "tfoot": _ROWS,
}
FURNITURE_ROLES = frozenset("banner navigation complementary contentinfo search form alert dialog menu menubar note".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|([^<]+|<)", re.S)
_NAMED = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_FURNITURE_NAME = frozenset(FURNITURE_NAMES)
_PARTS = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: bool
    furniture: bool


NO, MAYBE, SURE = range(3)


def _furniture(attributes: str) -> int:
    """Whether an element's attributes name it as page furniture.

    A class or id that is such a name, or one with words for containers, does.  A
    name among other words (``no-sidebar``, ``comments-open``) may: the page decides.
    """
    found = NO
    for name, a, b, c in _NAMED.findall(attributes):
        value, name = (a or b or c).lower(), name.lower()
        if name in ("class", "id"):
            for token in value.split():
                parts = [p for p in _PARTS.split(token) if p]
                named = [p in _FURNITURE_NAME for p in parts]
                if any(named):
                    found = max(found, SURE if all(n or p in CONTAINERS for n, p in zip(named, parts, strict=True)) else MAYBE)
        elif name == "role" and value in FURNITURE_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return SURE
        elif name == "style" and "display:none" in value.replace(" ", ""):
            return SURE
    return found


MOST = 0.5  # of a page's plain words: what holds more is no furniture for a name that only may say so


def flat_blocks(page: str) -> list[Block]:
    """The page's text blocks in page order, head and scripts left out."""
    found: list[tuple[Block, tuple[int, ...]]] = []
    open_: list[tuple[str, tuple]] = []  # element, the state around it
    parts: list[str] = []
    links: list[str] = []
    linked, at, doubtful = False, 0, 0
    state: tuple[bool, bool, tuple[int, ...]] = (False, False, ())  # inside main, inside furniture, elements that may be furniture

    def leave(k: int) -> None:
        nonlocal state
        state = open_[k][1]
        del open_[k:]

    def enter(name: str, attributes: str) -> None:
        nonlocal state, doubtful
        open_.append((name, state))
        main, furniture, maybe = state
        kind = _furniture(attributes) if attributes else NO
        if kind == MAYBE:
            maybe, doubtful = (*maybe, doubtful), doubtful + 1
        main = main or name in MAIN or "main" in attributes and bool(re.search(r"role\s*=\s*[\"']?main", attributes, re.I))
        state = main, furniture or name in FURNITURE or kind == SURE, maybe

    def end_open(names: frozenset[str], around: frozenset[str]) -> None:
        """Close the outermost open element of ``names`` inside the nearest one of ``around``."""
        last = None
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] in around:
                break
            if open_[k][0] in names:
                last = k
        if last is not None:
            leave(last)

    def end_paragraph() -> None:
        k = len(open_) - 1
        while k >= 0 and open_[k][0] in INLINE:
            k -= 1
        if k >= 0 and open_[k][0] == "p":
            leave(k)

    def flush() -> None:
        nonlocal parts, links
        if parts:
            words = html.unescape("".join(parts)).split()
            if words:
                inside = len(html.unescape(" ".join(links)).split()) if links else 0
                found.append((Block(" ".join(words), len(words), min(inside, len(words)), state[0], state[1]), state[2]))
            parts, links = [], []

    while match := _TOKEN.match(page, at):
        at = match.end()
        close, name, attributes, text = match.groups()
        if text is not None:
            parts.append(text)
            if linked:
                links.append(text)
            continue
        if name is None:
            continue
        name = name.lower()
        if name in RAW or name == "head":
            if not close and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else at if name == "select" else len(page)
            if name not in ("title", "script", "style"):
                parts.append(" ")
            continue
        if name in ("button", "option", "optgroup"):
            if not close and not attributes.endswith("/"):
                end = _CONTROL_END.search(page, at)
                stop = end is not None and end.group().startswith("</") and end.group().lower().startswith(f"</{name}")
                at = (end.end() if stop else end.start()) if end else at
            parts.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                linked = not close
            elif name in ("br", "img"):
                parts.append(" ")
            elif attributes and not close and _furniture(attributes):
                flush()
                enter(name, attributes)
            elif close and (k := len(open_) - 1 - (len(open_) > 1 and open_[-1][0] == "p" and open_[-2][0] in INLINE)) >= 0 and open_[k][0] == name:
                flush()
                leave(k)
            continue
        flush()
        linked = False
        if close and name == "p":
            end_paragraph()
        elif close and name in ENDS and name not in ("tbody", "thead", "tfoot"):
            end_open(frozenset((name,)), ENDS[name][1])
        elif close:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    leave(k)
                    break
        elif name == "hr":
            end_paragraph()
        elif name not in VOID and not attributes.endswith("/") and name not in ("html", "body"):
            end_paragraph()
            if name in ENDS:
                end_open(*ENDS[name])
            enter(name, attributes)
    flush()

    # What holds most of the page is no furniture, whatever words its name has.
    plain, held = 0, [0] * doubtful
    for b, maybe in found:
        if not b.furniture:
            plain += b.words - b.linked
            for k in maybe:
                held[k] += b.words - b.linked
    for b, maybe in found:
        b.furniture = b.furniture or any(held[k] <= MOST * plain for k in maybe)
    return [b for b, _ in found]


FEATURES = ("words", "density", "words_before", "density_before", "words_after", "density_after", "main", "furniture", "main_part")
# A small table labelled by hand: the first six features of a block, then whether it is main text where it stands
# in an article, outside an article that holds most of the page's plain words, and elsewhere: on a page whose
# article is a small part (a teaser, a heading) or that has none.  In furniture nothing is main text.
SHAPES = (
    (1, 0.0, 0, 0.0, 8, 0.0, 1, 0, 0),
    (1, 0.0, 40, 0.0, 60, 0.0, 1, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0),
    (2, 1.0, 45, 0.0, 2, 1.0, 0, 0, 0),
    (3, 0.0, 6, 0.0, 0, 0.0, 1, 0, 0),
    (3, 1.0, 70, 0.0, 4, 1.0, 0, 0, 0),
    (4, 0.0, 30, 0.0, 48, 0.0, 1, 0, 1),
    (5, 1.0, 2, 1.0, 60, 0.0, 0, 0, 0),
    (5, 0.0, 2, 1.0, 0, 0.0, 1, 0, 0),
    (6, 0.0, 55, 0.0, 70, 0.0, 1, 0, 1),
    (6, 0.33, 1, 0.0, 1, 0.0, 1, 0, 0),
    (6, 0.7, 40, 0.0, 9, 0.0, 0, 0, 0),
    (7, 0.0, 5, 0.0, 4, 0.0, 1, 0, 0),
    (9, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0),
    (18, 0.0, 40, 0.0, 25, 0.0, 1, 0, 1),
    (20, 0.0, 3, 1.0, 22, 0.0, 1, 0, 1),
    (25, 0.3, 60, 0.0, 6, 0.0, 1, 0, 1),
    (28, 0.9, 4, 1.0, 30, 0.8, 0, 0, 0),
    (30, 0.8, 28, 0.9, 5, 0.0, 0, 0, 0),
    (45, 0.0, 3, 1.0, 4, 1.0, 1, 0, 1),
    (50, 0.0, 90, 0.0, 45, 0.0, 1, 1, 1),
    (60, 0.0, 2, 0.0, 80, 0.1, 1, 0, 1),
    (70, 0.1, 60, 0.0, 0, 0.0, 1, 0, 1),
    (70, 0.0, 60, 0.0, 80, 0.0, 1, 1, 1),
    (90, 0.0, 0, 0.0, 0, 0.0, 1, 0, 1),
)
# (main, furniture, main_part) and the label's place in the shape; None for furniture.
_PLACES = (
    (1, 0, 0.9, 6), (1, 0, 0.1, 6), (0, 0, 0.9, 7), (0, 0, 0.1, 8), (0, 0, 0.0, 8),
    (1, 1, 0.9, None), (1, 1, 0.1, None), (0, 1, 0.9, None), (0, 1, 0.1, None), (0, 1, 0.0, None),
)
LABELLED = tuple((*s[:6], *place, s[k] if k else 0) for s in SHAPES for *place, k in _PLACES)


def grown(rows: tuple[tuple[float, ...], ...]):
    """A decision tree (feature, limit, at most, over) with shares of main text at its leaves, split by Gini impurity."""

    def impurity(part) -> float:
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * p * (1 - p)

    share = sum(r[-1] for r in rows) / len(rows)
    if share in (0.0, 1.0):
        return share
    best = None
    for f in range(len(FEATURES)):
        values = sorted({r[f] for r in rows})
        for a, b in zip(values, values[1:], strict=False):
            limit = (a + b) / 2
            low, high = [r for r in rows if r[f] <= limit], [r for r in rows if r[f] > limit]
            cost = impurity(low) + impurity(high)
            if best is None or cost < best[0] - 1e-12:
                best = cost, f, limit, low, high
    if best is None:
        return share
    _, f, limit, low, high = best
    return f, limit, grown(tuple(low)), grown(tuple(high))


@functools.cache
def _tree():
    return grown(LABELLED)


def _main_share(features: tuple[float, ...]) -> float:
    node = _tree()
    while isinstance(node, tuple):
        node = node[2] if features[node[0]] <= node[1] else node[3]
    return node


def main_text(page: str) -> str:
    """The blocks that the tree takes for main text, one a line."""
    found = flat_blocks(page)
    plain = [(b.words - b.linked, b.main) for b in found if not b.furniture]
    main_part = sum(n for n, main in plain if main) / max(1, sum(n for n, _ in plain))
    shape = [(0, 0.0), *((b.words, b.linked / b.words) for b in found), (0, 0.0)]
    out = []
    for k, b in enumerate(found):
        if _main_share((*shape[k + 1], *shape[k], *shape[k + 2], b.main, b.furniture, main_part)) > 0.5:
            out.append(b.text)
    return "\n".join(out)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in blocks(batches, text="html"):
        out = [main_text(h) for h in table["html"].to_pylist()]
        kept = table.select(["page_id", "url"])
        kept = kept.append_column("text", pa.array(out, pa.string())).append_column("n_chars", pa.array(map(len, out), pa.int64()))
        yield from kept.to_batches()


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    bounded_batches(pages.sparkSession)
    own = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return own.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
