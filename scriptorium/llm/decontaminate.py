"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ by ``m // PIECE`` edits.  Cut into one
piece more than that, at least one piece of it stands unchanged wherever the
item does.  One automaton of all pieces runs over each whole text; every hit
names a window, windows of one item that overlap merge, and Myers' bit-parallel
recurrence gives the item's least edit distance inside each.

An item under ``PIECE`` characters has no budget: it must stand as it is and at
word edges, so that "the" is not found in "others".  Such an item still matches
every text that holds it as words; a benchmark of single words would.

Letters count regardless of case and any white space as a blank, both one to
one, so spans refer to the text as it is.

The items are the stated query set.  They are read in blocks of a bounded
number of characters; each block becomes one automaton, sent to the tasks, and
one pass over the documents.  Documents are neither shuffled nor gathered.

Cases: a null or empty text matches nothing, a null or blank item is no test
item.  Equal items match independently.  Rows are judged one by one; repeated
rows and repeated or null ids keep their matches each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded_batches, texts

PIECE = 18  # characters an item has for each edit that it may differ by
BLOCK_CHARS = 16 << 20  # characters of items that one automaton holds

# The white space of Unicode.
_BLANKS = {c: " " for c in (*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)}


def plain(text: str) -> str:
    """Lower case and blanks, one character for one."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.translate(_BLANKS)


def at_edges(text: str, start: int, stop: int) -> bool:
    """Whether a place neither begins nor ends inside a word; scripts written without blanks have no such edges."""
    letter = lambda c: c.isalnum() and c < "\u2e80"
    inside = lambda k: 0 < k < len(text) and letter(text[k - 1]) and letter(text[k])
    return not inside(start) and not inside(stop)


def cut(item: str, piece: int = PIECE) -> list[tuple[int, str]]:
    """Error budget plus one pieces of an item, as (offset, piece)."""
    n = len(item) // piece + 1
    ends = [len(item) * j // n for j in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:], strict=False) if a < b]


class Pattern:
    """An item prepared for Myers' recurrence."""

    def __init__(self, item: str):
        self.size, self.item = len(item), item
        self.masks: dict[str, int] = {}
        for i, c in enumerate(item):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str, budget: int) -> tuple[int, int] | None:
        """(least distance of the item to a part of ``text``, the first end of such a part), within the budget."""
        every, top, get = (1 << self.size) - 1, 1 << (self.size - 1), self.masks.get
        up, down, score, found = every, 0, self.size, None
        for at, c in enumerate(text):
            same = get(c, 0)
            diagonal = (((same & up) + up) ^ up) | same | down
            rise, fall = down | (~(diagonal | up) & every), up & diagonal
            if rise & top:
                score += 1
            elif fall & top:
                score -= 1
            if score <= budget:
                found, budget = (score, at + 1), score - 1
            rise, fall = (rise << 1) & every, (fall << 1) & every
            up, down = fall | (~((same | down) | rise) & every), rise & (same | down)
        return found


class Matcher:
    """All items of a block; ``matches`` yields (item_id, distance, start, stop), the best and first of each item."""

    def __init__(self, items: list[tuple[int, str]], piece: int = PIECE):
        import ahocorasick

        self.ids, self.patterns, self.backward, self.budgets = [], [], [], []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            low = plain(text).strip()
            for offset, part in cut(low, piece):
                places.setdefault(part, []).append((len(self.ids), offset))
            self.ids.append(item_id)
            self.patterns.append(Pattern(low))
            self.backward.append(Pattern(low[::-1]))
            self.budgets.append(len(low) // piece)
        self.automaton = ahocorasick.Automaton()
        for part, at in places.items():
            self.automaton.add_word(part, (len(part), at))
        self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        if not self.ids:
            return
        low = plain(text)
        windows: dict[int, list[list[int]]] = {}
        exact: dict[int, int] = {}
        for last, (size, places) in self.automaton.iter(low):
            for k, offset in places:
                first = last + 1 - size - offset
                slack = self.budgets[k]
                if not slack:
                    if k not in exact and at_edges(low, first, first + size):
                        exact[k] = first
                    continue
                windows.setdefault(k, []).append([max(0, first - slack), first + self.patterns[k].size + slack])
        for k, first in exact.items():
            yield self.ids[k], 0, first, first + self.patterns[k].size
        for k, found in windows.items():
            found.sort()
            merged = [found[0]]
            for a, b in found[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            best, budget = None, self.budgets[k]
            for a, b in merged:
                if hit := self.patterns[k].best(low[a:b], budget):
                    best, budget = (hit[0], a, a + hit[1]), hit[0] - 1
                    if budget < 0:
                        break
            if best:
                distance, a, stop = best
                back = self.backward[k].best(low[a:stop][::-1][: self.patterns[k].size + distance], distance)
                yield self.ids[k], distance, stop - back[1] if back else a, stop


_FOUND = "array<struct<item_id:long,distance:int,start:int,stop:int>>"


def _blocks_of(items: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``BLOCK_CHARS`` characters (or one longer item)."""
    own = items.select("item_id", F.col("text").cast("string").alias("text")).where(F.btrim("text") != "")
    n = int(own.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0) // BLOCK_CHARS + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for b in range(n):
        rows = own.where(block == b).collect()
        yield sorted((r.item_id, r.text) for r in rows)


def _finder(matcher_items: list[tuple[int, str]], piece: int):
    """A column function: the matches of a text as an array."""
    held: list[Matcher] = []

    @F.pandas_udf(_FOUND)
    def found(texts):
        import pandas as pd

        if not held:
            held.append(Matcher(matcher_items, piece))
        return pd.Series([list(held[0].matches(t)) if t else [] for t in texts])

    return found


def matched(docs: DataFrame, items: DataFrame, piece: int = PIECE) -> DataFrame:
    """(doc_id, item_id, distance, start, stop): each item that a document holds, with its best and first place."""
    bounded_batches(docs.sparkSession)
    whole, out = texts(docs, "doc_id"), None
    for block in _blocks_of(items):
        # Rebuilt in each Python worker from the items; the pieces of a block are bounded.
        hits = whole.withColumn("hit", F.explode(_finder(block, piece)("text"))).select("doc_id", "hit.*")
        out = hits if out is None else out.unionByName(hits)
    return out


def clean(docs: DataFrame, items: DataFrame, piece: int = PIECE) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their columns."""
    bounded_batches(docs.sparkSession)
    out = docs
    for block in _blocks_of(items):
        out = out.where(F.size(_finder(block, piece)(F.coalesce(F.col("text").cast("string"), F.lit("")))) == 0)
    return out
