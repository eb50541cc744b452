"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

Blocks are lines and, across line ends, windows of words.  A line meets a
template when it holds at least ``THRESHOLD`` percent of the template's distinct
words.  Words are ordered by how many
documents hold them, rarest first, counted over the whole table.  A block that
meets a template of n words must hold one of its n - k + 1 rarest (k words must
be shared): only those prefixes are indexed.  Length and position filters drop
candidates that cannot reach k before the sets meet.

A window is as long as a notice and a quarter, over the words of the whole text.
It meets the notice when it holds all of its key words (those that tell the
licence from others) and ``NOTICE_THRESHOLD`` percent of its distinct words, so
wrapped and slightly edited notices count.  The rarest key word is the prefix; a
text must hold enough of the notice's words before its windows are looked at.

The templates are a bounded parameter (a few notices); their words' frequencies
are the only corpus counts needed.  The index goes to the tasks, and every
document is scanned where it lies: no shuffle of texts.

Cases: a null or empty text has no words and no labels.  Rows are scanned one
by one, so repeated rows and repeated or null ids keep a row each.  Words of
equal frequency are ordered by their letters.
Building the frame runs Spark jobs and lowers the session's Arrow batch size.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blocks, bounded_batches, texts

# The phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Short notices by which works name their license, with labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Licensed under the BSD 3-Clause License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("reserved", "All rights reserved."),
)
THRESHOLD = 95  # percent of a template's words
# The key words of each template, in the order of TEMPLATES.
_KEYS = (
    "mit license", "permission granted associated files", "apache license", "gnu general public license", "general public license",
    "lesser general public license", "affero general public license", "cc by", "cc by sa", "cc by nc", "creative commons attribution",
    "creative commons attribution noncommercial", "redistribution source binary forms", "bsd license", "mozilla public license",
    "unencumbered public domain", "all rights reserved",
)
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software "
    "Foundation, either version {2} of the License, or (at your option) any later version. This {0} is distributed in the hope that it will be "
    "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
    "GNU {1} for more details. You should have received a copy of the GNU {1} along with this {0}. If not, see https://www.gnu.org/licenses/."
)
_AS_IS = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"
# Notices that may be wrapped and edited, with labels and key words: the templates and whole notices.
NOTICES = (*((label, text, keys) for (label, text), keys in zip(TEMPLATES, _KEYS, strict=True)), *(
    ("mit", TEMPLATES[1][1] + " (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
     "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to "
     "do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
     "substantial portions of the Software. " + _AS_IS + ". In no event shall the authors or copyright holders be liable for any claim, damages or "
     "other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or "
     "other dealings in the software.", "permission sublicense sell noninfringement"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may "
     "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
     "License for the specific language governing permissions and limitations under the License.", "apache license"),
    ("gpl", _GNU.format("program", "General Public License", "3"), "general public license"),
    ("lgpl", _GNU.format("library", "Lesser General Public License", "2.1"), "lesser general public license"),
    ("agpl", _GNU.format("program", "Affero General Public License", "3"), "affero general public license"),
    ("bsd", TEMPLATES[12][1] + " provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
     "this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of "
     "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "redistributions binary disclaimer"),
    ("mpl", TEMPLATES[14][1] + " If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "mozilla public license"),
    ("unlicense", TEMPLATES[15][1] + " Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
     "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", "unencumbered public domain"),
))
NOTICE_THRESHOLD = 80  # percent of a notice's words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower())


def places(words: list[str]) -> dict[str, list[int]]:
    """Where each phrase's words stand one after another."""
    found: dict[str, list[int]] = {p: [] for p in PHRASES}
    at = -1
    while True:
        try:
            at = words.index("license", at + 1)
        except ValueError:
            return found
        for phrase in PHRASES:
            parts = phrase.split()
            if at >= len(parts) - 1 and words[at - len(parts) + 1:at + 1] == parts:
                found[phrase].append(at - len(parts) + 1)


class Index:
    """Templates with their words in global order, by the words of their prefixes."""

    def __init__(self, templates, frequency: dict[str, int], threshold: int = THRESHOLD):
        order = {w: i for i, w in enumerate(sorted({w for _, t in templates for w in words_of(t)}, key=lambda w: (frequency.get(w, 0), w)))}
        self.order, self.templates, self.prefixes = order, [], {}
        for label, text in templates:
            ranks = sorted({order[w] for w in words_of(text)})
            need = -(-threshold * len(ranks) // 100)
            k = len(self.templates)
            self.templates.append((label, ranks, need))
            for at, rank in enumerate(ranks[: len(ranks) - need + 1]):
                self.prefixes.setdefault(rank, []).append((k, at))
        self.words = {w for w, i in order.items() if i in self.prefixes}

    def best(self, words: list[str]) -> dict[str, float]:
        """Label -> largest share of a template's words that the block holds, where it meets the threshold.

        A template whose shared words are part of another met template's says
        less about the block and gives way to it.
        """
        ranks = sorted({r for r in map(self.order.get, words) if r is not None})
        met: list[tuple[str, frozenset[int], float]] = []
        seen = set()
        for here, rank in enumerate(ranks):
            for k, at in self.prefixes.get(rank, ()):
                label, own, need = self.templates[k]
                # Length: the block has too few words left.  Position: too little follows this first shared word.
                if k in seen or len(ranks) < need or min(len(own) - at, len(ranks) - here) < need:
                    continue
                seen.add(k)
                shared = frozenset(r for r in own if (j := bisect_left(ranks, r)) < len(ranks) and ranks[j] == r)
                if len(shared) >= need:
                    met.append((label, shared, len(shared) / len(own)))
        found: dict[str, float] = {}
        for label, shared, share in met:
            if not any(shared < other for _, other, _ in met):
                found[label] = max(found.get(label, 0.0), share)
        return found


def window_words(text: str) -> int:
    """Words of a window for a notice: the notice's, and a quarter or three more."""
    n = len(words_of(text))
    return n + max(3, n // 4)


class Notices:
    """Notices by their rarest key word."""

    def __init__(self, notices, frequency: dict[str, int], threshold: int = NOTICE_THRESHOLD):
        self.by_key: dict[str, list[tuple[str, frozenset[str], frozenset[str], int, int]]] = {}
        for label, text, keys in notices:
            own, keys = frozenset(words_of(text)), frozenset(words_of(keys))
            rarest = min(keys, key=lambda w: (frequency.get(w, 0), w))
            self.by_key.setdefault(rarest, []).append((label, own, keys, -(-threshold * len(own) // 100), window_words(text)))
        self.keys = frozenset(self.by_key)

    def best(self, words: list[str]) -> dict[str, float]:
        """Label -> largest share of a notice's words that a window of the text holds, where it meets the threshold.

        A window gives way to one of another notice that covers its words and shares more.
        """
        there = set(words)
        met = []
        for rarest in self.keys & there:
            for label, own, keys, need, length in self.by_key[rarest]:
                if keys <= there and len(own & there) >= need:
                    if found := self._windows(words, own, keys, need, length):
                        met.append((label, len(own), length, [a for a, _, _ in found], found))
        shares: dict[str, float] = {}
        for k, (label, n, _, _, found) in enumerate(met):
            for start, stop, shared in found:
                share = len(shared) / n
                if share > shares.get(label, 0.0) and not any(
                    any(stop <= stop_o and shared < shared_o for _, stop_o, shared_o in found_o[bisect_left(starts, stop - length):bisect_right(starts, start)])
                    for j, (_, _, length, starts, found_o) in enumerate(met) if j != k
                ):
                    shares[label] = share
        return shares

    @staticmethod
    def _windows(words, own, keys, need, length) -> list[tuple[int, int, frozenset[str]]]:
        """(start, stop, shared words) of the met windows that start at a word of the notice, cut behind their last.

        Windows that share the same words hold one set between them.
        """
        at = [i for i, w in enumerate(words) if w in own]
        held: dict[str, int] = {}
        sets: dict[frozenset[str], frozenset[str]] = {}
        out, stop = [], 0
        for k, start in enumerate(at):
            while stop < len(at) and at[stop] < start + length:
                held[words[at[stop]]] = held.get(words[at[stop]], 0) + 1
                stop += 1
            if len(held) >= need and held.keys() >= keys:
                shared = frozenset(held)
                out.append((start, at[stop - 1] + 1, sets.setdefault(shared, shared)))
            held[words[start]] -= 1
            if not held[words[start]]:
                del held[words[start]]
        return out


def _frequencies(vocabulary: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = dict.fromkeys(vocabulary, 0)
        for table in blocks(batches):
            for text in table["text"].to_pylist():
                for w in vocabulary.intersection(words_of(text)):
                    counts[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return run


def frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """In how many documents each template word stands; as many numbers as the templates have words."""
    vocabulary = frozenset(w for _, t in templates for w in words_of(t))
    bounded_batches(docs.sparkSession)
    counts = texts(docs).mapInArrow(_frequencies(vocabulary), "word string, n long")
    return {r.word: r.n for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


_OUT = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan(index: Index, notices: Notices):
    longs, words = pa.int64(), pa.string()
    types = (longs, longs, longs, longs, longs, words, words, pa.float64())
    names = [c.split()[0] for c in _OUT.split(", ")]

    def one(text: str):
        every = words_of(text)
        found = places(every)
        starts = [at for p in found.values() for at in p]
        base = {PHRASES[p] for p, at in found.items() if at}
        shares: dict[str, float] = {}
        if not index.words.isdisjoint(every):
            for line in text.split("\n"):
                for label, share in index.best(words_of(line)).items():
                    shares[label] = max(shares.get(label, 0.0), share)
        if not notices.keys.isdisjoint(every):
            for label, share in notices.best(every).items():
                shares[label] = max(shares.get(label, 0.0), share)
        score = 1.0 if base else max(shares.values(), default=0.0)
        return (
            len(every), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | shares.keys())), score,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            rows = [(d, *one(t)) for d, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def scanned(docs: DataFrame, templates=TEMPLATES, threshold: int = THRESHOLD, notices=NOTICES) -> DataFrame:
    """Base phrases, labels and the best containment of every row of ``docs``."""
    frequency = frequencies(docs, [*templates, *((label, text) for label, text, _ in notices)])
    return texts(docs, "doc_id").mapInArrow(_scan(Index(templates, frequency, threshold), Notices(notices, frequency)), _OUT)
