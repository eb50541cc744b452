"""Word-sequence alignment by longest common blocks.

The longest common block of two sequences (of several the first in a, then the
first in b) splits both; the parts before and after it are aligned the same way.
The matched words of all blocks give the likeness, the gaps the differing spans.

Tokens are integer codes.  Two runs of any length are compared by one number, a
rolling hash, and a part's longest block is found by bisecting its length upwards
from a block that is there: the longest one on the diagonal that most words of the
part share.  Equal word pairs are never listed.

Equal runs have equal hashes, so no block is missed; a block that is taken is
compared word by word.  Where a hash was equal by chance, the texts are aligned
anew by exact numbers: every run of 1, 2, 4, ... words gets one, equal for equal
runs only, and two of them tell a run of any length.

Once the greatest length n in a part is known, all its blocks of n words are taken
in one walk: after a block, the rest of the part behind it has the next one, and
what lies before it has shorter blocks only.  So a part is searched again for
shorter lengths alone, and dissimilar texts do not lead to a search per word.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import chain

import numpy as np


def coded(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Both token lists as integers of one numbering."""
    number = {token: k for k, token in enumerate(dict.fromkeys(chain(a, b)))}
    code = lambda tokens: np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))
    return code(a), code(b)


class Chance(Exception):
    """Two different runs have one hash."""


class Hashes:
    """Hashes of the runs of a text, modulo 2^64: equal runs of a length have equal hashes."""

    _BASE = 0x9E3779B97F4A7C15
    _tables = (np.zeros(0, np.uint64),) * 3  # of words, powers of the base and of its inverse; they grow with the longest text

    def __init__(self, words: np.ndarray):
        least = max(len(words), int(words.max(initial=-1)) + 1)
        if len(Hashes._tables[0]) < least:
            size = 1 << least.bit_length()
            powers = lambda base: np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, base, np.uint64))), dtype=np.uint64)
            of_words = np.random.default_rng(1).integers(0, 1 << 64, size, np.uint64)
            Hashes._tables = (of_words, powers(Hashes._BASE), powers(pow(Hashes._BASE, -1, 1 << 64)))
        of_words, powers, self.inverse = Hashes._tables
        self.words, self.kinds = words, int(words.max(initial=-1)) + 1
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(of_words[words] * powers[: len(words)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: int, end: int, length: int) -> np.ndarray:
        """Hashes of the runs of ``length`` words that lie in start:end."""
        stop = max(end - length + 1, start)
        return (self.sums[start + length : stop + length] - self.sums[start:stop]) * self.inverse[start:stop]

    def check(self, x: int, y: int, length: int) -> None:
        """The runs at x and y are equal."""
        if not np.array_equal(self.words[x : x + length], self.words[y : y + length]):
            raise Chance


class Runs:
    """Numbers of the runs of a text: equal runs of a length have equal numbers."""

    def __init__(self, words: np.ndarray):
        self.words, self.kinds = words, int(words.max(initial=-1)) + 1
        self.levels = [words]  # of runs of 1, 2, 4, ... words
        self.bounds = [int(words.max(initial=0)) + 1]

    def _level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            pairs = last[:-half] * self.bounds[-1] + last[half:]
            numbers = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
            self.levels.append(numbers)
            self.bounds.append(int(numbers.max(initial=0)) + 1)
        return self.levels[k]

    def of(self, start: int, end: int, length: int) -> np.ndarray:
        """Numbers of the runs of ``length`` words that lie in start:end."""
        k = length.bit_length() - 1
        level, step, stop = self._level(k), length - (1 << k), end - length + 1
        if not step:
            return level[start:stop]
        return level[start:stop] * self.bounds[k] + level[start + step : stop + step]

    def check(self, x: int, y: int, length: int) -> None:
        """Equal numbers are of equal runs."""


def _beside(runs: Hashes | Runs, border: int, part: tuple[int, int, int, int]) -> int:
    """Words of the longest block on the diagonal that most words of a part vote for: no longer than the part's longest block."""
    a0, a1, b0, b1 = part
    left, right = runs.words[a0:a1], runs.words[border + b0 : border + b1]
    place = np.full(runs.kinds, -1)
    place[right] = np.arange(b1 - b0)
    there = place[left]
    found = (there >= 0).nonzero()[0]
    if not len(found):
        return 0
    shift = int(np.bincount(there[found] - found + len(left)).argmax()) - len(left)
    x, y = max(0, -shift), max(0, shift)
    n = min(len(left) - x, len(right) - y)
    breaks = (left[x : x + n] != right[y : y + n]).nonzero()[0]
    if not len(breaks):
        return n
    between = int((breaks[1:] - breaks[:-1]).max(initial=1)) - 1
    return max(between, int(breaks[0]), n - 1 - int(breaks[-1]))


def _length(runs: Hashes | Runs, border: int, part: tuple[int, int, int, int], most: int) -> int:
    """Length of the longest common block of a part, at most ``most``."""
    a0, a1, b0, b1 = part

    def common(length: int) -> bool:
        left, right = runs.of(a0, a1, length), np.sort(runs.of(border + b0, border + b1, length))
        at = np.searchsorted(right, left)
        at[at == len(right)] = 0
        return bool((right[at] == left).any())

    most = min(most, a1 - a0, b1 - b0)
    low, step = min(most, _beside(runs, border, part)), 1  # low words are common
    while low + step <= most and common(low + step):
        low, step = low + step, 2 * step
    high = min(low + step, most + 1)  # high is not, or out of reach
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if common(middle) else (low, middle)
    return low


def _walk(runs: Hashes | Runs, border: int, part: tuple[int, int, int, int], length: int) -> list[tuple[int, int]]:
    """Starts of the blocks of a part's greatest length: the first in a, then in b, then on behind both."""
    a0, a1, b0, b1 = part
    left, right = runs.of(a0, a1, length), runs.of(border + b0, border + b1, length)
    order = np.argsort(right, kind="stable")
    ranked = right[order]
    low = np.searchsorted(ranked, left)
    met = (ranked[np.minimum(low, len(ranked) - 1)] == left).nonzero()[0]
    high = np.searchsorted(ranked, left[met], "right")
    places, out, i, j = order.tolist(), [], 0, 0
    for at, least, most in zip(met.tolist(), low[met].tolist(), high.tolist()):
        if at < i:
            continue
        first = bisect_left(places, j, least, most)
        if first < most:
            runs.check(a0 + at, border + b0 + places[first], length)
            out.append((a0 + at, b0 + places[first]))
            i, j = at + length, places[first] + length
    return out


def matching_blocks(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """Blocks (start in a, start in b, length) in text order, touching ones joined."""
    words = np.concatenate((a, b))
    try:
        return _blocks(Hashes(words), len(a), len(b))
    except Chance:
        return _blocks(Runs(words), len(a), len(b))


def _blocks(runs: Hashes | Runs, border: int, size: int) -> list[tuple[int, int, int]]:
    found = []
    todo = [((0, border, 0, size), min(border, size))]
    while todo:
        part, most = todo.pop()
        if not most or part[0] == part[1] or part[2] == part[3]:
            continue
        length = _length(runs, border, part, most)
        if not length:
            continue
        i, j = part[0], part[2]
        for x, y in _walk(runs, border, part, length):
            found.append((x, y, length))
            todo.append(((i, x, j, y), length - 1))
            i, j = x + length, y + length
        todo.append(((i, part[1], j, part[3]), length - 1))
    joined: list[tuple[int, int, int]] = []
    for i, j, n in sorted(found):
        if joined and joined[-1][0] + joined[-1][2] == i and joined[-1][1] + joined[-1][2] == j:
            i, j, n = joined[-1][0], joined[-1][1], joined.pop()[2] + n
        joined.append((i, j, n))
    return joined


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Words that both have, each as often as the one that has it less often."""
    x, y = np.bincount(a), np.bincount(b)
    n = min(len(x), len(y))
    return int(np.minimum(x[:n], y[:n]).sum())


def likeness(a: list[str], b: list[str]) -> float:
    """2 * matched / (len(a) + len(b)); two empty lists are alike."""
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    return coded_likeness(*coded(a, b))


def coded_likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 2.0 * sum(n for _, _, n in matching_blocks(a, b)) / (len(a) + len(b))


def gaps(a: list[str], b: list[str]) -> list[tuple[str, int, int, int, int]]:
    """What differs, in text order: (replace, delete or insert, span of a, span of b)."""
    out, i, j = [], 0, 0
    for x, y, n in [*matching_blocks(*coded(a, b)), (len(a), len(b), 0)]:
        if i < x or j < y:
            out.append(("insert" if i == x else "delete" if j == y else "replace", i, x, j, y))
        i, j = x + n, y + n
    return out
