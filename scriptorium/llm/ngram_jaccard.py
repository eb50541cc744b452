"""N-gram Jaccard join: exact near-duplicate classes with signature trees.

Two documents link when the Jaccard similarity of their word n-gram sets
reaches ``percent``.  Every document gets the smallest id that links reach.

1. One pass hashes each document's set.  Sets that may link differ in at most
   D elements, so of more than D parts of the hash range one is equal in both:
   each non-empty part of a set is a cell key.  Classes of sizes fix the number
   of parts, and a set also enters the larger classes that its partners may be
   in.  Keys travel packed, grouped by block and hash bucket; equal keys inside
   a block leave it once.
2. The pairs of a cell's members are tested where they meet the sets' sketches:
   each element flips one bit, so sketches of linked sets differ in no more bits
   than the sets in elements.  No link is lost and few other pairs are left.  A
   cell of over ``PAIRED`` members is too large for all pairs; its members point
   to its smallest id untested.  Families are the components of what is left.
   Equal sets are one representative, so copies are never compared.
3. A family's sets meet in signature trees: nodes hold the OR of token bitmaps
   and the range of set sizes.  The dual traversal drops a pair of nodes whose
   greatest possible overlap cannot reach the threshold, and pairs that are
   linked already; what is left is verified exactly.
4. A family over ``CHUNK`` shingles is cut: every chunk with a few pivots.  Only
   the sets outside the family's main class then meet all chunks: first by
   signatures alone, which tell what may link with what, then those exactly.  No
   task holds an unbounded family and no pairs are listed.

Cases: a null or empty text has an empty set, links with nothing and is its own
class (a null id has a null class).  Fewer words than n make one shingle.  Rows
with equal ids are one document: their classes merge, each keeps its row.
Building the frame runs Spark jobs and lowers the session's Arrow batch size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import blocks, bounded_batches, sent, texts, total_bytes, with_least, written
from .components import components, forest

CELL_BYTES = 4 << 20  # text bytes for each bucket of cells
CELL_BLOCK = 2 << 20  # text bytes whose cells or signatures are made at a time
PAIR_BUCKETS = 16  # buckets of cells for each bucket of pairs
PAIRED = 32  # members of a cell whose pairs are all tested
MOST_BITS = 1 << 17  # of a sketch; there are as many as elements below that
CHUNK = 1 << 17  # shingles of one side of a comparison task
TASK = 1 << 18  # shingles of small families that share a task
SIGNATURE = 1 << 13  # bits of the signatures that split a large family
SIGNED_CHUNK = 4096  # documents of one side of a comparison of signatures
PIVOTS = 8
BROADCAST_ROWS = 500_000  # ids that may be sent to every task; more are joined by a shuffle
GONE_BYTES = 16  # of a dropped id that is sent to every task
GROWTH = 1.2  # of the size classes
SAMPLE_DOCS = 8000  # documents that tell which shingles are frequent
FREQUENT = 8  # of them
MOST_FREQUENT = 200_000  # shingles; more of them would only save comparisons
KNOWN_WORDS = 1 << 17
LEAF, FANOUT = 16, 8

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _C2
    h = (h ^ (h >> np.uint64(29))) * _C3
    return h ^ (h >> np.uint64(32))


@dataclass(frozen=True)
class Link:
    """When two sets link."""

    words: int = 4
    percent: int = 85

    def differs(self, size: int) -> int:
        """Most elements in which two sets of at most ``size`` may differ."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    def holds(self, shared: int, a: int, b: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)


class Shingles:
    """Sorted distinct 64-bit hashes of the word n-grams of texts given as bytes."""

    def __init__(self, words: int):
        self.words, self._known, self._table = words, {}, np.zeros(1 << 12, np.uint64)

    def of(self, docs: list[bytes]) -> list[np.ndarray]:
        if len(self._known) > KNOWN_WORDS:
            self._known.clear()
        known, numbers, sizes = self._known, [], []
        for text in docs:
            words = text.split()  # bytes split at exactly the six ASCII white spaces
            sizes.append(len(words))
            for w in words:
                k = known.get(w)
                if k is None:
                    k = known[w] = len(known)
                    if k >= len(self._table):
                        self._table = np.concatenate((self._table, np.zeros_like(self._table)))
                    self._table[k] = xxhash.xxh64_intdigest(w.translate(_LOWER))
                numbers.append(k)
        h = self._table[np.asarray(numbers, np.int64)]
        n, gram = self.words, h
        if len(h) >= n:
            gram = h[: len(h) - n + 1].copy()
            for k in range(1, n):
                gram = gram * _C1 + h[k : len(h) - n + 1 + k]
            gram = _mix(gram)
        out, at = [], 0
        for size in sizes:
            if size >= n:
                out.append(np.unique(gram[at : at + size - n + 1]))
            elif size:
                whole = np.uint64(size)
                with np.errstate(over="ignore"):
                    for x in h[at : at + size]:
                        whole = whole * _C1 + x
                out.append(_mix(np.asarray([whole], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
            at += size
        return out


def _classes(link: Link, largest: int) -> list[tuple[int, int, int, int]]:
    """(lowest size, highest size, most differing elements, parts) of each size class."""
    out, low = [], 1
    while low <= largest:
        high = max(low, int(low * GROWTH) - 1)
        d = link.differs(high)
        out.append((low, high, d, d + 1 + -(-d // 6)))
        low = high + 1
    return out


def _parts(s: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, size, digest) of the non-empty parts of a sorted set: ranges of the hash, one after another."""
    part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    return part[first], np.diff(first, append=len(s)), np.add.reduceat(_mix(s ^ _C1), first)


def cell_keys(s: np.ndarray, link: Link, classes: list[tuple[int, int, int, int]], frequent: np.ndarray) -> np.ndarray:
    """Keys of a set: sets that link share one at least.

    At most d parts of two such sets differ.  If one of them has more than d
    parts of m elements or more, one of these is equal in the other; so each set
    may drop the parts under its own largest m of that kind.
    """
    out = []
    rare = s[~np.isin(s, frequent, assume_unique=True)] if len(frequent) else s
    for number, (low, high, d, parts) in enumerate(classes):
        if high < len(s):
            continue
        if low > len(s) and low * link.percent > 100 * len(s):
            break
        for mode, elements in enumerate((rare, s)):
            own = size = digest = np.zeros(0, np.uint64)
            if len(elements):
                own, size, digest = _parts(elements, parts)
            enough = len(own) > d
            if enough:
                large = size >= np.partition(size, len(size) - d - 1)[len(size) - d - 1]
                own, digest = own[large], digest[large]
            elif mode == 1:  # no pigeonhole without the empty parts
                empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), own)
                own, digest = np.concatenate((own, empty)), np.concatenate((digest, np.zeros(len(empty), np.uint64)))
            out.append(_mix(digest + _mix(own * _C3 + np.uint64(2 * number + mode + 1))))
            if enough:
                break
    return np.concatenate(out)


def _common(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for table in blocks(batches):
            found, count = np.unique(np.concatenate(shingles.of(table["text"].cast(pa.binary()).to_pylist())), return_counts=True)
            kept = count > 1
            yield pa.RecordBatch.from_arrays([pa.array(found[kept].view(np.int64)), pa.array(count[kept].astype(np.int64))], names=["shingle", "n"])

    return run


def frequent_shingles(whole: DataFrame, words: int) -> np.ndarray:
    """Shingles that ``FREQUENT`` documents of a sample hold, sorted; a bounded list that no result depends on."""
    every = whole.count() // SAMPLE_DOCS + 1
    sample = whole.where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(every)) == 0).select("text")
    counts = sample.mapInArrow(_common(words), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).collect()
    return np.sort(np.asarray([r.shingle for r in rows], np.int64).view(np.uint64))


def sketch_of(s: np.ndarray) -> bytes:
    """Bits that say of each slot whether an odd number of a set's elements falls into it.

    Longer sketches fold to shorter ones.  Sketches of two sets differ in at most
    as many bits as the sets in elements.
    """
    bits = min(MOST_BITS, max(64, 1 << (len(s) - 1).bit_length()))
    slot = (_mix(s ^ _C3) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


_ROWS = "kind int, bucket int, doc_id long, n long, s1 long, s2 long, sketch binary, keys binary, ids binary"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]
_TYPES = [pa.int32(), pa.int32(), *[pa.int64()] * 4, *[pa.binary()] * 3]
_DOC, _CELLS = 0, 1


def _batch(columns: dict, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in zip(_NAMES, _TYPES, strict=True)], names=_NAMES)


def _cells(link: Link, buckets: int, common: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, frequent = Shingles(link.words), np.frombuffer(common, np.uint64)
        for table in blocks(batches, limit=CELL_BLOCK):
            docs = table["text"].cast(pa.binary()).to_pylist()
            ids = table["doc_id"].to_pylist()
            sets = shingles.of(docs)
            classes = _classes(link, int(max(map(len, sets)) * 100 / link.percent) + 1)
            with np.errstate(over="ignore"):
                sums = np.asarray([(_mix(s ^ _C2).sum(dtype=np.uint64), _mix(s ^ _C3).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)
            sizes = [len(s) for s in sets]
            yield _batch({
                "kind": [_DOC] * len(ids), "doc_id": ids, "n": sizes, "s1": sums[:, 0], "s2": sums[:, 1],
                "sketch": [sketch_of(s) if len(s) else None for s in sets],
            }, len(ids))
            # Equal sets of a block send their cells once: copies meet by their sums.
            first: dict[tuple, int] = {}
            for k, i in enumerate(ids):
                if i is not None and sizes[k]:
                    first.setdefault((sizes[k], *sums[k].tolist()), k)
            if not first:
                continue
            sent = list(first.values())
            with np.errstate(over="ignore"):
                keyed = [cell_keys(sets[k], link, classes, frequent) for k in sent]
            keys = np.concatenate(keyed)
            own = np.repeat(np.asarray([ids[k] for k in sent], np.int64), [len(k) for k in keyed])
            order = np.argsort(keys, kind="stable")
            keys, own = keys[order], own[order]
            # The upper bits choose the bucket; 40 others tell keys of a bucket apart (a chance hit is only a candidate).
            bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            starts = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
            short = np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
            full = [k for k in range(buckets) if starts[k] < starts[k + 1]]
            yield _batch({
                "kind": [_CELLS] * len(full), "bucket": full,
                "keys": [short[starts[k]:starts[k + 1]].tobytes() for k in full],
                "ids": [own[starts[k]:starts[k + 1]].astype("<i8").tobytes() for k in full],
            }, len(full))

    return run


_MET = "dest int, pairs binary, stars binary"


def _meet(dests: int):
    """One bucket of cells: the pairs of members of small cells, and members of large ones with the least, packed by ``dest``."""

    def run(table: pa.Table) -> pa.Table:
        short = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint8).reshape(-1, 5)
        keys = np.zeros((len(short), 8), np.uint8)
        keys[:, :5] = short
        keys = keys.view("<u8").ravel()
        ids = np.frombuffer(b"".join(table["ids"].to_pylist()), "<i8")
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        once = np.concatenate(([True], (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))) if len(keys) else np.zeros(0, bool)
        keys, ids = keys[once], ids[once]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        count = np.diff(first, append=len(keys))
        pairs = [np.zeros((0, 2), np.int64)]
        for m in range(2, PAIRED + 1):
            members = ids[first[count == m][:, None] + np.arange(m)]
            low, high = np.triu_indices(m, 1)
            pairs.append(np.unique(np.stack((members[:, low].ravel(), members[:, high].ravel()), 1), axis=0))
        pairs = np.unique(np.concatenate(pairs), axis=0)
        large = np.repeat(count > PAIRED, count)
        stars = np.stack((ids[large], np.repeat(ids[first], count)[large]), 1)
        stars = np.unique(stars[stars[:, 0] != stars[:, 1]], axis=0)
        out = {}
        for kind, rows in (("pairs", pairs), ("stars", stars)):
            dest = (_mix(rows[:, 0].astype(np.uint64)) % np.uint64(dests)).astype(np.int64)
            order = np.argsort(dest, kind="stable")
            at = np.searchsorted(dest[order], np.arange(dests + 1))
            out[kind] = [rows[order[x:y]].astype("<i8").tobytes() for x, y in zip(at, at[1:], strict=False)]
        full = [k for k in range(dests) if out["pairs"][k] or out["stars"][k]]
        return pa.table({"dest": pa.array(full, pa.int32()), **{c: pa.array([out[c][k] for k in full], pa.binary()) for c in ("pairs", "stars")}})

    return run


def _gathered(table: pa.Table) -> pa.Table:
    """All that buckets sent to one place: distinct pairs to test, and a spanning forest of the untested edges."""
    pairs, stars = (np.frombuffer(b"".join(table[c].to_pylist()), "<i8").reshape(-1, 2) for c in ("pairs", "stars"))
    pairs = np.unique(pairs, axis=0)
    a, b = forest(stars[:, 0], stars[:, 1])
    return pa.table({
        "a": pa.array(np.concatenate((pairs[:, 0], a)), pa.int64()), "b": pa.array(np.concatenate((pairs[:, 1], b)), pa.int64()),
        "test": pa.array(np.arange(len(pairs) + len(a)) < len(pairs)),
    })


def _fit(link: Link):
    """Pairs with sizes and sketches to those that may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = np.asarray(batch.column("m")), np.asarray(batch.column("n"))
            most = (m + n) * (100 - link.percent) // (100 + link.percent)
            fits = np.abs(m - n) <= most
            x, y = batch.column("x"), batch.column("y")
            widths = np.minimum(*(np.asarray(pc.binary_length(c)) for c in (x, y)))
            for width in np.unique(widths[fits]):
                some = np.flatnonzero(fits & (widths == width))
                for at in range(0, len(some), 4096):
                    part = some[at : at + 4096]
                    bits = np.stack([_folded(c, part, int(width)) for c in (x, y)])
                    fits[part] = np.bitwise_count(bits[0] ^ bits[1]).sum(1) <= most[part]
            kept = pa.array(fits)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"])

    return run


def _folded(sketches: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to ``width`` bytes."""
    out = np.zeros((len(rows), width // 8), np.uint64)
    for k, value in enumerate(sketches.take(pa.array(rows)).to_pylist()):
        out[k] = np.bitwise_xor.reduce(np.frombuffer(value, np.uint64).reshape(-1, width // 8), axis=0)
    return out


class Forest:
    """Union-find over positions."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


class Tree:
    """Signature tree over some of the sets: OR-combined bitmaps, size ranges and most collisions, level by level."""

    def __init__(self, at: np.ndarray, size: np.ndarray, lead: np.ndarray, maps: np.ndarray):
        """``at`` chooses rows; ``lead`` is each set's least hash, which similar sets often share."""
        self.at = at[np.lexsort((size[at], lead[at]))]
        size, bits = size[self.at], maps[self.at]
        lost = size - np.bitwise_count(bits).sum(1)
        self.levels = [(bits, size, size, lost)]
        step = LEAF
        while len(self.levels[-1][0]) > 1:
            bits, low, high, lost = self.levels[-1]
            first = np.arange(0, len(bits), step)
            self.levels.append((
                np.bitwise_or.reduceat(bits, first), np.minimum.reduceat(low, first),
                np.maximum.reduceat(high, first), np.maximum.reduceat(lost, first),
            ))
            step = FANOUT

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(parent's position in ``node``, child) of the nodes of a level."""
        step = LEAF if level == 1 else FANOUT
        child = (node[:, None] * step + np.arange(step)).ravel()
        parent = np.repeat(np.arange(len(node)), step)
        real = child < len(self.levels[level - 1][0])
        return parent[real], child[real]


def _mark(bitmap: np.ndarray, s: np.ndarray, width: int) -> None:
    bit = s & np.uint64(width - 1)
    np.bitwise_or.at(bitmap, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))


def _possible(link: Link, a, b, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether nodes ``i`` of level ``a`` and ``j`` of level ``b`` may hold a link."""
    overlap = np.bitwise_count(a[0][i] & b[0][j]).sum(1) + np.minimum(a[3][i], b[3][j])
    fits = (100 * a[2][i] >= link.percent * b[1][j]) & (100 * b[2][j] >= link.percent * a[1][i])
    return fits & ((100 + link.percent) * np.minimum(overlap, np.minimum(a[2][i], b[2][j])) >= link.percent * (a[1][i] + b[1][j]))


def _candidates(link: Link, x: Tree, y: Tree, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of set positions that survive the dual traversal, in slices."""
    stack = [(len(x.levels) - 1, len(y.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        p, q, i, j = stack.pop()
        if len(i) > 256:
            stack.append((p, q, i[256:], j[256:]))
            i, j = i[:256], j[:256]
        ok = _possible(link, x.levels[p], y.levels[q], i, j)
        if same and p == q:
            ok &= i <= j
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        if p == q == 0:
            apart = i != j if same else np.ones(len(i), bool)
            yield x.at[i[apart]], y.at[j[apart]]
            continue
        if p >= q:
            parent, child = x.children(p, i)
            p, i, j = p - 1, child, j[parent]
        if q > p:
            parent, child = y.children(q, j)
            q, i, j = q - 1, i[parent], child
        stack.append((p, q, i, j))


def linked(link: Link, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, forest: Forest) -> None:
    """Join in ``forest`` all that links among ``left``, or between ``left`` and ``right``."""
    every = left if right is None else np.concatenate((left, right))
    if len(left) == 0 or len(every) < 2:
        return
    width = 1 << max(6, int(max(len(sets[i]) for i in every) * 4 - 1).bit_length())
    width = min(width, 1 << 15)
    maps = np.zeros((len(sets), width // 64), np.uint64)
    for i in every:
        _mark(maps[i], sets[i], width)
    size = np.asarray([len(s) for s in sets])
    lead = np.asarray([s[0] if len(s) else 0 for s in sets], np.uint64)
    x = Tree(left, size, lead, maps)
    y = x if right is None else Tree(right, size, lead, maps)
    held: dict[int, set[int]] = {}

    def own(i: int) -> set[int]:
        if i not in held:
            held[i] = set(sets[i].tolist())
        return held[i]

    for a, b in _candidates(link, x, y, right is None):
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            if forest.find(i) != forest.find(j) and link.holds(len(own(i) & own(j)), len(sets[i]), len(sets[j])):
                forest.join(i, j)


def _compare(link: Link):
    """One task: rows (unit, side, doc_id, root, text) to edges of the sets that link.

    Sides: 0 compares with all of its unit, 1 only with side 2 of its unit.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["unit", "side", "doc_id", "root"]).to_pylist()
        sets = Shingles(link.words).of(table["text"].cast(pa.binary()).to_pylist())
        forest = Forest(len(rows))
        units: dict[int, list[list[int]]] = {}
        for k, row in enumerate(rows):
            if len(sets[k]):
                units.setdefault(row["unit"], [[], [], []])[row["side"]].append(k)
        seen: dict[tuple[int, int], int] = {}
        for k, row in enumerate(rows):  # what earlier rounds linked
            if row["root"] is not None:
                forest.join(k, seen.setdefault((row["unit"], row["root"]), k))
        for both, low, high in units.values():
            if both:
                linked(link, sets, np.asarray(both), None, forest)
            if low and high:
                linked(link, sets, np.asarray(low), np.asarray(high), forest)
        edges = {(rows[k]["doc_id"], rows[forest.find(k)]["doc_id"]) for k in range(len(rows)) if forest.find(k) != k}
        return pa.table({"a": pa.array([a for a, _ in edges], pa.int64()), "b": pa.array([b for _, b in edges], pa.int64())})

    return run


_SIGNED = "doc_id long, family long, chunks int, parts int, n int, lead long, bitmap binary"


def _signatures(words: int):
    """Members of families to signatures of a set width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for table in blocks(batches, limit=CELL_BLOCK):
            sets = shingles.of(table["text"].cast(pa.binary()).to_pylist())
            maps = np.zeros((len(sets), SIGNATURE // 64), np.uint64)
            for bitmap, own in zip(maps, sets, strict=True):
                _mark(bitmap, own, SIGNATURE)
            lead = np.asarray([own[0] if len(own) else 0 for own in sets], np.uint64).view(np.int64)
            out = table.select(["doc_id", "family", "chunks", "parts"]).append_column("n", pa.array([len(own) for own in sets], pa.int32()))
            out = out.append_column("lead", pa.array(lead)).append_column("bitmap", pa.array([m.tobytes() for m in maps], pa.binary()))
            yield from out.to_batches(max_chunksize=4096)

    return run


def _may_link(link: Link):
    """One pair of chunks of a family: a spanning forest of the pairs whose signatures allow a link."""

    def run(table: pa.Table) -> pa.Table:
        ids, size = np.asarray(table["doc_id"]), np.asarray(table["n"]).astype(np.int64)
        lead = np.asarray(table["lead"]).view(np.uint64)
        maps = np.frombuffer(b"".join(table["bitmap"].to_pylist()), np.uint64).reshape(len(ids), -1)
        side, forest = np.asarray(table["side"]), Forest(len(ids))
        low, high = np.flatnonzero((side == 0) & (size > 0)), np.flatnonzero((side == 1) & (size > 0))
        if len(low) and (len(high) or not side.any()):
            x = Tree(low, size, lead, maps)
            y = Tree(high, size, lead, maps) if len(high) else x
            for a, b in _candidates(link, x, y, x is y):
                for i, j in zip(a.tolist(), b.tolist(), strict=True):
                    if forest.find(i) != forest.find(j):
                        forest.join(i, j)
        up = np.asarray([forest.find(k) for k in range(len(ids))])
        own = np.flatnonzero(up != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[own], pa.int64()), "b": pa.array(ids[up[own]], pa.int64())})

    return run


def _grouped(docs: DataFrame, state: DataFrame, rest: DataFrame, link: Link) -> DataFrame:
    """(doc_id, family, n, root) of what may link with a set of ``rest``, the families now groups of such sets.

    Sets that link always allow it by their signatures, so they stay together; a
    set that nothing outside its class may link with leaves.  Only ``rest`` meets
    all chunks of its family.
    """
    share = lambda df, name: df.groupBy("family").agg(F.ceil(F.count("*") / SIGNED_CHUNK).cast("int").alias(name))
    open_ = state.join(share(state, "chunks").join(share(rest, "parts"), "family"), "family")
    names = open_.select("doc_id", "family", "chunks", "parts")
    signed = _with_texts(docs, names).select("doc_id", "family", "text", "chunks", "parts").mapInArrow(_signatures(link.words), _SIGNED)
    signed = written(signed, "jaccard-signatures")
    spot = lambda seed, of: F.pmod(F.xxhash64("doc_id", F.lit(seed)), of).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    low = signed.withColumns({"chunk": spot(3, "chunks"), "part": every("parts"), "side": F.lit(0)})
    high = signed.join(rest.select("doc_id", "family"), ["doc_id", "family"]).withColumns({"chunk": every("chunks"), "part": spot(4, "parts"), "side": F.lit(1)})
    columns = [F.xxhash64("family", "chunk", "part").alias("task"), "doc_id", "n", "lead", "bitmap", "side"]
    edges = low.select(*columns).unionByName(high.select(*columns)).groupBy("task").applyInArrow(_may_link(link), "a long, b long")
    groups = components(edges, "jaccard-groups", state.count()).select(F.col("id").alias("doc_id"), F.col("root").alias("family"))
    return groups.join(state.select("doc_id", "n", "root"), "doc_id")


def _with_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``members`` (doc_id, ...) with their texts."""
    few = members.count() <= BROADCAST_ROWS
    return texts(docs, "doc_id").join(F.broadcast(members) if few else members, "doc_id")


def classes_of(docs: DataFrame, link: Link = Link()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    whole = texts(docs, "doc_id")
    buckets = total_bytes(whole) // CELL_BYTES + 8
    common = frequent_shingles(whole, link.words).tobytes()
    rows = written(whole.mapInArrow(_cells(link, buckets, common), _ROWS), "jaccard")
    own = rows.where(F.col("kind") == _DOC).select("doc_id", "n", "s1", "s2", "sketch")

    # Equal sets are one representative; a document of several sets stands for itself.
    some, n = own.where("n > 0 and doc_id is not null"), own.count()
    several = some.groupBy("doc_id").agg(F.min("s1").alias("x"), F.max("s1").alias("y")).where("x <> y").select("doc_id")
    copies = with_least(some.drop("sketch"), ["s1", "s2", "n"], "doc_id", "rep", n).where("rep < doc_id").select("doc_id", "rep").distinct()
    copies = written(copies.join(several, "doc_id", "left_anti"), "jaccard-copies", n)
    cells = rows.where(F.col("kind") == _CELLS).select("bucket", "keys", "ids")
    met = cells.groupBy("bucket").applyInArrow(_meet(buckets // PAIR_BUCKETS + 8), _MET)
    met = written(met.groupBy("dest").applyInArrow(_gathered, "a long, b long, test boolean"), "jaccard-met")
    sets = some.select("doc_id", "n", "sketch")
    tested = (
        met.where("test").select("a", "b").join(sets.select(F.col("doc_id").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("x")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), "n", F.col("sketch").alias("y")), "b")
        .select("a", "b", "m", "n", "x", "y").mapInArrow(_fit(link), "a long, b long")
    )
    near = written(tested.unionByName(met.where("not test").select("a", "b")), "jaccard-near")
    pairs = near.count()
    for end in ("a", "b"):
        rep = copies.select(F.col("doc_id").alias(end), "rep")
        near = near.join(rep, end, "left").withColumn(end, F.coalesce("rep", end)).drop("rep")
    family = components(near, "jaccard-family", pairs).select(F.col("id").alias("doc_id"), F.col("root").alias("family"))
    members = family.join(some.groupBy("doc_id").agg(F.sum("n").alias("n")), "doc_id")
    links = _links(docs, written(members, "jaccard-members", n), link)

    edges = links.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    roots = components(edges, "jaccard-links", n).select(F.col("id").alias("doc_id"), "root")
    return own.join(roots, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("component_id")
    )


def _sized(members: DataFrame, rows: int) -> DataFrame:
    """``members`` with the shingles of their family as ``total``."""
    return members.join(written(members.groupBy("family").agg(F.sum("n").alias("total")), "jaccard-totals", rows), "family")


def _links(docs: DataFrame, members: DataFrame, link: Link) -> DataFrame:
    """Edges of a spanning forest of the links inside the families."""
    n = members.count()
    sized = _sized(members.withColumn("root", F.lit(None).cast("long")), n)
    out, large = _small(docs, sized.where(F.col("total") <= CHUNK), link), sized.where(F.col("total") > CHUNK)
    if large.isEmpty():
        return out
    found, state, rest = _cut(docs, large, link)
    out = out.unionByName(found)
    if rest.isEmpty():
        return out
    groups = _sized(written(_grouped(docs, state, rest, link), "jaccard-fine", n), n)
    out = out.unionByName(_small(docs, groups.where(F.col("total") <= CHUNK), link))
    large = groups.where(F.col("total") > CHUNK)
    return out if large.isEmpty() else out.unionByName(_outside(docs, large, link))


def _small(docs: DataFrame, small: DataFrame, link: Link) -> DataFrame:
    """Edges inside families that fit a task; a task takes several."""
    tasks = int(small.agg(F.sum("n")).first()[0] or 0) // TASK + 1
    one = small.select("doc_id", F.pmod(F.xxhash64("family"), F.lit(tasks)).alias("task"), F.col("family").alias("unit"), F.lit(0).alias("side"), "root")
    return _with_texts(docs, one).groupBy("task").applyInArrow(_compare(link), "a long, b long")


def _chunked(large: DataFrame) -> DataFrame:
    chunks = F.ceil(F.col("total") / CHUNK).cast("int").alias("chunks")
    return large.select("doc_id", "family", "n", "root", chunks).withColumn("chunk", F.pmod(F.xxhash64("doc_id"), "chunks").cast("int"))


def _apart(state: DataFrame) -> DataFrame:
    """The rows of ``state`` outside the main (largest) class of their family."""
    sizes = state.groupBy("family", "root").agg(F.count("*").alias("size"))
    main = written(sizes.groupBy("family").agg(F.max_by("root", F.struct("size", "root")).alias("main")), "jaccard-main")
    return state.join(main, "family").where("root <> main").drop("main")


def _cut(docs: DataFrame, large: DataFrame, link: Link) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Families in chunks, each with some pivots of the family: (edges found, members with their classes, those outside the main class)."""
    cut = written(_chunked(large).drop("root"), "jaccard-chunks")
    order = Window.partitionBy("family").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id")
    pivots = (
        cut.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PIVOTS)
        .withColumn("of", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("of <> chunk")
    )
    first = cut.select("doc_id", "family", "chunk").unionByName(pivots.select("doc_id", "family", F.col("of").alias("chunk")))
    null = F.lit(None).cast("long").alias("root")
    first = first.select("doc_id", F.xxhash64("family", "chunk").alias("task"), F.col("family").alias("unit"), F.lit(0).alias("side"), null)
    found = written(_with_texts(docs, first).groupBy("task").applyInArrow(_compare(link), "a long, b long"), "jaccard-first")
    roots = components(found, "jaccard-classes", found.count()).select(F.col("id").alias("doc_id"), "root")
    state = written(cut.join(roots, "doc_id", "left").select("doc_id", "family", "n", F.coalesce("root", "doc_id").alias("root")), "jaccard-state")
    return found, state, written(_apart(state), "jaccard-rest")


def _outside(docs: DataFrame, large: DataFrame, link: Link) -> DataFrame:
    """Edges of what is outside a group's main class with all chunks of the group."""
    state = written(_chunked(large), "jaccard-large")
    rest = _apart(state)
    parts = written(rest.groupBy("family").agg(F.ceil(F.sum("n") / CHUNK).cast("int").alias("parts")), "jaccard-parts")
    high = rest.join(parts, "family").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(2)), "parts").cast("int"))
    high = high.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("side", F.lit(2))
    low = state.join(parts, "family").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("side", F.lit(1))
    key = F.xxhash64("family", "chunk", "part")
    columns = ["doc_id", key.alias("task"), key.alias("unit"), "side", "root"]
    return _with_texts(docs, low.select(*columns).unionByName(high.select(*columns))).groupBy("task").applyInArrow(_compare(link), "a long, b long")


def first_of_class(docs: DataFrame, link: Link = Link()) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, equal rows once; a null id is its own class."""
    classes = written(classes_of(docs, link), "jaccard-classes")
    gone = written(classes.where("component_id <> doc_id").select("doc_id").distinct(), "jaccard-gone", classes.count())
    kept = docs.join(sent(gone, F.lit(GONE_BYTES)), "doc_id", "left_anti")  # texts are shuffled only where the ids are too many to send
    if not classes.groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text"])  # a shuffle of texts that unique ids don't need
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
