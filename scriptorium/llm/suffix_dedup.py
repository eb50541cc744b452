"""Suffix-array dedup: remove bytes of 50-byte strings that start in an earlier document.

A string is removed from a document if it also starts in one with a smaller id.
Only strings that may repeat are sorted, wherever they stand:

0. Copies of an earlier text go whole, by digest, and take no part in the rest.
1. Anchors.  The least hash of the 25-byte grams in a 50-byte string depends on
   the string alone, so equal strings have equal anchors.  Each block of
   documents sends its distinct anchors, packed by hash bucket; a bucket finds
   those that two documents hold and returns them to their documents.
2. Contexts.  A document cuts out the runs of strings that share a repeated
   anchor.  Equal contexts leave a block once: the others of the block follow an
   earlier document in full.
3. Columns.  A bucket sorts the strings of its distinct contexts column by
   column, from the last symbol to the first: every round inserts one symbol in
   front of each string, moves the strings by a stable sort on it (the step from
   the first to the last column of a Burrows-Wheeler transform) and updates which
   neighbours share the prefix so far.  After 50 rounds neighbours that share it
   are equal strings, and the least id of each class decides.
4. Anchors that stand in more than ``HOT`` documents skip the bucket: their
   contexts are aggregated to the first document on the map side.  The distinct
   ones that are left go to buckets of their own and are sorted as in step 3; only
   the strings of a bucket of over ``HOT_BYTES`` are listed and aggregated instead.

A bucket's state is bounded by the text bytes dealt to it, so it stays in
memory where the published method keeps sequential files.

Cases: a null or empty text, or one under 50 bytes, keeps all bytes.  Rows with
equal ids never remove from each other; a null id removes from nothing and
keeps all.  Equal rows get equal results.
Building the frame runs Spark jobs and lowers the session's Arrow batch size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import blocks, bounded_batches, sent, texts, total_bytes, with_least, written

LENGTH = 50
GRAM = 25
SPAN = LENGTH - GRAM + 1  # grams of a string
LONGEST_RUN = 64  # strings of one context
BLOCK_BYTES = 3 << 20  # text bytes that a task holds at a time
ANCHOR_BYTES = 6 << 20  # text bytes for each bucket of anchors
CONTEXT_BYTES = 3 << 19  # context bytes for each bucket of strings
HOT = 4096  # documents
HOT_BYTES = 4 << 20  # distinct hot contexts that one task sorts

_TABLE = np.random.default_rng(25).integers(1, 1 << 64, 256, np.uint64)
_A = [np.uint64(pow(0x9E3779B97F4A7C15, 1 << k, 1 << 64)) for k in range(5)]
_C = np.uint64(0xC2B2AE3D27D4EB4F)


def anchors(data: np.ndarray) -> np.ndarray:
    """The anchor of the string at every start."""
    h = [_TABLE[data]]
    for k in range(4):  # grams of 2, 4, 8 and 16 bytes
        h.append(h[-1][: -(1 << k)] * _A[k] + h[-1][1 << k :])
    n = len(data) - GRAM + 1
    gram = (h[4][:n] * _A[3] + h[3][16 : 16 + n]) * _A[0] + h[0][24 : 24 + n]  # 16, 8 and 1
    gram = (gram ^ (gram >> np.uint64(31))) * _C
    gram ^= gram >> np.uint64(29)
    for k in range(4):
        gram = np.minimum(gram[: -(1 << k)], gram[1 << k :])
    return np.minimum(gram[: len(data) - LENGTH + 1], gram[SPAN - 16 : SPAN - 16 + len(data) - LENGTH + 1])


def runs_of(values: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values, none longer than ``LONGEST_RUN``."""
    change = np.concatenate(([True], values[1:] != values[:-1]))
    first = np.flatnonzero(change)
    if len(first) * LONGEST_RUN < len(values) or np.diff(first, append=len(values)).max() > LONGEST_RUN:
        since = np.arange(len(values)) - np.repeat(first, np.diff(first, append=len(values)))
        first = np.flatnonzero(since % LONGEST_RUN == 0)
    return first


_NAME = 4  # bytes of an anchor's name inside its bucket
_BRIEF = 3  # and inside a document; a chance hit is only a candidate, on every path whose list it hits


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each anchor.  Anchors are least hashes, most of them small, so they are mixed first."""
    return (((values * _C) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _short(values: np.ndarray, width: int = _NAME) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _long(data: bytes, width: int = _NAME) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


_ROWS = "block long, bucket int, names binary, docs binary, ids array<long>, digests array<long>"
_ARROW = pa.schema([
    ("block", pa.int64()), ("bucket", pa.int32()), ("names", pa.binary()), ("docs", pa.binary()), ("ids", pa.list_(pa.int64())), ("digests", pa.list_(pa.int64())),
])


def _bytes(table: pa.Table) -> list[bytes]:
    return table["text"].cast(pa.binary()).to_pylist()


def _digest(data: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(data, 42)).view(np.int64))  # as the engine's xxhash64 of a string


def _anchor_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for k, table in enumerate(blocks(batches, limit=BLOCK_BYTES)):
            ids, own = table["doc_id"].to_pylist(), _bytes(table)
            found = [np.unique(anchors(np.frombuffer(d, np.uint8))) if i is not None and len(d) >= LENGTH else None for i, d in zip(ids, own, strict=True)]
            has = [n for n, f in enumerate(found) if f is not None]
            rows = [{"block": part + k, "bucket": -1, "ids": ids, "digests": [_digest(d) for d in own]}]
            if has:
                values = np.concatenate([found[n] for n in has])
                of = np.repeat(np.asarray(has, np.uint32), [len(found[n]) for n in has])
                bucket = _bucket(values, buckets)
                order = np.argsort(bucket, kind="stable")
                values, of = values[order], of[order]
                starts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
                rows += [
                    {"block": part + k, "bucket": b, "names": _short(values[x:y]), "docs": of[x:y].astype("<u4").tobytes()}
                    for b, (x, y) in enumerate(zip(starts, starts[1:], strict=False)) if x < y
                ]
            yield from pa.Table.from_pylist(rows, schema=_ARROW).to_batches(max_chunksize=64)

    return run


def _repeated(most: int):
    """One bucket of anchors: keep those that two documents hold; ``bucket`` then tells those of over ``most`` documents."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        if rows[0]["bucket"] < 0:
            return table
        names = [_long(r["names"]) for r in rows]
        _, inverse, count = np.unique(np.concatenate(names), return_inverse=True, return_counts=True)
        often = count[inverse]
        out, at = [], 0
        for r, own in zip(rows, names, strict=True):
            n = often[at : at + len(own)]
            at += len(own)
            docs = np.frombuffer(r["docs"], "<u4")
            for hot, kept in ((0, (n > 1) & (n <= most)), (1, n > most)):
                if kept.any():
                    out.append({"block": r["block"], "bucket": hot, "names": _short(own[kept]), "docs": docs[kept].astype("<u4").tobytes()})
        return pa.Table.from_pylist(out, schema=_ARROW)

    return run


_LISTS = "doc_id long, digest long, names binary, hot binary"


def _per_document(brief: int):
    """One block: the repeated anchors of each of its documents."""
    return lambda table: _lists_of(table, brief)


def _lists_of(table: pa.Table, brief: int) -> pa.Table:
    rows = table.to_pylist()
    head = next(r for r in rows if r["bucket"] < 0)
    out: dict[int, list[bytes]] = {}
    for hot in (0, 1):
        own = [r for r in rows if r["bucket"] == hot]
        if not own:
            continue
        names = np.concatenate([_long(r["names"]) for r in own])
        docs = np.concatenate([np.frombuffer(r["docs"], "<u4") for r in own])
        order = np.argsort(docs, kind="stable")
        names, docs = names[order], docs[order]
        first = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
        for a, b in zip(first, np.append(first[1:], len(docs)), strict=True):
            out.setdefault(int(docs[a]), [b"", b""])[hot] = _short(names[a:b], brief)
    at = list(out)
    return pa.table({
        "doc_id": pa.array([head["ids"][k] for k in at], pa.int64()), "digest": pa.array([head["digests"][k] for k in at], pa.int64()),
        "names": pa.array([out[k][0] for k in at], pa.binary()), "hot": pa.array([out[k][1] for k in at], pa.binary()),
    })


_CUTS = "kind int, bucket long, doc_id long, digest long, start long, stop long, context binary, ids binary, digests binary, starts binary, sizes binary"
_CUT_NAMES = [c.split()[0] for c in _CUTS.split(", ")]
_CUT_TYPES = [pa.int32(), pa.int64(), *[pa.int64()] * 4, *[pa.binary()] * 5]
_MARK, _PACK, _HOT = 0, 1, 2


def _cut_batch(columns: dict, size: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in zip(_CUT_NAMES, _CUT_TYPES, strict=True)], names=_CUT_NAMES)


def _contexts(buckets: int, brief: int):
    """Documents with their repeated anchors to marks, packed contexts and hot contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low_bits = np.uint64((1 << 8 * brief) - 1)
        for table in blocks(batches, limit=BLOCK_BYTES):
            rows = table.select(["doc_id", "digest", "names", "hot"]).to_pylist()
            own = _bytes(table)
            seen: dict[bytes, int] = {}
            marks: list[tuple[int, int, int, int]] = []
            packs: dict[int, list[list]] = {}
            hots: list[tuple] = []
            for k in sorted(range(len(rows)), key=lambda k: rows[k]["doc_id"]):
                row, data = rows[k], own[k]
                doc, digest = row["doc_id"], row["digest"]
                values = anchors(np.frombuffer(data, np.uint8))
                first = runs_of(values)
                last = np.append(first[1:], len(values))
                key = values[first]
                low = key & low_bits
                # A short name in both lists may be of either: all documents must send a string on the path of its anchor.
                hot, cold = np.isin(low, _long(row["hot"], brief)), np.isin(low, _long(row["names"], brief))
                live = hot | cold
                bucket = _bucket(key, buckets)
                mark = None
                for a, b, bk, is_hot, is_cold in zip(first[live].tolist(), last[live].tolist(), bucket[live].tolist(), hot[live].tolist(), cold[live].tolist(), strict=True):
                    context = data[a : b + LENGTH - 1]
                    earlier = seen.setdefault(context, doc)
                    if earlier < doc:
                        if mark and a <= mark[3]:
                            mark[3] = b + LENGTH - 1
                        else:
                            if mark:
                                marks.append(tuple(mark))
                            mark = [doc, digest, a, b + LENGTH - 1]
                        continue
                    if is_hot:
                        hots.append((doc, digest, a, context, bk))
                    if is_cold:
                        pack = packs.setdefault(bk, [[], [], [], []])
                        for to, value in zip(pack, (doc, digest, a, context), strict=True):
                            to.append(value)
                if mark:
                    marks.append(tuple(mark))
            if marks:
                doc, digest, a, b = zip(*marks, strict=True)
                yield _cut_batch({"kind": [_MARK] * len(doc), "doc_id": doc, "digest": digest, "start": a, "stop": b}, len(doc))
            for x in range(0, len(hots), 8192):
                doc, digest, a, c, bk = zip(*hots[x : x + 8192], strict=True)
                yield _cut_batch({"kind": [_HOT] * len(doc), "bucket": bk, "doc_id": doc, "digest": digest, "start": a, "context": c}, len(doc))
            full = list(packs)
            for x in range(0, len(full), 16):
                some = [packs[b] for b in full[x : x + 16]]
                yield _cut_batch({
                    "kind": [_PACK] * len(some), "bucket": full[x : x + 16],
                    "context": [b"".join(p[3]) for p in some], "ids": [np.asarray(p[0], "<i8").tobytes() for p in some],
                    "digests": [np.asarray(p[1], "<i8").tobytes() for p in some], "starts": [np.asarray(p[2], "<i8").tobytes() for p in some],
                    "sizes": [bytes(map(len, p[3])) for p in some],
                }, len(some))

    return run


def equal_strings(flat: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(order, class in that order) of the strings of ``length`` symbols that start at ``at`` in ``flat``.

    Column by column from the last: each round inserts one symbol in front of
    every string, and a common prefix lives on where the symbols agree.
    """
    order, place = np.arange(len(at), dtype=np.int32), at
    shared = np.zeros(len(at), np.int32)
    for column in range(length - 1, -1, -1):
        symbol = flat[place + column]
        move = np.argsort(symbol, kind="stable").astype(np.int32)
        order, place, shared, symbol = order[move], place[move], shared[move], symbol[move]
        new = (symbol[1:] != symbol[:-1]) | (shared[1:] != shared[:-1])
        shared = np.concatenate((np.zeros(1, np.int32), np.cumsum(new, dtype=np.int32)))
    return order, shared


_MARKS = "doc_id long, digest long, start long, stop long"


def _decide(table: pa.Table) -> pa.Table:
    """One bucket: spans of its contexts whose strings start in an earlier document."""
    ids, digests, starts = (np.frombuffer(b"".join(table[c].to_pylist()), "<i8") for c in ("ids", "digests", "starts"))
    sizes = np.frombuffer(b"".join(table["sizes"].to_pylist()), np.uint8).astype(np.int64)
    blob = b"".join(table["context"].to_pylist())
    ends = np.cumsum(sizes)
    # Distinct contexts and the first document of each.
    known: dict[bytes, int] = {}
    kind = np.fromiter((known.setdefault(blob[a:b], len(known)) for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)), np.int64, len(sizes))
    first = np.full(len(known), np.iinfo(np.int64).max)
    np.minimum.at(first, kind, ids)
    flat = np.frombuffer(b"".join(known), np.uint8)
    length = np.fromiter(map(len, known), np.int64, len(known))
    windows = length - LENGTH + 1
    begin = np.cumsum(windows) - windows
    # A bucket's contexts are a few megabytes: 32 bits hold every position.
    shift_of = np.repeat((np.cumsum(length) - length - begin).astype(np.int32), windows)
    at = shift_of + np.arange(len(shift_of), dtype=np.int32)
    of = np.repeat(np.arange(len(known), dtype=np.int32), windows)
    order, shared = equal_strings(flat, at)
    head = np.flatnonzero(np.concatenate(([True], shared[1:] != shared[:-1])))
    least = np.minimum.reduceat(first[of[order]], head)
    gone = np.zeros(len(at), bool)
    gone[order] = least[shared] < first[of[order]]

    # A later document's equal context goes whole; the first document's loses the strings that are gone.
    later = ids > first[kind]
    out = [(ids[later], digests[later], starts[later], starts[later] + sizes[later])]
    mine = np.flatnonzero(~later)
    count = windows[kind[mine]]
    row = np.repeat(mine, count)
    shift = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    flag = gone[np.repeat(begin[kind[mine]], count) + shift]
    row, shift = row[flag], shift[flag]
    if len(row):
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (shift[1:] != shift[:-1] + 1)))
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(row)) - 1
        out.append((ids[row[a]], digests[row[a]], starts[row[a]] + shift[a], starts[row[a]] + shift[b] + LENGTH))
    columns = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*out, strict=True)]
    return pa.Table.from_arrays(columns, names=["doc_id", "digest", "start", "stop"])


def _merged(spans):
    """Sorted spans with touching ones joined: a few per document, whatever the number of marks."""
    pair = "struct<start:long,stop:long>"
    state = f"struct<start:long,stop:long,out:array<{pair}>>"
    none = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("stop"), F.array().alias("out")).cast(state)
    closed = lambda acc: F.when(acc["stop"] < 0, acc["out"]).otherwise(
        F.concat(acc["out"], F.array(F.struct(acc["start"], acc["stop"]).cast(pair))))
    step = lambda acc, s: F.when(
        s["start"] <= acc["stop"], F.struct(acc["start"].alias("start"), F.greatest(acc["stop"], s["stop"]).alias("stop"), acc["out"].alias("out"))
    ).otherwise(F.struct(s["start"].alias("start"), s["stop"].alias("stop"), closed(acc).alias("out"))).cast(state)
    return F.aggregate(F.sort_array(spans), none, step, closed)


_GONE = "context binary, start long, stop long"


def _decide_distinct(table: pa.Table) -> pa.Table:
    """One bucket of distinct hot contexts: the runs of their strings that start in an earlier document."""
    context = table["context"].to_pylist()
    rows = np.arange(len(context), dtype="<i8")
    pack = {"ids": np.asarray(table["first"]).astype("<i8"), "digests": rows, "starts": np.zeros_like(rows)}  # a row's number goes as its digest
    columns = {name: pa.array([values.tobytes()], pa.binary()) for name, values in pack.items()}
    found = _decide(pa.table({**columns, "sizes": pa.array([bytes(map(len, context))], pa.binary()), "context": pa.array([b"".join(context)], pa.binary())}))
    own = pa.array([context[k] for k in found["digest"].to_pylist()], pa.binary())
    return pa.table({"context": own, "start": found["start"], "stop": found["stop"]})


def _shared(hot: DataFrame, most: int) -> DataFrame:
    """(key, first, spans) of each distinct hot context: its first document, and the runs of its strings that start in an earlier one.

    Contexts are aggregated before their strings are compared, so a context that
    many documents hold is sorted once.  Equal strings have one anchor and with it one
    bucket; a bucket of over ``most`` bytes is not sorted by one task, its strings are
    aggregated.
    """
    each = hot.groupBy("context").agg(F.min("doc_id").alias("first"), F.min("bucket").alias("bucket"))
    each = written(each.withColumn("key", F.xxhash64("context")), "suffix-hot")
    sizes = each.groupBy("bucket").agg(F.sum(F.octet_length("context").cast("long")).alias("bytes"))
    large = F.broadcast(written(sizes.where(F.col("bytes") > most).select("bucket"), "suffix-large"))  # so many bytes each: few
    sorted_ = each.join(large, "bucket", "left_anti").select("bucket", "context", "first").groupBy("bucket").applyInArrow(_decide_distinct, _GONE)
    strings = each.join(large, "bucket", "left_semi").withColumn("shift", F.explode(F.expr(f"sequence(0, octet_length(context) - {LENGTH})"))).select(
        "context", "first", F.col("shift").cast("long").alias("start"), F.expr(f"substring(context, shift + 1, {LENGTH})").alias("string")
    )
    listed = with_least(strings, ["string"], "first", "least").where("least < first").select("context", "start", (F.col("start") + LENGTH).alias("stop"))
    spans = sorted_.unionByName(listed).groupBy("context").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # a context has at most LONGEST_RUN strings
    return each.join(spans, "context", "left").select("context", "key", "first", _merged(F.coalesce("spans", F.array().cast("array<struct<start:long,stop:long>>"))).alias("spans"))


def _hot_marks(hot: DataFrame, most: int) -> DataFrame:
    """Spans of hot contexts: a later document's goes whole, the first one's loses what an earlier document has in another context."""
    shared = written(_shared(hot, most), "suffix-shared")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.octet_length("context").cast("long").alias("stop")))
    shared = sent(shared, F.octet_length("context") + 16 * F.size("spans") + 32)
    met = hot.drop("bucket").withColumn("key", F.xxhash64("context")).join(shared, ["key", "context"])
    lost = met.withColumn("span", F.explode(F.when(F.col("doc_id") > F.col("first"), whole).otherwise(F.col("spans"))))
    return lost.select("doc_id", "digest", (F.col("start") + F.col("span.start")).alias("start"), (F.col("start") + F.col("span.stop")).alias("stop"))


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in blocks(batches, limit=BLOCK_BYTES):
        rows = []
        for doc, data, spans in zip(table["doc_id"].to_pylist(), _bytes(table), table["spans"].to_pylist(), strict=True):
            kept, at, removed, count = hashlib.sha256(), 0, 0, 0
            stop = -1
            for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
                if a > stop:
                    count += 1
                    kept.update(data[max(at, 0):a])
                    removed += b - a
                elif b > stop:
                    removed += b - stop
                stop = at = max(stop, b)
            kept.update(data[max(at, 0):])
            rows.append((doc, len(data), removed, count, kept.hexdigest()))
        columns = list(zip(*rows, strict=True))
        types = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _copies(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, stop) of documents whose whole text an earlier document has."""
    each = docs.where("doc_id is not null").select(
        "doc_id", F.xxhash64("text").alias("digest"), F.hash("text").alias("check"), F.octet_length("text").cast("long").alias("stop")
    )
    return with_least(each, ["digest", "check", "stop"], "doc_id", "first").where("first < doc_id").select("doc_id", "digest", "stop").distinct()


def spans(docs: DataFrame, hot: int = HOT, brief: int = _BRIEF, most: int = HOT_BYTES) -> DataFrame:
    """(doc_id, digest, start, stop): removable spans, which may overlap, of the documents (doc_id, text)."""
    buckets = total_bytes(docs) // ANCHOR_BYTES + 8
    copies = written(_copies(docs), "suffix-copies")
    keyed = docs.where("doc_id is not null").withColumn("digest", F.xxhash64("text"))
    own = keyed.join(sent(copies, F.lit(32).cast("long")), ["doc_id", "digest"], "left_anti")
    found = own.select("doc_id", "text").mapInArrow(_anchor_rows(buckets), _ROWS)
    # A block's list of documents goes along under a key of its own.
    key = F.when(F.col("bucket") < 0, -1 - F.col("block")).otherwise(F.col("bucket"))
    kept = found.groupBy(key.alias("key")).applyInArrow(_repeated(hot), _ROWS)
    lists = kept.groupBy("block").applyInArrow(_per_document(brief), _LISTS).groupBy("doc_id", "digest")
    lists = written(lists.agg(F.first("names").alias("names"), F.first("hot").alias("hot")), "suffix-lists")
    size = (F.octet_length("names") + F.octet_length("hot")).cast("long")
    groups = int(lists.agg(F.sum(size)).first()[0] or 0) * 60 // brief // CONTEXT_BYTES + 8  # a name stands for a context of about 60 bytes
    cuts = keyed.join(sent(lists, size + 32), ["doc_id", "digest"]).select("doc_id", "digest", "text", "names", "hot").mapInArrow(_contexts(groups, brief), _CUTS)
    cuts = written(cuts, "suffix-cuts")
    packs = cuts.where(F.col("kind") == _PACK).select("bucket", "context", "ids", "digests", "starts", "sizes")
    marks = packs.groupBy("bucket").applyInArrow(_decide, _MARKS)
    clear = cuts.where(F.col("kind") == _MARK).select("doc_id", "digest", "start", "stop")
    whole = copies.where(F.col("stop") >= LENGTH).select("doc_id", "digest", F.lit(0).cast("long").alias("start"), "stop")
    common = _hot_marks(cuts.where(F.col("kind") == _HOT).select("bucket", "doc_id", "digest", "start", "context"), most)
    return marks.unionByName(clear).unionByName(whole).unionByName(common)


def deduplicated(table: DataFrame, hot: int = HOT, brief: int = _BRIEF, most: int = HOT_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    bounded_batches(table.sparkSession)
    docs = texts(table, "doc_id")
    found = spans(docs, hot, brief, most).groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).withColumn("spans", _merged(F.col("spans")))
    found = written(found, "suffix-spans")
    keyed = docs.withColumn("digest", F.xxhash64("text")).join(sent(found, (16 * F.size("spans") + 32).cast("long")), ["doc_id", "digest"], "left")
    return keyed.select("doc_id", "text", "spans").mapInArrow(_remove, _OUT)
