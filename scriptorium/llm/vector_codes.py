"""Vector codes: product quantisation whose assignments walk a trie of the distinct parts.

Vectors are scaled to integers and cut into equal parts.  A part position's
codebook starts as that part of the vectors with the smallest ids; each round
assigns every part to the nearest entry and moves the entries to the floors of
their means.  All arithmetic is in integers, so results do not depend on how
rows are dealt.

1. Equal parts of a position are one row with a weight (aggregated map-side, so
   a vector that a third of the rows hold costs one row), range-partitioned and
   sorted by position and components: neighbours share prefixes.
2. A round walks the trie of each sorted run depth first.  A node holds the
   distances of its prefix to all entries, summed over the dimensions so far;
   children add one dimension to it, so a shared prefix is computed once.
   Leaves take the argmin (the lowest index of ties) and add their weight and
   weighted components to it.  Tasks return one sum per entry and dimension;
   only those, bounded by the size of the codebooks, reach the driver.
3. The last assignment walks the tries of each batch of rows, without a shuffle.

Cases: rows whose vector is null, holds null or non-finite components or one of
an absolute value of ``RANGE`` or more (squared distances would leave 64 bits),
and vectors that have not the common length, are dropped.  A null id counts as
the largest; equal ids start a codebook in the order of their components.
Without a row the result is empty.  Repeated rows count each.  Null labels are
one label.  Other columns are not read.  A length that ``parts`` does not divide
is an error of the call.  Building the frame runs the rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written
from .vectors import common_length, finite, matrix, scaled

RANGE = 1 << 16  # absolute value of a component
SIBLINGS = 512  # nodes whose distances are held at once on a level of the walk
PARTS_PER_TASK = 1 << 18  # distinct parts in a task
BROADCAST_BYTES = 8 << 20  # of label totals that may be sent to every task


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, its squared distance) of distinct parts in lexicographic order."""
    count, width = parts.shape
    index, distance = np.zeros(count, np.int64), np.zeros(count, np.int64)
    fresh = np.ones((count, width), bool)  # rows that begin a node of each depth
    if count > 1:
        fresh[1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1)

    def walk(depth: int, low: int, high: int, sums: np.ndarray) -> None:
        own = fresh[low:high, depth]
        child = np.flatnonzero(own)
        parent = np.zeros(len(child), np.int64) if depth == 0 else (np.cumsum(fresh[low:high, depth - 1]) - 1)[child]
        child += low
        for k in range(0, len(child), SIBLINGS):
            some = child[k : k + SIBLINGS]
            reached = sums[parent[k : k + SIBLINGS]] + np.square(parts[some, depth][:, None] - entries[:, depth])
            if depth + 1 == width:
                index[some] = reached.argmin(1)
                distance[some] = reached[np.arange(len(some)), index[some]]
            else:
                walk(depth + 1, int(some[0]), int(child[k + SIBLINGS]) if k + SIBLINGS < len(child) else high, reached)

    if count:
        walk(0, 0, count, np.zeros((1, len(entries)), np.int64))
    return index, distance


def _sums(codebooks: np.ndarray):
    """Distinct parts (position, part, n) to (position, entry, dimension, n, total) of what each entry got in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positions, entries, width = codebooks.shape
        counts, totals = np.zeros((positions, entries), np.int64), np.zeros((positions, entries, width), np.int64)
        for batch in batches:
            at, parts = np.asarray(batch.column("position")), matrix(batch.column("part"), np.int64)
            weight = np.asarray(batch.column("n"))
            for p in np.unique(at):
                rows = np.flatnonzero(at == p)
                rows = rows[np.lexsort(parts[rows].T[::-1])]
                index, _ = nearest(parts[rows], codebooks[p])
                np.add.at(counts[p], index, weight[rows])
                np.add.at(totals[p], index, parts[rows] * weight[rows][:, None])
        p, e = np.nonzero(counts)
        d = np.tile(np.arange(width), len(p))
        p, e = np.repeat(p, width), np.repeat(e, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(d, pa.int32()), pa.array(counts[p, e]), pa.array(totals[p, e, d])],
            names=["position", "entry", "dimension", "n", "total"],
        )

    return run


def _coded(codebooks: np.ndarray):
    """Rows with their vectors to rows with code and error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        positions, _, width = codebooks.shape
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"), np.int64)
            codes, error = np.zeros((len(x), positions), np.uint8), np.zeros(len(x), np.int64)
            for p in range(positions):
                parts, back = np.unique(x[:, p * width : (p + 1) * width], axis=0, return_inverse=True)
                index, distance = nearest(parts, codebooks[p])
                codes[:, p] = index[back.ravel()]
                error += distance[back.ravel()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def digest_of(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by position, entry and dimension, in decimal."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def fitted(rows: DataFrame, length: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """The codebooks (part positions x entries x dimensions) of ``rows`` (vec_id, x)."""
    width = length // parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
    start = np.asarray([r["x"] for r in first], np.int64).reshape(len(first), parts, width)
    codebooks = np.ascontiguousarray(start.transpose(1, 0, 2))
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("x", p * width + 1, width))
    distinct = rows.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count("*").alias("n"))
    distinct = written(distinct, "codes-distinct")
    tasks = distinct.count() // PARTS_PER_TASK + parts
    distinct = written(distinct.repartitionByRange(tasks, "position", "part").sortWithinPartitions("position", "part"), "codes-sorted")
    for _ in range(rounds):
        found = distinct.mapInArrow(_sums(codebooks), "position int, entry int, dimension int, n long, total long")
        sums = found.groupBy("position", "entry", "dimension").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
        codebooks = codebooks.copy()
        for r in sums:
            codebooks[r["position"], r["entry"], r["dimension"]] = r["total"] // r["n"]
    return codebooks


def coded(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable row of ``vectors`` (vec_id, embedding, label).

    ``code`` has two hex digits for each part, so at most 256 entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    schema = vectors.schema
    ids, labels = schema["vec_id"].dataType.simpleString(), schema["label"].dataType.simpleString()
    kept = vectors.select("vec_id", "embedding", "label").where(finite(F.col("embedding"), RANGE))
    length = common_length(kept, "embedding")
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    rows = kept.where(F.size("embedding") == length).select("vec_id", "label", scaled(F.col("embedding"), scale).alias("x"))
    if not length:
        return rows.select(
            "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"),
        ).limit(0)
    codebooks = fitted(rows.select("vec_id", "x"), length, parts, entries, rounds)
    out = written(rows.mapInArrow(_coded(codebooks), f"vec_id {ids}, label {labels}, code string, error long"), "codes")
    totals = written(out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "codes-labels")
    size = totals.agg(F.sum(F.coalesce(F.octet_length(F.col("of").cast("string")), F.lit(0)) + 64)).first()[0] or 0
    few = F.broadcast(totals) if size <= BROADCAST_BYTES else totals
    return out.join(few, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest_of(codebooks)).alias("codebooks_sha256")
    )
