"""Whitening directions of embeddings: blockwise QR, bidiagonal form, dqds, twisted factorisations.

Each component c becomes the integer x = floor(64 * c) + 1000000; the fit list is
each distinct x vector once.

1. Distinct vectors and their sums per dimension are exact: aggregated in long
   integers, map-side first, so copies of one vector never gather.
2. Every task reduces its centred rows block by block to one triangle R (the QR of
   the triangle so far over the next block).  Triangles of ``FAN`` tasks are
   reduced again until one is left: what moves is a triangle a task, never rows.
3. R, as large as the dimensions squared, is made bidiagonal by Householder
   reflections on the driver; dqds finds its singular values, twisted
   factorisations the right vectors.  The covariance is never formed, so small
   eigenvalues keep their digits.
4. One scan of the rows projects them.  The covariance of the whitened fit list is
   summed by another scan; its distance from the identity is returned.

Cases: rows whose vector is null or holds null or non-finite entries, or one of an
absolute value of ``RANGE`` or more, and vectors that have not the common length,
are dropped.  Null and repeated ids are rows like others.  Components with no
variance are left out, so one distinct vector, or none, gives no rows.  Equal
eigenvalues have any orthonormal vectors of their space.  ``deviation`` is null
where it exceeds a long.  Other columns are not read.  Building the frame runs jobs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written
from .bidiagonal import leading
from .vectors import common_length, finite, matrix, scaled

RANGE = 1 << 30  # absolute value of a component
BLOCK = 4096  # rows of a QR step
FAN = 16  # triangles that one task reduces
_TRIANGLE = "part long, r binary"
_LONG = np.iinfo(np.int64).max


def _sums(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, totals = 0, np.zeros(length, np.int64)
        for batch in batches:
            if batch.num_rows:
                count += batch.num_rows
                totals += matrix(batch.column("x"), np.int64).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([count]), pa.array([totals.tolist()], pa.list_(pa.int64()))], names=["n", "s"])

    return run


def centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """x - s / n with the difference taken in integers."""
    return (n * x - s) / n


def _stacked(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The triangle of ``r`` over ``rows``, square."""
    size = rows.shape[1]
    found = np.linalg.qr(np.concatenate((r, rows)), "r")
    return np.concatenate((found, np.zeros((size - len(found), size)))) if len(found) < size else found


def _triangles(n: int, s: np.ndarray):
    """Distinct vectors to one triangle for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r, seen = np.zeros((0, len(s))), False
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                r, seen = _stacked(r, centred(matrix(batch.column("x").slice(at, BLOCK), np.int64), n, s)), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], names=["part", "r"])

    return run


def _reduced(length: int):
    def run(table: pa.Table) -> pa.Table:
        r = np.zeros((0, length))
        rows = sorted(zip(table["part"].to_pylist(), table["r"].to_pylist(), strict=True))
        for _, data in rows:
            r = _stacked(r, np.frombuffer(data).reshape(-1, length))
        return pa.table({"part": pa.array([rows[0][0] // FAN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    return run


def triangle(distinct: DataFrame, n: int, s: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of the centred rows of ``distinct`` (x)."""
    left = written(distinct.mapInArrow(_triangles(n, s), _TRIANGLE), "whitening-triangles")
    while left.count() > FAN:
        left = written(left.groupBy(F.floor(F.col("part") / FAN).alias("of")).applyInArrow(_reduced(len(s)), _TRIANGLE), "whitening-triangles")
    r = np.zeros((0, len(s)))
    for row in sorted(left.collect(), key=lambda row: row["part"]):
        r = _stacked(r, np.frombuffer(bytes(row["r"])).reshape(-1, len(s)))
    return r


def _covariance(n: int, s: np.ndarray, directions: np.ndarray):
    """Sums of whitened components and of their products over a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = directions.shape[1]
        total, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = centred(matrix(batch.column("x"), np.int64), n, s) @ directions
                total += w.sum(0)
                products += w.T @ w
        i = np.repeat(np.arange(k + 1), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(np.tile(np.arange(k), k + 1), pa.int32()), pa.array(np.concatenate((products, total[None])).ravel())],
            names=["i", "j", "v"],
        )

    return run


def _projected(n: int, s: np.ndarray, directions: np.ndarray):
    """Rows (vec_id, x) to one row a component: vec_id, component, deviation, whitened."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = directions.shape[1]
        for batch in batches:
            if not batch.num_rows:
                continue
            apart = n * matrix(batch.column("x"), np.int64) - s
            if int(np.abs(apart).max()) < math.isqrt(_LONG // len(s)):
                deviation = np.square(apart).sum(1).tolist()
            else:
                deviation = [v if v <= _LONG else None for v in (sum(c * c for c in row) for row in apart.tolist())]
            white = (apart / n) @ directions
            rows = np.repeat(np.arange(len(apart)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1), len(apart)), pa.int32()),
                    pa.array(deviation, pa.int64()).take(pa.array(rows)), pa.array(white.ravel()),
                ],
                names=["vec_id", "component", "deviation", "whitened"],
            )

    return run


def whitened(vectors: DataFrame, components: int = 16, scale: int = 64, plus: int = 1_000_000) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row of ``vectors`` (vec_id, embedding)."""
    kept = vectors.select("vec_id", "embedding").where(finite(F.col("embedding"), RANGE))
    length = common_length(kept, "embedding")
    rows = kept.where(F.size("embedding") == length).select("vec_id", scaled(F.col("embedding"), scale, plus).alias("x"))
    ids = vectors.schema["vec_id"].dataType.simpleString()
    distinct = written(rows.select("x").distinct(), "whitening-distinct")
    sums = distinct.mapInArrow(_sums(length), "n long, s array<long>").select("n", F.posexplode("s").alias("d", "v"))
    found = sums.groupBy("d").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).orderBy("d").collect() if length else []
    n, s = (int(found[0]["n"]), np.asarray([r["v"] for r in found], np.int64)) if found else (0, np.zeros(0, np.int64))
    values, right, total = leading(triangle(distinct, n, s), components) if n else (np.zeros(0), np.zeros((0, 0)), 0.0)
    directions = right * math.sqrt(n) / np.sqrt(values)  # the eigenvalues are the squared singular values over n
    out = f"vec_id {ids}, component int, deviation long, whitened double"
    if not len(values):
        projected = rows.limit(0).select("vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("deviation"), F.lit(0.0).alias("whitened"))
        error = 0.0
    else:
        k = len(values)
        moments = np.zeros((k + 1, k))
        spread = distinct.mapInArrow(_covariance(n, s, directions), "i int, j int, v double")
        for r in spread.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            moments[r["i"], r["j"]] = r["v"]
        mean = moments[k] / n
        error = float(np.abs(moments[:k] / n - np.outer(mean, mean) - np.eye(k)).max())
        projected = rows.mapInArrow(_projected(n, s, directions), out)
    explained = F.array(*[F.lit(float(v / total)) for v in values]) if len(values) else F.array(F.lit(0.0))
    return projected.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("component") - 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
