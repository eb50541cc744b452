"""Shared helpers: table access, whole-text columns, Arrow blocks, written tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Rows per Arrow batch for whole texts: with the default of 10,000 a batch of
# very long texts would not fit an executor.
TEXT_BATCH_ROWS = 1024
TEXT_BATCH_BYTES = 32 << 20
SMALL_BATCH_ROWS = 256  # where several stages share an executor's memory


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch to a size that whole texts fit (never raises it)."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows, "10000")) <= TEXT_BATCH_ROWS:
        spark.conf.set(rows, str(TEXT_BATCH_ROWS))


def small_batches(spark: SparkSession) -> None:
    """Lower the session's batches of table readers and of Arrow to ``SMALL_BATCH_ROWS`` (never raises them).

    A reader's 4,096 whole texts take arrays of tens of MB in every task.
    """
    for rows in ("spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        if not 0 < int(spark.conf.get(rows)) <= SMALL_BATCH_ROWS:
            spark.conf.set(rows, str(SMALL_BATCH_ROWS))


def texts(df: DataFrame, *keys: str, column: str = "text") -> DataFrame:
    """The key columns and the whole text as ``text``, null as empty; other columns are not read."""
    return df.select(*keys, F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text"))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def total_bytes(df: DataFrame, column: str = "text") -> int:
    return int(df.agg(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0)


SCRATCH: list[str] = []  # paths of the tables that this process wrote, in order


FILE_ROWS = 1 << 17  # rows of a scratch file of a narrow table


def few_files(df: DataFrame, rows: int | None) -> DataFrame:
    """``df`` in so few partitions that about ``rows`` narrow rows fill their files; as it is where they are not known."""
    return df if rows is None else df.coalesce(rows // FILE_ROWS + 1)


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    ``rows`` says about how many a narrow table has, so that few rows go to few
    files.  Else every task that has a row makes a file, and on a local disk starts
    processes that set its rights.

    Cuts lineage: a lost executor later rereads these files instead of
    computing again.  ``SCRATCH`` tells a caller what it may ``drop`` once its own
    result is written.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    few_files(df, rows).write.option("compression", "zstd").parquet(path)
    SCRATCH.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete tables by path, on whatever file system they are."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


SENT_BYTES = 48 << 20  # of a table that may be sent to every task; a larger one is joined by a shuffle


def sent(df: DataFrame, size: Column, limit: int | None = None) -> DataFrame:
    """``df`` as a broadcast side where its rows' ``size`` adds up to ``limit`` at most (it is computed for this), else as it is."""
    total = int(df.agg(F.sum(size.cast("long"))).first()[0] or 0)
    return F.broadcast(df) if total <= (SENT_BYTES if limit is None else limit) else df


def with_least(df: DataFrame, keys: list[str], value: str, name: str, rows: int | None = None) -> DataFrame:
    """``df`` with the least ``value`` of its group as ``name``, only rows of groups of two or more.

    The least is aggregated on the map side and written, so both sides of the join
    are plain shuffles: adaptive execution splits a group that many rows hold.
    """
    least = df.groupBy(*keys).agg(F.min(value).alias(name), F.count("*").alias("__rows")).where("__rows > 1").drop("__rows")
    return df.join(written(few_files(least, rows), "least"), keys)


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = 16 << 20) -> Iterator[pa.Table]:
    """Join Arrow batches to tables of about ``limit`` bytes of text (one longer row is never cut)."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pc.binary_length(batch.column(text)).fill_null(0))
        start, run = 0, size
        for i, n in enumerate(lengths.tolist()):
            run += n
            if run >= limit:
                held.append(batch.slice(start, i + 1 - start))
                yield pa.Table.from_batches(held)
                held, start, run = [], i + 1, 0
        if start < batch.num_rows:
            held.append(batch.slice(start))
        size = run
    if held:
        yield pa.Table.from_batches(held)


def varints(values: np.ndarray) -> bytes:
    """Non-negative integers as LEB128 bytes."""
    v = values.astype(np.uint64)
    width = np.ones(len(v), np.int64)
    for bits in range(7, 64, 7):
        more = v >> np.uint64(bits) != 0
        if not more.any():
            break
        width += more
    end = np.cumsum(width)
    out = np.zeros(int(end[-1]) if len(v) else 0, np.uint8)
    start = end - width
    for k in range(int(width.max()) if len(v) else 0):
        has = width > k
        part = (v[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[start[has] + k] = part.astype(np.uint8) | ((width[has] > k + 1) * np.uint8(128))
    return out.tobytes()


def from_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(raw < 128)
    start = np.concatenate(([0], last[:-1] + 1))
    index = np.arange(len(raw)) - np.repeat(start, last - start + 1)
    parts = (raw & 127).astype(np.int64) << (7 * index)
    return np.add.reduceat(parts, start)
