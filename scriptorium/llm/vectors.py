"""Columns of vectors: which rows count, and their components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column, below: float = float("inf")) -> Column:
    """Whether a vector is there and every component is a finite number of an absolute value under ``below``."""
    # NaN is greater than any number in Spark, so it fails the comparison too; a null component counts as failing.
    return vector.isNotNull() & F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float(below)), F.lit(False)))


def scaled(vector: Column, by: int, plus: int = 0) -> Column:
    """floor(by * c) + plus of every component, as array<bigint>."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(by)) * c.cast("double")).cast("long") + F.lit(plus).cast("long"))


def common_length(df: DataFrame, column: str) -> int:
    """The length that most vectors of ``df`` have (the smaller of equally frequent ones), 0 without a vector."""
    row = df.groupBy(F.size(column).alias("length")).count().where("length > 0").orderBy(F.desc("count"), "length").first()
    return int(row["length"]) if row else 0


def matrix(column: pa.Array | pa.ChunkedArray, dtype) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
