"""Corpus sizing: words, approximate tokens, totals, arg-max, deciles, size split.

All of it is native Catalyst work.  Deciles are computed on the *histogram* of
token counts (one row per distinct count), so the only global ordering step
runs over a table bounded by the largest document, not by the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.naming import is_under, relative_path
from ..functions.text import approx_tokens, count_words

DEFAULT_SPLIT_THRESHOLD = 15000


def with_token_sizes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``words`` (``\\S+`` runs) and ``tokens`` (``round(words*4/3)``)."""
    return docs.withColumn("words", count_words(text_col)).withColumn("tokens", approx_tokens("words"))


def token_stats(sized: DataFrame) -> DataFrame:
    """Documents, total / mean / median tokens (median rounded half-even)."""
    return sized.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("tokens").cast("long").alias("total_tokens"),
        F.avg("tokens").alias("avg_tokens"),
        F.bround(F.median("tokens"), 0).cast("long").alias("median_tokens"),
    )


def largest_document(sized: DataFrame, path_col: str = "path") -> DataFrame:
    """Document with most words; ties go to the first path in walk (sorted) order."""
    best = F.min_by(
        F.struct(F.col(path_col).alias("max_path"), F.col("words").alias("max_words"),
                 F.col("tokens").alias("max_tokens")),
        F.struct((-F.col("words")).alias("neg_words"), F.col(path_col).alias("p")),
    )
    return sized.agg(best.alias("b")).select("b.*")


def token_histogram(sized: DataFrame) -> DataFrame:
    """(tokens, n) with the running count before each value: partial-aggregated, small."""
    hist = sized.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"))
    # Single-partition window, but over distinct token values only.
    w = Window.orderBy("tokens").rowsBetween(Window.unboundedPreceding, -1)
    return hist.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)).cast("long")).withColumn(
        "upto", F.col("before") + F.col("n")
    )


def token_deciles(sized: DataFrame, buckets: int = 10) -> DataFrame:
    """Slice rule over sorted counts: bucket i holds positions [i*n//k, (i+1)*n//k).

    Not ``ntile``: the remainder lands in the later buckets.  An empty bucket
    reports count 0 with min = c[start], max = c[end-1] (0/0 when end = 0).

    One pass over the (small) histogram: each distinct token value covers the
    sorted positions [before, upto); the k bucket indices are exploded per
    value and a value is kept for a bucket when its range holds the bucket's
    first or last position.  No join, one scan of the corpus.
    """
    hist = token_histogram(sized).withColumn("total", F.sum("n").over(Window.partitionBy()))
    x = hist.select("tokens", "before", "upto", "total",
                    F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("i"))
    x = x.withColumn("start", F.expr(f"(i * total) div {buckets}")).withColumn(
        "end", F.expr(f"((i + 1) * total) div {buckets}")).withColumn(
        "last", F.greatest(F.col("end") - 1, F.lit(0)))
    in_lo = (F.col("before") <= F.col("start")) & (F.col("start") < F.col("upto"))
    in_hi = (F.col("before") <= F.col("last")) & (F.col("last") < F.col("upto"))
    return (
        x.where(in_lo | in_hi)
        .groupBy("i", "start", "end")
        .agg(F.max(F.when(in_lo, F.col("tokens"))).alias("lo_tokens"),
             F.max(F.when(in_hi, F.col("tokens"))).alias("hi_tokens"))
        .select(
            (F.col("i") + 1).cast("int").alias("decile"),
            F.when(F.col("end") == 0, F.lit(0)).otherwise(F.col("lo_tokens")).cast("long").alias("min_tokens"),
            F.when(F.col("end") == 0, F.lit(0)).otherwise(F.col("hi_tokens")).cast("long").alias("max_tokens"),
            (F.col("end") - F.col("start")).cast("long").alias("n_docs"),
        )
    )


def size_bucket(tokens_col: str = "tokens", threshold: int = DEFAULT_SPLIT_THRESHOLD):
    return F.when(F.col(tokens_col) <= F.lit(threshold), F.lit("small")).otherwise(F.lit("large"))


def size_split_plan(
    sized: DataFrame,
    threshold: int = DEFAULT_SPLIT_THRESHOLD,
    small_dir: str | None = None,
    large_dir: str | None = None,
    path_col: str = "path",
    input_root: str | None = None,
) -> DataFrame:
    """Dry-run plan: bucket and destination for every document (nothing is moved).

    ``tokens <= threshold`` is small.  Files already under a target folder are
    excluded, as in the tool; the destination keeps the path relative to
    ``input_root`` below the bucket's folder.
    """
    out = sized.withColumn("bucket", size_bucket("tokens", threshold))
    for d in (small_dir, large_dir):
        if d:
            out = out.where(~is_under(path_col, d))
    if small_dir and large_dir:
        rel = relative_path(path_col, input_root) if input_root else F.col(path_col)
        out = out.withColumn(
            "dest",
            F.concat(
                F.when(F.col("bucket") == "small", F.lit(small_dir.rstrip("/") + "/"))
                .otherwise(F.lit(large_dir.rstrip("/") + "/")),
                rel,
            ),
        )
    return out


def size_split_counts(plan: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return plan.groupBy(*by, "bucket").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("tokens").cast("long").alias("tokens")
    )


def write_size_split(plan: DataFrame, path: str, mode: str = "error") -> None:
    """The physical split: one folder per bucket (inputs are never moved)."""
    plan.write.mode(mode).partitionBy("bucket").parquet(path)


def pending_split(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows of a split plan whose ``dest`` is not among the ``existing`` paths (``path``); only paths are compared."""
    todo = plan.select("dest").join(existing.select(F.col("path").alias("dest")).distinct(), "dest", "left_anti")
    return plan.join(todo.distinct(), "dest", "left_semi")


def split_report(plan: DataFrame, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """(bucket, n_docs, moved, skipped) of a split run against existing targets."""
    there = existing.select(F.col("path").alias("dest")).distinct().withColumn("_there", F.lit(True))
    skip = F.col("_there").isNotNull() & F.lit(not overwrite)
    return plan.select("dest", "bucket").join(there, "dest", "left").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if(~skip).alias("moved"), F.count_if(skip).alias("skipped"))
