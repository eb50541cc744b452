"""Batch text transform: skip finished work, unwrap, call a user function, measure.

The model call of the original tool is any Python callable ``fn(text) ->
str | (str, stats)`` supplied by the user (no client ships here).  It runs in
``mapInPandas``: one callable instance per task, retried on the given error
types; blank input after unwrap never reaches it.  An explicit partition count
caps how many calls run at once against a shared service.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from urllib.error import URLError

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import cleaned_output_path
from ..functions.text import is_blank, unwrap_text
from . import runs

STATS_TYPE = T.StructType([
    T.StructField("prompt_eval_count", T.LongType()),
    T.StructField("prompt_eval_duration", T.LongType()),
    T.StructField("eval_count", T.LongType()),
    T.StructField("eval_duration", T.LongType()),
    T.StructField("total_duration", T.LongType()),
])
RESULT_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("output_path", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("input_chars", T.LongType()),
    T.StructField("unwrapped_chars", T.LongType()),
    T.StructField("output_chars", T.LongType()),
    T.StructField("started", T.DoubleType()),
    T.StructField("elapsed", T.DoubleType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("stats", STATS_TYPE),
    T.StructField("output", T.StringType()),
])


def pending_inputs(
    inputs: DataFrame,
    input_root: str,
    output_root: str,
    ext: str = ".txt",
    existing_outputs: DataFrame | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """Inputs whose output does not exist yet (anti-join on the output listing).

    ``existing_outputs`` is a listing (``output_path`` only).  The anti-join
    runs on paths alone; texts are then picked by the paths that are left.
    """
    df = inputs.withColumn("output_path", cleaned_output_path("path", input_root, output_root, ext))
    if existing_outputs is None or overwrite:
        return df
    todo = df.select("output_path").join(existing_outputs.select("output_path").distinct(), "output_path", "left_anti")
    return df.join(todo.distinct(), "output_path", "left_semi")


def skipped_inputs(inputs: DataFrame, input_root: str, output_root: str, ext: str, existing_outputs: DataFrame) -> DataFrame:
    """``skip`` rows of the log: inputs whose output exists (paths only)."""
    paths = inputs.select("path", cleaned_output_path("path", input_root, output_root, ext).alias("output_path"))
    done = paths.join(existing_outputs.select("output_path").distinct(), "output_path", "left_semi")
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA.fields}
    own = {"path": F.col("path"), "output_path": F.col("output_path"), "status": F.lit("skip").alias("status"),
           "attempts": F.lit(0).alias("attempts")}
    return done.select(*[own.get(n, c) for n, c in empty.items()])


def attempted(fn: Callable, text: str, tries: int, retry_on: tuple[type[BaseException], ...]) -> tuple:
    """(result, calls made, last error or None) of at most ``tries`` calls; other errors pass through."""
    error = None
    for calls in range(1, tries + 1):
        try:
            return fn(text), calls, None
        except retry_on as caught:
            error = f"{type(caught).__name__}: {caught}"
    return None, tries, error


def _runner(fn_factory: Callable[[], Callable], retries: int, retry_on: tuple[type[BaseException], ...]):
    def one(fn: Callable, path: str, output_path: str, input_chars: int, unwrapped: str) -> dict:
        started, clock = time.time(), time.perf_counter()
        result, calls, error = ("", 0, None) if not unwrapped.strip() else attempted(fn, unwrapped, retries + 1, retry_on)
        text, stats = result if isinstance(result, tuple) else (result, None)
        return {
            "path": path, "output_path": output_path, "status": "wrote" if error is None else "error",
            "input_chars": input_chars, "unwrapped_chars": len(unwrapped), "output_chars": len(text or ""),
            "started": started, "elapsed": time.perf_counter() - clock, "attempts": calls, "error": error,
            "stats": stats and {k: stats.get(k) for k in STATS_TYPE.names}, "output": text,
        }

    def run(batches):
        fn = fn_factory()
        for pdf in batches:
            rows = zip(pdf["path"], pdf["output_path"], pdf["input_chars"], pdf["unwrapped"])
            yield pd.DataFrame([one(fn, *r) for r in rows], columns=RESULT_SCHEMA.names)
    return run


def apply_transform(
    pending: DataFrame,
    fn_factory: Callable[[], Callable],
    retries: int = 0,
    retry_on: tuple[type[BaseException], ...] = (TimeoutError, URLError),
    concurrency: int | None = None,
) -> DataFrame:
    """``transform_log`` rows (plus the output text) for every pending input.

    ``fn_factory`` builds the callable once per task (client set-up outside
    the per-row loop).  Attempts are ``retries + 1`` at most; other errors
    fail the task, and Spark's task retry re-runs it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = pending.select("path", "output_path", F.length(text).cast("long").alias("input_chars"),
                        F.coalesce(unwrap_text("text"), F.lit("")).alias("unwrapped"))
    if concurrency:
        df = df.repartition(concurrency)
    return df.mapInPandas(_runner(fn_factory, retries, retry_on), RESULT_SCHEMA)


def skipped_blank(pending: DataFrame) -> DataFrame:
    """Inputs that are blank after unwrap (written as empty, no call)."""
    return pending.where(is_blank(unwrap_text("text")))


def with_rates(log: DataFrame) -> DataFrame:
    """Per-document throughput: chars/s (truncated), token rates from ns durations."""
    el = F.greatest(F.col("elapsed"), F.lit(1e-6))
    s = F.col("stats")
    pe = F.nullif(s.getField("prompt_eval_duration"), F.lit(0)) / 1e9
    ev = F.nullif(s.getField("eval_duration"), F.lit(0)) / 1e9
    return log.withColumns({
        "out_chars_per_sec": F.when(F.col("output_chars") > 0, F.floor(F.col("output_chars") / el)).cast("long"),
        "prompt_seconds": pe,
        "prompt_tok_per_sec": F.try_divide(s.getField("prompt_eval_count"), pe),
        "gen_seconds": ev,
        "gen_tok_per_sec": F.try_divide(s.getField("eval_count"), ev),
        "model_seconds": s.getField("total_duration") / 1e9,
    })


def rollup(log: DataFrame) -> DataFrame:
    """Run totals over written documents; rates are ratios of sums; wall clock is
    last end minus first start (never a sum of per-document times)."""
    w = F.col("status") == "wrote"
    s = F.col("stats")

    def wsum(c):
        return F.sum(F.when(w, c)).cast("long")

    agg = log.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(w).alias("wrote"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(F.col("status") == "skip").alias("skipped"),
        F.coalesce(F.sum("attempts"), F.lit(0)).cast("long").alias("attempts"),
        F.coalesce(wsum(F.col("input_chars")), F.lit(0)).alias("input_chars"),
        F.coalesce(wsum(F.col("unwrapped_chars")), F.lit(0)).alias("unwrapped_chars"),
        F.coalesce(wsum(F.col("output_chars")), F.lit(0)).alias("output_chars"),
        F.coalesce(wsum(s.getField("prompt_eval_count")), F.lit(0)).alias("prompt_eval_count"),
        F.coalesce(F.sum(F.when(w, s.getField("prompt_eval_duration"))) / 1e9, F.lit(0.0)).alias("prompt_seconds"),
        F.coalesce(wsum(s.getField("eval_count")), F.lit(0)).alias("eval_count"),
        F.coalesce(F.sum(F.when(w, s.getField("eval_duration"))) / 1e9, F.lit(0.0)).alias("gen_seconds"),
        (F.max(F.col("started") + F.col("elapsed")) - F.min("started")).alias("wall_seconds"),
    )
    wall = F.greatest(F.col("wall_seconds"), F.lit(1e-6))
    return agg.withColumns({
        "out_chars_per_sec": F.when(F.col("output_chars") > 0, F.floor(F.col("output_chars") / wall)).cast("long"),
        "prompt_tok_per_sec": F.when(F.col("prompt_seconds") > 0, F.col("prompt_eval_count") / F.col("prompt_seconds")),
        "gen_tok_per_sec": F.when(F.col("gen_seconds") > 0, F.col("eval_count") / F.col("gen_seconds")),
    })


def any_error(log: DataFrame) -> DataFrame:
    return log.agg(F.coalesce(F.bool_or(F.col("status") == "error"), F.lit(False)).alias("had_error"))


def raise_on_error(log: DataFrame) -> None:
    """Fail the run after all documents were tried; ``log`` is a written table (a lazy one would call again)."""
    if not log.where(F.col("status") == "error").isEmpty():
        raise RuntimeError("one or more documents failed to transform")


def write_outputs(log: DataFrame, path: str, mode: str = "append") -> None:
    """Written texts keyed by output path (Parquet), outside a ledger; reruns skip them via the listing."""
    log.where(F.col("status") == "wrote").select("output_path", "output").write.mode(mode).parquet(path)


def run_transform(
    inputs: DataFrame,
    input_root: str,
    output_root: str,
    fn_factory: Callable[[], Callable],
    out_dir: str,
    ext: str = ".txt",
    existing_outputs: DataFrame | None = None,
    overwrite: bool = False,
    fail: bool = True,
    run_id: str | None = None,
    **calls,
) -> tuple[DataFrame, DataFrame]:
    """(log, totals) of one run: skip finished work, call once per document, commit
    the run to the ledger at ``out_dir`` (:mod:`.runs`), then fail if a document failed.

    Finished work is what whole runs in the ledger wrote, and ``existing_outputs``
    (a listing) beside it.  Log, totals and the check are those of this run alone:
    a run after a failed one tries the failed documents again and succeeds if they
    do.  ``overwrite`` does everything again; the new outputs replace the earlier
    ones in :func:`.runs.current_outputs`.
    """
    spark = inputs.sparkSession
    done = runs.finished_outputs(spark, out_dir)
    if existing_outputs is not None:
        done = done.unionByName(existing_outputs.select("output_path"))
    pending = pending_inputs(inputs, input_root, output_root, ext, done, overwrite)
    log = apply_transform(pending, fn_factory, **calls)
    if not overwrite:
        log = log.unionByName(skipped_inputs(inputs, input_root, output_root, ext, done))
    log = runs.write_run(log, out_dir, run_id or runs.new_run_id())
    if fail:
        raise_on_error(log)
    return log, rollup(log)
