"""Ledger of transform runs: what each run wrote, and which runs are whole.

A run writes its log and its outputs into partitions named by its ``run_id`` and
then one marker row into ``runs``.  Only runs with a marker count, so what a run
that died has written is never read.  A run whose documents partly failed is whole:
it has its marker, its log says which failed, and the next run tries those again.
The current output of a path is the one of the latest whole run that wrote it.

Layout under ``out_dir``: ``log/run_id=...``, ``outputs/run_id=...`` and
``runs/run_id=...``.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKER = "number long, committed double, files long, wrote long, errors long"


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The table at ``path`` with its ``run_id``, empty where nothing was written yet."""
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    named = T.StructType([*columns.fields, T.StructField("run_id", T.StringType())])
    try:
        return spark.read.schema(named).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], named)


def committed_runs(spark: SparkSession, out_dir: str) -> DataFrame:
    """(run_id, number, committed, files, wrote, errors) of every whole run."""
    return _read(spark, f"{out_dir}/runs", MARKER).select("run_id", *T.StructType.fromDDL(MARKER).names)


def run_log(spark: SparkSession, out_dir: str, run_id: str, schema: T.StructType) -> DataFrame:
    """The log rows of one run; other runs' files are not listed."""
    return spark.read.schema(schema).parquet(f"{out_dir}/log/run_id={run_id}")


def _outputs(spark: SparkSession, out_dir: str) -> DataFrame:
    return _read(spark, f"{out_dir}/outputs", "output_path string, output string")


def _latest(spark: SparkSession, out_dir: str) -> DataFrame:
    """(output_path, run_id) of the current outputs; paths only, no text is read."""
    runs = committed_runs(spark, out_dir).select("run_id", "number")
    keys = _outputs(spark, out_dir).select("output_path", "run_id").join(runs, "run_id")
    return keys.groupBy("output_path").agg(F.max_by("run_id", F.struct("number", "run_id")).alias("run_id"))


def finished_outputs(spark: SparkSession, out_dir: str) -> DataFrame:
    """(output_path) that some whole run wrote: what a rerun may skip."""
    return _latest(spark, out_dir).select("output_path")


def current_outputs(spark: SparkSession, out_dir: str) -> DataFrame:
    """(output_path, output, run_id): each path once, as its latest whole run wrote it."""
    return _outputs(spark, out_dir).join(_latest(spark, out_dir), ["output_path", "run_id"]).select("output_path", "output", "run_id")


def new_run_id() -> str:
    return uuid.uuid4().hex


def is_committed(spark: SparkSession, out_dir: str, run_id: str) -> bool:
    return not committed_runs(spark, out_dir).where(F.col("run_id") == run_id).isEmpty()


def write_run(log: DataFrame, out_dir: str, run_id: str) -> DataFrame:
    """Write one run and commit it; ``log`` is computed once, all else reads it back.

    Returns the run's log.  Without a marker a second call for the same
    ``run_id`` replaces what the first one left.
    """
    spark, schema = log.sparkSession, log.schema
    log.write.mode("overwrite").parquet(f"{out_dir}/log/run_id={run_id}")
    own = run_log(spark, out_dir, run_id, schema)
    own.where(F.col("status") == "wrote").select("output_path", "output").write.mode("overwrite").parquet(f"{out_dir}/outputs/run_id={run_id}")
    number = committed_runs(spark, out_dir).agg(F.coalesce(F.max("number"), F.lit(0))).first()[0] + 1
    marker = own.agg(
        F.lit(number).cast("long").alias("number"), F.lit(time.time()).alias("committed"), F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("status") == "wrote").alias("wrote"), F.count_if(F.col("status") == "error").alias("errors"),
    )
    marker.write.mode("overwrite").parquet(f"{out_dir}/runs/run_id={run_id}")
    return own
