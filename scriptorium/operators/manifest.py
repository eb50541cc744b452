"""Id lists per speaker: parse, count, cross-list duplicates, download manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import DEFAULT_AUDIO_URL_TEMPLATE, audio_url
from ..functions.text import py_strip


def read_id_lists(spark: SparkSession, directory: str) -> DataFrame:
    """(source, value) from ``<source>_talks.txt`` files, one value per line."""
    df = spark.read.option("pathGlobFilter", "*_talks.txt").text(directory)
    return df.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)_talks\.txt$", 1).alias("source"),
        F.col("value"),
    )


def parse_ids(lines: DataFrame) -> DataFrame:
    """Keep stripped all-digit lines (duplicates kept): ``ref_ids(source, ref_id)``."""
    v = py_strip("value")
    return lines.where(v.rlike(r"^\p{Nd}+$")).select("source", v.alias("ref_id"))


def ids_by_source(ref_ids: DataFrame) -> DataFrame:
    return ref_ids.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_ids"), F.count_distinct("ref_id").alias("n_distinct"))


def id_totals(ref_ids: DataFrame) -> DataFrame:
    return ref_ids.agg(F.count(F.lit(1)).alias("n_ids"), F.count_distinct("ref_id").alias("n_distinct"))


def cross_list_duplicates(ref_ids: DataFrame) -> DataFrame:
    """Ids that appear in more than one list (two-level aggregate, no pairs)."""
    per = ref_ids.groupBy("ref_id", "source").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("ref_id").agg(
        F.count(F.lit(1)).alias("n_lists"), F.sum("n").cast("long").alias("n_rows"),
    ).where(F.col("n_lists") > 1)


def pending_sources(ref_ids: DataFrame, done_sources: Sequence[str]) -> DataFrame:
    """Drop lists already transcribed (a short, user-given list of names)."""
    done = ref_ids.sparkSession.createDataFrame([(s,) for s in done_sources], "source string")
    return ref_ids.join(F.broadcast(done), "source", "left_anti")


def download_manifest(ref_ids: DataFrame, template: str = DEFAULT_AUDIO_URL_TEMPLATE) -> DataFrame:
    """One download row per listed id: URL and target file name."""
    return ref_ids.select("source", "ref_id", audio_url("ref_id", template).alias("url"),
                          F.concat("ref_id", F.lit(".mp3")).alias("file_name"))
