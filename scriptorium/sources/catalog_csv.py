"""Catalog CSV and talk-document JSON sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lineage import LINEAGE_TYPE
from ..operators.catalog import check_headers
from .csv_records import read_records


def read_catalog_csv(spark: SparkSession, path: str, row_limit: int | None = None) -> DataFrame:
    """UTF-8 (BOM dropped) CSV with a header, quoted multi-line fields, all strings.

    Adds ``src_row``: the 1-based row number over all files in name order, so
    names of rows without an id never meet and the later row of a repeated id
    wins.  Large files are read by many tasks (:mod:`.csv_records`).
    ``row_limit`` keeps the first rows of the whole input.
    """
    header = (
        spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        .option("encoding", "UTF-8").option("mode", "PERMISSIVE").csv(path).columns
    )
    if not header:
        raise ValueError("CSV file contains no headers.")
    check_headers(header)
    df = read_records(spark, path, header)
    return df if row_limit is None else df.where(F.col("src_row") <= row_limit)


TALK_SCHEMA = T.StructType(
    [T.StructField(k, T.StringType()) for k in (
        "id", "date", "catalogId", "koanCase", "location", "title", "caption", "speaker",
        "koanCollection", "track", "duration", "trainingQuarter", "audioUrl", "summary")]
    + [T.StructField("tags", T.ArrayType(T.StringType())),
       T.StructField("dataLineage", T.StringType()),
       T.StructField("transcript", T.StringType())]
)


def parse_lineage(raw_json_col: str = "dataLineage"):
    """Raw JSON list of strings or {stage, likeness} objects -> ARRAY<STRUCT>."""
    items = F.from_json(F.col(raw_json_col), "array<string>")
    return F.transform(
        items,
        lambda x: F.when(
            x.startswith("{"),
            F.struct(F.get_json_object(x, "$.stage").alias("stage"),
                     F.get_json_object(x, "$.likeness").cast("double").alias("likeness")),
        ).otherwise(F.struct(x.alias("stage"), F.lit(None).cast("double").alias("likeness"))),
    ).cast(LINEAGE_TYPE)


def read_talk_documents(spark: SparkSession, directory: str) -> DataFrame:
    """One pretty/compact JSON object per ``*.json`` file; invalid JSON fails the read.

    Keys outside the schema are kept in ``extra`` (key -> JSON text) and go out
    again with the export.
    """
    df = spark.read.option("pathGlobFilter", "*.json").text(directory, wholetext=True)
    known = F.from_json("value", TALK_SCHEMA, {"mode": "FAILFAST"})
    every = F.from_json("value", "map<string,variant>", {"mode": "FAILFAST"})
    extra = F.transform_values(F.map_filter(every, lambda k, _: ~k.isin(*TALK_SCHEMA.names)), lambda _, v: F.to_json(v))
    df = df.select(
        known.alias("doc"), extra.alias("extra"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1).alias("safe_name"),
    ).select("doc.*", "extra", "safe_name")
    return df.withColumn("dataLineage", parse_lineage("dataLineage"))
