"""Registered incremental queries: available-now streams over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..streaming import incremental as I
from .corpus_queries import NONWS_RE2
from .merge_queries import EDITED_SQL


def incremental_token_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.incremental_token_sizes(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def incremental_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.incremental_edit_scores(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def incremental_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed as the quality log; latest entry per (version, talk_id)."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    stream = I.parquet_stream(spark, path, spark.read.parquet(path))
    log = stream.select(
        F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("path_ordinal"),
        F.col("event_id").alias("line"),
        F.when((F.col("event_type") == "error") & (F.col("value") < 5), F.lit(None).cast("string"))
        .otherwise(F.col("user_id").cast("string")).alias("talk_id"),
        F.when(F.col("value") >= 90, "succeeded").otherwise("failed").alias("status"),
        F.when(F.col("value") < 1, F.lit(None).cast("double"))
        .otherwise(F.least(F.col("value") / 100.0, F.lit(1.0))).alias("likeness"),
        F.col("event_type").alias("model_version"),
    ).where(Q.valid_talk())
    out, ckpt = I.run_dir(spark, "latest")
    I.start_latest_entries(log, out, ckpt).awaitTermination()
    return I.read_latest(spark, out).select("model_version", "talk_id", "status", "likeness", "n_entries")


QUERIES = {
    "incremental_token_sizes": incremental_token_sizes,
    "incremental_scores": incremental_scores,
    "incremental_latest": incremental_latest,
}

ORACLES = {
    "incremental_scores": f"""WITH {EDITED_SQL} SELECT pair_id, cast(score AS double) AS likeness FROM es""",
    "incremental_token_sizes": f"""SELECT doc_id, len(regexp_extract_all(text, '{NONWS_RE2}+', 0)) AS words,
        cast(round(len(regexp_extract_all(text, '{NONWS_RE2}+', 0)) * 4 / 3.0) AS bigint) AS tokens
      FROM documents""",
    "incremental_latest": """
      SELECT event_type AS model_version, cast(user_id AS varchar) AS talk_id,
             CASE WHEN value >= 90 THEN 'succeeded' ELSE 'failed' END AS status,
             CASE WHEN value < 1 THEN NULL ELSE least(value / 100.0, 1.0) END AS likeness,
             count(*) OVER (PARTITION BY event_type, user_id) AS n_entries
      FROM events WHERE NOT (event_type = 'error' AND value < 5)
      QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) = 1""",
}
