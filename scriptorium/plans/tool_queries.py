"""Registered transform and manifest queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.editors import CountingEditor, tidy_punctuation_factory
from ..operators import manifest as MF
from ..operators import transform as TR
from ..sources.tables import corpus_documents, id_list_lines, read_table
from .corpus_queries import unwrap_sql

IN_ROOT, OUT_ROOT = "corpus", "cleaned"
DONE_SOURCES = ("error",)


BLANK = " \n "


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, and for each source a file of white space (the short cut of blank inputs)."""
    d = corpus_documents(spark, sf_dir).select(F.concat(F.lit(IN_ROOT + "/"), "path").alias("path"), "text")
    blank = read_table(spark, sf_dir, "documents").select("source").where("source is not null").distinct()
    return d.unionByName(blank.select(F.concat(F.lit(f"{IN_ROOT}/blank/"), "source", F.lit(".txt")).alias("path"), F.lit(BLANK).alias("text")))


def _existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs of an earlier run: every labelled document was already cleaned."""
    lab = read_table(spark, sf_dir, "labels")
    return lab.select(F.concat(F.lit(OUT_ROOT + "/"), F.col("doc_id").cast("string"), F.lit("_cleaned.txt"))
                      .alias("output_path"))


def _pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TR.pending_inputs(_inputs(spark, sf_dir), IN_ROOT, OUT_ROOT, ".txt", _existing(spark, sf_dir))


def pending_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pending(spark, sf_dir).select("path", "output_path")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TR.apply_transform(_pending(spark, sf_dir), tidy_punctuation_factory)


def transform_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select("path", "output_path", "status", "input_chars", "unwrapped_chars",
                                      "output_chars", "attempts", "error", "output")


def transform_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = TR.rollup(_log(spark, sf_dir))
    return r.select("files", "wrote", "errors", "input_chars", "unwrapped_chars", "output_chars",
                    "prompt_eval_count", "eval_count")


def transform_rollup_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rollup of a run whose calls return statistics, fail and are retried, with ``skip`` rows of finished work."""
    done = TR.skipped_inputs(_inputs(spark, sf_dir), IN_ROOT, OUT_ROOT, ".txt", _existing(spark, sf_dir))
    log = TR.apply_transform(_pending(spark, sf_dir), CountingEditor, retries=1).unionByName(done)
    return TR.rollup(log).select(
        "files", "wrote", "errors", "input_chars", "unwrapped_chars", "output_chars", "prompt_eval_count", "prompt_seconds",
        "eval_count", "gen_seconds", "prompt_tok_per_sec", "gen_tok_per_sec", (F.col("wall_seconds") > 0).alias("has_wall"),
        "skipped", "attempts",
    )


def transform_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of each document of a run with call statistics, failures and blank inputs."""
    log = TR.with_rates(TR.apply_transform(_pending(spark, sf_dir), CountingEditor, retries=1))
    return log.select("path", "status", "prompt_seconds", "prompt_tok_per_sec", "gen_seconds", "gen_tok_per_sec",
                      (F.col("out_chars_per_sec") > 0).alias("has_char_rate"))


def transform_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that are blank after unwrap: written empty, without a call."""
    return TR.skipped_blank(_pending(spark, sf_dir)).select("path", "output_path")


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MF.parse_ids(id_list_lines(spark, sf_dir))


def manifest_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MF.ids_by_source(_ids(spark, sf_dir))


def manifest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MF.id_totals(_ids(spark, sf_dir))


def manifest_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MF.cross_list_duplicates(_ids(spark, sf_dir))


def manifest_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MF.download_manifest(MF.pending_sources(_ids(spark, sf_dir), DONE_SOURCES))


QUERIES = {
    "pending_inputs": pending_inputs,
    "transform_metrics": transform_metrics,
    "transform_rollup": transform_rollup,
    "transform_rollup_calls": transform_rollup_calls,
    "transform_rates": transform_rates,
    "transform_blank": transform_blank,
    "manifest_by_source": manifest_by_source,
    "manifest_totals": manifest_totals,
    "manifest_duplicates": manifest_duplicates,
    "manifest_pending": manifest_pending,
}

PENDING_SQL = f"""
pend AS (
  SELECT '{IN_ROOT}/' || cast(doc_id AS varchar) || '.txt' AS path,
         '{OUT_ROOT}/' || cast(doc_id AS varchar) || '_cleaned.txt' AS output_path, coalesce(text, '') AS text
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
  UNION ALL
  SELECT DISTINCT '{IN_ROOT}/blank/' || source || '.txt', '{OUT_ROOT}/blank/' || source || '_cleaned.txt', ' ' || chr(10) || ' '
  FROM documents WHERE source IS NOT NULL
),
tr AS (
  SELECT path, output_path, text, {unwrap_sql('text')} AS unwrapped FROM pend
),
tr2 AS (
  SELECT *, CASE WHEN trim(unwrapped) = '' THEN '' ELSE regexp_replace(unwrapped, '\\s+([,.;:!?])', '\\1', 'g') END
    AS output FROM tr
)"""
IDS_SQL = "ids AS (SELECT event_type AS source, cast(user_id AS varchar) AS ref_id FROM events)"

ORACLES = {
    "pending_inputs": f"WITH {PENDING_SQL} SELECT path, output_path FROM pend",
    "transform_metrics": f"""WITH {PENDING_SQL}
      SELECT path, output_path, 'wrote' AS status, length(text) AS input_chars, length(unwrapped) AS unwrapped_chars,
             length(output) AS output_chars, CASE WHEN trim(unwrapped) = '' THEN 0 ELSE 1 END AS attempts,
             NULL::varchar AS error, output FROM tr2""",
    "transform_rollup": f"""WITH {PENDING_SQL}
      SELECT count(*) AS files, count(*) AS wrote, 0::BIGINT AS errors, cast(sum(length(text)) AS bigint) AS input_chars,
             cast(sum(length(unwrapped)) AS bigint) AS unwrapped_chars,
             cast(sum(length(output)) AS bigint) AS output_chars, 0::BIGINT AS prompt_eval_count,
             0::BIGINT AS eval_count FROM tr2""",
    "transform_rollup_calls": f"""WITH {PENDING_SQL},
      c AS (
        SELECT length(text) AS input_chars, length(unwrapped) AS unwrapped_chars, length(output) AS output_chars,
               trim(unwrapped) <> '' AS called FROM tr2),
      l AS (SELECT *, called AND unwrapped_chars % 7 = 0 AS failed, CASE WHEN NOT called THEN 0
                   WHEN unwrapped_chars % 7 = 0 OR unwrapped_chars % 5 = 0 THEN 2 ELSE 1 END AS attempts FROM c),
      s AS (SELECT count(*) AS skipped FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
      t AS (
        SELECT count(*) AS n, count(*) FILTER (NOT failed) AS wrote, count(*) FILTER (failed) AS errors,
               sum(input_chars) FILTER (NOT failed) AS input_chars, sum(unwrapped_chars) FILTER (NOT failed) AS unwrapped_chars,
               sum(output_chars) FILTER (NOT failed) AS output_chars, sum(unwrapped_chars) FILTER (called AND NOT failed) AS pe,
               sum(output_chars) FILTER (called AND NOT failed) AS ev, sum(attempts) AS attempts FROM l)
      SELECT n + skipped AS files, wrote, errors, cast(input_chars AS bigint) AS input_chars,
             cast(unwrapped_chars AS bigint) AS unwrapped_chars, cast(output_chars AS bigint) AS output_chars,
             cast(pe AS bigint) AS prompt_eval_count, pe::DOUBLE * 0.002 AS prompt_seconds, cast(ev AS bigint) AS eval_count,
             ev::DOUBLE * 0.004 AS gen_seconds, 500.0::DOUBLE AS prompt_tok_per_sec, 250.0::DOUBLE AS gen_tok_per_sec,
             true AS has_wall, skipped, cast(attempts AS bigint) AS attempts FROM t, s""",
    "transform_rates": f"""WITH {PENDING_SQL},
      c AS (SELECT path, length(unwrapped) AS n, length(output) AS m, trim(unwrapped) <> '' AS called FROM tr2),
      l AS (SELECT *, called AND n % 7 = 0 AS failed FROM c)
      SELECT path, CASE WHEN failed THEN 'error' ELSE 'wrote' END AS status,
             CASE WHEN called AND NOT failed THEN (n * 2000000)::DOUBLE / 1e9 END AS prompt_seconds,
             CASE WHEN called AND NOT failed THEN n::DOUBLE / ((n * 2000000)::DOUBLE / 1e9) END AS prompt_tok_per_sec,
             CASE WHEN called AND NOT failed AND m > 0 THEN (m * 4000000)::DOUBLE / 1e9 END AS gen_seconds,
             CASE WHEN called AND NOT failed AND m > 0 THEN m::DOUBLE / ((m * 4000000)::DOUBLE / 1e9) END AS gen_tok_per_sec,
             CASE WHEN NOT failed AND m > 0 THEN true END AS has_char_rate
      FROM l""",
    "transform_blank": f"WITH {PENDING_SQL} SELECT path, output_path FROM tr WHERE trim(unwrapped) = ''",
    "manifest_by_source": f"""WITH {IDS_SQL}
      SELECT source, count(*) AS n_ids, count(DISTINCT ref_id) AS n_distinct FROM ids GROUP BY source""",
    "manifest_totals": f"WITH {IDS_SQL} SELECT count(*) AS n_ids, count(DISTINCT ref_id) AS n_distinct FROM ids",
    "manifest_duplicates": f"""WITH {IDS_SQL}
      SELECT ref_id, count(DISTINCT source) AS n_lists, count(*) AS n_rows FROM ids GROUP BY ref_id
      HAVING count(DISTINCT source) > 1""",
    "manifest_pending": f"""WITH {IDS_SQL}
      SELECT source, ref_id, 'https://media.example.org/download?direct=1&ref=' || ref_id || '&ext=mp3' AS url,
             ref_id || '.mp3' AS file_name FROM ids WHERE source NOT IN ('error')""",
}
