"""Registered catalog queries: validate, rename, name files, normalise, enrich."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as K
from ..sources.tables import catalog_rows

SCALAR_TALK_COLS = K.KEPT_KEYS + ["audioUrl", "summary"]


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.validate(catalog_rows(spark, sf_dir))


def catalog_talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = K.latest_per_name(K.to_talks(_validated(spark, sf_dir), "enforce"))
    return talks.select("safe_name", *SCALAR_TALK_COLS, "src_row", "n_rows",
                        F.size("tags").alias("n_tags"), F.size("dataLineage").alias("n_lineage"))


def catalog_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.quarantine(_validated(spark, sf_dir))


def catalog_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.ingest_counters(_validated(spark, sf_dir), "enforce")


def catalog_log_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = K.latest_per_name(K.to_talks(_validated(spark, sf_dir), "log_only"))
    return talks.select("safe_name", "id", "title", "missing", "src_row", "n_rows")


def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.to_talks(_validated(spark, sf_dir), "log_only").select("src_row", "id", "safe_name")


def latest_per_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = K.latest_per_name(K.to_talks(_validated(spark, sf_dir), "enforce"))
    return t.where(F.col("n_rows") > 1).select("safe_name", "id", "src_row", "n_rows")


def _talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.latest_per_name(K.to_talks(_validated(spark, sf_dir), "enforce"))


def duration_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.normalize_durations(_talks(spark, sf_dir)).select(
        "safe_name", "duration_before", "duration", "duration_changed")


def duration_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.stage_counters(K.normalize_durations(_talks(spark, sf_dir)), "duration_changed")


def audio_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = K.add_audio_urls(_talks(spark, sf_dir))
    return t.select("safe_name", "id", "audioUrl", "audio_reason")


def audio_urls_log_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With invalid rows kept, talks without an id are skipped with their reason."""
    talks = K.latest_per_name(K.to_talks(_validated(spark, sf_dir), "log_only"))
    return K.add_audio_urls(talks).select("safe_name", "id", "audioUrl", "audio_reason")


def _catalog_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in catalog written in row order to several CSV files (doubled
    quotes, header) of the shared folder and read back through the CSV source."""
    import uuid

    from ..session import scratch_path
    from ..sources.catalog_csv import read_catalog_csv

    path = scratch_path(spark, f"catalog-csv-{uuid.uuid4().hex[:12]}")
    rows = catalog_rows(spark, sf_dir).repartitionByRange(4, "src_row").sortWithinPartitions("src_row").drop("src_row")
    rows.write.option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).csv(path)
    return K.validate(read_catalog_csv(spark, path))


def catalog_csv_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.ingest_counters(_catalog_from_csv(spark, sf_dir), "enforce")


def catalog_csv_talks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-only ingest from several CSV files: no row without an id is lost."""
    talks = K.latest_per_name(K.to_talks(_catalog_from_csv(spark, sf_dir), "log_only"))
    return talks.select("safe_name", "id", "title", "src_row", "n_rows")


QUERIES = {
    "catalog_talks": catalog_talks,
    "catalog_invalid": catalog_invalid,
    "catalog_counters": catalog_counters,
    "catalog_csv_counters": catalog_csv_counters,
    "catalog_csv_talks": catalog_csv_talks,
    "catalog_log_only": catalog_log_only,
    "safe_names": safe_names,
    "latest_per_name": latest_per_name,
    "duration_normalized": duration_normalized,
    "duration_changed": duration_changed,
    "audio_urls": audio_urls,
    "audio_urls_log_only": audio_urls_log_only,
}

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------
WS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def sanitize_sql(x: str) -> str:
    v = f"replace({strip_sql(x)}, '/', '_')"
    v = f"regexp_replace({v}, '[^A-Za-z0-9._-]+', '_', 'g')"
    v = f"regexp_replace({v}, '_+', '_', 'g')"
    v = f"regexp_replace({v}, '^_+|_+$', '', 'g')"
    return f"(CASE WHEN coalesce({v}, '') = '' THEN 'missing-id' ELSE {v} END)"


CATALOG_SQL = f"""
raw_catalog AS (
  SELECT d.doc_id + 1 AS src_row,
    CASE WHEN l.toxic = 1 THEN '' WHEN d.lang = 'es' THEN 'ES/' || cast(d.doc_id // 10 AS varchar)
         WHEN d.lang = 'de' THEN '  ' || cast(d.doc_id AS varchar) || ' ' ELSE cast(d.doc_id AS varchar) END AS rid,
    CASE WHEN l.quality = 0 THEN '' ELSE split_part(d.text, chr(10), 1) END AS rtitle,
    d.source AS rspeaker, d.lang AS rlocation,
    CASE WHEN d.lang IN ('en', 'fr') THEN cast(d.n_chars AS varchar) || ' (approx)' ELSE cast(d.n_chars AS varchar) END
      AS rduration
  FROM documents d LEFT JOIN labels l USING (doc_id)
),
validated AS (
  SELECT src_row, {strip_sql('rid')} AS id, {strip_sql('rtitle')} AS title, {strip_sql('rspeaker')} AS speaker,
    {strip_sql('rspeaker')} AS catalogId, {strip_sql('rlocation')} AS location, {strip_sql('rduration')} AS duration
  FROM raw_catalog
),
checked AS (
  SELECT *, concat_ws(', ', CASE WHEN coalesce(id, '') = '' THEN 'resource id' END,
                            CASE WHEN coalesce(title, '') = '' THEN 'title' END) AS missing
  FROM validated
),
named AS (
  SELECT *, {sanitize_sql("CASE WHEN id = '' THEN 'missing-id-row-' || cast(src_row AS varchar) ELSE id END")}
    AS safe_name FROM checked
),
talks AS (
  SELECT safe_name, arg_max(id, src_row) AS id, arg_max(title, src_row) AS title, arg_max(speaker, src_row) AS speaker,
         arg_max(catalogId, src_row) AS catalogId, arg_max(location, src_row) AS location,
         arg_max(duration, src_row) AS duration, max(src_row) AS src_row, count(*) AS n_rows
  FROM named WHERE missing = '' GROUP BY safe_name
)"""

ORACLES = {
    "catalog_talks": f"""WITH {CATALOG_SQL}
      SELECT safe_name, id, '' AS date, catalogId, '' AS koanCase, location, title, '' AS caption, speaker,
             '' AS koanCollection, '' AS track, duration, '' AS trainingQuarter, '' AS audioUrl, '' AS summary,
             src_row, n_rows, 0 AS n_tags, 0 AS n_lineage FROM talks""",
    "catalog_invalid": f"""WITH {CATALOG_SQL}
      SELECT src_row, id, title, missing FROM checked WHERE missing <> ''""",
    "catalog_counters": f"""WITH {CATALOG_SQL}
      SELECT count(*) FILTER (WHERE missing = '') AS written, count(*) FILTER (WHERE missing <> '') AS skipped,
             count(*) FILTER (WHERE missing <> '') AS missing_required,
             count(*) FILTER (WHERE missing LIKE '%title%') AS removed_missing_title FROM checked""",
    "catalog_log_only": f"""WITH {CATALOG_SQL}
      SELECT safe_name, arg_max(id, src_row) AS id, arg_max(title, src_row) AS title,
             arg_max(missing, src_row) AS missing, max(src_row) AS src_row, count(*) AS n_rows
      FROM named GROUP BY safe_name""",
    "catalog_csv_talks": f"""WITH {CATALOG_SQL}
      SELECT safe_name, arg_max(id, src_row) AS id, arg_max(title, src_row) AS title, max(src_row) AS src_row,
             count(*) AS n_rows FROM named GROUP BY safe_name""",
    "safe_names": f"""WITH {CATALOG_SQL} SELECT src_row, id, safe_name FROM named""",
    "latest_per_name": f"""WITH {CATALOG_SQL} SELECT safe_name, id, src_row, n_rows FROM talks WHERE n_rows > 1""",
    "duration_normalized": f"""WITH {CATALOG_SQL}
      SELECT safe_name, duration AS duration_before, {strip_sql("replace(duration, '(approx)', '')")} AS duration,
             duration IS DISTINCT FROM {strip_sql("replace(duration, '(approx)', '')")} AS duration_changed
      FROM talks""",
    "duration_changed": f"""WITH {CATALOG_SQL}
      SELECT CASE WHEN duration IS DISTINCT FROM {strip_sql("replace(duration, '(approx)', '')")}
                  THEN 'updated' ELSE 'skipped' END AS outcome, count(*) AS n FROM talks GROUP BY 1""",
    "audio_urls": f"""WITH {CATALOG_SQL}
      SELECT safe_name, id, 'https://media.example.org/download?direct=1&ref=' || {strip_sql('id')} || '&ext=mp3'
             AS audioUrl, 'updated' AS audio_reason FROM talks""",
    "audio_urls_log_only": f"""WITH {CATALOG_SQL}, kept AS (SELECT safe_name, arg_max(id, src_row) AS id FROM named GROUP BY safe_name)
      SELECT safe_name, id, CASE WHEN {strip_sql('id')} = '' THEN '' ELSE
               'https://media.example.org/download?direct=1&ref=' || {strip_sql('id')} || '&ext=mp3' END AS audioUrl,
             CASE WHEN {strip_sql('id')} = '' THEN 'missing id' ELSE 'updated' END AS audio_reason FROM kept""",
    "catalog_csv_counters": f"""WITH {CATALOG_SQL}
      SELECT count(*) FILTER (WHERE missing = '') AS written, count(*) FILTER (WHERE missing <> '') AS skipped,
             count(*) FILTER (WHERE missing <> '') AS missing_required,
             count(*) FILTER (WHERE missing LIKE '%title%') AS removed_missing_title FROM checked""",
}
