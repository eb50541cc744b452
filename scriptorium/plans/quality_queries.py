"""Registered quality-log queries over the events stand-in (one log file per day)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality as Q
from ..sources.tables import quality_log_rows

TOP_LIMIT = 10
PARSER_THRESHOLD = 0.95
# A ``VERSION=PATH`` override as given on the command line.
OVERRIDE = {"quality_2024-01-01.log": "click"}


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_log_rows(spark, sf_dir)


def _latest(spark: SparkSession, sf_dir: str, version_map: DataFrame | None = None) -> DataFrame:
    return Q.latest_entries(Q.prepared_entries(_log(spark, sf_dir), version_map))


def _override(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(OVERRIDE.items()), "source_path string, version string")


def log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir)


def version_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.version_summary(_latest(spark, sf_dir))


def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.log_summary(_log(spark, sf_dir))


def log_summary_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.log_summary(_log(spark, sf_dir), threshold=PARSER_THRESHOLD)


def log_summary_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-log report over all entries as one log."""
    return Q.log_summary(_log(spark, sf_dir), by=())


def accuracy_histogram_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.accuracy_histogram(_log(spark, sf_dir), by=())


def accuracy_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.accuracy_histogram(_log(spark, sf_dir))


def version_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.compare_versions(Q.version_pairs(_latest(spark, sf_dir)))


def top_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.top_changes(Q.version_pairs(_latest(spark, sf_dir)), "regression", TOP_LIMIT)


def top_improvements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.top_changes(Q.version_pairs(_latest(spark, sf_dir)), "improvement", TOP_LIMIT)


def version_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version summary with the printed ``%.4f`` / ``N/A`` columns."""
    return Q.summary_report(Q.version_summary(_latest(spark, sf_dir)))


def log_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.warnings(_log(spark, sf_dir))


def version_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.version_summary(_latest(spark, sf_dir, _override(spark)))


def override_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Q.warnings(_log(spark, sf_dir), _override(spark))
    return w.where(w.kind == "version_override")


QUERIES = {
    "log_latest": log_latest,
    "version_summary": version_summary,
    "log_summary": log_summary,
    "log_summary_threshold": log_summary_threshold,
    "log_summary_all": log_summary_all,
    "accuracy_histogram": accuracy_histogram,
    "accuracy_histogram_all": accuracy_histogram_all,
    "version_compare": version_compare,
    "top_regressions": top_regressions,
    "top_improvements": top_improvements,
    "version_report": version_report,
    "log_warnings": log_warnings,
    "version_override": version_override,
    "override_warnings": override_warnings,
}

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------
LOG_SQL = """
qlog AS (
  SELECT 'quality_' || cast(cast(ts AS date) AS varchar) || '.log' AS source_path,
         cast(date_diff('day', DATE '2024-01-01', cast(ts AS date)) AS INTEGER) AS path_ordinal,
         event_id - min(event_id) OVER (PARTITION BY cast(ts AS date)) + 1 AS line,
         CASE WHEN event_type = 'error' AND value < 5 THEN NULL ELSE cast(user_id AS varchar) END AS talk_id,
         CASE WHEN value >= 90 THEN 'succeeded' ELSE 'failed' END AS status,
         CASE WHEN value < 1 THEN NULL ELSE least(value / 100.0, 1.0) END AS likeness,
         CASE WHEN value >= 90 THEN cast(user_id AS varchar) || '_cleaned.txt'
              ELSE cast(user_id AS varchar) || '.txt' END AS selected_file,
         event_type AS raw_version
  FROM events
)"""


def _versioned(override: bool) -> str:
    if not override:
        ver = "coalesce(nullif(raw_version, ''), 'unknown')"
    else:
        cases = " ".join(f"WHEN source_path = '{p}' THEN '{v}'" for p, v in OVERRIDE.items())
        ver = f"coalesce(CASE {cases} END, nullif(raw_version, ''), 'unknown')"
    return f"""
ventries AS (SELECT *, {ver} AS model_version FROM qlog WHERE talk_id IS NOT NULL AND talk_id <> ''),
latest AS (
  SELECT model_version, talk_id, status, likeness, selected_file, source_path, path_ordinal, line,
         count(*) OVER (PARTITION BY model_version, talk_id) AS n_entries
  FROM ventries
  QUALIFY row_number() OVER (PARTITION BY model_version, talk_id ORDER BY path_ordinal DESC, line DESC) = 1
)"""


SUMMARY_SELECT = """
  SELECT model_version, count(*) AS total, count(*) FILTER (WHERE status = 'succeeded') AS successes,
         count(*) FILTER (WHERE status = 'succeeded') / count(*) AS success_rate,
         count(likeness) AS likeness_count, avg(likeness) AS avg_likeness, median(likeness) AS median_likeness
  FROM latest GROUP BY model_version"""

PAIRS_SQL = """
base AS (SELECT min(model_version) AS v FROM latest),
pairs AS (
  SELECT b.talk_id, b.model_version AS base_version, b.likeness AS base_likeness, b.status AS base_status,
         o.model_version AS other_version, o.likeness AS other_likeness, o.status AS other_status,
         (b.likeness IS NOT NULL AND o.likeness IS NOT NULL) AS compared,
         CASE WHEN b.likeness IS NOT NULL AND o.likeness IS NOT NULL THEN o.likeness - b.likeness END AS delta
  FROM latest b JOIN latest o ON b.talk_id = o.talk_id
  WHERE b.model_version = (SELECT v FROM base) AND o.model_version <> (SELECT v FROM base)
)"""


def _top(direction: str) -> str:
    cond, order = ("delta < 0", "delta ASC") if direction == "regression" else ("delta > 0", "delta DESC")
    return f"""WITH {LOG_SQL}, {_versioned(False)}, {PAIRS_SQL}
      SELECT base_version, other_version,
             cast(row_number() OVER (PARTITION BY base_version, other_version ORDER BY {order}, talk_id) AS int) AS rank,
             talk_id, base_likeness, other_likeness, delta,
             coalesce(base_status, 'None') || ' -> ' || coalesce(other_status, 'None') AS status_change
      FROM pairs WHERE {cond}
      QUALIFY row_number() OVER (PARTITION BY base_version, other_version ORDER BY {order}, talk_id) <= {TOP_LIMIT}"""


def _parser(threshold: float | None) -> str:
    ok = "status = 'succeeded'" if threshold is None else f"coalesce(likeness >= {threshold}, false)"
    return f"""WITH {LOG_SQL}
      SELECT source_path, count(likeness) AS entries, count(*) FILTER (WHERE {ok}) AS successes,
             CASE WHEN count(likeness) > 0 THEN count(*) FILTER (WHERE {ok}) / count(likeness) END AS success_rate,
             avg(likeness) AS avg_likeness, median(likeness) AS median_likeness
      FROM qlog GROUP BY source_path"""


ORACLES = {
    "log_latest": f"WITH {LOG_SQL}, {_versioned(False)} SELECT * FROM latest",
    "version_summary": f"WITH {LOG_SQL}, {_versioned(False)} {SUMMARY_SELECT}",
    "log_summary": _parser(None),
    "log_summary_threshold": _parser(PARSER_THRESHOLD),
    "log_summary_all": f"""WITH {LOG_SQL}
      SELECT count(likeness) AS entries, count(*) FILTER (WHERE status = 'succeeded') AS successes,
             count(*) FILTER (WHERE status = 'succeeded') / count(likeness) AS success_rate,
             avg(likeness) AS avg_likeness, median(likeness) AS median_likeness
      FROM qlog""",
    "accuracy_histogram_all": f"""WITH {LOG_SQL},
      binned AS (
        SELECT CASE WHEN p = 100 THEN 10 ELSE p // 10 END AS bin
        FROM (SELECT least(greatest(cast(trunc(likeness * 100) AS int), 0), 100) AS p FROM qlog WHERE likeness IS NOT NULL))
      SELECT cast(x.bin AS int) AS bin,
             CASE WHEN x.bin = 10 THEN '100%' ELSE lpad(cast(x.bin * 10 AS varchar), 2, '0') || '-'
                  || lpad(cast(x.bin * 10 + 9 AS varchar), 2, '0') || '%' END AS label,
             count(y.bin) AS n
      FROM range(11) x(bin) LEFT JOIN binned y ON x.bin = y.bin GROUP BY x.bin""",
    "accuracy_histogram": f"""WITH {LOG_SQL},
      files AS (SELECT DISTINCT source_path FROM qlog),
      bins AS (SELECT source_path, b.bin FROM files, range(11) b(bin)),
      binned AS (
        SELECT source_path,
               CASE WHEN least(greatest(cast(trunc(likeness * 100) AS int), 0), 100) = 100 THEN 10
                    ELSE least(greatest(cast(trunc(likeness * 100) AS int), 0), 100) // 10 END AS bin
        FROM qlog WHERE likeness IS NOT NULL)
      SELECT x.source_path, cast(x.bin AS int) AS bin,
             CASE WHEN x.bin = 10 THEN '100%' ELSE lpad(cast(x.bin * 10 AS varchar), 2, '0') || '-'
                  || lpad(cast(x.bin * 10 + 9 AS varchar), 2, '0') || '%' END AS label,
             count(y.bin) AS n
      FROM bins x LEFT JOIN binned y ON x.source_path = y.source_path AND x.bin = y.bin
      GROUP BY x.source_path, x.bin""",
    "version_compare": f"""WITH {LOG_SQL}, {_versioned(False)}, {PAIRS_SQL}
      SELECT base_version, other_version, count(*) AS matched, count(*) FILTER (WHERE compared) AS compared,
             count(*) FILTER (WHERE compared AND delta > 0) AS improved,
             count(*) FILTER (WHERE compared AND delta < 0) AS regressed,
             count(*) FILTER (WHERE compared AND delta = 0) AS unchanged,
             count(*) FILTER (WHERE compared AND coalesce(base_status = 'succeeded', false)
                              AND NOT coalesce(other_status = 'succeeded', false)) AS success_to_fail,
             count(*) FILTER (WHERE compared AND NOT coalesce(base_status = 'succeeded', false)
                              AND coalesce(other_status = 'succeeded', false)) AS fail_to_success,
             count(*) FILTER (WHERE NOT compared) AS skipped_missing,
             avg(delta) AS avg_delta, median(delta) AS median_delta
      FROM pairs GROUP BY base_version, other_version""",
    "top_regressions": _top("regression"),
    "top_improvements": _top("improvement"),
    "log_warnings": f"""WITH {LOG_SQL}, {_versioned(False)},
      firsts AS (SELECT model_version, talk_id, min(cast(path_ordinal AS BIGINT) * 100000000 + line) AS f FROM ventries GROUP BY ALL)
      SELECT source_path, line, 'missing_talk_id' AS kind, 'missing talk_id, skipping' AS detail
        FROM qlog WHERE talk_id IS NULL OR talk_id = ''
      UNION ALL
      SELECT v.source_path, v.line, 'duplicate',
             'duplicate talk_id ''' || v.talk_id || ''' for version ''' || v.model_version
             || ''', overwriting prior entry'
      FROM ventries v JOIN firsts f USING (model_version, talk_id)
      WHERE cast(v.path_ordinal AS BIGINT) * 100000000 + v.line <> f.f""",
    "version_override": f"WITH {LOG_SQL}, {_versioned(True)} {SUMMARY_SELECT}",
    "override_warnings": f"""WITH {LOG_SQL}, {_versioned(True)}
      SELECT source_path, line, 'version_override' AS kind,
             'model_version ''' || raw_version || ''' overridden by --version ''' || model_version || '''' AS detail
      FROM ventries WHERE source_path IN ({", ".join(f"'{p}'" for p in OVERRIDE)})
        AND nullif(raw_version, '') IS NOT NULL AND raw_version <> model_version""",
    "version_report": f"""WITH {LOG_SQL}, {_versioned(False)}, summ AS ({SUMMARY_SELECT})
      SELECT *, coalesce(printf('%.4f', success_rate), 'N/A') AS success_rate_text,
             coalesce(printf('%.4f', avg_likeness), 'N/A') AS avg_likeness_text,
             coalesce(printf('%.4f', median_likeness), 'N/A') AS median_likeness_text FROM summ""",
}
