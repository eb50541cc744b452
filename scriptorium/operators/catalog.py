"""Catalog rows -> validated talk records, quarantine, counters, per-file last-wins.

Everything is one narrow projection over the catalog (validation, renaming,
defaults, file names); the only shuffle is the last-wins aggregation on the
sanitised file name, which aggregates partially before shuffling, so a hot
name costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lineage import LINEAGE_TYPE
from ..functions.naming import audio_url, normalize_duration, sanitize_for_filename
from ..functions.text import is_blank, py_strip

# Catalog header -> talk key (in export order), ignored headers,
# required headers with their labels.
FIELD_MAP = {
    "Resource ID(s)": "id",
    "Resource type": "resourceType",
    "Status": "status",
    "Contributed by": "contributedBy",
    "Date": "date",
    "Audio Library Catalog ID": "catalogId",
    "Koan Case #": "koanCase",
    "Talk Location": "location",
    "Title": "title",
    "Caption or Other Speaker": "caption",
    "Speaker": "speaker",
    "Koan Collection": "koanCollection",
    "Track": "track",
    "Genre": "genre",
    "Duration": "duration",
    "Training Quarter": "trainingQuarter",
}
IGNORED_FIELDS = ("Resource type", "Status", "Contributed by", "Genre")
ID_FIELD = "Resource ID(s)"
TITLE_FIELD = "Title"


# Required headers and how reports name them.
REQUIRED = {ID_FIELD: "resource id", TITLE_FIELD: "title"}

CATALOG_SCHEMA = T.StructType([T.StructField(h, T.StringType()) for h in FIELD_MAP])
KEPT_KEYS = [k for h, k in FIELD_MAP.items() if h not in IGNORED_FIELDS]
TALK_KEYS = KEPT_KEYS + ["audioUrl", "summary", "tags", "dataLineage"]


def check_headers(columns: Iterable[str], required: Mapping[str, str] = REQUIRED) -> None:
    """Required headers must exist (tested on the untrimmed names)."""
    absent = sorted(set(required) - set(columns))
    if absent:
        raise ValueError(f"the catalog lacks the column(s) {absent}")


def clean_rows(rows: DataFrame) -> DataFrame:
    """Strip header names and every string value (Python ``str.strip``)."""
    out = rows.toDF(*[c.strip() for c in rows.columns])
    return out.select(*[
        py_strip(F.col(f"`{c}`")).alias(c) if isinstance(out.schema[c].dataType, T.StringType) else F.col(f"`{c}`")
        for c in out.columns
    ])


def missing_labels(rows: DataFrame, required: Mapping[str, str] = REQUIRED) -> Column:
    """Array of the labels of blank or absent required fields (in rule order)."""
    checks = [
        F.when(is_blank(F.col(f"`{header}`")) if header in rows.columns else F.lit(True), F.lit(label))
        for header, label in required.items()
    ]
    return F.array_compact(F.array(*checks))


def validate(rows: DataFrame, required: Mapping[str, str] = REQUIRED) -> DataFrame:
    """Cleaned rows + ``missing`` (labels) + ``valid``."""
    cleaned = clean_rows(rows)
    return cleaned.withColumn("missing", missing_labels(cleaned, required)).withColumn(
        "valid", F.size("missing") == 0
    )


def _value(rows: DataFrame, header: str) -> Column:
    return F.coalesce(F.col(f"`{header}`"), F.lit("")) if header in rows.columns else F.lit("")


def to_talks(validated: DataFrame, mode: str = "enforce") -> DataFrame:
    """Talk records: 12 renamed fields + defaults, ``safe_name`` and ``src_row``.

    ``enforce`` drops invalid rows; ``log_only`` keeps them and names a file
    for a blank id ``missing-id-row-{src_row}`` (the ``id`` stays blank).
    """
    if mode not in ("enforce", "log_only"):
        raise ValueError(f"unknown validation mode {mode!r}")
    rows = validated if mode == "log_only" else validated.where("valid")
    rid = _value(rows, ID_FIELD)
    name_src = F.when(rid == "", F.concat(F.lit("missing-id-row-"), F.col("src_row").cast("string"))).otherwise(rid)
    cols = [_value(rows, h).alias(k) for h, k in FIELD_MAP.items() if h not in IGNORED_FIELDS]
    return rows.select(
        *cols,
        F.lit("").alias("audioUrl"),
        F.lit("").alias("summary"),
        F.array().cast("array<string>").alias("tags"),
        F.array().cast(LINEAGE_TYPE).alias("dataLineage"),
        sanitize_for_filename(name_src).alias("safe_name"),
        F.col("src_row"),
        F.array_join("missing", ", ").alias("missing"),
    )


def quarantine(validated: DataFrame) -> DataFrame:
    """Invalid rows with the joined labels of what is missing."""
    return validated.where(~F.col("valid")).select(
        "src_row", _value(validated, ID_FIELD).alias("id"), _value(validated, TITLE_FIELD).alias("title"),
        F.array_join("missing", ", ").alias("missing"),
    )


def counter_columns(mode: str = "enforce") -> list[Column]:
    """The ingest counters over validated rows, as aggregates (also for an observation)."""
    invalid = ~F.col("valid")
    enforce = F.lit(mode != "log_only")
    no_title = F.array_contains("missing", "title")
    return [
        F.count_if(F.col("valid") | ~enforce).cast("long").alias("written"),
        F.count_if(invalid & enforce).cast("long").alias("skipped"),
        F.count_if(invalid).cast("long").alias("missing_required"),
        F.count_if(invalid & enforce & no_title).cast("long").alias("removed_missing_title"),
    ]


def ingest_counters(validated: DataFrame, mode: str = "enforce") -> DataFrame:
    """written / skipped / missing_required / removed_missing_title in one pass."""
    return validated.agg(*counter_columns(mode))


def latest_per_name(talks: DataFrame) -> DataFrame:
    """Same file name twice: the later row wins (``max_by`` on ``src_row``)."""
    cols = [c for c in talks.columns if c != "safe_name"]
    return (
        talks.groupBy("safe_name")
        .agg(F.max_by(F.struct(*cols), F.col("src_row")).alias("t"), F.count(F.lit(1)).alias("n_rows"))
        .select("safe_name", "t.*", "n_rows")
    )


def normalize_durations(talks: DataFrame) -> DataFrame:
    """Drop ``(approx)`` and strip; ``duration_changed`` only when the value changes."""
    new = normalize_duration("duration")
    return talks.withColumn("duration_before", F.col("duration")).withColumn("duration", new).withColumn(
        "duration_changed", ~F.col("duration").eqNullSafe(F.col("duration_before"))
    )


def add_audio_urls(talks: DataFrame, template: str | None = None) -> DataFrame:
    """``audioUrl`` from the trimmed id; talks without an id are skipped (unchanged)."""
    has_id = ~is_blank("id")
    url = audio_url("id", template) if template else audio_url("id")
    return talks.withColumn("audioUrl", F.when(has_id, url).otherwise(F.col("audioUrl"))).withColumn(
        "audio_reason", F.when(has_id, F.lit("updated")).otherwise(F.lit("missing id"))
    )


def stage_counters(df: DataFrame, flag: str, reason: str | None = None) -> DataFrame:
    """Updated vs skipped (and reason) for a single-column update stage."""
    keys = [F.when(F.col(flag), "updated").otherwise("skipped").alias("outcome")]
    if reason:
        keys.append(F.col(reason))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
