"""JSON export of talks and the index (sorted keys, non-ASCII kept).

Rendering is a JVM-side ``to_json`` over an alphabetical struct; the
heterogeneous lineage list (bare strings, or objects when a likeness exists)
is spliced in as pre-rendered JSON.  Per-talk files are written by a data source
that publishes them together once all tasks have succeeded (:mod:`.files`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import lineage_json
from .files import write_files

EXPORT_KEYS = (
    "audioUrl", "caption", "catalogId", "dataLineage", "date", "duration", "id", "koanCase",
    "koanCollection", "location", "speaker", "summary", "tags", "title", "track", "trainingQuarter",
    "transcript",
)
_SLOT = "\u0001lineage\u0001"


def talk_json(talks: DataFrame, pretty: bool = False) -> DataFrame:
    """(safe_name, json): one compact (or pretty) document per talk; ``transcript``
    is omitted when null, every other key is always present.  Keys of an
    ``extra`` column (key -> JSON text) stand among them in key order.

    Compact matches Python's ``separators=(",", ":")``; pretty matches
    ``indent=2`` (``sort_keys``, non-ASCII kept) plus the trailing newline.
    """
    if pretty:
        return talks.select("safe_name", _pretty_doc(talks).alias("json"))
    if "extra" in talks.columns:
        return talks.select("safe_name", F.concat(F.lit("{"), _joined(_compact_pairs(talks), ":", ","), F.lit("}")).alias("json"))
    fields = []
    for k in EXPORT_KEYS:
        if k == "dataLineage":
            fields.append(F.lit(_SLOT).alias(k))
        elif k in talks.columns:
            fields.append(F.col(k).alias(k))
    doc = F.to_json(F.struct(*fields))
    slot = F.to_json(F.array(F.lit(_SLOT)))
    slot = slot.substr(F.lit(2), F.length(slot) - F.lit(2))
    return talks.select("safe_name", F.replace(doc, slot, lineage_json("dataLineage")).alias("json"))


def _pair(key: str, value):
    return F.when(value.isNotNull(), F.struct(F.lit(key).alias("k"), value.alias("v")))


def _joined(pairs: list, colon: str, comma: str):
    """Known and extra (key, JSON) pairs in key order."""
    extra = F.transform(F.map_entries(F.coalesce("extra", F.create_map().cast("map<string,string>"))),
                        lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")))
    every = F.sort_array(F.concat(F.array_compact(F.array(*pairs)), extra))
    return F.array_join(F.transform(every, lambda e: F.concat(_jstr(e["k"]), F.lit(colon), e["v"])), comma)


def _compact_pairs(talks: DataFrame) -> list:
    values = {k: F.col(k) for k in EXPORT_KEYS if k in talks.columns}
    special = {"dataLineage": lambda c: lineage_json("dataLineage"), "tags": F.to_json}
    return [_pair(k, special[k](c) if k in special else F.when(c.isNotNull(), _jstr(c))) for k, c in values.items()]


def _jstr(c):
    j = F.to_json(F.array(c))
    return j.substr(F.lit(2), F.length(j) - F.lit(2))


def _pretty_list(items, indent: str):
    """``[]`` when empty, else one item per line at ``indent + 2``."""
    inner = indent + "  "
    return F.when(F.size(items) == 0, F.lit("[]")).otherwise(F.concat(
        F.lit("[\n" + inner), F.array_join(items, ",\n" + inner), F.lit("\n" + indent + "]")))


def _pretty_doc(talks: DataFrame):
    from ..functions.lineage import _py_float

    lin_items = F.transform(F.col("dataLineage"), lambda x: F.when(
        x.getField("likeness").isNull(), _jstr(x.getField("stage"))
    ).otherwise(F.concat(
        F.lit('{\n      "likeness": '), _py_float(x.getField("likeness")),
        F.lit(',\n      "stage": '), _jstr(x.getField("stage")), F.lit("\n    }"))))
    parts = []
    for k in EXPORT_KEYS:
        if k == "dataLineage":
            v = _pretty_list(lin_items, "  ")
        elif k == "tags":
            v = _pretty_list(F.transform(F.coalesce(F.col("tags"), F.array().cast("array<string>")), _jstr), "  ")
        elif k in talks.columns:
            v = _jstr(F.col(k)) if k != "transcript" else F.when(F.col(k).isNotNull(), _jstr(F.col(k)))
        else:
            continue
        parts.append((k, v))
    if "extra" in talks.columns:
        return F.concat(F.lit("{\n  "), _joined([_pair(k, F.when(F.col(k).isNotNull(), v)) for k, v in parts], ": ", ",\n  "), F.lit("\n}\n"))
    parts = [F.when(v.isNotNull(), F.concat(F.lit(f'  "{k}": '), v)) for k, v in parts]
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *parts), F.lit("\n}\n"))


def index_json_lines(index: DataFrame) -> DataFrame:
    """One compact JSON object per index entry, globally ordered by id."""
    keys = ["date", "duration", "id", "summary", "tags", "teacher", "title", "ts"]
    return index.select("id", F.to_json(F.struct(*[F.col(k) for k in keys])).alias("json")).orderBy("id")  # SL1


def write_talk_files(spark, docs: DataFrame, path: str, trailing_newline: bool = False) -> None:
    """Write one file per talk under ``path``, committed together (:mod:`.files`)."""
    content = F.concat("json", F.lit("\n")) if trailing_newline else F.col("json")
    write_files(spark, docs, path, F.concat("safe_name", F.lit(".json")), content)


def write_index(index: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Index as range-partitioned JSON lines, globally sorted by id."""
    index_json_lines(index).select("json").write.mode(mode).text(path)


def append_quality_log(log: DataFrame, path: str, run_id: str) -> None:
    """Append this run's evaluations (JSON lines) under ``run_id=<id>``."""
    from pyspark.sql import functions as F2

    cols = ["talk_id", "candidate_stage", "candidate_file", "status", "likeness", "selected_stage",
            "selected_file", "model_version"]
    (log.select(*cols).withColumn("run_id", F2.lit(run_id))
     .write.mode("append").partitionBy("run_id").json(path))


def write_text_files(spark, df: DataFrame, root: str, name_col: str, content_col: str) -> None:
    """One file per row at ``root/<name>`` (names may hold sub-folders): the
    cleaned-text sink, mirroring the input folder layout."""
    write_files(spark, df, root, F.col(name_col), F.col(content_col))
