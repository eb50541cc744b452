"""File sources: text corpus, stage transcripts by file-name template, JSONL logs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import make_valid_utf8, universal_newlines


def strict_utf8(value: Column, path: Column) -> Column:
    """Text with universal newlines; bytes that are no UTF-8 fail the read and name the file."""
    bad = F.raise_error(F.concat(F.lit("invalid UTF-8 in "), path))
    return F.when(F.is_valid_utf8(value), universal_newlines(value)).otherwise(bad)


def read_whole_files(spark: SparkSession, roots: Sequence[str], ext: str = "", recursive: bool = True) -> DataFrame:
    """(path, value): one row per file under the roots, the whole content as it is."""
    r = spark.read
    if recursive:
        r = r.option("recursiveFileLookup", True)
    if ext:
        r = r.option("pathGlobFilter", f"*{ext}")
    df = r.text(list(roots), wholetext=True)  # the keyword overrides .option("wholetext")
    return df.select(F.col("_metadata.file_path").alias("path"), "value")


def read_text_corpus(spark: SparkSession, root: str, ext: str = ".txt", recursive: bool = True) -> DataFrame:
    """(path, text): one row per file, whole text, invalid UTF-8 replaced,
    newlines translated as Python's text mode does."""
    return read_whole_files(spark, [root], ext, recursive).select("path", universal_newlines(make_valid_utf8("value")).alias("text"))


def template_regex(template: str) -> str:
    """``{id}_cleaned.txt`` -> ``^(.+)_cleaned\\.txt$`` (matched on the base name)."""
    head, _, tail = template.partition("{id}")
    return "^" + re.escape(head) + "(.+)" + re.escape(tail) + "$"


def read_stage_transcripts(spark: SparkSession, sources: Mapping[str, Mapping]) -> DataFrame:
    """``transcript(talk_id, stage, file, template_rank, text)`` from one listing per stage.

    ``sources`` maps a stage to ``{"directory": ..., "filename_templates": [...]}``;
    the first matching template wins per talk (kept as ``template_rank``).
    Replaces one file probe per talk and stage with a single scan per folder.
    """
    parts = []
    for stage, spec in sources.items():
        df = spark.read.text(spec["directory"], wholetext=True)
        name = F.col("_metadata.file_name")
        for rank, tpl in enumerate(spec["filename_templates"]):
            rx = template_regex(tpl)
            text = strict_utf8(F.col("value"), F.col("_metadata.file_path"))
            parts.append(df.where(name.rlike(rx)).select(
                F.regexp_extract(name, rx, 1).alias("talk_id"), F.lit(stage).alias("stage"),
                name.alias("file"), F.lit(rank).alias("template_rank"), text.alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def local_path(uri):
    """``file:/x`` / ``file:///x`` -> ``/x``; other schemes (hdfs, s3a, ...) unchanged."""
    return F.regexp_replace(uri, "^file:(//)?(?=/)", "")


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Add ``source_path`` and 1-based ``line`` to ``spark.read.text`` output.

    Spark packs splits by size, so a monotonic id alone is not file order.
    Each split is a contiguous run of lines; its offset in the file comes from
    a small per-split count table (one row per split), never from a sort of
    the lines themselves.
    """
    df = lines.select(
        "value",
        local_path(F.col("_metadata.file_path")).alias("source_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    chunks = df.groupBy("source_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.partitionBy("source_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return df.join(chunks.select("source_path", "_block", "_first", "_offset"), ["source_path", "_block"]).select(
        "source_path", (F.col("_offset") + F.col("_mid") - F.col("_first") + 1).alias("line"), "value")


LOG_FIELDS = ("talk_id", "candidate_stage", "candidate_file", "status", "likeness", "selected_stage",
              "selected_file", "model_version")
LOG_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in LOG_FIELDS]
                          + [T.StructField("_corrupt", T.StringType())])


def read_quality_logs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Strict JSONL: blank lines skipped, a malformed line fails naming path:line.

    ``path_ordinal`` is the argument's position (paths given twice are read once);
    files of a folder share it and are ordered by ``source_path``;
    ``likeness`` stays a string here (numbers or numeric strings), and
    ``has_likeness`` tells an absent key from an explicit null.
    """
    uniq = list(dict.fromkeys(paths))
    lines = with_line_numbers(spark.read.text(uniq))
    lines = lines.withColumn("path_ordinal", _argument(F.col("source_path"), uniq))
    v = F.trim(F.col("value"))
    lines = lines.where(v != "")
    parsed = lines.withColumn("j", F.from_json(v, LOG_SCHEMA, {"mode": "PERMISSIVE",
                                                               "columnNameOfCorruptRecord": "_corrupt"}))
    bad = F.col("j").isNull() | F.col("j._corrupt").isNotNull() | ~v.startswith("{")
    msg = F.concat(F.lit("Invalid JSON on line "), F.col("line").cast("string"), F.lit(" in "), F.col("source_path"))
    checked = parsed.where(F.when(bad, F.raise_error(msg)).otherwise(F.lit(True)))
    return checked.select(
        "source_path", "path_ordinal", "line", *[F.col(f"j.{f}").alias(f) for f in LOG_FIELDS],
        F.array_contains(F.json_object_keys(v), "likeness").alias("has_likeness"))


def _argument(path: Column, paths: Sequence[str]) -> Column:
    """Position of the argument (a file or a folder) that a file was read for.

    Files of one folder have the same number and follow in name order; nothing is
    ranked, so no table of files is gathered or joined to the lines.
    """
    found = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(paths))):
        q = re.sub(r"^file:(//)?(?=/)", "", p.rstrip("/"))
        hit = (path == F.lit(q)) | path.startswith(q + "/")
        if not q.startswith("/"):
            hit = hit | path.endswith("/" + q) | path.contains("/" + q + "/")
        found = F.when(hit, F.lit(i)).otherwise(found)
    return found
