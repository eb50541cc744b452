"""File-level entry points, one per tool of the original workflow.

Each takes paths and returns DataFrames (nothing is printed): corpus sizing,
size split plan, likeness of file pairs, visual diff spans, one-log summary,
multi-log version comparison, catalog ingest and the publish run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import catalog as K
from .operators import corpus as C
from .operators import quality as Q
from .operators import scoring as S
from .operators.scoring import _WORD, likeness_of_tokens
from .plans.publish import publish_files
from .sinks.files import listed, write_files
from .sources.catalog_csv import read_catalog_csv
from .sources.text_files import read_quality_logs, read_text_corpus, read_whole_files, strict_utf8


def likeness_ratio(original: str, transcribed: str) -> float:
    """Likeness of two strings (single pair, plain Python; use ``score_pairs``
    for tables)."""
    return likeness_of_tokens(_WORD.findall(original.lower()), _WORD.findall(transcribed.lower()))


@dataclass
class CorpusSizes:
    sized: DataFrame
    stats: DataFrame
    largest: DataFrame
    deciles: DataFrame


def corpus_sizes(spark: SparkSession, input_dir: str, ext: str = ".txt") -> CorpusSizes:
    """Words/tokens per file, totals, the largest file and token deciles; no matching file is an error."""
    if listed(spark, input_dir, ext=ext).isEmpty():
        raise FileNotFoundError(f"no file *{ext} under {input_dir}")
    sized = C.with_token_sizes(read_text_corpus(spark, input_dir, ext))
    return CorpusSizes(sized, C.token_stats(sized), C.largest_document(sized), C.token_deciles(sized))


def split_plan(spark: SparkSession, input_dir: str, threshold: int = C.DEFAULT_SPLIT_THRESHOLD,
               ext: str = ".txt", small_dir: str | None = None, large_dir: str | None = None) -> DataFrame:
    """Dry-run size split: bucket and destination per file (write it with
    ``corpus.write_size_split``)."""
    root = input_dir.rstrip("/")
    small_dir = small_dir or f"{root}/small"
    large_dir = large_dir or f"{root}/large"
    sized = C.with_token_sizes(read_text_corpus(spark, input_dir, ext))
    sized = sized.withColumn("path", F.regexp_replace("path", "^file:(//)?(?=/)", ""))
    return C.size_split_plan(sized, threshold, small_dir, large_dir, input_root=root)


def run_split(spark: SparkSession, input_dir: str, threshold: int = C.DEFAULT_SPLIT_THRESHOLD, ext: str = ".txt",
              small_dir: str | None = None, large_dir: str | None = None, overwrite: bool = False) -> list:
    """Copy every file into its bucket's folder; targets that exist are skipped unless ``overwrite``.

    Each bucket is committed on its own, all files or none.  Returns the rows of
    (bucket, n_docs, moved, skipped).  Inputs stay where they are.
    """
    small_dir, large_dir = small_dir or f"{input_dir.rstrip('/')}/small", large_dir or f"{input_dir.rstrip('/')}/large"
    plan = split_plan(spark, input_dir, threshold, ext, small_dir, large_dir)
    existing = listed(spark, small_dir, large_dir)
    report = C.split_report(plan, existing, overwrite)
    rows = report.orderBy("bucket").collect()
    todo = plan if overwrite else C.pending_split(plan, existing)
    for bucket, folder in (("small", small_dir), ("large", large_dir)):
        if any(r.bucket == bucket and r.moved for r in rows):
            own = todo.where(F.col("bucket") == bucket)
            write_files(spark, own, folder, F.substring("dest", len(folder.rstrip("/")) + 2, 1 << 20), F.col("text"))
    return rows


def _outermost(roots: list[str]) -> list[str]:
    """The folders that lie in no other one of the list, so that each file is read once."""
    own = list(dict.fromkeys(re.sub("^file:(//)?(?=/)", "", r).rstrip("/") for r in roots))
    return [r for r in own if not any(r.startswith(other + "/") for other in own)]


def _file_pairs(spark: SparkSession, pairs: DataFrame, roots: list[str], ext: str = "") -> DataFrame:
    """(pair_id, a_path, b_path) -> (pair_id, a_text, b_text).

    The folders in ``roots`` are scanned once (whole texts) and joined to both
    sides on the path: no path list goes through the driver.  A file of a pair
    that is no UTF-8 fails the query; other files under the roots may be anything.
    """
    files = read_whole_files(spark, _outermost(roots), ext).withColumn("p", F.regexp_replace("path", "^file:(//)?(?=/)", ""))
    wanted = pairs.select(F.explode(F.array("a_path", "b_path")).alias("p")).distinct()
    texts = files.join(wanted, "p").select("p", strict_utf8(F.col("value"), F.col("path")).alias("t"))
    a = texts.select(F.col("p").alias("a_path"), F.col("t").alias("a_text"))
    b = texts.select(F.col("p").alias("b_path"), F.col("t").alias("b_text"))
    return pairs.join(a, "a_path").join(b, "b_path")


def likeness_of_files(spark: SparkSession, pairs: DataFrame, roots: list[str]) -> DataFrame:
    """Likeness per (pair_id, a_path, b_path); the files live under ``roots``."""
    return S.score_pairs(_file_pairs(spark, pairs, roots)).select("pair_id", "a_path", "b_path", "likeness")


def visual_diff(spark: SparkSession, pairs: DataFrame, roots: list[str], max_chunks: int = 10,
                context: int = 8, sort: str = "size") -> DataFrame:
    """Top differing spans per file pair, with context snippets."""
    return S.top_spans(S.diff_spans(_file_pairs(spark, pairs, roots), context=context), max_chunks, sort)


@dataclass
class LogSummary:
    summary: DataFrame
    histogram: DataFrame


def summarize_log(spark: SparkSession, path: str, threshold: float | None = None) -> LogSummary:
    """One log: entries, successes (statuses or a threshold), mean/median, bins."""
    log = read_quality_logs(spark, [path])
    return LogSummary(Q.log_summary(log, threshold, by=()), Q.accuracy_histogram(log, by=()))


@dataclass
class VersionReport:
    summaries: DataFrame
    comparisons: DataFrame
    regressions: DataFrame
    improvements: DataFrame
    warnings: DataFrame


def compare_logs(spark: SparkSession, log_paths: list[str], versions: list[str] | None = None,
                 baseline: str | None = None, limit: int = 10) -> VersionReport:
    """Logs (and ``VERSION=PATH`` overrides) -> summaries, comparisons, top-k, warnings."""
    vmap = Q.parse_version_pairs(versions or [])
    paths = Q.log_inputs(log_paths, vmap)
    if not paths:
        raise ValueError("no log path was given")
    log = read_quality_logs(spark, paths)
    vm = Q.version_map_frame(spark, vmap) if vmap else None
    latest = Q.latest_entries(Q.prepared_entries(log, vm))
    if log.where(Q.valid_talk()).isEmpty():
        raise ValueError("the logs hold no entry with a talk id")
    pairs = Q.version_pairs(latest, baseline)
    return VersionReport(
        Q.summary_report(Q.version_summary(latest)), Q.compare_versions(pairs),
        Q.change_report(Q.top_changes(pairs, "regression", limit)),
        Q.change_report(Q.top_changes(pairs, "improvement", limit)), Q.warnings(log, vm))


def ingest_catalog(spark: SparkSession, csv_path: str, mode: str = "enforce",
                   row_limit: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(talks after last-wins, quarantine, counters) from a catalog CSV."""
    v = K.validate(read_catalog_csv(spark, csv_path, row_limit))
    return K.latest_per_name(K.to_talks(v, mode)), K.quarantine(v), K.ingest_counters(v, mode)


def publish_run(spark: SparkSession, catalog_csv: str, stage_sources: dict, out_dir: str, run_id: str, **options) -> dict:
    """Catalog CSV and stage folders -> talks, talk files, quality log, index, quarantine,
    counters under ``out_dir`` (:func:`.plans.publish.publish_files`); returns the merge counters."""
    return publish_files(spark, catalog_csv, stage_sources, out_dir, run_id, **options)
