"""Catalog -> validated talks -> normalised -> enriched -> merged -> index.

One lazy DAG; the scored pivot feeds both the merged talks and the quality
log, so callers that materialise both should checkpoint it
(:func:`checkpointed`) to run the alignment once.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog as K
from ..operators import merge as M


@dataclass
class Published:
    talks: DataFrame
    scored: DataFrame
    merged: DataFrame
    log: DataFrame
    index: DataFrame
    quarantine: DataFrame
    counters: DataFrame


def publish(
    catalog_rows: DataFrame,
    transcripts: DataFrame,
    params: M.MergeParams = M.MergeParams(),
    mode: str = "enforce",
    audio_url_template: str | None = None,
) -> Published:
    return _published(K.validate(catalog_rows), transcripts, params, mode, audio_url_template, lambda scored: scored)


def _published(validated, transcripts, params, mode, audio_url_template, settle) -> Published:
    talks = K.latest_per_name(K.to_talks(validated, mode))
    talks = K.add_audio_urls(K.normalize_durations(talks), audio_url_template)
    stages = list(dict.fromkeys([M.RAW_STAGE, *params.candidate_order, *params.fallback_stages()]))
    pivot = M.pivot_stages(transcripts, stages)
    scored = settle(M.score_candidates(M.attach_transcripts(talks, pivot), params))
    merged = M.finalize_merge(scored, params)
    return Published(talks, scored, merged, M.quality_log(scored, params), M.talk_index(merged, params.stages),
                     K.quarantine(validated), K.ingest_counters(validated, mode))


def checkpointed(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Cut lineage into the shared checkpoint folder (reliable, not local)."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def run_publish(
    spark: SparkSession,
    catalog_rows: DataFrame,
    transcripts: DataFrame,
    out_dir: str,
    run_id: str,
    params: M.MergeParams = M.MergeParams(),
    mode: str = "enforce",
    talk_files: bool = False,
    audio_url_template: str | None = None,
) -> dict:
    """Materialise a publish run: talks, quarantine and ingest counters (Parquet),
    quality log (append), index.

    The catalog is read and validated once: its validated rows are checkpointed
    (reliable, in ``spark.checkpoint.dir``) and the ingest counters are observed on
    the way.  The scored pivot feeds both the talks and the log, so it is
    checkpointed too and the alignment runs once; the merge counters are observed
    as the talks are written.  Returns the merge counters.
    """
    from ..sinks.json_docs import append_quality_log, talk_json, write_index, write_talk_files

    ingest, merge = Observation("ingest"), Observation("merge")
    validated = checkpointed(spark, K.validate(catalog_rows).observe(ingest, *K.counter_columns(mode)))
    run = _published(validated, transcripts, params, mode, audio_url_template, lambda df: checkpointed(spark, df))
    run.quarantine.write.mode("overwrite").parquet(f"{out_dir}/quarantine")
    names = [c.name for c in run.counters.schema]
    counters = spark.createDataFrame([tuple(ingest.get[n] for n in names)], run.counters.schema)
    counters.write.mode("overwrite").parquet(f"{out_dir}/ingest_counters")
    reasons = M.merge_reasons(params)
    seen = [F.count_if(F.col("merge_reason") == r).alias(f"r{k}") for k, r in enumerate(reasons)]
    run.merged.observe(merge, F.count(F.lit(1)).alias("all"), *seen).write.mode("overwrite").parquet(f"{out_dir}/talks")
    published = spark.read.parquet(f"{out_dir}/talks")
    append_quality_log(run.log, f"{out_dir}/quality_log", run_id)
    write_index(M.talk_index(published, params.stages), f"{out_dir}/index")
    if talk_files:
        write_talk_files(spark, talk_json(published), f"{out_dir}/talk_files")
    return {(r.startswith("merged"), r): merge.get[f"r{k}"] for k, r in enumerate(reasons) if merge.get[f"r{k}"]}


def publish_files(
    spark: SparkSession,
    catalog_csv: str,
    stage_sources: Mapping[str, Mapping],
    out_dir: str,
    run_id: str,
    params: M.MergeParams = M.MergeParams(),
    mode: str = "enforce",
    audio_url_template: str | None = None,
) -> dict:
    """The whole chain from files: catalog CSV and a folder with name templates per stage
    (``{"directory": ..., "filename_templates": [...]}``) to talks, one JSON file per
    talk, quality log, index, quarantine and counters under ``out_dir``."""
    from ..sources.catalog_csv import read_catalog_csv
    from ..sources.text_files import read_stage_transcripts

    return run_publish(
        spark, read_catalog_csv(spark, catalog_csv), read_stage_transcripts(spark, stage_sources), out_dir, run_id,
        params, mode, talk_files=True, audio_url_template=audio_url_template,
    )
