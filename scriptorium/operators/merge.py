"""Merge the best transcript into each talk: pivot, gate, coalesce, lineage, log.

Physical shape (one shuffle of the text):
1. ``transcript`` rows are grouped by ``talk_id`` once, keeping the first
   matching file per stage (``min_by`` on the template rank).  A talk has at
   most stages x templates rows, so no key can grow hot.
2. Scoring is a projection over that grouped table (already hash-partitioned
   by ``talk_id``): candidates are scored in order, each pass masked by the
   failure of the previous one, so a candidate is aligned only when the
   reference order would reach it (Python UDFs are not short-circuited by
   ``when``; the masks do it).
3. The talk catalog joins on ``trim(id)``; the grouped side keeps its
   partitioning, only the small catalog side is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import LINEAGE_STAGES, build_lineage, lineage_stage_number
from ..functions.text import py_rstrip, py_strip
from .scoring import closed_form_likeness, lowered, ordered_gate_udf, tokens_of_lowered

RAW_STAGE = "transcript_raw"


@dataclass(frozen=True)
class MergeParams:
    threshold: float = 0.9
    candidate_order: tuple[str, ...] = ("transcript_structured", "transcript_cleaned")
    stages: tuple[str, ...] = LINEAGE_STAGES
    model_version: str = "v3"
    extra_stage_priority: tuple[str, ...] = field(default=())

    def fallback_stages(self) -> list[str]:
        """Stages tried after raw: highest lineage rank first, scored ones excluded."""
        skip = {RAW_STAGE, *self.candidate_order}
        return [s for s in reversed(self.stages) if s not in skip] + list(self.extra_stage_priority)


def _col(stage: str) -> str:
    return "st_" + stage


def pivot_stages(transcripts: DataFrame, stages: Sequence[str]) -> DataFrame:
    """One row per talk: ``st_<stage>`` = struct(file, text) of the first template hit."""
    aggs = [
        F.min_by(F.struct("file", "text"), F.when(F.col("stage") == s, F.col("template_rank"))).alias(_col(s))
        for s in stages
    ]
    return transcripts.groupBy("talk_id").agg(*aggs)


def store_transcripts(transcripts: DataFrame, table: str, path: str | None = None, buckets: int = 200) -> None:
    """Write stage transcripts once for many merges: partitioned by stage, bucketed by talk.

    Which file of a talk and stage counts is decided on the keys; its text is then
    fetched once, so no aggregation holds texts.  ``attach_stored`` joins such a table
    without a shuffle of its texts.
    """
    keys = ["talk_id", "stage"]
    first = transcripts.groupBy(*keys).agg(F.min(F.struct("template_rank", "file")).alias("first")).select(*keys, "first.*")
    chosen = transcripts.join(first, [*keys, "template_rank", "file"]).select("talk_id", "file", "text", "stage")
    writer = chosen.repartition(buckets, "talk_id").write.mode("overwrite").partitionBy("stage").bucketBy(buckets, "talk_id").sortBy("talk_id")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def attach_stored(talks: DataFrame, stored: DataFrame, stages: Sequence[str]) -> DataFrame:
    """:func:`attach_transcripts` over a stored table: one join per stage on the bucketed key.

    Only the catalog is shuffled, to the table's buckets; the stages follow in its
    partitioning.
    """
    t = _keyed(talks)
    for stage in stages:
        own = stored.where(F.col("stage") == stage).select(F.col("talk_id").alias("_id"), F.struct("file", "text").alias(_col(stage)))
        t = t.join(own, t["_join"] == own["_id"], "left").drop("_id")
    return t.withColumn("talk_id", F.col("_key")).drop("_key", "_join")


def score_candidates(pivot: DataFrame, params: MergeParams = MergeParams()) -> DataFrame:
    """Evaluate candidates in order; add per-candidate score/pass and the selection.

    Phase 1 (JVM only): token arrays and closed-form scores of every candidate
    that has a raw text.  Phase 2: one ordered Python pass aligns only the
    candidates the gate reaches and no closed form settles; its inputs are
    lower-cased texts computed inline and null-masked, so the rows buffered
    around the Python call carry no extra copies of the texts.
    """
    raw = F.col(_col(RAW_STAGE))
    has_raw = raw.isNotNull()
    n = len(params.candidate_order)
    t = F.lit(params.threshold)

    def low(c: Column) -> Column:
        return lowered(c.getField("text"))

    df = pivot.withColumn("_raw_tok", F.when(has_raw, tokens_of_lowered(low(raw))))
    for i, stage in enumerate(params.candidate_order):
        cand = F.col(_col(stage))
        df = df.withColumn(f"_c{i}_tok", F.when(has_raw & cand.isNotNull(), tokens_of_lowered(low(cand))))
        df = df.withColumn(f"_c{i}_closed", F.when(F.col(f"_c{i}_tok").isNotNull(),
                                                  closed_form_likeness("_raw_tok", f"_c{i}_tok")))
        df = df.drop(f"_c{i}_tok")
    df = df.drop("_raw_tok")

    # Which candidates need Python: reachable past earlier closed-form passes,
    # present with a raw text, and without a closed form.
    passed_before: Column = F.lit(False)
    needs = []
    for i, stage in enumerate(params.candidate_order):
        cand = F.col(_col(stage))
        closed = F.col(f"_c{i}_closed")
        needs.append(~passed_before & has_raw & cand.isNotNull() & closed.isNull())
        passed_before = passed_before | F.coalesce(closed >= t, F.lit(False))
    any_need = needs[0]
    for x in needs[1:]:
        any_need = any_need | x
    gate = ordered_gate_udf(n, params.threshold)
    cands = F.struct(*[
        c for i, stage in enumerate(params.candidate_order) for c in (
            F.when(needs[i], low(F.col(_col(stage)))).alias(f"text_{i}"),
            F.col(f"_c{i}_closed").alias(f"closed_{i}"))
    ])
    df = df.withColumn("_py", gate(F.when(any_need, low(raw)), cands))

    accepted: Column = F.lit(False)
    for i, stage in enumerate(params.candidate_order):
        cand = F.col(_col(stage))
        reached = ~accepted & cand.isNotNull()
        evaluate = reached & has_raw
        df = df.withColumn(f"evaluated_{i}", evaluate)
        df = df.withColumn(f"score_{i}", F.when(evaluate, F.coalesce(F.col(f"_c{i}_closed"),
                                                                    F.col(f"_py.score_{i}"))))
        df = df.withColumn(f"passed_{i}", reached & (~has_raw | (F.col(f"score_{i}") >= t)))
        accepted = accepted | F.col(f"passed_{i}")
    df = df.drop("_py", *[f"_c{i}_closed" for i in range(n)])

    # Stage-priority coalesce: passing candidates in order, raw, then the rest.
    options = []
    for i, stage in enumerate(params.candidate_order):
        c = F.col(_col(stage))
        options.append(F.when(F.col(f"passed_{i}"), F.struct(
            F.lit(stage).alias("stage"), c.getField("file").alias("file"), c.getField("text").alias("text"),
            F.col(f"score_{i}").alias("score"))))
    for stage in [RAW_STAGE] + params.fallback_stages():
        if _col(stage) not in df.columns:
            continue
        c = F.col(_col(stage))
        options.append(F.when(c.isNotNull(), F.struct(
            F.lit(stage).alias("stage"), c.getField("file").alias("file"), c.getField("text").alias("text"),
            F.lit(None).cast("double").alias("score"))))
    return df.withColumn("selected", F.coalesce(*options))


def quality_log(scored: DataFrame, params: MergeParams = MergeParams()) -> DataFrame:
    """One row per candidate evaluation (a talk may log two), likeness to 4 places."""
    entries = []
    raw_file = F.col(_col(RAW_STAGE)).getField("file")
    for i, stage in enumerate(params.candidate_order):
        cfile = F.col(_col(stage)).getField("file")
        passed = F.col(f"passed_{i}")
        entries.append(F.when(F.col(f"evaluated_{i}"), F.struct(
            F.col("talk_id").alias("talk_id"),
            F.lit(stage).alias("candidate_stage"),
            cfile.alias("candidate_file"),
            F.when(passed, "succeeded").otherwise("failed").alias("status"),
            F.bround(F.col(f"score_{i}"), 4).alias("likeness"),
            F.when(passed, F.lit(stage)).otherwise(F.lit(RAW_STAGE)).alias("selected_stage"),
            F.when(passed, cfile).otherwise(raw_file).alias("selected_file"),
            F.lit(params.model_version).alias("model_version"),
            F.lit(i).alias("eval_order"),
        )))
    return scored.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")


def _keyed(talks: DataFrame) -> DataFrame:
    """``talks`` with the stripped id as ``_key`` and what they join on as ``_join``.

    Talks without an id match nothing; a key of their own, the same in every attempt
    of a task, keeps them out of one task.
    """
    t = talks.withColumn("_key", py_strip(F.col("id")))
    alone = F.concat(F.lit("\u0001"), F.col("safe_name") if "safe_name" in talks.columns else F.xxhash64(*talks.columns).cast("string"))
    return t.withColumn("_join", F.when(F.col("_key") == "", alone).otherwise(F.col("_key")))


def attach_transcripts(talks: DataFrame, pivot: DataFrame) -> DataFrame:
    """Catalog talks left-joined with their stage pivot on ``strip(id) = talk_id``.

    Only talks in the catalog are scored, as in the per-talk merge.  The pivot
    is already hash-partitioned by ``talk_id`` (its aggregation), so only the
    small catalog side is shuffled; the join happens before any Python step,
    because a Python evaluation node hides that partitioning from the planner.
    """
    t = _keyed(talks)
    return t.join(pivot, t["_join"] == pivot["talk_id"], "left").withColumn(
        "talk_id", F.col("_key")).drop("_key", "_join")


def finalize_merge(scored: DataFrame, params: MergeParams = MergeParams()) -> DataFrame:
    """Talk records with ``transcript`` (right-stripped), ``dataLineage`` and a reason."""
    has_id = F.col("talk_id") != ""
    found = has_id & F.col("selected").isNotNull()
    stage = F.col("selected").getField("stage")
    lik = F.when(stage == F.lit("transcript_structured"), F.col("selected").getField("score"))
    lineage = F.when(found, build_lineage(stage, lik, params.stages)).when(
        has_id, build_lineage(F.lit(None).cast("string"), None, params.stages)
    ).otherwise(F.col("dataLineage"))
    transcript = F.when(found, py_rstrip(F.col("selected").getField("text")))
    if "transcript" in scored.columns:
        transcript = F.when(has_id, transcript).otherwise(F.col("transcript"))
    reason = (
        F.when(~has_id, F.lit("missing id"))
        .when(found, F.concat(F.lit("merged from "), stage))
        .otherwise(F.lit("no transcript found"))
    )
    candidates = range(len(params.candidate_order))
    internal = [f"{name}_{i}" for name in ("score", "evaluated", "passed") for i in candidates]
    internal += [_col(s) for s in dict.fromkeys([RAW_STAGE, *params.candidate_order, *params.fallback_stages()])]
    out = scored.withColumn("dataLineage", lineage).withColumn("transcript", transcript).withColumn(
        "merge_reason", reason
    ).withColumn("selected_stage", stage).withColumn("selected_file", F.col("selected").getField("file"))
    return out.drop("talk_id", "selected", *internal)


def merge_talks(talks: DataFrame, pivot: DataFrame, params: MergeParams = MergeParams()) -> DataFrame:
    """attach -> score -> finalize, for callers that need only the talks."""
    return finalize_merge(score_candidates(attach_transcripts(talks, pivot), params), params)


def merge_reasons(params: MergeParams = MergeParams()) -> list[str]:
    """Every reason that a merge can give."""
    stages = dict.fromkeys([RAW_STAGE, *params.candidate_order, *params.fallback_stages()])
    return [*(f"merged from {s}" for s in stages), "no transcript found", "missing id"]


def merge_counters(merged: DataFrame) -> DataFrame:
    return merged.groupBy(F.col("merge_reason").startswith("merged").alias("ok"), "merge_reason").agg(
        F.count(F.lit(1)).alias("n"))


def talk_index(talks: DataFrame, stages: Sequence[str] = LINEAGE_STAGES) -> DataFrame:
    """Index entries; ``ts`` = lineage stage number.

    Unsorted on purpose: the id order (code-point order) is applied by
    :func:`sorted_index` at the sink, over the materialised talk table — a
    global sort samples its input for range boundaries, which over a lazy
    merge plan would run the scoring twice.
    """
    def s(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) if c in talks.columns else F.lit("")
    tags = F.coalesce(F.col("tags"), F.array().cast("array<string>")) if "tags" in talks.columns else F.array()
    return talks.select(
        s("id").alias("id"), s("title").alias("title"), s("speaker").alias("teacher"), s("date").alias("date"),
        tags.alias("tags"), s("summary").alias("summary"), s("duration").alias("duration"),
        lineage_stage_number("dataLineage", stages).alias("ts"),
    )


def sorted_index(index: DataFrame) -> DataFrame:
    """Index in id order (UTF-8 byte order = code-point order: "10" < "9")."""
    return index.orderBy("id")
