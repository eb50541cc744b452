"""Registered merge queries over the stand-in catalog and stage transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import lineage_json, lineage_stage_number
from ..operators import merge as M
from ..operators import scoring as S
from ..sources.tables import INSERTED, catalog_rows, edited_pairs, stage_transcripts
from ..sinks.json_docs import index_json_lines, talk_json
from .catalog_queries import CATALOG_SQL, WS, strip_sql
from .corpus_queries import TOKEN_RE2
from .publish import checkpointed, publish

PARAMS = M.MergeParams()


def _pub(spark: SparkSession, sf_dir: str):
    return publish(catalog_rows(spark, sf_dir), stage_transcripts(spark, sf_dir), PARAMS)


def _evaluations(scored: DataFrame) -> DataFrame:
    evs = [
        F.when(F.col(f"evaluated_{i}"), F.struct(
            F.lit(stage).alias("candidate_stage"), F.col(f"score_{i}").alias("likeness"),
            F.col(f"passed_{i}").alias("passed")))
        for i, stage in enumerate(PARAMS.candidate_order)
    ]
    return scored.select("talk_id", F.explode(F.array_compact(F.array(*evs))).alias("e")).select("talk_id", "e.*")


def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluations(_pub(spark, sf_dir).scored)


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per catalog talk with a raw text: how many candidates were scored and
    which one (if any) passed the gate."""
    s = _pub(spark, sf_dir).scored
    n_eval = sum((F.col(f"evaluated_{i}").cast("int") for i in range(len(PARAMS.candidate_order))), F.lit(0))
    passed = F.coalesce(*[F.when(F.col(f"evaluated_{i}") & F.col(f"passed_{i}"), F.lit(st))
                          for i, st in enumerate(PARAMS.candidate_order)])
    return s.where(F.col("st_transcript_raw").isNotNull()).select(
        "talk_id", n_eval.alias("n_evaluated"), passed.alias("passed_stage"))


def gate_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pub(spark, sf_dir).log.drop("eval_order")


def stage_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected stage per catalog talk (null when no transcript exists)."""
    s = _pub(spark, sf_dir).scored
    return s.select("talk_id", F.col("selected.stage").alias("selected_stage"),
                    F.col("selected.file").alias("selected_file"), F.col("selected.score").alias("likeness"))


def merged_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _pub(spark, sf_dir).merged
    return m.select("safe_name", "id", "merge_reason", lineage_json("dataLineage").alias("lineage_json"),
                    lineage_stage_number("dataLineage").alias("ts"), "transcript")


def merge_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.merge_counters(_pub(spark, sf_dir).merged)


def talk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pub(spark, sf_dir).index


def talk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(safe_name, json): the compact export document of every merged talk."""
    return talk_json(_pub(spark, sf_dir).merged)


def talk_index_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index export: one compact JSON object per entry, in id order.

    The sort samples its input, so it runs over the checkpointed index: over the
    lazy merge it would score every pair twice."""
    return index_json_lines(checkpointed(spark, _pub(spark, sf_dir).index))


def edited_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate-only mode on the edited pairs: the overlap bound settles failures
    without alignment; ``likeness`` is exact wherever it is reported."""
    p = S.spread_by_cost(edited_pairs(spark, sf_dir))
    return S.gate_pairs(p, threshold=PARAMS.threshold).select("pair_id", "upper_bound", "likeness", "passed")


def pair_scores_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact likeness of every whole document against its edit."""
    return S.score_pairs(edited_pairs(spark, sf_dir), spread=True).select("pair_id", "likeness")


def diff_spans_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten largest differing spans per edited document, with 8 tokens of context."""
    return S.top_spans(S.diff_spans(edited_pairs(spark, sf_dir), context=8, spread=True), limit=10, sort="size")


QUERIES = {
    "pair_scores": pair_scores,
    "quality_gate": quality_gate,
    "gate_log": gate_log,
    "stage_selection": stage_selection,
    "merged_lineage": merged_lineage,
    "merge_counters": merge_counters,
    "talk_index": talk_index,
    "talk_documents": talk_documents,
    "talk_index_json": talk_index_json,
    "edited_gate": edited_gate,
    "pair_scores_edited": pair_scores_edited,
    "diff_spans_top": diff_spans_top,
}

# ---------------------------------------------------------------------------
# DuckDB oracles: the stand-in edits keep the whole raw text, so the score is
# the closed form 2*min(na,nb)/(na+nb) (0 when the raw side has no tokens).
# ---------------------------------------------------------------------------
PRE = "'Sure! Here is the cleaned up transcript with paragraphs:' || chr(10) || chr(10)"
POST = "chr(10) || chr(10) || 'Let me know if you would like any further edits.'"


def _ntok(x: str) -> str:
    return f"len(regexp_extract_all(lower({x}), '{TOKEN_RE2}', 0))"


def _score(na: str, nb: str) -> str:
    return (f"(CASE WHEN {na} = 0 AND {nb} = 0 THEN 1.0 WHEN {na} = 0 OR {nb} = 0 THEN 0.0 "
            f"ELSE 2 * least({na}, {nb}) / cast({na} + {nb} AS double) END)")


MERGE_SQL = f"""
doc AS (
  SELECT CASE WHEN lang = 'es' THEN 'ES/' || cast(doc_id // 10 AS varchar) ELSE cast(doc_id AS varchar) END AS talk_id,
         arg_max({{'lang': lang, 'text': text, 'doc_id': doc_id}}, doc_id) AS d
  FROM documents GROUP BY 1
),
tk AS (
  SELECT talk_id, d.lang AS lang, d.text AS text, replace(talk_id, '/', '_') AS file_id,
         d.lang <> 'es' AND NOT (d.lang = 'de' AND d.doc_id % 3 = 0) AS has_raw,
         {_ntok('d.text')} AS na, {_ntok(PRE + ' || d.text')} AS ns, {_ntok('d.text || ' + POST)} AS nc
  FROM doc
),
sc AS (
  SELECT *, {_score('na', 'ns')} AS s_score, {_score('na', 'nc')} AS c_score FROM tk
),
ev AS (
  SELECT *, lang = 'en' AS s_eval, lang = 'en' AND s_score >= 0.9 AS s_pass,
         (lang = 'en' AND s_score < 0.9) OR lang = 'fr' AS c_eval FROM sc
),
ev2 AS (SELECT *, c_eval AND c_score >= 0.9 AS c_pass FROM ev),
sel AS (
  SELECT talk_id, lang,
    CASE WHEN lang = 'es' THEN 'transcript_structured' WHEN s_pass THEN 'transcript_structured'
         WHEN c_pass THEN 'transcript_cleaned' WHEN has_raw THEN 'transcript_raw' ELSE 'audio_original' END AS selected_stage,
    CASE WHEN lang = 'es' OR s_pass OR c_pass THEN file_id || '_cleaned.txt' ELSE file_id || '.txt' END AS selected_file,
    CASE WHEN s_pass THEN s_score WHEN c_pass THEN c_score END AS likeness,
    CASE WHEN lang = 'es' THEN {PRE} || text WHEN s_pass THEN {PRE} || text WHEN c_pass THEN text || {POST}
         ELSE text END AS sel_text
  FROM ev2
)"""

# The edit inserts one word before position n - (n >> q) of n, while n >> q is positive.
_CUT = " + ".join(f"cast(n >= {2 ** q} AS int)" for q in range(1, len(INSERTED) + 1))
_NEW = " ".join(f"WHEN i = n - (n >> {q}) AND (n >> {q}) > 0 THEN ['{x}', t[i + 1]]" for q, x in enumerate(INSERTED, 1))
EDITED_SQL = f"""
et AS (SELECT cast(doc_id AS varchar) AS pair_id, regexp_extract_all(lower(coalesce(text, '')), '{TOKEN_RE2}', 0) AS t FROM documents),
en AS (SELECT pair_id, t, len(t) AS n, {_CUT.replace("n >=", "len(t) >=")} AS k FROM et),
es AS (SELECT *, CASE WHEN n = 0 THEN 1.0 ELSE 2 * n / cast(2 * n + k AS double) END AS score FROM en)"""

LINEAGE_SQL = """CASE
  WHEN s.selected_stage IS NULL OR s.selected_stage = 'audio_original' THEN '["audio_original"]'
  WHEN s.selected_stage = 'transcript_raw' THEN '["audio_original","transcript_raw"]'
  WHEN s.selected_stage = 'transcript_cleaned'
    THEN '["audio_original","transcript_raw","transcript_structured","transcript_cleaned"]'
  WHEN s.likeness IS NULL THEN '["audio_original","transcript_raw","transcript_structured"]'
  ELSE '["audio_original","transcript_raw",{"likeness":' || cast(round_even(s.likeness, 4) AS varchar)
       || ',"stage":"transcript_structured"}]' END"""

TS_SQL = """CASE WHEN s.selected_stage IS NULL OR s.selected_stage = 'audio_original' THEN 1 WHEN s.selected_stage = 'transcript_raw' THEN 2
  WHEN s.selected_stage = 'transcript_structured' THEN 3 ELSE 4 END"""

ORACLES = {
    "pair_scores_edited": f"""WITH {EDITED_SQL} SELECT pair_id, cast(score AS double) AS likeness FROM es""",
    "edited_gate": f"""WITH {EDITED_SQL}
      SELECT pair_id, cast(CASE WHEN k > 0 THEN score END AS double) AS upper_bound,
             cast(CASE WHEN k = 0 OR score >= 0.9 THEN score END AS double) AS likeness, score >= 0.9 AS passed FROM es""",
    "diff_spans_top": f"""WITH {EDITED_SQL},
      eb AS (SELECT pair_id, t, n, k, flatten(list_transform(range(n), lambda i: CASE {_NEW} ELSE [t[i + 1]] END)) AS b FROM es),
      ec AS (SELECT *, cast(unnest(range(1, k + 1)) AS int) AS q FROM eb),
      ep AS (SELECT *, cast(n - (n >> q) AS int) AS a0, cast(n - (n >> q) + q - 1 AS int) AS b0 FROM ec)
      SELECT pair_id, 'insert' AS tag, a0 AS a_start, a0 AS a_end, b0 AS b_start, b0 + 1 AS b_end, 0 AS a_len, 1 AS b_len,
             t[greatest(a0 - 8, 0) + 1 : a0 + 8] AS a_snip, b[greatest(b0 - 8, 0) + 1 : b0 + 9] AS b_snip, q AS rank FROM ep""",
    "pair_scores": f"""WITH {CATALOG_SQL}, {MERGE_SQL}
      SELECT talk_id, 'transcript_structured' AS candidate_stage, s_score AS likeness, s_pass AS passed
        FROM ev2 WHERE s_eval AND talk_id IN (SELECT id FROM talks)
      UNION ALL
      SELECT talk_id, 'transcript_cleaned', c_score, c_pass FROM ev2
      WHERE c_eval AND talk_id IN (SELECT id FROM talks)""",
    "gate_log": f"""WITH {CATALOG_SQL}, {MERGE_SQL}
      SELECT talk_id, 'transcript_structured' AS candidate_stage, talk_id || '_cleaned.txt' AS candidate_file,
             CASE WHEN s_pass THEN 'succeeded' ELSE 'failed' END AS status, round_even(s_score, 4) AS likeness,
             CASE WHEN s_pass THEN 'transcript_structured' ELSE 'transcript_raw' END AS selected_stage,
             CASE WHEN s_pass THEN talk_id || '_cleaned.txt' ELSE talk_id || '.txt' END AS selected_file,
             'v3' AS model_version FROM ev2 WHERE s_eval AND talk_id IN (SELECT id FROM talks)
      UNION ALL
      SELECT talk_id, 'transcript_cleaned', talk_id || '_cleaned.txt',
             CASE WHEN c_pass THEN 'succeeded' ELSE 'failed' END, round_even(c_score, 4),
             CASE WHEN c_pass THEN 'transcript_cleaned' ELSE 'transcript_raw' END,
             CASE WHEN c_pass THEN talk_id || '_cleaned.txt' ELSE talk_id || '.txt' END, 'v3'
      FROM ev2 WHERE c_eval AND talk_id IN (SELECT id FROM talks)""",
    "stage_selection": f"""WITH {CATALOG_SQL}, {MERGE_SQL}
      SELECT t.id AS talk_id, s.selected_stage, s.selected_file, s.likeness
      FROM talks t LEFT JOIN sel s ON t.id = s.talk_id""",
    "merged_lineage": f"""WITH {CATALOG_SQL}, {MERGE_SQL}
      SELECT t.safe_name, t.id,
             CASE WHEN s.selected_stage IS NULL THEN 'no transcript found'
                  ELSE 'merged from ' || s.selected_stage END AS merge_reason,
             {LINEAGE_SQL} AS lineage_json, {TS_SQL} AS ts,
             regexp_replace(s.sel_text, '{WS}+$', '') AS transcript
      FROM talks t LEFT JOIN sel s ON t.id = s.talk_id""",
    "merge_counters": f"""WITH {CATALOG_SQL}, {MERGE_SQL}
      SELECT s.selected_stage IS NOT NULL AS ok,
             CASE WHEN s.selected_stage IS NULL THEN 'no transcript found'
                  ELSE 'merged from ' || s.selected_stage END AS merge_reason, count(*) AS n
      FROM talks t LEFT JOIN sel s ON t.id = s.talk_id GROUP BY 1, 2""",
    "talk_index": f"""WITH {CATALOG_SQL}, {MERGE_SQL}
      SELECT t.id, t.title, t.speaker AS teacher, '' AS date, []::varchar[] AS tags, '' AS summary,
             {strip_sql("replace(t.duration, '(approx)', '')")} AS duration, {TS_SQL} AS ts
      FROM talks t LEFT JOIN sel s ON t.id = s.talk_id""",
    "talk_index_json": f"""WITH {CATALOG_SQL}, {MERGE_SQL}
      SELECT t.id, cast(to_json(struct_pack(date := '', duration := {strip_sql("replace(t.duration, '(approx)', '')")},
             id := t.id, summary := '', tags := []::varchar[], teacher := t.speaker, title := t.title,
             ts := {TS_SQL})) AS VARCHAR) AS json
      FROM talks t LEFT JOIN sel s ON t.id = s.talk_id""",
    "quality_gate": f"""WITH {CATALOG_SQL}, {MERGE_SQL}
      SELECT talk_id, cast(s_eval AS int) + cast(c_eval AS int) AS n_evaluated,
             CASE WHEN s_pass THEN 'transcript_structured' WHEN c_pass THEN 'transcript_cleaned' END AS passed_stage
      FROM ev2 WHERE has_raw AND talk_id IN (SELECT id FROM talks)""",
    "talk_documents": f"""WITH {CATALOG_SQL}, {MERGE_SQL},
      docs AS (
        SELECT t.safe_name, {LINEAGE_SQL} AS lineage,
               regexp_replace(s.sel_text, '{WS}+$', '') AS transcript,
               struct_pack(
                 audioUrl := 'https://media.example.org/download?direct=1&ref=' || t.id || '&ext=mp3',
                 caption := '', catalogId := t.catalogId, dataLineage := chr(1) || 'lineage' || chr(1), date := '',
                 duration := {strip_sql("replace(t.duration, '(approx)', '')")}, id := t.id, koanCase := '',
                 koanCollection := '', location := t.location, speaker := t.speaker, summary := '',
                 tags := []::varchar[], title := t.title, track := '', trainingQuarter := '') AS base
        FROM talks t LEFT JOIN sel s ON t.id = s.talk_id)
      SELECT safe_name, replace(CASE WHEN transcript IS NULL THEN to_json(base)
               ELSE to_json(struct_insert(base, transcript := transcript)) END,
             '"\\u0001lineage\\u0001"', lineage) AS json
      FROM docs""",
}
