"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base, decontaminate, html_text, license_scan, ngram_jaccard, packing, pii, quality_classifier, quality_rules, suffix_dedup, token_counts, vector_queries
from .base import read_table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detected(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in pii.KINDS],
        F.sha2(pii.digest(F.col("base")), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.counted(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(read_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matched(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.classes_of(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.texts(read_table(spark, sf_dir, "documents"), "doc_id")
    out = quality_rules.judged(docs)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return out.select("doc_id", *[f"quality_rules.{n}" for n in names])


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(read_table(spark, sf_dir, "pages"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_classifier.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


_STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_FORMS)
_VERDICT = " AND ".join(
    f"(n_words < {r.least} OR (100 * {r.part} >= {r.low} * {r.whole}"
    + (f" AND 100 * {r.part} <= {r.high} * {r.whole}" if r.high is not None else "")
    + "))"
    for r in quality_rules.RULES
)
OP6_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM win SEMI JOIN twice USING (doc_id, g)) GROUP BY doc_id),
c AS (
  SELECT doc_id, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(ws, lambda w: w IN ({_STOP}))) AS n_stop_words,
         len(list_filter(ws, lambda w: regexp_matches(w, '\p{{L}}'))) AS n_letter_words
  FROM d LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_VERDICT} AS kept
FROM f
"""

_TEMPLATE_ROWS = ", ".join(f"({k}, '{label}', '{w}')" for k, (label, t) in enumerate(license_scan.TEMPLATES) for w in sorted(set(license_scan.words_of(t))))
_LICENSE_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP3_SQL = f"""
WITH tw AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) AS v(k, label, word)),
tn AS (SELECT k, label, count(*) AS n FROM tw GROUP BY ALL),
d AS (SELECT doc_id, coalesce(text, '') AS t, {_LICENSE_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
phrase AS (SELECT * FROM (VALUES ('mit', ['mit', 'license']), ('apache', ['apache', 'license']), ('gpl', ['general', 'public', 'license'])) AS v(label, parts)),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d WHERE list_contains(ws, 'license')),
hit AS (SELECT doc_id, i - 1 AS p, label FROM pos, phrase WHERE ws[i:i + len(parts) - 1] = parts),
base AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list(DISTINCT label) AS base_list FROM hit GROUP BY doc_id),
line AS (SELECT doc_id, generate_subscripts(ls, 1) AS line, unnest(ls) AS l FROM (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d)),
lw AS (SELECT DISTINCT doc_id, line, unnest({_LICENSE_WORDS.format("l")}) AS word FROM line),
met AS (
  SELECT doc_id, line, k, label, list_sort(list(word)) AS shared, count(*) / n AS share
  FROM lw JOIN tw USING (word) JOIN tn USING (k, label) GROUP BY doc_id, line, k, label, n
  HAVING 100 * count(*) >= {license_scan.THRESHOLD} * n),
top AS (
  SELECT * FROM met a WHERE NOT EXISTS (
    FROM met b WHERE a.doc_id = b.doc_id AND a.line = b.line AND len(a.shared) < len(b.shared) AND list_has_all(b.shared, a.shared))),
found AS (SELECT doc_id, list(DISTINCT label) AS more, max(share) AS share FROM top GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(base_list), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_list, []), coalesce(more, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_SHINGLE_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
OP5_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_SHINGLE_WORDS} AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                                     WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
many AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
r AS (SELECT doc_id, g FROM s SEMI JOIN many USING (g)),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM r a JOIN r b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * k >= 85 * (u.n + v.n - k)),
l AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS c FROM reach GROUP BY x) USING (doc_id)
"""
OP7_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, i, h[2 * i + 1 : 2 * i + 100] AS g FROM (SELECT doc_id, h, unnest(range(n - 49)) AS i FROM d WHERE n >= 50)),
f AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g),
gone AS (SELECT doc_id, i FROM w JOIN f USING (g) WHERE least < doc_id),
run AS (
  SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM gone)),
span AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, r),
gap AS (
  SELECT doc_id, n, h, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_, a AS to_ FROM span JOIN d USING (doc_id)),
kept AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
         string_agg(h[2 * from_ + 1 : 2 * to_], '' ORDER BY a) || any_value(h[2 * last + 1 :]) AS k
  FROM (SELECT *, max(b) OVER (PARTITION BY doc_id) AS last FROM gap) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, cast(coalesce(n_removed, 0) AS bigint) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

QUERIES = {
    "op1_pii": op1_pii,
    "op2_token_counts": op2_token_counts,
    "op3_license_scan": op3_license_scan,
    "op4_decontamination": op4_decontamination,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_quality_rules": op6_quality_rules,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_packing": op8_packing,
    "op9_html_text": op9_html_text,
    "op10_quality_classifier": op10_quality_classifier,
    **vector_queries.QUERIES,
}
ORACLES = {
    "op3_license_scan": OP3_SQL,
    "op5_ngram_jaccard": OP5_SQL,
    "op6_quality_rules": OP6_SQL,
    "op7_suffix_dedup": OP7_SQL,
    **vector_queries.ORACLES,
}
