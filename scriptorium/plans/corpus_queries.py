"""Registered corpus queries: token sizing, deciles, size split, unwrap, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_tokens, unwrap_text, unwrap_text_ascii
from ..operators import corpus as C
from ..sources.tables import corpus_documents

# The size split is reported at the 4,000-token context boundary (the tool's
# default of 15,000 puts every driver document in one bucket).
SPLIT_THRESHOLD = 4000


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.with_token_sizes(corpus_documents(spark, sf_dir))


def corpus_token_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.token_stats(_sized(spark, sf_dir))


def corpus_largest_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.largest_document(_sized(spark, sf_dir))


def corpus_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.token_deciles(_sized(spark, sf_dir))


def corpus_size_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.size_split_counts(C.size_split_plan(_sized(spark, sf_dir), SPLIT_THRESHOLD))


def corpus_size_split_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.size_split_counts(C.size_split_plan(_sized(spark, sf_dir), SPLIT_THRESHOLD), by=("lang",))


def unwrap_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = corpus_documents(spark, sf_dir)
    u = unwrap_text("text")
    return d.select("doc_id", F.length(u).alias("unwrapped_chars"), u.alias("unwrapped"))


def unwrap_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = corpus_documents(spark, sf_dir)
    u = unwrap_text_ascii("text")
    return d.select("doc_id", F.length(u).alias("unwrapped_chars"), u.alias("unwrapped"))


def normalized_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = corpus_documents(spark, sf_dir)
    t = normalize_tokens("text")
    return d.select("doc_id", F.size(t).alias("n_tokens"), F.md5(F.array_join(t, " ")).alias("tokens_md5"))


QUERIES = {
    "corpus_token_stats": corpus_token_stats,
    "corpus_largest_doc": corpus_largest_doc,
    "corpus_deciles": corpus_deciles,
    "corpus_size_split": corpus_size_split,
    "corpus_size_split_by_lang": corpus_size_split_by_lang,
    "unwrap_paragraphs": unwrap_paragraphs,
    "unwrap_ascii": unwrap_ascii,
    "normalize_tokens": normalized_tokens,
}

# ---------------------------------------------------------------------------
# DuckDB oracles (RE2: no lookaround; replacement newlines via chr(10)).
# ---------------------------------------------------------------------------
WS_RE2 = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NONWS_RE2 = r"[^\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
TOKEN_RE2 = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_'']*[\p{L}\p{N}_])?"

SIZED_SQL = f"""
sized AS (
  SELECT doc_id, cast(doc_id AS varchar) || '.txt' AS path, lang, source,
         len(regexp_extract_all(text, '{NONWS_RE2}+', 0)) AS words,
         cast(round(len(regexp_extract_all(text, '{NONWS_RE2}+', 0)) * 4 / 3.0) AS bigint) AS tokens
  FROM documents
)"""


def unwrap_sql(t: str) -> str:
    s = (f"regexp_replace({t}, '\\r\\n|[\\r\\x{{0B}}\\x{{0C}}\\x{{1C}}\\x{{1D}}\\x{{1E}}\\x{{85}}\\x{{2028}}\\x{{2029}}]', "
         "chr(10), 'g')")
    s = (f"regexp_replace({s}, '[\\x{{09}}\\x{{1F}}\\x{{20}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}"
         "\\x{205F}\\x{3000}]+', ' ', 'g')")
    s = f"regexp_replace({s}, ' ?\\n ?', chr(10), 'g')"
    s = f"regexp_replace({s}, '^[ \\n]+|[ \\n]+$', '', 'g')"
    s = f"regexp_replace({s}, '\\n\\n+', chr(1), 'g')"
    s = f"regexp_replace({s}, '\\n', ' ', 'g')"
    s = f"replace({s}, chr(1), chr(10) || chr(10))"
    return f"(CASE WHEN {s} = '' THEN '' ELSE {s} || chr(10) END)"


def unwrap_ascii_sql(t: str) -> str:
    s = f"regexp_replace({t}, '\\n$', '')"
    # lines of [ \t\v\f\r]* become empty; then trim [ \t\r] per line
    s = f"regexp_replace({s}, '(?m)^[ \\t\\x{{0B}}\\f\\r]*$', '', 'g')"
    s = f"regexp_replace({s}, '(?m)^[ \\t\\r]+|[ \\t\\r]+$', '', 'g')"
    s = f"regexp_replace({s}, '[ \\t]+', ' ', 'g')"
    s = f"regexp_replace({s}, '^\\n+', '')"
    s = f"regexp_replace({s}, '\\n\\n+', chr(1), 'g')"
    s = f"regexp_replace({s}, '\\n$', chr(2))"
    s = f"regexp_replace({s}, '\\n', ' ', 'g')"
    s = f"replace(replace({s}, chr(1), chr(10) || chr(10)), chr(2), chr(10) || chr(10))"
    return (f"(CASE WHEN {s} = '' THEN '' WHEN suffix({s}, chr(10) || chr(10)) THEN {s} "
            f"ELSE {s} || chr(10) END)")


ORACLES = {
    "corpus_token_stats": f"""WITH {SIZED_SQL}
      SELECT count(*) AS n_docs, cast(sum(tokens) AS bigint) AS total_tokens, avg(tokens) AS avg_tokens,
             cast(round_even(median(tokens), 0) AS bigint) AS median_tokens FROM sized""",
    "corpus_largest_doc": f"""WITH {SIZED_SQL}
      SELECT path AS max_path, words AS max_words, tokens AS max_tokens FROM sized
      ORDER BY words DESC, path ASC LIMIT 1""",
    "corpus_deciles": f"""WITH {SIZED_SQL},
      s AS (SELECT list_sort(list(tokens)) AS c, count(*) AS n FROM sized),
      b AS (SELECT i + 1 AS decile, (i * n) // 10 AS st, ((i + 1) * n) // 10 AS en, c
            FROM s, range(10) r(i) WHERE n > 0)
      SELECT cast(decile AS int) AS decile,
             cast(CASE WHEN en = 0 THEN 0 ELSE c[st + 1] END AS bigint) AS min_tokens,
             cast(CASE WHEN en = 0 THEN 0 ELSE c[en] END AS bigint) AS max_tokens,
             cast(en - st AS bigint) AS n_docs FROM b""",
    "corpus_size_split": f"""WITH {SIZED_SQL}
      SELECT CASE WHEN tokens <= {SPLIT_THRESHOLD} THEN 'small' ELSE 'large' END AS bucket,
             count(*) AS n_docs, cast(sum(tokens) AS bigint) AS tokens FROM sized GROUP BY 1""",
    "corpus_size_split_by_lang": f"""WITH {SIZED_SQL}
      SELECT lang, CASE WHEN tokens <= {SPLIT_THRESHOLD} THEN 'small' ELSE 'large' END AS bucket,
             count(*) AS n_docs, cast(sum(tokens) AS bigint) AS tokens FROM sized GROUP BY 1, 2""",
    "unwrap_paragraphs": f"""SELECT doc_id, cast(length({unwrap_sql('coalesce(text, \'\')')}) AS INTEGER) AS unwrapped_chars,
             {unwrap_sql('coalesce(text, \'\')')} AS unwrapped FROM documents""",
    "unwrap_ascii": f"""SELECT doc_id, cast(length({unwrap_ascii_sql('coalesce(text, \'\')')}) AS INTEGER) AS unwrapped_chars,
             {unwrap_ascii_sql('coalesce(text, \'\')')} AS unwrapped FROM documents""",
    "normalize_tokens": f"""SELECT doc_id, cast(len(regexp_extract_all(lower(coalesce(text, '')), '{TOKEN_RE2}', 0)) AS INTEGER) AS n_tokens,
             md5(array_to_string(regexp_extract_all(lower(coalesce(text, '')), '{TOKEN_RE2}', 0), ' ')) AS tokens_md5
      FROM documents""",
}
