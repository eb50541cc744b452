"""Quality rules: one threshold table compiled into one Spark projection.

Each rule bounds a ratio of two counts that the projection holds.  The table
compiles to boolean columns; no user function runs and nothing is shuffled.

Cases: a null or empty text has no words, fails the base rule and is rejected.
Repeated rows are judged row by row; other columns are neither read nor changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import let

# White space and symbols of the word and symbol counts.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    # English
    "the of and to in is it that for with on as was be this by an are at or from not have which "
    # French
    "la de le les des du et un une que qui est pour dans par sur pas au aux avec ce il elle "
    # German
    "der die das und ein eine zu von mit nicht den ist im auf für sich dem als auch es "
    # Spanish
    "el los las y en se por con no su para al lo como más del una"
).split()
STOP_FORMS = sorted({f for w in STOP_WORDS for f in (w, w.capitalize(), w.upper())})
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Keep a text while low * whole <= 100 * part <= high * whole, judged from ``least`` words on."""

    name: str
    part: str
    whole: str
    low: int = 0
    high: int | None = None
    least: int = 0


RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=2500),
    Rule("symbols", "n_symbols", "n_words", high=25),
    Rule("letter_words", "n_letter_words", "n_words", low=50, least=50),
    Rule("stop_words", "n_stop_words", "n_words", low=1, least=100),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=50),
)
# The base rule of the contract.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that occur twice or more in the text."""

    def covered(found: Column) -> Column:
        # ``found``: sorted starts of repeated windows; each adds the words up to the next start, five at most.
        step = F.transform(
            found,
            lambda x, i: F.when(i + 1 < F.size(found), F.least(F.lit(WINDOW), F.get(found, i + 1) - x)).otherwise(F.lit(WINDOW)),
        )
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, b: a + b)

    def repeated(pairs: Column) -> Column:
        same = lambda i, j: F.get(pairs, i)["h"] == F.get(pairs, j)["h"]
        flagged = F.filter(
            F.transform(
                pairs,
                lambda p, i: F.when((i > 0) & same(i, i - 1) | (i + 1 < F.size(pairs)) & same(i, i + 1), p["i"]),
            ),
            lambda x: x.isNotNull(),
        )
        return let(F.sort_array(flagged), covered)

    def of_hashes(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), repeated)
        )

    def of_word_hashes(w: Column) -> Column:
        window = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WINDOW)]))
        return let(F.slice(window, 1, F.size(w) - (WINDOW - 1)), of_hashes)

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(
        let(F.transform(words, lambda x: F.xxhash64(x)), of_word_hashes)
    )


def measures(text: Column) -> dict[str, Column]:
    """The counts that rules refer to, as one struct column each."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    count = lambda c: F.size(c).cast("long")
    return {
        "by_word": let(
            words,
            lambda w: F.struct(
                count(w).alias("n_words"),
                _repeat_words(w).alias("n_repeat_words"),
                count(F.filter(w, lambda x: x.isin(*STOP_FORMS))).alias("n_stop_words"),
                count(F.filter(w, lambda x: x.rlike(r"\p{L}"))).alias("n_letter_words"),
            ),
        ),
        "by_line": let(
            lines,
            lambda x: F.struct(count(x).alias("n_lines"), (count(x) - count(F.array_distinct(x))).alias("n_dup_lines")),
        ),
        "word_chars": F.length(F.translate(text, SPACE_CHARS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
    }


def verdict(rules: tuple[Rule, ...], col) -> Column:
    """The threshold table as one boolean expression over the counts ``col(name)``."""
    kept = F.lit(True)
    for r in rules:
        part, whole = F.lit(100) * col(r.part), col(r.whole)
        ok = part >= r.low * whole
        if r.high is not None:
            ok = ok & (part <= r.high * whole)
        kept = kept & (ok | (col("n_words") < r.least))
    return kept


def judged(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "quality_rules") -> DataFrame:
    """``docs`` with one struct column ``out``: every count, ``base_failed`` and ``kept``."""
    raw, tmp = F.coalesce(F.col(text).cast("string"), F.lit("")), f"__{out}_"
    counts = measures(raw)
    # One column per measure: a single struct would be taken apart and evaluated once per field.
    base = docs.withColumns({tmp + k: c for k, c in counts.items()})
    nested = {
        **{n: f"{tmp}by_word.{n}" for n in ("n_words", "n_repeat_words", "n_stop_words", "n_letter_words")},
        **{n: f"{tmp}by_line.{n}" for n in ("n_lines", "n_dup_lines")},
        **{n: tmp + n for n in ("word_chars", "n_symbols")},
    }
    col = lambda n: F.col(nested[n])
    failed = (col("n_words") < MIN_WORDS) | (100 * col("n_repeat_words") > MAX_REPEAT_PERCENT * col("n_words"))
    fields = [F.col(p).alias(n) for n, p in nested.items()]
    return base.withColumn(
        out, F.struct(*fields, failed.alias("base_failed"), (~failed & verdict(rules, col)).alias("kept"))
    ).drop(*[tmp + k for k in counts])


def kept_documents(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that every rule keeps, with the columns of ``docs``."""
    out = "__quality_rules"
    return judged(docs, text, rules, out).where(F.col(f"{out}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
