"""Likeness of an edited text against its source, and the spans that differ.

likeness = 2*M / (na + nb) over lower-cased word tokens, where M is the size of
the longest common blocks (:mod:`.alignment`).  It is not an LCS and not
symmetric.

Scale plan:
1. Closed forms: both empty -> 1, one empty -> 0, equal token lists -> 1, one list
   a contiguous run of the other -> 2*min/(na+nb) (the longest block is then the
   whole shorter side).
2. Pairs are cut into words once, in the worker that aligns them: equal texts are
   settled JVM-side, their UDF inputs are null, so they cross the Arrow boundary as
   nulls and cost nothing.  The ordered gate of the merge, whose candidates mostly
   have a closed form, settles all closed forms JVM-side.
3. The exact alignment runs in an Arrow-batched pandas UDF, after a range
   repartition on the pair's cost (product of the text lengths) at every input
   size, so heavy pairs spread over tasks.
4. Optional gate-only mode: the length bound, then the multiset-overlap bound, both
   over the words at hand, decide failures without alignment when only pass/fail is
   needed.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import TOKEN_PATTERN
from . import alignment


# --------------------------------------------------------------------------
# Python helpers (run inside Arrow batches, one pair at a time)
# --------------------------------------------------------------------------
# Fixed value: the token rule of the likeness score (word runs with
# apostrophes, on lower-cased text).  JVM-side it is TOKEN_PATTERN.
_WORD = re.compile(r"[\w']+")


def words_of(text: str) -> list[str]:
    found = _WORD.findall(text)
    return [w for w in (x.strip("'") for x in found) if w] if "'" in text else found


def likeness_of_tokens(a: list, b: list) -> float:
    return alignment.likeness(a, b)


# The UDFs receive lower-cased *texts* (one Arrow string per row) and split
# them in the worker: shipping token arrays instead would materialise one
# Python object per token on the Arrow -> pandas boundary.
@F.pandas_udf(T.DoubleType())
def likeness_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    out = [
        None if (x is None or y is None) else likeness_of_tokens(words_of(x), words_of(y))
        for x, y in zip(a, b)
    ]
    return pd.Series(out, dtype="float64")


def gate_udf(threshold: float):
    """(upper_bound, likeness) of two lower-cased texts for pass/fail at ``threshold``.

    Pairs with a closed form have no bound.  The others have the length bound where it
    is below the threshold, else the overlap bound, and are aligned where that is not
    below the threshold either.
    """
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in ("upper_bound", "likeness")])

    @F.pandas_udf(schema)
    def gate(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if (x is None or y is None) else _gated(words_of(x), words_of(y), threshold) for x, y in zip(a, b)]
        return pd.DataFrame(rows, columns=schema.names, dtype="float64")

    return gate


def _gated(a: list, b: list, threshold: float) -> tuple[float | None, float | None]:
    total, (short, long) = len(a) + len(b), sorted((a, b), key=len)
    if not short:
        return None, 0.0 if long else 1.0
    if f" {' '.join(short)} " in f" {' '.join(long)} ":
        return None, 2.0 * len(short) / total
    bound = 2.0 * len(short) / total
    if bound < threshold:
        return bound, None
    x, y = alignment.coded(a, b)
    bound = 2.0 * alignment.shared(x, y) / total
    return bound, alignment.coded_likeness(x, y) if bound >= threshold else None


def ordered_gate_udf(n_candidates: int, threshold: float):
    """One Python pass for an ordered list of candidates against one source.

    Inputs: the lower-cased source (null when no candidate needs alignment)
    and a struct with, per candidate, its lower-cased text (sent only when it
    needs alignment) and its JVM closed-form score.  Candidates are walked in
    order and the walk stops at the first pass, as the gate does; returns the
    aligned score per candidate (null where none was computed).
    """
    names = [f"score_{i}" for i in range(n_candidates)]
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])

    @F.pandas_udf(schema)
    def gate(src: pd.Series, cands: pd.DataFrame) -> pd.DataFrame:
        rows = []
        settled = [cands[f"closed_{i}"].tolist() for i in range(n_candidates)]
        texts = [cands[f"text_{i}"].tolist() for i in range(n_candidates)]
        for r, a in enumerate(src):
            out = [None] * n_candidates
            if a is not None:
                ta = None
                for i in range(n_candidates):
                    closed, text = settled[i][r], texts[i][r]
                    if closed is not None and closed == closed:  # not null / NaN
                        if closed >= threshold:
                            break
                        continue
                    if text is None:
                        continue
                    if ta is None:
                        ta = words_of(a)
                    out[i] = likeness_of_tokens(ta, words_of(text))
                    if out[i] >= threshold:
                        break
            rows.append(out)
        return pd.DataFrame(rows, columns=names, dtype="float64")

    return gate


# --------------------------------------------------------------------------
# Column forms
# --------------------------------------------------------------------------
def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def closed_form_likeness(a_tokens: Column | str, b_tokens: Column | str) -> Column:
    """Exact likeness where a closed form exists, else null."""
    a, b = _c(a_tokens), _c(b_tokens)
    na, nb = F.size(a), F.size(b)
    ja = F.concat(F.lit(" "), F.array_join(a, " "), F.lit(" "))
    jb = F.concat(F.lit(" "), F.array_join(b, " "), F.lit(" "))
    tot = (na + nb).cast("double")
    return (
        F.when((na == 0) & (nb == 0), F.lit(1.0))
        .when((na == 0) | (nb == 0), F.lit(0.0))
        .when((na == nb) & (ja == jb), F.lit(1.0))
        .when((na < nb) & (F.instr(jb, ja) > 0), F.lit(2.0) * na / tot)
        .when((nb < na) & (F.instr(ja, jb) > 0), F.lit(2.0) * nb / tot)
    )


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def numbered_tokens(tokens: Column | str) -> Column:
    """Each token with its occurrence number (``1 the``, ``2 the``): a multiset as a set of strings.

    The sorted array is cut where the token changes; each stretch is numbered from one.
    """

    def cut(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        numbers = lambda at, k, every: F.sequence(F.lit(1), F.coalesce(F.get(every, k + 1), n) - at)
        stretch = lambda at, k, every: F.transform(numbers(at, k, every), lambda o: F.concat_ws(" ", o, F.get(s, at)))
        return _let(starts, lambda every: F.flatten(F.transform(every, lambda at, k: stretch(at, k, every))))

    t = _c(tokens)
    return F.when(F.size(t) > 0, _let(F.sort_array(t), cut)).otherwise(F.array().cast("array<string>"))


def length_bound(a_tokens: Column | str, b_tokens: Column | str) -> Column:
    """2 * min(na, nb) / (na + nb): never below the likeness; 1 for two empty lists."""
    na, nb = F.size(_c(a_tokens)), F.size(_c(b_tokens))
    return F.when(na + nb > 0, F.lit(2.0) * F.least(na, nb) / (na + nb)).otherwise(1.0)


def overlap_bound(a_tokens: Column | str, b_tokens: Column | str) -> Column:
    """2 * sum(min(count_a, count_b)) / (na + nb), JVM-side: never below the likeness, never above the length bound."""
    a, b = _c(a_tokens), _c(b_tokens)
    shared = F.size(F.array_intersect(numbered_tokens(a), numbered_tokens(b)))
    total = F.size(a) + F.size(b)
    return F.when(total > 0, F.lit(2.0) * shared / total).otherwise(1.0)


def lowered(c: Column | str) -> Column:
    return F.lower(F.coalesce(_c(c), F.lit("")))


def tokens_of_lowered(c: Column | str) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(TOKEN_PATTERN), 0)


def add_likeness(df: DataFrame, a_low: str, b_low: str, out: str, mask: Column | None = None) -> DataFrame:
    """Add ``out`` = likeness of two lower-cased text columns where ``mask`` holds.

    The Python UDF gets null-masked inputs for every other row and for equal texts,
    so it cuts into words and aligns only the pairs that need it.
    """
    m = F.lit(True) if mask is None else mask
    ok = m & F.col(a_low).isNotNull() & F.col(b_low).isNotNull()
    need = ok & (F.col(a_low) != F.col(b_low))
    aligned = likeness_udf(F.when(need, F.col(a_low)), F.when(need, F.col(b_low)))
    return df.withColumn(out, F.when(need, aligned).when(ok, F.lit(1.0)))


def spread_by_cost(pairs: DataFrame, a_text: str = "a_text", b_text: str = "b_text") -> DataFrame:
    """Deal pairs to tasks by the logarithm of their cost, equal costs at random:
    every task gets a few of the heaviest pairs at any input size (AQE cannot
    split a single row)."""
    tasks = 4 * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = lambda c: F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("double") + 1
    cost = F.floor(F.log2(size(a_text) * size(b_text)))
    return pairs.repartition(tasks, cost, F.pmod(F.xxhash64(F.col(a_text), F.col(b_text)), F.lit(64 * tasks)))


def score_pairs(
    pairs: DataFrame,
    a_text: str = "a_text",
    b_text: str = "b_text",
    out: str = "likeness",
    spread: bool = False,
) -> DataFrame:
    """Add ``out`` = likeness(a, b) for every row (a = source, b = edit).

    ``spread`` deals the pairs to tasks by cost first.
    """
    pairs = spread_by_cost(pairs, a_text, b_text) if spread else pairs
    df = pairs.withColumn("_a_low", lowered(a_text)).withColumn("_b_low", lowered(b_text))
    df = add_likeness(df, "_a_low", "_b_low", out, F.col(a_text).isNotNull() & F.col(b_text).isNotNull())
    return df.drop("_a_low", "_b_low")


def gate_pairs(
    pairs: DataFrame,
    threshold: float,
    a_text: str = "a_text",
    b_text: str = "b_text",
) -> DataFrame:
    """Pass/fail only: pairs whose length bound or overlap bound is below the threshold
    fail without alignment; ``likeness`` is null for those (not logged exactly).

    Words, bounds and alignment are the one Python node of the plan; equal texts do
    not reach it.
    """
    df = pairs.withColumn("_a_low", lowered(a_text)).withColumn("_b_low", lowered(b_text))
    need = F.col("_a_low") != F.col("_b_low")
    df = df.withColumn("_gate", gate_udf(threshold)(F.when(need, F.col("_a_low")), F.when(need, F.col("_b_low"))))
    df = df.withColumn("upper_bound", F.col("_gate.upper_bound"))
    df = df.withColumn("likeness", F.when(need, F.col("_gate.likeness")).otherwise(F.lit(1.0)))
    df = df.withColumn("passed", F.coalesce(F.col("likeness") >= F.lit(threshold), F.lit(False)))
    return df.drop("_gate", "_a_low", "_b_low")


# --------------------------------------------------------------------------
# Diff spans (non-equal opcodes) and top-n per pair
# --------------------------------------------------------------------------
SPAN_SCHEMA = T.StructType([
    T.StructField("pair_id", T.StringType()),
    T.StructField("tag", T.StringType()),
    T.StructField("a_start", T.IntegerType()),
    T.StructField("a_end", T.IntegerType()),
    T.StructField("b_start", T.IntegerType()),
    T.StructField("b_end", T.IntegerType()),
    T.StructField("a_len", T.IntegerType()),
    T.StructField("b_len", T.IntegerType()),
    T.StructField("a_snip", T.ArrayType(T.StringType())),
    T.StructField("b_snip", T.ArrayType(T.StringType())),
])


def _spans_fn(context: int):
    def run(batches):
        for pdf in batches:
            rows = []
            for key, a, b in zip(pdf["pair_id"], pdf["_a_low"], pdf["_b_low"]):
                a, b = words_of(a or ""), words_of(b or "")
                for tag, a0, a1, b0, b1 in alignment.gaps(a, b):
                    near = lambda words, x, y: words[max(x - context, 0):y + context]
                    rows.append((key, tag, a0, a1, b0, b1, a1 - a0, b1 - b0, near(a, a0, a1), near(b, b0, b1)))
            yield pd.DataFrame(rows, columns=[f.name for f in SPAN_SCHEMA.fields])
    return run


def diff_spans(
    pairs: DataFrame,
    a_text: str = "a_text",
    b_text: str = "b_text",
    context: int = 8,
    spread: bool = False,
) -> DataFrame:
    """One row per differing span (replace/delete/insert) with clipped snippets."""
    pairs = spread_by_cost(pairs, a_text, b_text) if spread else pairs
    df = pairs.select(
        F.col("pair_id").cast("string").alias("pair_id"),
        lowered(a_text).alias("_a_low"),
        lowered(b_text).alias("_b_low"),
    )
    # No JVM "skip equal pairs" filter here: Catalyst would push that
    # predicate below the repartition, back into the scan tasks.
    return df.mapInPandas(_spans_fn(context), SPAN_SCHEMA)


def top_spans(spans: DataFrame, limit: int = 10, sort: str = "size") -> DataFrame:
    """Top ``limit`` spans per pair: by ``a_len`` desc (ties in text order) or text order."""
    order = [F.col("a_start"), F.col("b_start")]
    if sort == "size":
        order = [F.col("a_len").desc()] + order
    w = Window.partitionBy("pair_id").orderBy(*order)
    return spans.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)
