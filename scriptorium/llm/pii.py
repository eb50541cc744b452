"""Personal data: fixed patterns as seeds, contextual patterns found by bootstrapping.

Only DataFrame functions run.  Positions come from splitting a text by a
pattern: the pieces between the matches give every match's start.

1. ``spans_of_text`` finds the base spans of the four kinds in the whole text.
2. ``mentions`` lists words, and digit groups set apart by blanks, that look like
   identifiers, each with the words before it.  A mention in which a base span
   starts is a seed of its kind.
3. ``induced`` scores the graph of contexts (patterns) and values (instances)
   in rounds: a pattern's confidence in a kind is the share of that kind among
   its distinct labelled values and those that can be no identifier; values that
   nobody has labelled yet speak against it in part where they look unlike that
   kind (digit count, separators), else not at all.  An instance's is the
   noisy-or of its patterns.  Values over the threshold are identifiers that
   no base pattern names; they label contexts in turn, until nothing new passes.

Only contexts that could pass if all their identifier-like values were of one
kind, and have one to reveal, enter the graph.  Edges are pre-aggregated to
distinct (pattern, value) before they are shuffled, sums combine on the map
side, and the joins are plain equi-joins that adaptive execution can split, so
one frequent context does not fill one task.

Cases: a null or empty text has no spans.  Rows are judged one by one, so
repeated rows and repeated or null ids keep a row each.  Columns other than
``doc_id`` and ``text`` are not read, or pass through ``masked`` unchanged.
Overlapping base spans of different kinds all stay; an induced span never
overlaps a base span.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import let, sent, written

KINDS = ("email", "ip", "card", "phone")
# The four base patterns.  Look-behinds and possessive loops only
# keep long runs linear; they match what the plain patterns match leftmost.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap tests that every text with a match passes.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

MENTION = r"\+[0-9][\x20().0-9-]+[0-9]|(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
# Two or more groups of digits with single blanks between them.
GROUPS = r"(?<!\S)\(?[0-9][0-9().-]*+(?:\x20\(?[0-9][0-9().-]*+)+(?![^\s,;:!?\"'\])}>»”])"
EDGE = r"^[(\[{<\"'«“]*(.*?)[)\]}>\"'»”.,;:!?]*$"


@dataclass(frozen=True)
class Induction:
    """How strict the bootstrapping is."""

    support: float = 3.0  # distinct labelled values that a pattern needs
    pattern_confidence: float = 0.8
    instance_confidence: float = 0.8
    min_digits: int = 6  # an induced identifier has an @ or so many digits
    unlike: float = 0.2  # vote of an unlabelled value that looks unlike the kind, against a labelled one's


# How a value of each kind looks, loosely: also where no base pattern takes it.
LOOKS = {
    "email": lambda v: F.contains(v, F.lit("@")),
    "ip": lambda v: v.rlike(r"^[0-9]{1,3}(?:[^0-9\p{L}@]+[0-9]{1,3}){3}$"),
    "card": lambda v: ~v.rlike(r"[\p{L}@]") & F.length(_digits(v)).between(13, 19),
    "phone": lambda v: ~v.rlike(r"[\p{L}@]") & v.rlike("[^0-9]") & F.length(_digits(v)).between(9, 15),
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) < 3) | (F.length(part(p)) == 3) & (part(p) <= "255"))
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    return F.length(_digits(value)).between(9, 15)


def _checker(kind: str):
    return lambda span: _valid(kind, span["value"])


_SPAN = "array<struct<kind:string,start:int,stop:int>>"


def _located(text: Column, pattern: str, kind: Column) -> Column:
    """Every match as (kind, start, stop, value, text before it back to the last match)."""
    state = "struct<at:int,i:int,out:array<struct<kind:string,start:int,stop:int,value:string,before:string>>>"

    def step(acc: Column, value: Column, gaps: Column) -> Column:
        gap = F.get(gaps, acc["i"])
        start = acc["at"] + F.length(gap)
        stop = start + F.length(value)
        found = F.struct(kind.alias("kind"), start.alias("start"), stop.alias("stop"), value.alias("value"), gap.alias("before"))
        return F.struct(stop.alias("at"), (acc["i"] + 1).alias("i"), F.concat(acc["out"], F.array(found)).alias("out")).cast(state)

    empty = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.array().alias("out")).cast(state)
    return let(
        F.split(text, pattern, -1),
        lambda gaps: F.aggregate(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), empty, lambda acc, v: step(acc, v, gaps), lambda acc: acc["out"]
        ),
    )


def spans_of_text(text: Column) -> Column:
    """The base spans of a text, by kind as listed, then start."""
    parts = []
    for kind in KINDS:
        found = F.filter(_located(text, PATTERNS[kind], F.lit(kind)), _checker(kind))
        slim = F.transform(found, lambda s: F.struct(s["kind"], s["start"], s["stop"])).cast(_SPAN)
        hint = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else text.rlike("[0-9](?:[ -]?[0-9]){12}")
        parts.append(F.when(hint, slim).otherwise(F.array().cast(_SPAN)))
    return F.concat(*parts)


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _mentions_of(text: Column, base: Column) -> Column:
    """Words with a digit or an @, and spaced digit groups, without the marks around them, and their left context."""

    def clean(m: Column) -> Column:
        inner = F.regexp_extract(m["value"], EDGE, 1)
        start = m["start"] + F.position(inner, m["value"]) - 1
        return F.struct(
            start.alias("start"),
            (start + F.length(inner)).alias("stop"),
            inner.alias("value"),
            # The last two whole words of the gap, found from its end; a blank gap follows another mention.
            F.lower(F.reverse(F.regexp_extract(F.reverse(m["before"]), r"^\s*+(\S++(?:\s++\S++)?+)", 1))).alias("before"),
        )

    def labelled(m: Column) -> Column:
        seeds = F.filter(base, lambda b: (b["start"] >= m["start"]) & (b["start"] < m["stop"]))
        return F.struct(
            m["start"].alias("start"), m["stop"].alias("stop"), m["value"].alias("value"), m["before"].alias("before"),
            F.get(seeds, F.lit(0))["kind"].alias("seed"),
            F.exists(base, lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])).alias("taken"),
        )

    # A word of one sign only is no identifier.
    every = F.concat(_located(text, MENTION, F.lit("")), F.when(text.rlike(GROUPS), _located(text, GROUPS, F.lit(""))).otherwise(F.array()))
    found = F.filter(F.transform(every, clean), lambda m: F.length(m["value"]) >= 5)
    every = F.transform(found, labelled)
    return F.filter(every, lambda m: m["seed"].isNotNull() | ~m["taken"])


def located(docs: DataFrame) -> DataFrame:
    """(row, doc_id, base, mentions) of every row, written: both later steps start from it."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kind = "array<struct<start:int,stop:int,value:string,before:string,seed:string,taken:boolean>>"
    base = docs.select("doc_id", raw.alias("text")).withColumn("base", spans_of_text(F.col("text")))
    both = base.withColumn(
        "mentions",
        F.when(F.col("text").rlike("[0-9@]"), _mentions_of(F.col("text"), F.col("base")).cast(kind)).otherwise(F.array().cast(kind)),
    )
    return written(both.select(F.monotonically_increasing_id().alias("row"), "doc_id", "base", "mentions"), "pii")


def _patterns(before: Column, value: Column) -> Column:
    """Lexical patterns of a mention: the two words before it, the word before it with the value's shape."""
    words = F.split(F.btrim(before), r"\s+")
    last, previous = F.element_at(words, -1), F.element_at(words, -2)
    shape = F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), r"\p{L}+", "a")
    has = F.btrim(before) != ""
    return F.filter(
        F.array(
            F.when(has & (F.size(words) > 1), F.concat_ws(" ", F.lit("2"), previous, last)),
            F.when(has, F.concat_ws(" ", F.lit("s"), last, shape)),
        ),
        lambda p: p.isNotNull(),
    )


def induced(found: DataFrame, how: Induction = Induction()) -> DataFrame:
    """(row, kind, start, stop) of identifiers that the contexts of the seeds reveal."""
    one = found.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    each = one.withColumn("pattern", F.explode(_patterns(F.col("before"), F.col("value"))))
    like_id = F.contains(F.col("value"), F.lit("@")) | (F.length(_digits(F.col("value"))) >= how.min_digits)
    edges = each.groupBy("pattern", "value").agg(F.max("seed").alias("seed")).withColumn("may", F.col("seed").isNotNull() | like_id)
    counts = edges.groupBy("pattern").agg(
        F.count_if("may").alias("n_may"), F.count_if(~F.col("may")).alias("n_none"), F.count_if(F.col("may") & F.col("seed").isNull()).alias("n_free")
    )
    live = counts.where(
        (F.col("n_free") > 0) & (F.col("n_may") > how.support) & (F.col("n_may") >= how.pattern_confidence * (F.col("n_may") + F.col("n_none")))
    )
    graph = written(edges.where("may").drop("may").join(live.select("pattern", "n_none"), "pattern"), "pii-graph")

    known = graph.where("seed is not null").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    order = Window.partitionBy("value").orderBy(F.desc("score"), F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))
    best, n_best = None, 0
    while True:
        scores = known if best is None else known.unionByName(best.join(known, "value", "left_anti"))
        free = F.col("kind").isNull()
        sums = graph.join(scores, "value", "left").groupBy("pattern").agg(
            F.first("n_none").alias("n_none"), F.sum(F.coalesce("score", F.lit(0.0))).alias("labelled"),
            *[F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(k) for k in KINDS],
            *[F.count_if(free & ~LOOKS[k](F.col("value"))).alias(f"un_{k}") for k in KINDS],
        )
        share = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("s"), F.col(f"un_{k}").alias("un")) for k in KINDS]))
        strong = (
            sums.select("pattern", (F.col("labelled") + F.col("n_none")).alias("n"), share.alias("own")).select("pattern", "n", "own.*")
            .withColumn("n", F.col("n") + how.unlike * F.col("un"))
            .where((F.col("s") >= how.support - 1e-9) & (F.col("s") >= how.pattern_confidence * F.col("n") - 1e-9))
            .select("pattern", "kind", (F.col("s") / F.col("n")).alias("confidence"))
        )
        miss = F.exp(F.sum(F.log(F.lit(1.0000001) - F.col("confidence"))))
        fresh = (
            graph.where("seed is null").select("pattern", "value").join(strong, "pattern")
            .groupBy("value", "kind").agg(F.round(1 - miss, 6).alias("score")).where(F.col("score") >= how.instance_confidence)
            .withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")
        )
        # A value keeps the kind with which it passed, so every round but the last adds one and the rounds end.
        best = written(fresh if best is None else best.unionByName(fresh.join(best, "value", "left_anti")), "pii-labels")
        now = best.count()
        if now == n_best:
            break
        n_best = now
    free = one.where("seed is null").select("row", "value", "start", "stop")
    return free.join(best.select("value", "kind"), "value").select("row", "kind", "start", "stop").distinct()


def _outermost(spans: Column) -> Column:
    """Spans by start that lie in no other one: a word may also stand in a group of words."""
    state = "struct<at:int,out:array<struct<rank:int,start:int,stop:int,kind:string>>>"
    empty = F.struct(F.lit(-1).alias("at"), F.array().alias("out")).cast(state)
    by_start = F.array_sort(spans, lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["stop"] - a["stop"]))
    return F.aggregate(
        by_start, empty,
        lambda acc, s: F.when(s["stop"] > acc["at"], F.struct(s["stop"].alias("at"), F.concat(acc["out"], F.array(s)).alias("out")).cast(state)).otherwise(acc),
        lambda acc: acc["out"],
    )


def detected(docs: DataFrame, how: Induction = Induction()) -> DataFrame:
    """(row, doc_id, base, spans): base spans and all spans of every row of ``docs``."""
    found = located(docs)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    more = induced(found, how).groupBy("row").agg(
        F.collect_list(F.struct(rank.cast("int").alias("rank"), "start", "stop", "kind")).alias("more")
    ).withColumn("more", _outermost(F.col("more")))
    ranked = lambda s: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int").alias("rank"),
        s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"),
    )
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(
        F.transform(
            F.sort_array(F.concat(F.transform("base", ranked), F.col("more"))),
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")),
        )
    )
    return found.drop("mentions").join(more, "row", "left").select("row", "doc_id", "base", every.cast(_SPAN).alias("spans"))


def masked(docs: DataFrame, how: Induction = Induction()) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; null texts stay null.

    Base spans are found again where a text is rebuilt, so only induced ones travel:
    they are sent to the texts where that is a checked small table, else joined by
    a shuffle.  They meet by id and text digest, so equal rows get equal spans.
    """
    key = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = located(docs.select(key.alias("doc_id"), "text"))
    more = induced(found, how).join(found.select("row", F.col("doc_id").alias("__pii_key")), "row")
    more = more.groupBy("__pii_key").agg(F.collect_set(F.struct("kind", "start", "stop")).cast(_SPAN).alias("__pii_more"))
    more = sent(written(more, "pii-more"), 24 * F.size("__pii_more") + 16)

    def rebuild(text: Column, found: Column) -> Column:
        by_start = F.sort_array(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
        state = "struct<at:int,out:array<string>>"
        empty = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(state)

        def step(acc: Column, s: Column) -> Column:
            # A span inside an earlier one adds nothing; one that sticks out extends it.
            fresh = F.concat(
                F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))),
                F.when(s["start"] >= acc["at"], F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit("")),
            )
            out = F.when(s["stop"] > acc["at"], F.concat(acc["out"], F.array(fresh))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), out.alias("out")).cast(state)

        rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
        return F.aggregate(by_start, empty, step, rest)

    raw = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.withColumn("__pii_key", key).join(more, "__pii_key", "left")
    spans = F.concat(spans_of_text(raw), F.coalesce("__pii_more", F.array().cast(_SPAN)))
    joined = joined.withColumn("__pii_spans", spans)
    text = F.when(F.size("__pii_spans") == 0, F.col("text")).otherwise(rebuild(raw, F.col("__pii_spans")))
    return joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
