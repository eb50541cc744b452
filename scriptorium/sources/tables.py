"""Driver tables and the stand-in mapping from them onto the curation data model.

The given tables are generic (documents, events, labels, ...); each stand-in is
a column mapping over *all* rows of a table, defined once here and spelled the
same way in the DuckDB oracles (``__spark_entry__.oracle_sql``):

* corpus        <- documents: path ``{doc_id}.txt``, the whole text.
* catalog       <- documents left join labels: one CSV-shaped row per document.
                   Ids of documents labelled toxic are withheld (blank), titles
                   of documents labelled low quality are withheld, Spanish
                   talks were exported under a shared ``ES/{doc_id div 10}`` id
                   (so several rows sanitise to one file name), German ids are
                   padded with spaces, English/French durations carry
                   ``(approx)``.
* transcripts   <- documents, keyed as their talks: ``transcript_raw`` for English,
                   French and German (Spanish is not transcribed yet, nor is a third
                   of the German talks, which have ``audio_original`` only);
                   ``transcript_structured`` for English and Spanish (the editing
                   model prefixed a chatty preamble); ``transcript_cleaned`` for
                   English and French (the model appended a closing offer).  Both
                   edits keep the whole raw text, so their likeness has the closed
                   form 2*na/(na+nb).  Documents that share a Spanish talk id are
                   files of templates in their order; the latest one comes first.
* edited        <- documents: the likeness tokens of the whole text with a
                   foreign word inserted after half of them, half of the rest,
                   and so on; scored by the aligner, known in closed form.
* quality log   <- events: one log file per day (``quality_{date}.log``), line
                   = position of the event inside its day, talk_id = user_id
                   (missing for ``error`` events with value < 5), version =
                   event_type, likeness = min(value/100, 1) (absent when
                   value < 1), status succeeded iff value >= 90.
* id lists      <- events: one list per event_type, one line per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import tokens_of_lowered

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed values used by the stand-in edits.
STRUCTURED_PREAMBLE = "Sure! Here is the cleaned up transcript with paragraphs:\n\n"
CLEANED_CLOSING = "\n\nLet me know if you would like any further edits."


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Spread per-document CPU work when the scan is narrower than the cluster.

    A file written as one row group scans as one task however many splits it
    gets; the regex-heavy per-document work after it would then run serially.
    Only in that case (fewer scan partitions than task slots) the rows are
    hash-repartitioned on their key; a large input already has far more splits
    than slots and is left alone, so no shuffle is added at scale.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(slots * 2, *keys)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table, balanced for per-document text work."""
    return balanced(read_table(spark, sf_dir, "documents"), "doc_id")


def corpus_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, path, lang, source, text): the text corpus."""
    d = documents(spark, sf_dir)
    return d.select(
        "doc_id",
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        "lang",
        "source",
        "text",
    )


def catalog_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV-shaped catalog (16 string headers + ``src_row``) from documents and labels."""
    # Light per-row work: no rebalancing, and only the first line of the text
    # leaves the scan (the title), not the whole text.
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", F.split(F.col("text"), "\n", 2).getItem(0).alias("first_line"))
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    rid = (
        F.when(F.col("toxic") == 1, F.lit(""))
        .when(F.col("lang") == "es", F.concat(F.lit("ES/"), F.expr("cast(doc_id div 10 as string)")))
        .when(F.col("lang") == "de", F.concat(F.lit("  "), F.col("doc_id").cast("string"), F.lit(" ")))
        .otherwise(F.col("doc_id").cast("string"))
    )
    title = F.when(F.col("quality") == 0, F.lit("")).otherwise(F.col("first_line"))
    duration = F.when(
        F.col("lang").isin("en", "fr"), F.concat(F.col("n_chars").cast("string"), F.lit(" (approx)"))
    ).otherwise(F.col("n_chars").cast("string"))
    empty = F.lit("")
    return j.select(
        rid.alias("Resource ID(s)"),
        F.lit("Audio").alias("Resource type"),
        F.lit("Published").alias("Status"),
        empty.alias("Contributed by"),
        empty.alias("Date"),
        F.col("source").alias("Audio Library Catalog ID"),
        empty.alias("Koan Case #"),
        F.col("lang").alias("Talk Location"),
        title.alias("Title"),
        empty.alias("Caption or Other Speaker"),
        F.col("source").alias("Speaker"),
        empty.alias("Koan Collection"),
        empty.alias("Track"),
        F.lit("Talk").alias("Genre"),
        duration.alias("Duration"),
        empty.alias("Training Quarter"),
        (F.col("doc_id") + 1).alias("src_row"),
    )


def stage_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transcript(talk_id, stage, file, template_rank, text)`` for four stages.

    One (balanced) scan; every document explodes into the stage rows it has.
    A union of three filtered branches would scan three times, and Catalyst
    pushes each branch's filter below the rebalancing shuffle.
    """
    d = documents(spark, sf_dir).select("doc_id", "lang", "text")
    lang, doc_id = F.col("lang"), F.col("doc_id")
    shared = lang == "es"
    number = F.when(shared, F.expr("doc_id div 10")).otherwise(doc_id).cast("string")
    tid = F.when(shared, F.concat(F.lit("ES/"), number)).otherwise(number)
    rank = F.when(shared, -doc_id).otherwise(F.lit(0)).cast("int")

    def row(stage: str, file_suffix: str, text):
        file = F.concat(F.when(shared, F.lit("ES_")).otherwise(F.lit("")), number, F.lit(file_suffix))
        return F.struct(F.lit(stage).alias("stage"), file.alias("file"), rank.alias("template_rank"), text.alias("text"))

    audio_only = (lang == "de") & (doc_id % 3 == 0)
    rows = F.array_compact(F.array(
        F.when((lang != "es") & ~audio_only, row("transcript_raw", ".txt", F.col("text"))),
        F.when(audio_only, row("audio_original", ".txt", F.col("text"))),
        F.when(lang.isin("en", "es"), row("transcript_structured", "_cleaned.txt",
                                          F.concat(F.lit(STRUCTURED_PREAMBLE), F.col("text")))),
        F.when(lang.isin("en", "fr"), row("transcript_cleaned", "_cleaned.txt",
                                          F.concat(F.col("text"), F.lit(CLEANED_CLOSING)))),
    ))
    return d.select(tid.alias("talk_id"), F.explode(rows).alias("r")).select("talk_id", "r.*")


# Words that occur nowhere in the tables, in the order in which an edit inserts them.
INSERTED = tuple(f"qzxinserted{q}" for q in range(1, 6))


def inserting_edit(text_col: str = "text"):
    """The edited stand-in: the likeness tokens with a foreign word at each cut.

    The first cut is after half of the words (rounded up), the next after half
    of the rest, and so on: n words get a word before position ``n - (n >> q)``
    for q = 1..5 while ``n >> q`` is positive.  Every part before a cut is at
    least as long as the rest, so the longest-block alignment finds exactly the
    parts: the likeness is 2n / (2n + k) for k cuts, the spans are the k inserts.
    """
    tokens = tokens_of_lowered(F.lower(F.coalesce(F.col(text_col), F.lit(""))))

    def with_cuts(words):
        n = F.size(words)
        cuts = [F.lit(0), *[n - F.shiftright(n, q) for q in range(1, len(INSERTED) + 1)], n]
        none = F.array().cast("array<string>")
        new = [none, *[F.when(F.shiftright(n, q) > 0, F.array(F.lit(x))).otherwise(none) for q, x in enumerate(INSERTED, 1)]]
        parts = [F.concat(word, F.slice(words, at + 1, to - at)) for word, at, to in zip(new, cuts, cuts[1:])]
        return F.array_join(F.concat(*parts), " ")

    # Bound once: the words are used in every part.
    return F.transform(F.array(tokens), with_cuts)[0]


def edited_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(pair_id, a_text, b_text): raw text against its edit with inserted words."""
    d = documents(spark, sf_dir).select("doc_id", "text")
    return d.select(
        F.col("doc_id").cast("string").alias("pair_id"),
        F.col("text").alias("a_text"),
        inserting_edit("text").alias("b_text"),
    )


def quality_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality-log entries with ``source_path`` and 1-based ``line`` (file order)."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    e = e.withColumn("source_path", F.concat(F.lit("quality_"), F.to_date("ts").cast("string"), F.lit(".log")))
    # Line numbers: position inside the day's file.  One small aggregate per
    # file plus a join keeps this distributed (no per-file window sort).
    first = e.groupBy("source_path").agg(F.min("event_id").alias("first_id"))
    e = e.join(first, "source_path")
    passed = F.col("value") >= 90
    return e.select(
        "source_path",
        F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("path_ordinal"),
        (F.col("event_id") - F.col("first_id") + 1).alias("line"),
        F.when((F.col("event_type") == "error") & (F.col("value") < 5), F.lit(None).cast("string"))
        .otherwise(F.col("user_id").cast("string")).alias("talk_id"),
        F.lit("transcript_structured").alias("candidate_stage"),
        F.concat(F.col("user_id").cast("string"), F.lit("_cleaned.txt")).alias("candidate_file"),
        F.when(passed, "succeeded").otherwise("failed").alias("status"),
        F.when(F.col("value") < 1, F.lit(None).cast("double"))
        .otherwise(F.least(F.col("value") / 100.0, F.lit(1.0))).alias("likeness"),
        F.when(passed, "transcript_structured").otherwise("transcript_raw").alias("selected_stage"),
        F.when(passed, F.concat(F.col("user_id").cast("string"), F.lit("_cleaned.txt")))
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".txt"))).alias("selected_file"),
        F.col("event_type").alias("model_version"),
    )


def id_list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, value): one id-list line per event, list named by event type."""
    e = read_table(spark, sf_dir, "events").select("event_type", "user_id")
    return e.select(F.col("event_type").alias("source"), F.col("user_id").cast("string").alias("value"))
