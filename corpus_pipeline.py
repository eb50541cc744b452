"""Corpus pipeline: quality rules, near duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read back as the next one's docs.  All but the last return the columns of
documents.  As a stage begins, scratch tables of earlier stages that its docs are
not read from are dropped: their results were written; the session's batches are
lowered.

Cases: a null or empty text is a document without words, which the quality rules
reject.  Rows with equal ids are one document to the near-duplicate stage and rows
of their own to the others; equal rows are one after it.  An empty table gives an
empty one.  Columns beside those of documents pass through to the last stage, which
returns pieces; the stages' own columns have names of their own.
"""

from __future__ import annotations

import functools
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import decontaminate, ngram_jaccard, packing, pii, quality_rules
from scriptorium.llm.base import SCRATCH, drop, read_table, small_batches
from scriptorium.session import scratch_path

# Near duplicates: five words, a similarity of 0.8 or more.
NEAR = ngram_jaccard.Link(words=5, percent=80)


_left: list[str] = []  # scratch tables of earlier stages


def _stage(function):
    """``function`` as a stage: scratch tables of earlier stages go first, its own stay until a later one begins."""

    @functools.wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {part for file in docs.inputFiles() for part in file.split("/")} if _left else ()
        held = [path for path in _left if path.rpartition("/")[2] in read]
        drop(spark, *(path for path in _left if path not in held))
        small_batches(spark)
        before = len(SCRATCH)
        out = function(spark, docs, sf_dir)
        _left[:] = held + SCRATCH[before:]
        return out

    return run


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that every quality rule keeps."""
    return quality_rules.kept_documents(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest id."""
    return ngram_jaccard.first_of_class(docs, NEAR)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` follows the text."""
    out = pii.masked(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in training sequences."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]
# Near-duplicate classes, edit distance and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again."""
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        if last:
            drop(spark, last)
        docs, last = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
