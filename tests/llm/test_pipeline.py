"""The pipeline's stages, each on its own input, against brute force."""

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from scriptorium.llm import decontaminate, pii, quality_rules
from scriptorium.llm.base import read_table
from tests.conftest import SF
from tests.llm.test_sets import _classes

LONG = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    kept = pipeline.quality(spark, docs, SF)
    judged = {r.doc_id: r.q.kept for r in quality_rules.judged(docs, out="q").collect()}
    assert kept.columns == LONG and {r.doc_id for r in kept.collect()} == {d for d, k in judged.items() if k}

    apart = pipeline.near_duplicates(spark, kept, SF)
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert apart.columns == LONG and {r.doc_id for r in apart.collect()} == {d for d, (_, c) in _classes(rows, 5, 80).items() if d == c}

    clean = pipeline.decontamination(spark, apart, SF)
    items = [decontaminate.plain(r.text) for r in read_table(spark, SF, "benchmark").collect()]
    left = {r.doc_id for r in clean.collect()}
    for r in apart.collect():
        if any(i in decontaminate.plain(r.text) for i in items):
            assert r.doc_id not in left
    assert clean.columns == LONG and len(left) > 0.9 * apart.count()

    masked = pipeline.personal_data(spark, clean, SF)
    found = {r.doc_id: len(r.base) for r in pii.detected(clean).collect()}
    texts = {r.doc_id: r.text for r in clean.collect()}
    for r in masked.collect():
        assert (r.text == texts[r.doc_id]) == (found[r.doc_id] == 0) and r.n_chars == len(r.text)
    assert masked.columns == LONG and masked.count() == clean.count()

    packed = pipeline.packed(spark, masked, SF)
    assert {r.doc_id for r in packed.collect()} == left


def test_run(spark):
    out = pipeline.run(spark, SF)
    assert "sequence_id" in out.columns and out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
