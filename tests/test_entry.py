"""Driver contract: entry() runs and every query has a stable, named schema."""

import __spark_entry__ as E
from tests.conftest import SF


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["decile", "min_tokens", "max_tokens", "n_docs"]
    assert df.count() == 10


def test_registry_consistent():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 52


def test_incremental_scores_equal_batch(spark):
    qs = E.queries()
    stream = {r.pair_id: r.likeness for r in qs["incremental_scores"](spark, SF).collect()}
    batch = {r.pair_id: r.likeness for r in qs["pair_scores_edited"](spark, SF).collect()}
    assert stream == batch and len(batch) > 100


def test_rollup_of_calls_has_sums_errors_and_skips(spark):
    r = E.queries()["transform_rollup_calls"](spark, SF).first()
    assert min(r.wrote, r.errors, r.skipped, r.prompt_eval_count, r.eval_count) > 0 and r.files == r.wrote + r.errors + r.skipped
    assert r.attempts > r.wrote + r.errors and abs(r.prompt_tok_per_sec - 500) < 1e-6 and abs(r.gen_tok_per_sec - 250) < 1e-6


def test_incremental_queries_read_tables_of_part_files(spark, tmp_path):
    """Tables as folders of part files, named as a single file would be."""
    import datetime

    texts = [(k, "one two three four five " * (k + 1) if k % 3 else None) for k in range(12)]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    seen = [(k, datetime.datetime(2024, 1, 1 + k), k % 2, "click", 50.0) for k in range(6)]
    spark.createDataFrame(seen, "event_id long, ts timestamp, user_id long, event_type string, value double").repartition(2).write.parquet(
        f"{tmp_path}/events.parquet")
    qs = E.queries()
    rows = {name: qs[name](spark, str(tmp_path)).collect() for name in ("incremental_token_sizes", "incremental_scores", "incremental_latest")}
    assert {r.doc_id: r.words for r in rows["incremental_token_sizes"]} == {k: 5 * (k + 1) if k % 3 else 0 for k in range(12)}
    batch = {r.pair_id: r.likeness for r in qs["pair_scores_edited"](spark, str(tmp_path)).collect()}
    assert {r.pair_id: r.likeness for r in rows["incremental_scores"]} == batch and len(batch) == 12
    assert sorted(r.n_entries for r in rows["incremental_latest"]) == [3, 3]
