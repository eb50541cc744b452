"""Quality logs (strict JSONL, last-wins, summaries, compare), deciles, transform,
id lists and the incremental stream."""

import json
import time

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import corpus as C
from scriptorium.operators import manifest as MF
from scriptorium.operators import quality as Q
from scriptorium.operators import transform as TR
from scriptorium.sources.text_files import read_quality_logs, read_stage_transcripts, read_text_corpus
from scriptorium.streaming import incremental as I


def _write_log(path, entries):
    with open(path, "w") as f:
        for e in entries:
            f.write((e if isinstance(e, str) else json.dumps(e)) + "\n")


def test_strict_jsonl_and_last_wins(spark, tmp_path):
    a, b = tmp_path / "a.log", tmp_path / "b.log"
    _write_log(a, [
        {"talk_id": "1", "status": "succeeded", "likeness": 0.95, "model_version": "v2"},
        "",
        {"talk_id": "2", "status": "failed", "likeness": "0.5", "model_version": "v2"},
        {"talk_id": "3", "status": "failed", "likeness": "x", "model_version": "v2"},
        {"talk_id": "4", "status": None, "likeness": None, "model_version": "v2"},
        {"status": "failed", "likeness": 0.1, "model_version": "v2"},
        {"talk_id": "1", "status": "failed", "likeness": 0.2, "model_version": "v2"},
    ])
    _write_log(b, [
        {"talk_id": "1", "status": "succeeded", "likeness": 0.97, "model_version": "v3"},
        {"talk_id": "2", "status": "succeeded", "likeness": 0.4, "model_version": "v3"},
        {"talk_id": "5", "status": "failed", "model_version": "v3"},
    ])
    log = read_quality_logs(spark, [str(a), str(b)])
    lines = sorted((r.source_path.rsplit("/", 1)[-1], r.line) for r in log.collect())
    assert ("a.log", 3) in lines and ("a.log", 2) not in lines  # blank line counted, skipped
    latest = {(r.model_version, r.talk_id): r for r in Q.latest_entries(Q.prepared_entries(log)).collect()}
    assert latest[("v2", "1")].likeness == 0.2 and latest[("v2", "1")].n_entries == 2
    assert latest[("v2", "2")].likeness == 0.5 and latest[("v2", "3")].likeness is None
    s = {r.model_version: r for r in Q.version_summary(Q.latest_entries(Q.prepared_entries(log))).collect()}
    assert s["v2"].total == 4 and s["v2"].successes == 0 and s["v2"].likeness_count == 2
    cmp_ = Q.compare_versions(Q.version_pairs(Q.latest_entries(Q.prepared_entries(log)))).first()
    assert (cmp_.base_version, cmp_.other_version, cmp_.matched, cmp_.compared) == ("v2", "v3", 2, 2)
    assert (cmp_.improved, cmp_.regressed, cmp_.fail_to_success) == (1, 1, 2)
    kinds = sorted(r.kind for r in Q.warnings(log).collect())
    assert kinds == ["duplicate", "missing_talk_id"]
    assert log.where("talk_id = '5'").first().has_likeness is False


def test_malformed_line_names_file_and_line(spark, tmp_path):
    p = tmp_path / "bad.log"
    _write_log(p, [{"talk_id": "1"}, "", "{not json"])
    with pytest.raises(Exception, match="Invalid JSON on line 3"):
        read_quality_logs(spark, [str(p)]).collect()


def test_histogram_and_parser(spark):
    df = spark.createDataFrame([(0.29, "succeeded"), (1.0, "failed"), (0.999, None), (None, "succeeded")],
                               "likeness double, status string").withColumn("source_path", F.lit("x"))
    h = {r.bin: r.n for r in Q.accuracy_histogram(df).collect()}
    assert h[2] == 1 and h[10] == 1 and h[9] == 1 and sum(h.values()) == 3 and len(h) == 11
    s = Q.log_summary(df).first()
    assert (s.entries, s.successes) == (3, 2)
    t = Q.log_summary(df, threshold=0.95).first()
    assert t.successes == 2


def test_deciles_slice_rule(spark):
    sized = spark.range(6032).select(F.col("id").alias("tokens"))
    d = sorted((r.decile, r.n_docs) for r in C.token_deciles(sized).collect())
    assert [n for _, n in d] == [603, 603, 603, 603, 604, 603, 603, 603, 603, 604]
    small = spark.createDataFrame([(t,) for t in [5, 1, 3]], "tokens long")
    rows = {r.decile: (r.min_tokens, r.max_tokens, r.n_docs) for r in C.token_deciles(small).collect()}
    counts, ref = [], sorted([5, 1, 3])
    for i in range(10):
        st, en = i * 3 // 10, (i + 1) * 3 // 10
        want = (0, 0, 0) if en == 0 else (ref[st], ref[en - 1], en - st)
        assert rows[i + 1] == want


def test_transform_retries_and_blank(spark):
    def Flaky():  # factory: built once per task, shipped by value
        def call(text):
            if "boom" in text:
                raise TimeoutError("slow model")
            return text.upper(), {"eval_count": 3, "eval_duration": 1_000_000_000}
        return call

    df = spark.createDataFrame([("in/a.txt", "hello\nworld"), ("in/b.txt", "  \n "), ("in/c.txt", "boom")],
                               "path string, text string")
    existing = spark.createDataFrame([("out/zzz_cleaned.txt",)], "output_path string")
    pending = TR.pending_inputs(df, "in", "out", ".txt", existing)
    log = {r.path: r for r in TR.apply_transform(pending, Flaky, retries=2).collect()}
    assert log["in/a.txt"].output == "HELLO WORLD\n" and log["in/a.txt"].status == "wrote"
    assert log["in/b.txt"].output == "" and log["in/b.txt"].attempts == 0 and log["in/b.txt"].stats is None
    assert log["in/c.txt"].status == "error" and log["in/c.txt"].attempts == 3
    r = TR.rollup(TR.apply_transform(pending, Flaky, retries=0)).first()
    assert (r.files, r.wrote, r.errors, r.eval_count) == (3, 2, 1, 3)
    done = spark.createDataFrame([("out/a_cleaned.txt",)], "output_path string")
    assert TR.pending_inputs(df, "in", "out", ".txt", done).count() == 2


def test_id_lists(spark, tmp_path):
    (tmp_path / "x_talks.txt").write_text("1\n 2 \nabc\n\n3\n")
    (tmp_path / "y_talks.txt").write_text("3\n4\n")
    ids = MF.parse_ids(MF.read_id_lists(spark, str(tmp_path)))
    assert sorted((r.source, r.ref_id) for r in ids.collect()) == [
        ("x", "1"), ("x", "2"), ("x", "3"), ("y", "3"), ("y", "4")]
    assert [r.ref_id for r in MF.cross_list_duplicates(ids).collect()] == ["3"]


def test_text_sources_and_stream(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "edited"
    raw.mkdir(), out.mkdir()
    (raw / "7.txt").write_text("one two\nthree")
    (out / "7_cleaned.txt").write_text("One two three.")
    (out / "notes.md").write_text("x")
    t = read_stage_transcripts(spark, {
        "transcript_raw": {"directory": str(raw), "filename_templates": ["{id}.txt"]},
        "transcript_structured": {"directory": str(out), "filename_templates": ["{id}_cleaned.txt"]},
    })
    assert sorted((r.talk_id, r.stage) for r in t.collect()) == [("7", "transcript_raw"), ("7", "transcript_structured")]
    assert read_text_corpus(spark, str(raw)).count() == 1
    # ST1: a rerun with the same checkpoint picks up only the new file
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    for name in ("8.txt", None):
        stream = C.with_token_sizes(I.text_file_stream(spark, str(raw))).select("path", "tokens")
        I.start_token_sizes(stream, sink, ckpt).awaitTermination()
        if name:
            (raw / name).write_text("a b c d")
    stream = C.with_token_sizes(I.text_file_stream(spark, str(raw))).select("path", "tokens")
    I.start_token_sizes(stream, sink, ckpt).awaitTermination()
    got = sorted((r.path.rsplit("/", 1)[-1], r.tokens) for r in spark.read.parquet(sink).collect())
    assert got == [("7.txt", 4), ("8.txt", 5)]


def test_version_pairs_and_reports(spark, tmp_path):
    import os

    m = Q.parse_version_pairs(["v9=" + str(tmp_path / "a.log")])
    assert list(m.values()) == ["v9"] and os.path.isabs(next(iter(m)))
    with pytest.raises(ValueError):
        Q.parse_version_pairs(["=x"])
    with pytest.raises(ValueError):
        Q.parse_version_pairs(["nopath"])
    assert Q.log_inputs([str(tmp_path / "a.log"), str(tmp_path / "a.log")], m) == [str(tmp_path / "a.log")]
    a = tmp_path / "a.log"
    _write_log(a, [{"talk_id": "1", "status": "failed", "likeness": 0.5, "model_version": "v2"}])
    log = read_quality_logs(spark, Q.log_inputs([], m))
    ent = Q.prepared_entries(log, Q.version_map_frame(spark, m)).first()
    assert ent.model_version == "v9" and ent.override_mismatch is True
    rep = Q.summary_report(Q.version_summary(Q.latest_entries(Q.prepared_entries(log)))).first()
    assert rep.success_rate_text == "0.0000" and rep.avg_likeness_text == "0.5000"


def test_run_publish(spark, tmp_path):
    from tests.test_catalog_merge import _merge_fixture
    from scriptorium.plans.publish import run_publish

    cat, tr = _merge_fixture(spark)
    out = str(tmp_path / "pub")
    counts = run_publish(spark, cat, tr, out, run_id="r1", talk_files=True)
    assert counts[(True, "merged from transcript_cleaned")] == 1
    log = spark.read.json(f"{out}/quality_log")
    assert log.count() == 3 and log.select("run_id").distinct().count() == 1
    idx = [json.loads(r.value)["id"] for r in spark.read.text(f"{out}/index").collect()]
    assert sorted(idx) == ["1", "2", "3", "4", "5"]


def test_parser_strict_likeness(spark, tmp_path):
    good, bad = tmp_path / "good.log", tmp_path / "bad.log"
    _write_log(good, [{"talk_id": "1", "status": "succeeded", "likeness": "0.91"},
                      {"talk_id": "2", "status": "failed"}])
    s = Q.log_summary(read_quality_logs(spark, [str(good)])).first()
    assert (s.entries, s.successes) == (1, 1) and s.avg_likeness == pytest.approx(0.91)
    _write_log(bad, [{"talk_id": "1", "status": "succeeded", "likeness": None}])
    with pytest.raises(Exception, match="could not convert likeness"):
        Q.log_summary(read_quality_logs(spark, [str(bad)])).collect()


def test_streamed_latest_equals_batch(spark, tmp_path):
    rows = [(1, i, f"t{i % 7}", "v1" if i % 2 else "v2", "failed" if i % 3 else "succeeded", i / 100.0)
            for i in range(200)]
    df = spark.createDataFrame(rows, "path_ordinal int, line int, talk_id string, model_version string, "
                                     "status string, likeness double")
    src = tmp_path / "log"
    df.repartition(4).write.parquet(str(src))
    stream = I.parquet_stream(spark, str(src), df, max_files=1)
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ck")
    I.start_latest_entries(stream, sink, ckpt).awaitTermination()
    got = {(r.model_version, r.talk_id): (r.line, r.n_entries) for r in I.read_latest(spark, sink).collect()}
    assert spark.read.parquet(sink).select("batch_id").distinct().count() == 4  # one file per trigger
    want = {(r.model_version, r.talk_id): (r.line, r.n_entries) for r in Q.latest_entries(df).collect()}
    assert got == want


def test_compaction_at_any_crash_point(spark, tmp_path, monkeypatch):
    """Snapshot half written, batches not or partly deleted, a batch repeated: always the state of the batch run."""
    import shutil

    def batch(number, rows):
        frame = spark.createDataFrame(rows, "model_version string, talk_id string, status string, likeness double, path_ordinal int, line int, n_entries long")
        frame.write.mode("overwrite").parquet(f"{sink}/batch_id={number}")

    sink = str(tmp_path / "sink")
    rows = lambda n, keys: [("v", f"t{k}", f"b{n}", n / 10, 0, n, n + 1) for k in keys]
    state = {}
    read = lambda: {r.talk_id: (r.status, r.line, r.n_entries) for r in I.read_latest(spark, sink).collect()}
    for n, keys in enumerate([range(5), range(3, 9), [0, 20]]):
        batch(n, rows(n, keys))
        state |= {f"t{k}": (f"b{n}", n, n + 1) for k in keys}
        assert read() == state
    shutil.copytree(sink, tmp_path / "whole")
    (tmp_path / "sink/_bases/upto=2").mkdir(parents=True)  # died while the snapshot was written
    (tmp_path / "sink/_bases/upto=2/part-0.parquet").write_text("half")
    assert read() == state
    assert I.compact_latest(spark, sink) == 2 and read() == state
    assert not [p for p in (tmp_path / "sink").iterdir() if p.name.startswith("batch_id=")]
    for number in (0, 2):  # died before all batches were deleted; the last one repeated
        shutil.copytree(tmp_path / f"whole/batch_id={number}", tmp_path / f"sink/batch_id={number}")
    assert read() == state
    batch(3, rows(3, [1, 30]))
    state |= {f"t{k}": ("b3", 3, 4) for k in (1, 30)}
    assert read() == state and I.compact_latest(spark, sink) == 3 and read() == state
    assert [p.name for p in (tmp_path / "sink/_bases").iterdir()] == ["upto=3"] and I.compact_latest(spark, sink) == 3 and read() == state


def test_files_are_committed_together(spark, tmp_path):
    """A failed task leaves no file; sub-folders, replaced files and bytes are as one open() would write them."""
    from pyspark.sql import functions as F2

    from scriptorium.sinks.files import listed, write_files

    out = tmp_path / "out"
    rows = [(f"sub{k % 3}/n{k}.txt", f"line {k}\r\nü\n" if k else None) for k in range(40)]
    df = spark.createDataFrame(rows, "name string, content string").repartition(4)
    write_files(spark, df, str(out), F2.col("name"), F2.col("content"))
    # a task of the failed job that is still being stopped may write to its hidden staging folder
    read = lambda: {p.relative_to(out).as_posix(): p.read_bytes() for p in out.rglob("*") if p.is_file() and "_staging-" not in str(p)}
    assert read() == {n: (c or "").encode() for n, c in rows}
    broken = df.withColumn("content", F2.when(F2.col("name") == "sub1/n7.txt", F2.raise_error(F2.lit("lost"))).otherwise(F2.lit("other")))
    with pytest.raises(Exception, match="lost"):
        write_files(spark, broken, str(out), F2.col("name"), F2.col("content"))
    assert read() == {n: (c or "").encode() for n, c in rows} and sorted(p.name for p in out.iterdir() if p.name[0] != "_") == ["sub0", "sub1", "sub2"]
    write_files(spark, df.limit(1), f"file://{out}", F2.lit("sub1/n7.txt"), F2.lit("new"))
    assert read()["sub1/n7.txt"] == b"new" and listed(spark, str(out / "sub1"), str(tmp_path / "missing")).count() == 13


def test_hot_key_and_partition_independence(spark):
    """One (version, talk) holds a third of all rows; results do not depend on
    the shuffle partition count."""
    rows = []
    for i in range(3000):
        talk = "hot" if i % 3 == 0 else f"t{i}"
        rows.append((i // 1000, i, talk, "v1" if i % 2 else "v2", "failed", (i % 100) / 100.0, "f"))
    log = spark.createDataFrame(rows, "path_ordinal int, line int, talk_id string, model_version string, "
                                      "status string, likeness double, source_path string")
    results = []
    for parts in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        lat = Q.latest_entries(Q.prepared_entries(log))
        hot = {r.model_version: (r.line, r.n_entries) for r in lat.where("talk_id = 'hot'").collect()}
        dups = Q.warnings(log).where("kind = 'duplicate'").count()
        results.append((hot, dups, lat.count()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]
    hot, dups, n = results[0]
    assert hot["v2"] == (2994, 500) and hot["v1"] == (2997, 500) and dups == 998


def test_rerun_has_no_pending_and_metamorphic_likeness(spark, tmp_path):
    df = spark.createDataFrame([("in/a.txt", "Hello, World.\\nline two"), ("in/b.txt", "x y")],
                               "path string, text string")
    pending = TR.pending_inputs(df, "in", "out", ".txt")
    out = str(tmp_path / "outputs")
    TR.write_outputs(TR.apply_transform(pending, lambda: (lambda t: t.lower())), out)
    listing = spark.read.parquet(out).select("output_path")
    assert TR.pending_inputs(df, "in", "out", ".txt", listing).count() == 0
    from scriptorium.operators import scoring as S

    base = "The quick brown fox jumps over the lazy dog again and again"
    variants = [base.upper(), base.replace(" ", "\n"), base.replace(" ", ", "), "  " + base + "!!"]
    pairs = spark.createDataFrame([(str(i), base, v) for i, v in enumerate(variants)],
                                  "pair_id string, a_text string, b_text string")
    assert {r.likeness for r in S.score_pairs(pairs).collect()} == {1.0}


def test_deciles_match_slice_rule_random(spark):
    import random

    rnd = random.Random(5)
    for n in (1, 7, 10, 23, 101):
        vals = [rnd.randint(0, 50) for _ in range(n)]
        got = {r.decile: (r.min_tokens, r.max_tokens, r.n_docs) for r in
               C.token_deciles(spark.createDataFrame([(v,) for v in vals], "tokens long")).collect()}
        c = sorted(vals)
        for i in range(10):
            st, en = i * n // 10, (i + 1) * n // 10
            assert got[i + 1] == ((0, 0, 0) if en == 0 else (c[st], c[en - 1], en - st)), (n, i)


def test_cleaned_text_files(spark, tmp_path):
    from scriptorium.sinks.json_docs import write_text_files

    df = spark.createDataFrame([("in/sub/a.txt", "A b"), ("in/c.txt", "")], "path string, text string")
    log = TR.apply_transform(TR.pending_inputs(df, "in", "out", ".txt"), lambda: (lambda t: t.upper()))
    log = log.withColumn("rel", F.regexp_replace("output_path", "^out/", ""))
    write_text_files(spark, log, str(tmp_path / "out"), "rel", "output")
    assert (tmp_path / "out" / "sub" / "a_cleaned.txt").read_text() == "A B\n"
    assert (tmp_path / "out" / "c_cleaned.txt").read_text() == ""


def test_incremental_transform_only_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("first  file\nwrapped")
    out, ck = str(tmp_path / "log"), str(tmp_path / "ck")
    calls = lambda: (lambda t: t.upper())
    I.start_incremental_transform(spark, str(src), out, ck, calls).awaitTermination()
    (src / "b.txt").write_text("second")
    I.start_incremental_transform(spark, str(src), out, ck, calls).awaitTermination()
    rows = sorted((r.output_path, r.output) for r in spark.read.parquet(out).collect())
    assert rows == [("cleaned/a_cleaned.txt", "FIRST FILE WRAPPED\n"), ("cleaned/b_cleaned.txt", "SECOND\n")]


def test_log_folder_order(spark, tmp_path):
    d = tmp_path / "logs"
    d.mkdir()
    _write_log(d / "run_2.log", [{"talk_id": "1", "status": "failed", "likeness": 0.2, "model_version": "v"}])
    _write_log(d / "run_1.log", [{"talk_id": "1", "status": "failed", "likeness": 0.1, "model_version": "v"}])
    extra = tmp_path / "late.log"
    _write_log(extra, [{"talk_id": "1", "status": "succeeded", "likeness": 0.9, "model_version": "v"}])
    log = read_quality_logs(spark, [str(d), str(extra)])
    order = sorted((r.path_ordinal, r.source_path.rsplit("/", 1)[-1]) for r in log.collect())
    assert [n for _, n in order] == ["run_1.log", "run_2.log", "late.log"]
    assert Q.latest_entries(Q.prepared_entries(log)).first().likeness == 0.9
    log2 = read_quality_logs(spark, [str(extra), str(d)])
    assert Q.latest_entries(Q.prepared_entries(log2)).first().likeness == 0.2


@pytest.mark.parametrize("n,ok,text", [(77, 10, "0.1299"), (56, 19, "0.3393"), (56, 11, "0.1964")])
def test_published_success_rates(spark, n, ok, text):
    rows = [(str(i), "succeeded" if i < ok else "failed", 0.5, "v", "p", 0, i) for i in range(n)]
    log = spark.createDataFrame(rows, "talk_id string, status string, likeness double, model_version string, "
                                      "source_path string, path_ordinal int, line int")
    rep = Q.summary_report(Q.version_summary(Q.latest_entries(Q.prepared_entries(log)))).first()
    assert (rep.total, rep.successes, rep.success_rate_text) == (n, ok, text)


def test_histogram_extreme_scores(spark):
    df = spark.createDataFrame([(1e300,), (-5.0,), (0.999999,), (1.0,)], "likeness double") \
        .withColumn("source_path", F.lit("x"))
    h = {r.bin: r.n for r in Q.accuracy_histogram(df).collect()}
    assert h[10] == 2 and h[0] == 1 and h[9] == 1


def test_newlines_and_strict_utf8(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "5.txt").write_bytes(b"one\r\ntwo\rthree\n")
    t = read_stage_transcripts(spark, {"transcript_raw": {"directory": str(raw), "filename_templates": ["{id}.txt"]}})
    assert t.first().text == "one\ntwo\nthree\n"
    assert read_text_corpus(spark, str(raw)).first().text == "one\ntwo\nthree\n"
    (raw / "6.txt").write_bytes(b"bad \xff byte")
    with pytest.raises(Exception, match="invalid UTF-8"):
        read_stage_transcripts(spark, {"transcript_raw": {"directory": str(raw),
                                                          "filename_templates": ["{id}.txt"]}}).collect()
    corpus = {r.path.rsplit("/", 1)[-1]: r.text for r in read_text_corpus(spark, str(raw)).collect()}
    assert corpus["6.txt"] == "bad \ufffd byte"


def test_per_document_rates(spark):
    from scriptorium.operators.transform import STATS_TYPE

    rows = [("a", 1000, 2.0, {"prompt_eval_count": 100, "prompt_eval_duration": 2_000_000_000,
                               "eval_count": 50, "eval_duration": 0, "total_duration": 3_000_000_000}),
            ("b", 0, 0.0, None)]
    df = spark.createDataFrame(rows, "path string, output_chars long, elapsed double, stats " +
                               STATS_TYPE.simpleString())
    r = {x.path: x for x in TR.with_rates(df).collect()}
    assert r["a"].out_chars_per_sec == 500 and r["a"].prompt_tok_per_sec == 50.0
    assert r["a"].gen_tok_per_sec is None and r["a"].model_seconds == 3.0
    assert r["b"].out_chars_per_sec is None and r["b"].prompt_tok_per_sec is None
