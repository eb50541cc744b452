"""Whole runs and the edges that earlier oracles did not reach."""

import random
import shutil
import statistics
import time
from difflib import SequenceMatcher
from urllib.error import URLError

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.operators import alignment
from scriptorium.operators import catalog as K
from scriptorium.operators import quality as Q
from scriptorium.operators import runs as R
from scriptorium.operators import transform as T
from scriptorium.sources.catalog_csv import read_catalog_csv


def test_catalog_rows_are_numbered_over_files(spark, tmp_path):
    for name, ids in (("a.csv", ["", "x", ""]), ("b.csv", ["", "x", "", ""])):
        rows = "".join(f'"{i}","{name} {k}"\n' for k, i in enumerate(ids))
        (tmp_path / name).write_text("Resource ID(s),Title\n" + rows, encoding="utf-8")
    rows = K.validate(read_catalog_csv(spark, str(tmp_path)))
    talks = {r.safe_name: r.title for r in K.latest_per_name(K.to_talks(rows, "log_only")).collect()}
    assert set(talks) == {"x", *(f"missing-id-row-{k}" for k in (1, 3, 4, 6, 7))} and talks["x"] == "b.csv 1"
    assert sorted(r.src_row for r in read_catalog_csv(spark, str(tmp_path), row_limit=4).collect()) == [1, 2, 3, 4]


def _unsplit(spark, path, header):
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(", ".join("`" + c.replace("`", "``") + "` string" for c in header))
          .csv(path).withColumn("f", F.col("_metadata.file_path")).withColumn("i", F.monotonically_increasing_id()))
    return [tuple(r)[:-2] for r in sorted(df.collect(), key=lambda r: (r.f, r.i))]


@pytest.mark.parametrize("size", [17, 64, 1 << 20])
def test_csv_records_over_splits_equal_the_unsplit_reader(spark, tmp_path, size):
    """Quoted breaks, doubled quotes, blank lines, short and long rows at every offset near a split, over several files."""
    rnd = random.Random(size)
    header = ["Resource ID(s)", "Title", "a b`c"]

    def field() -> str:
        kind = rnd.random()
        if kind < 0.4:
            return rnd.choice(["", "x", "é ü", "a b", "1"])
        inner = "".join(rnd.choice(["a", "\n", '""', ",", "é", "\n\n", "long text "]) for _ in range(rnd.randint(0, 6)))
        return f'"{inner}"'

    for name in ("a.csv", "b.csv", "c.csv"):
        rows = [",".join(field() for _ in range(rnd.choice([3, 3, 3, 2, 4]))) for _ in range(60)]
        rows = [r for r in rows if r] + ["", "z,end,"]
        rnd.shuffle(rows)
        head = ",".join('"' + h + '"' for h in header)
        (tmp_path / name).write_bytes((("\ufeff" if name == "b.csv" else "") + head + "\n" + "\n".join(rows) + rnd.choice(["", "\n", "\n\n"])).encode())
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(old, (str(size), "1")):
        spark.conf.set(k, v)
    try:
        got = read_catalog_csv(spark, str(tmp_path))
        assert got.columns == [*header, "src_row"]
        rows = sorted(got.collect(), key=lambda r: r.src_row)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = _unsplit(spark, str(tmp_path), header)
    assert [r.src_row for r in rows] == list(range(1, len(want) + 1))
    assert [tuple(r)[:-1] for r in rows] == want


def test_csv_with_carriage_returns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'Resource ID(s),Title\r\n1,"two\r\nlines"\r\n\r\n2,"said ""no"""\r\n3,\r\n')
    got = sorted(tuple(r) for r in read_catalog_csv(spark, str(tmp_path)).collect())
    assert got == [("1", "two\r\nlines", 1), ("2", 'said "no"', 2), ("3", None, 3)]


def test_missing_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Resource ID(s),Other\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError, match="Title"):
        read_catalog_csv(spark, str(tmp_path))


def _edited(rnd, a: list[str], edits: int, words: list[str]) -> list[str]:
    b = list(a)
    for _ in range(edits):
        at = rnd.randrange(len(b) + 1)
        b[at:at + rnd.randint(0, 2)] = [rnd.choice(words)] * rnd.randint(0, 2)
    return b


def test_alignment_equals_longest_block_reference():
    rnd = random.Random(1)
    for _ in range(1500):
        words = [str(n) for n in range(rnd.choice([1, 2, 3, 6, 30]))]
        a = [rnd.choice(words) for _ in range(rnd.randint(0, 50))]
        b = list(a) if rnd.random() < 0.5 else [rnd.choice(words) for _ in range(rnd.randint(0, 50))]
        b = _edited(rnd, b, rnd.randint(0, 5), words)
        reference = SequenceMatcher(None, a, b, autojunk=False)
        assert alignment.likeness(a, b) == pytest.approx(reference.ratio())
        assert alignment.gaps(a, b) == [o for o in reference.get_opcodes() if o[0] != "equal"]


def test_alignment_of_long_texts():
    """Frequent words, many edits and periodic texts stay quick; no equal pairs are listed."""
    rnd = random.Random(2)
    often = lambda n: [f"w{int(8000 ** rnd.random())}" for _ in range(n)]
    a = often(3000)
    for b in (_edited(rnd, a, 200, a), often(3000), a[1500:] + a[:1500]):
        reference = SequenceMatcher(None, a, b, autojunk=False)
        assert alignment.gaps(a, b) == [o for o in reference.get_opcodes() if o[0] != "equal"]
    a = often(40_000)
    b = _edited(rnd, a, 800, a)
    periodic = ["x", "y"] * 20_000
    began = time.perf_counter()
    assert alignment.likeness(a, b) > 0.95
    assert alignment.gaps(["x"] * 40_000, ["x"] * 39_990) == [("delete", 39_990, 40_000, 39_990, 39_990)]
    assert alignment.likeness(periodic, periodic[1:] + ["z"]) == pytest.approx(39_999 / 40_000)
    assert time.perf_counter() - began < 20


def test_aligner_starts_from_the_diagonal_of_a_part(monkeypatch):
    """A text with some inserts is aligned by a few probes for each part, not by bisecting every length."""
    rnd = random.Random(4)
    a = [f"w{rnd.randrange(4000)}" for _ in range(2000)]
    b = list(a)
    for at in (1900, 1700, 1500, 1000):
        b.insert(at, "new")
    calls, of = [], alignment.Hashes.of
    monkeypatch.setattr(alignment.Hashes, "of", lambda self, *args: calls.append(1) or of(self, *args))
    assert [g[:3] for g in alignment.gaps(a, b)] == [("insert", at, at) for at in (1000, 1500, 1700, 1900)]
    assert len(calls) <= 4 * 5


def test_hashes_equal_by_chance_fall_back_to_exact_runs(monkeypatch):
    rnd = random.Random(6)
    monkeypatch.setattr(alignment.Hashes, "of", lambda self, start, end, length: np.zeros(max(end - length + 1 - start, 0), np.uint64))
    for _ in range(50):
        a, b = ([str(rnd.randrange(6)) for _ in range(rnd.randint(0, 40))] for _ in range(2))
        assert alignment.gaps(a, b) == [o for o in SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if o[0] != "equal"]


def test_runs_are_numbered_alike_when_equal():
    rnd = random.Random(3)
    words = np.asarray([rnd.randrange(3) for _ in range(64)])
    words[32:] = words[:32]
    runs = alignment.Runs(words)
    for length in range(1, 33):
        left, right = runs.of(0, 32, length), runs.of(32, 64, length)
        assert (left == right).all()
        for i in range(len(left)):
            for j in range(len(left)):
                assert (left[i] == left[j]) == (words[i:i + length] == words[j:j + length]).all()


def test_numbers_in_reports(spark):
    df = spark.createDataFrame([("0.5",), ("0.5d",), ("1f",), ("nope",), (None,), (" 3e-1 ",)], "v string")
    assert [r[0] for r in df.select(Q.coerce_likeness("v")).collect()] == [0.5, None, None, None, None, 0.3]
    ties = spark.createDataFrame([(1 / 32,), (3 / 32,), (0.12345,), (-5 / 32,), (None,)], "v double")
    assert [r[0] for r in ties.select(Q.fmt4("v")).collect()] == [*("%.4f" % x for x in (1 / 32, 3 / 32, 0.12345, -5 / 32)), "N/A"]


def test_version_arguments():
    assert list(Q.parse_version_pairs(["v1=/a=b", " v2 =/c"]).items()) == [("/a=b", "v1"), ("/c", "v2")]
    for wrong in ("v1", "=/a", "  =/a"):
        with pytest.raises(ValueError):
            Q.parse_version_pairs([wrong])


def test_medians_and_hot_keys(spark, monkeypatch):
    rows = [("v", float(x)) for x in (1, 2, 2, 9)] + [("w", 3.0), ("w", None), ("x", None), (None, 4.0), (None, 8.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    out = Q.with_median(df.groupBy("g").agg(F.count("*").alias("n")), df, ("g",), F.col("v"), "m")
    assert {r.g: r.m for r in out.collect()} == {"v": 2.0, "w": 3.0, "x": None, None: 6.0}
    every = Q.with_median(df.groupBy().agg(F.count("*").alias("n")), df, (), F.col("v"), "m")
    assert [(r.n, r.m) for r in every.collect()] == [(9, statistics.median(v for _, v in rows if v is not None))]
    log = spark.createDataFrame(
        [("f", 0, k, "hot" if k < 40 else f"t{k % 50}", "v1") for k in range(100)],
        "source_path string, path_ordinal int, line int, talk_id string, model_version string")
    plain = {tuple(r) for r in Q.warnings(log).collect()}
    monkeypatch.setattr(Q, "HOT_KEY", 5)
    assert {tuple(r) for r in Q.warnings(log).collect()} == plain and len(plain) == 39 + 10


@pytest.mark.parametrize("middle", [1.0, 0.1, 1 / 1000])
def test_median_selection(spark, monkeypatch, middle):
    """Odd and even counts, heavy ties, negative, tiny, huge and infinite values, NaN, nothing: as sorted values give it."""
    monkeypatch.setattr(Q, "MIDDLE", middle)
    rnd, inf = random.Random(4), float("inf")
    groups = {
        "a": [rnd.random() for _ in range(301)], "b": [rnd.gauss(0, 1e-3) for _ in range(300)], "c": [0.5] * 200 + [0.1, 0.9],
        "d": [1e308, -1e308, 3.0, 1e308], "e": [inf, 1.0, 2.0, inf, -inf], "f": [], "g": [5e-324, 0.0], "h": [7.0], "i": [1.0, float("nan"), float("nan"), 2.0, 0.0],
    }
    df = spark.createDataFrame([(k, v) for k, own in groups.items() for v in [*own, None]], "g string, v double").repartition(4)
    out = Q.with_median(df.select("g").distinct(), df, ("g",), F.col("v"), "m")
    nan_last = lambda own: sorted(own, key=lambda v: (v != v, v))
    middle = lambda own: (nan_last(own)[(len(own) - 1) // 2] + nan_last(own)[len(own) // 2]) / 2 if own else None
    assert {r.g: r.m for r in out.collect()} == {k: middle(own) for k, own in groups.items()}
    plain = [v for k in "abch" for v in groups[k]]
    some = df.where("g in ('a', 'b', 'c', 'h')")
    assert Q.with_median(some.groupBy().count(), some, (), F.col("v"), "m").first().m == statistics.median(plain)


def test_median_orders_the_middle_only(spark):
    """Of many distinct values only a small part around the middle reaches the task that orders them."""
    df = spark.range(200_000).select((F.hash("id") / 7).alias("v"))
    out = Q.with_median(df.groupBy().count(), df, (), F.col("v"), "m")
    assert out.first().m == statistics.median(r.v for r in df.collect())
    own = df.select("v", F.col("v").alias("_key"))
    low, high = own.agg(F.percentile_approx("_key", [0.5 - Q.MIDDLE / 2, 0.5 + Q.MIDDLE / 2], int(16 / Q.MIDDLE))).first()[0]
    assert own.where(f"v between {low!r} and {high!r}").count() <= 200_000 * Q.MIDDLE * 1.2


def _models():
    """A model made where it is called; nested, so that workers need not import this file."""

    def model():
        calls: dict[str, int] = {}

        def fn(text: str):
            calls[text] = calls.get(text, 0) + 1
            if "retry" in text and calls[text] == 1:
                raise URLError("busy")
            if "broken" in text:
                raise TimeoutError("gone")
            return text.upper(), {"prompt_eval_count": 3, "prompt_eval_duration": 10**9, "eval_count": 5, "eval_duration": 2 * 10**9, "total_duration": 3 * 10**9}

        return fn

    return model


def test_transform_run(spark, tmp_path):
    inputs = spark.createDataFrame(
        [("in/a.txt", "one two"), ("in/b.txt", " \n "), ("in/c.txt", "retry me"), ("in/d.txt", "broken"), ("in/e.txt", "done before")],
        "path string, text string")
    done = inputs.where("path = 'in/e.txt'").select(T.cleaned_output_path("path", "in", "out", ".txt").alias("output_path"))
    out = str(tmp_path / "run")
    with pytest.raises(RuntimeError):
        T.run_transform(inputs, "in", "out", _models(), out, existing_outputs=done, retries=1, run_id="1")
    own = R.run_log(spark, out, "1", T.RESULT_SCHEMA)
    log = {r.path[3]: r for r in own.collect()}
    assert {k: r.status for k, r in log.items()} == {"a": "wrote", "b": "wrote", "c": "wrote", "d": "error", "e": "skip"}
    assert {k: r.attempts for k, r in log.items()} == {"a": 1, "b": 0, "c": 2, "d": 2, "e": 0}
    assert {r.output.strip() for r in R.current_outputs(spark, out).collect()} == {"ONE TWO", "", "RETRY ME"}
    totals = T.rollup(own).first()
    assert (totals.wrote, totals.errors, totals.skipped, totals.attempts, totals.prompt_eval_count, totals.eval_count) == (3, 1, 1, 5, 6, 10)


def test_run_after_a_failed_one_succeeds(spark, tmp_path):
    """Fail, rerun with a working callable, overwrite: totals and errors are those of one run, each path has one output."""
    out = str(tmp_path / "run")
    inputs = spark.createDataFrame([("in/a.txt", "one"), ("in/b.txt", "broken")], "path string, text string")
    with pytest.raises(RuntimeError):
        T.run_transform(inputs, "in", "out", _models(), out, run_id="1")

    def mended():
        return lambda text: text.strip() + "!"

    log, totals = T.run_transform(inputs, "in", "out", mended, out, run_id="2")
    assert {r.path: r.status for r in log.collect()} == {"in/a.txt": "skip", "in/b.txt": "wrote"}
    assert (totals.first().wrote, totals.first().errors, totals.first().skipped) == (1, 0, 1)
    texts = lambda: {r.output_path: (r.output.strip(), r.run_id) for r in R.current_outputs(spark, out).collect()}
    assert texts() == {"out/a_cleaned.txt": ("ONE", "1"), "out/b_cleaned.txt": ("broken!", "2")}
    _, totals = T.run_transform(inputs, "in", "out", mended, out, overwrite=True, run_id="3")
    assert totals.first().wrote == 2
    assert texts() == {"out/a_cleaned.txt": ("one!", "3"), "out/b_cleaned.txt": ("broken!", "3")}
    runs = [(r.run_id, r.number, r.files, r.wrote, r.errors) for r in R.committed_runs(spark, out).orderBy("number").collect()]
    assert runs == [("1", 1, 2, 1, 1), ("2", 2, 2, 1, 0), ("3", 3, 2, 2, 0)]


def test_a_run_that_died_is_not_read(spark, tmp_path):
    """Log and outputs without a marker count for nothing, and the same run id may be used again."""
    out = str(tmp_path / "run")
    inputs = spark.createDataFrame([("in/a.txt", "one")], "path string, text string")
    T.run_transform(inputs, "in", "out", lambda: (lambda t: "half"), out, run_id="batch")
    shutil.rmtree(tmp_path / "run/runs/run_id=batch")
    assert R.finished_outputs(spark, out).isEmpty() and not R.is_committed(spark, out, "batch")
    T.run_transform(inputs, "in", "out", lambda: (lambda t: "whole"), out, run_id="batch")
    assert [r.output for r in R.current_outputs(spark, out).collect()] == ["whole"] and R.is_committed(spark, out, "batch")


def test_one_call_per_document(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counting():
        def fn(text):
            calls.add(1)
            return text
        return fn

    inputs = spark.createDataFrame([(f"in/{k}.txt", f"text {k}") for k in range(20)], "path string, text string").repartition(4)
    log, totals = T.run_transform(inputs, "in", "out", counting, str(tmp_path / "run"))
    assert (totals.first().attempts, log.count(), R.current_outputs(spark, str(tmp_path / "run")).count(), calls.value) == (20, 20, 20, 20)


def test_incremental_runs_share_the_ledger(spark, tmp_path):
    from scriptorium.streaming.incremental import start_incremental_runs

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("first")
    args = (spark, str(tmp_path / "in"), str(tmp_path / "run"), str(tmp_path / "ck"), lambda: (lambda t: t.upper()))
    start_incremental_runs(*args).awaitTermination()
    (tmp_path / "in/b.txt").write_text("second")
    start_incremental_runs(*args).awaitTermination()
    assert [(r.run_id, r.wrote) for r in R.committed_runs(spark, args[2]).orderBy("number").collect()] == [("batch-00000000", 1), ("batch-00000001", 1)]
    assert {r.output.strip() for r in R.current_outputs(spark, args[2]).collect()} == {"FIRST", "SECOND"}


def test_other_errors_fail_the_run(spark, tmp_path):
    def factory():
        def fn(text):
            raise OSError("no file")
        return fn

    inputs = spark.createDataFrame([("in/a.txt", "one")], "path string, text string")
    with pytest.raises(Exception, match="no file"):
        T.run_transform(inputs, "in", "out", factory, str(tmp_path / "run"))


def test_unknown_keys_pass_through(spark, tmp_path):
    import json

    from scriptorium.sinks.json_docs import talk_json
    from scriptorium.sources.catalog_csv import read_talk_documents

    doc = {"id": "7", "title": "T é", "tags": ["a"], "dataLineage": ["audio_original", {"likeness": 0.5, "stage": "transcript_raw"}],
           "transcript": "x\ny", "rating": 4, "Zebra": {"a": [1, None, "ü"]}, "flag": True, "note": "n", "none": None}
    (tmp_path / "7.json").write_text(json.dumps(doc, indent=2), encoding="utf-8")
    docs = read_talk_documents(spark, str(tmp_path))
    compact = talk_json(docs).first().json
    back = json.loads(compact)
    assert {k: back[k] for k in doc} == doc
    assert compact == json.dumps(back, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
    assert json.loads(talk_json(docs, pretty=True).first().json) == back
    (tmp_path / "8.json").write_text("{broken", encoding="utf-8")
    with pytest.raises(Exception):
        read_talk_documents(spark, str(tmp_path)).collect()


def test_text_stream_reads_what_the_batch_reads(spark, tmp_path):
    from scriptorium.sources.text_files import read_text_corpus
    from scriptorium.streaming.incremental import text_file_stream

    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.txt").write_bytes(b"one\r\ntwo\rthree")
    (tmp_path / "in/sub/b.txt").write_bytes(b"bad \xff byte")
    out = str(tmp_path / "out")
    (text_file_stream(spark, str(tmp_path / "in")).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
     .trigger(availableNow=True).start(out).awaitTermination())
    stream = {r.path: r.text for r in spark.read.parquet(out).collect()}
    assert stream == {r.path: r.text for r in read_text_corpus(spark, str(tmp_path / "in")).collect()} and len(stream) == 2


def test_talks_without_id_keep_their_own_key(spark):
    from scriptorium.operators import merge as M

    talks = spark.createDataFrame([(" 1 ", "1"), ("", "missing-1"), ("  ", "missing-2")], "id string, safe_name string")
    texts = spark.createDataFrame([("1", M.RAW_STAGE, "1.txt", 0, "hello"), ("", M.RAW_STAGE, ".txt", 0, "no")],
                                  "talk_id string, stage string, file string, template_rank int, text string")
    joined = M.attach_transcripts(talks, M.pivot_stages(texts, [M.RAW_STAGE]))
    assert {(r.safe_name, r.talk_id, r.st_transcript_raw and r.st_transcript_raw.text) for r in joined.collect()} == {
        ("1", "1", "hello"), ("missing-1", "", None), ("missing-2", "", None)}
    plan = joined._jdf.queryExecution().toString()
    assert "_join" in plan


def test_a_cluster_must_name_its_checkpoint_folder(spark, monkeypatch):
    from scriptorium import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
