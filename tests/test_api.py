"""File-level API over small files written by the test."""

import json

import pytest

from scriptorium import api


def test_likeness_ratio_goldens():
    assert api.likeness_ratio("Hello, world!", "hello world") == 1.0
    assert api.likeness_ratio("", "") == 1.0 and api.likeness_ratio("", "x") == 0.0
    assert api.likeness_ratio("a b c d", "a b x d") == 0.75


def test_files_and_logs(spark, tmp_path):
    d = tmp_path / "corpus"
    d.mkdir()
    (d / "1.txt").write_text("one two three four five six")
    (d / "2.txt").write_text("one two three")
    (d / "2_cleaned.txt").write_text("One, two; three.")
    sizes = api.corpus_sizes(spark, str(d))
    assert sizes.stats.first().n_docs == 3
    assert sizes.largest.first().max_words == 6
    rows = api.split_plan(spark, str(d), threshold=5).collect()
    plan = {r.path.rsplit("/", 1)[-1]: r.bucket for r in rows}
    assert plan == {"1.txt": "large", "2.txt": "small", "2_cleaned.txt": "small"}
    assert {r.dest for r in rows} == {f"{d}/large/1.txt", f"{d}/small/2.txt", f"{d}/small/2_cleaned.txt"}
    pairs = spark.createDataFrame([("p", str(d / "1.txt"), str(d / "2.txt")),
                                   ("q", str(d / "2.txt"), str(d / "2_cleaned.txt"))],
                                  "pair_id string, a_path string, b_path string")
    got = {r.pair_id: r.likeness for r in api.likeness_of_files(spark, pairs, [str(d)]).collect()}
    assert got["q"] == 1.0 and got["p"] == pytest.approx(2 * 3 / 9)
    assert api.visual_diff(spark, pairs, [str(d)]).where("pair_id = 'p'").first().tag == "delete"
    a, b = tmp_path / "v2.log", tmp_path / "v3.log"
    a.write_text("\n".join(json.dumps(x) for x in [
        {"talk_id": "1", "status": "failed", "likeness": 0.5, "model_version": "v2"},
        {"talk_id": "2", "status": "succeeded", "likeness": 0.95, "model_version": "v2"}]) + "\n")
    b.write_text(json.dumps({"talk_id": "1", "status": "succeeded", "likeness": 0.92, "model_version": "x"}) + "\n")
    rep = api.compare_logs(spark, [str(a)], versions=[f"v3={b}"])
    cmp_ = rep.comparisons.first()
    assert (cmp_.base_version, cmp_.other_version, cmp_.improved, cmp_.fail_to_success) == ("v2", "v3", 1, 1)
    assert rep.improvements.first().line.startswith("1: 0.5000 -> 0.9200 (delta +0.4200)")
    assert [w.kind for w in rep.warnings.collect()] == ["version_override"]
    one = api.summarize_log(spark, str(a), threshold=0.9)
    assert one.summary.first().successes == 1 and one.histogram.count() == 11


def test_ingest_catalog_modes(spark, tmp_path):
    p = tmp_path / "cat.csv"
    p.write_text("Resource ID(s),Title,Speaker\n1,First,A\n,No id,B\n2,,C\n1,First again,A\n")
    talks, bad, counters = api.ingest_catalog(spark, str(p))
    assert counters.first().asDict() == {"written": 2, "skipped": 2, "missing_required": 2,
                                         "removed_missing_title": 1}
    t = {r.safe_name: (r.title, r.n_rows) for r in talks.collect()}
    assert t == {"1": ("First again", 2)}
    assert sorted(r.missing for r in bad.collect()) == ["resource id", "title"]
    talks_lo, _, counters_lo = api.ingest_catalog(spark, str(p), mode="log_only")
    assert counters_lo.first().written == 4 and counters_lo.first().skipped == 0
    assert {r.safe_name for r in talks_lo.collect()} == {"1", "missing-id-row-2", "2"}
    limited, _, c = api.ingest_catalog(spark, str(p), row_limit=2)
    assert c.first().written + c.first().skipped == 2


def test_split_run_skips_existing_targets(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.txt").write_text("word " * 20)
    (tmp_path / "in/sub/b.txt").write_text("few words\n")
    run = lambda **more: [tuple(r) for r in api.run_split(spark, str(tmp_path / "in"), threshold=10, **more)]
    assert run() == [("large", 1, 1, 0), ("small", 1, 1, 0)]
    small = tmp_path / "in/small/sub/b.txt"
    assert small.read_text() == "few words\n" and (tmp_path / "in/large/a.txt").read_text() == "word " * 20
    small.write_text("kept")
    (tmp_path / "in/c.txt").write_text("new")
    assert run() == [("large", 1, 0, 1), ("small", 2, 1, 1)]
    assert small.read_text() == "kept" and (tmp_path / "in/small/c.txt").read_text() == "new"
    assert run() == [("large", 1, 0, 1), ("small", 2, 0, 2)]
    assert run(overwrite=True) == [("large", 1, 1, 0), ("small", 2, 2, 0)] and small.read_text() == "few words\n"


def test_publish_run_from_files(spark, tmp_path):
    """Files in, files out; the counters that ride on the writes equal those counted from the results."""
    from scriptorium.operators import catalog as K
    from scriptorium.sources.catalog_csv import read_catalog_csv

    (tmp_path / "talks.csv").write_text(
        "\ufeffResource ID(s),Title,Speaker,Duration\n1,One,A,10 (approx)\n2,\"Two\nlines\",B,20\n,No id,C,1\n4,,D,1\n5,Five,E,5\n1,One again,A,11\n", encoding="utf-8")
    words = "the talk has some words that were said and written down here "
    for name, text in {"raw/1.txt": words * 3, "raw/2.txt": words, "out/1_cleaned.txt": words * 3 + "yes", "out/2_cleaned.txt": "something else entirely"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    sources = {"transcript_raw": {"directory": str(tmp_path / "raw"), "filename_templates": ["{id}.txt"]},
               "transcript_structured": {"directory": str(tmp_path / "out"), "filename_templates": ["{id}.txt", "{id}_cleaned.txt"]}}
    out = tmp_path / "pub"
    counts = api.publish_run(spark, str(tmp_path / "talks.csv"), sources, str(out), run_id="r1")
    assert counts == {(True, "merged from transcript_structured"): 1, (True, "merged from transcript_raw"): 1, (False, "no transcript found"): 1}
    one = json.loads((out / "talk_files/1.json").read_text())
    assert one["title"] == "One again" and one["transcript"].endswith("yes") and one["dataLineage"][-1]["stage"] == "transcript_structured"
    assert sorted(p.name for p in (out / "talk_files").iterdir()) == ["1.json", "2.json", "5.json"]
    validated = K.validate(read_catalog_csv(spark, str(tmp_path / "talks.csv")))
    assert spark.read.parquet(str(out / "ingest_counters")).collect() == K.ingest_counters(validated).collect()
    assert {r.missing for r in spark.read.parquet(str(out / "quarantine")).collect()} == {"resource id", "title"}
    assert {r.status for r in spark.read.json(str(out / "quality_log")).collect()} == {"succeeded", "failed"}
    assert [json.loads(r.value)["id"] for r in spark.read.text(str(out / "index")).collect()] == ["1", "2", "5"]


def test_empty_input_and_bad_files_are_errors(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    with pytest.raises(FileNotFoundError):
        api.corpus_sizes(spark, str(tmp_path / "in"))
    (tmp_path / "empty.log").write_text('\n{"talk_id": "", "likeness": 1}\n')
    with pytest.raises(ValueError, match="hold no entry"):
        api.compare_logs(spark, [str(tmp_path / "empty.log")])
    (tmp_path / "in/a.txt").write_text("one two")
    (tmp_path / "in/sub/b.txt").write_text("one two three")
    (tmp_path / "in/sub/bad.txt").write_bytes(b"one \xff two")
    roots = [str(tmp_path / "in"), str(tmp_path / "in/sub"), str(tmp_path / "in/")]
    pair = lambda b: spark.createDataFrame([("p", str(tmp_path / "in/a.txt"), str(tmp_path / b))], "pair_id string, a_path string, b_path string")
    assert [r.likeness for r in api.likeness_of_files(spark, pair("in/sub/b.txt"), roots).collect()] == [pytest.approx(4 / 5)]
    with pytest.raises(Exception, match="invalid UTF-8 in .*bad.txt"):
        api.likeness_of_files(spark, pair("in/sub/bad.txt"), roots).collect()
