"""Catalog CSV ingest, naming rules, lineage, merge gate and index."""

import json

import pytest
from pyspark.sql import functions as F

from scriptorium.functions.lineage import build_lineage, lineage_json, lineage_stage_number
from scriptorium.functions.naming import cleaned_output_path, normalize_duration, sanitize_for_filename
from scriptorium.operators import catalog as K
from scriptorium.operators import merge as M
from scriptorium.plans.publish import publish
from scriptorium.sinks.json_docs import talk_json, write_talk_files
from scriptorium.sources.catalog_csv import read_catalog_csv, read_talk_documents

HEAD = ("Resource ID(s),Resource type,Status,Contributed by,Date,Audio Library Catalog ID,Koan Case #,"
        "Talk Location,Title,Caption or Other Speaker,Speaker,Koan Collection,Track,Genre,Duration,Training Quarter")


def _csv(tmp_path, body):
    p = tmp_path / "catalog.csv"
    p.write_bytes(("﻿" + HEAD + "\n" + body).encode("utf-8"))
    return str(p)


CSV_BODY = "\n".join([
    '10,Audio,Pub,,2020,C1,,Hall,Valid talk,,Teacher A,,,Talk,45:10 (approx),Q1',
    ',Audio,Pub,,,,,,No id,,,,,,,',
    '11,Audio,Pub,,,,,,  ,,,,,,,',
    ',,,,,,,,,,,,,,,',
    ' 12 ,Audio,Pub,,,,,, Padded title ,,,,,,30,',
    '"1, 2",Audio,Pub,,,,,,Comma id,,,,,,,',
    '13,Audio,Pub,,,,,,First,,,,,,,',
    '13,Audio,Pub,,,,,,Second wins,,,,,,,',
    '14,Audio,Pub,,,,,,"Line one',
    'line two",,,,,,,',
    '15,Audio,Pub,,,,,,"He said ""hi""",,,,,,,',
    '16,Audio,Pub,,,,,,Título ñ,,,,,,,',
    '',
    '17,Audio,Pub',
])


def test_catalog_csv_ingest(spark, tmp_path):
    rows = read_catalog_csv(spark, _csv(tmp_path, CSV_BODY))
    v = K.validate(rows)
    c = K.ingest_counters(v).first().asDict()
    # invalid: blank id, blank title, both blank, short row (title missing)
    assert c == {"written": 8, "skipped": 4, "missing_required": 4, "removed_missing_title": 3}
    talks = {r.safe_name: r for r in K.latest_per_name(K.to_talks(v)).collect()}
    assert talks["12"].title == "Padded title" and talks["12"].id == "12"
    assert talks["1_2"].id == "1, 2"
    assert talks["13"].title == "Second wins" and talks["13"].n_rows == 2
    assert talks["14"].title == "Line one\nline two"
    assert talks["15"].title == 'He said "hi"'
    assert talks["16"].title == "Título ñ"
    assert talks["10"].duration == "45:10 (approx)"
    bad = {r.src_row: r.missing for r in K.quarantine(v).collect()}
    assert bad == {2: "resource id", 3: "title", 4: "resource id, title", 12: "title"}
    lo = {r.safe_name for r in K.to_talks(v, "log_only").collect()}
    assert "missing-id-row-2" in lo and "missing-id-row-4" in lo


def test_missing_header(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("Resource ID(s),Speaker\n1,x\n")
    with pytest.raises(ValueError, match="Title"):
        read_catalog_csv(spark, str(p))


def test_scalar_rules(spark):
    df = spark.createDataFrame([(" a/b  c??.x ", "45:10 (approx)"), ("***", None)], "n string, d string")
    r = df.select(sanitize_for_filename("n").alias("s"), normalize_duration("d").alias("d")).collect()
    assert [x.s for x in r] == ["a_b_c_.x", "missing-id"]
    assert [x.d for x in r] == ["45:10", None]
    p = spark.createDataFrame([("in/sub/x.txt",), ("in/y.md",)], "path string")
    outs = [x[0] for x in p.select(cleaned_output_path("path", "in", "out", ".txt")).collect()]
    assert outs == ["out/sub/x_cleaned.txt", "out/y.md_cleaned.txt"]


def test_lineage_and_ts(spark):
    df = spark.createDataFrame(
        [("transcript_structured", 0.91234), ("transcript_cleaned", None), ("transcript_raw", None),
         (None, None), ("other", None)], "s string, l double")
    out = df.select(lineage_json(build_lineage("s", "l")).alias("j"),
                    lineage_stage_number(build_lineage("s", "l")).alias("ts")).collect()
    assert json.loads(out[0].j) == ["audio_original", "transcript_raw",
                                    {"likeness": 0.9123, "stage": "transcript_structured"}]
    assert json.loads(out[1].j) == ["audio_original", "transcript_raw", "transcript_structured", "transcript_cleaned"]
    assert json.loads(out[2].j) == ["audio_original", "transcript_raw"]
    assert json.loads(out[3].j) == ["audio_original"]
    assert [r.ts for r in out] == [3, 4, 2, 1, 0]
    small = spark.createDataFrame([("transcript_structured", 0.00049), ("transcript_structured", 0.95)],
                                  "s string, l double")
    got = [r[0] for r in small.select(lineage_json(build_lineage("s", "l"))).collect()]
    assert got[0].endswith('{"likeness":0.0005,"stage":"transcript_structured"}]')
    assert got[1].endswith('{"likeness":0.95,"stage":"transcript_structured"}]')
    empty = spark.createDataFrame([([],)], "l array<struct<stage:string,likeness:double>>")
    assert empty.select(lineage_stage_number("l")).first()[0] == 0


def _merge_fixture(spark):
    words = " ".join(f"w{i}" for i in range(40))
    cat = spark.createDataFrame([
        ("1", "t1"), ("2", "t2"), ("3", "t3"), ("4", "t4"), ("5", "t5")], "`Resource ID(s)` string, Title string")
    cat = cat.withColumn("src_row", F.monotonically_increasing_id())
    tr = spark.createDataFrame([
        ("1", "transcript_raw", "1.txt", 0, words + "\n"),
        ("1", "transcript_structured", "1_cleaned.txt", 0, words + " extra"),      # 80/81 pass
        ("2", "transcript_raw", "2.txt", 0, words),
        ("2", "transcript_structured", "2_cleaned.txt", 0, "summary only"),         # fails
        ("2", "transcript_cleaned", "2_cleaned.txt", 0, words),                     # passes
        ("3", "transcript_structured", "3_cleaned.txt", 0, "no raw, accepted"),
        ("4", "transcript_raw", "4.txt", 0, "raw only  \n\n"),
    ], "talk_id string, stage string, file string, template_rank int, text string")
    return cat, tr


def test_merge_gate(spark):
    cat, tr = _merge_fixture(spark)
    pub = publish(cat, tr, M.MergeParams(threshold=0.9))
    m = {r.id: r for r in pub.merged.collect()}
    assert m["1"].merge_reason == "merged from transcript_structured"
    assert m["1"].dataLineage[-1].likeness == pytest.approx(round(80 / 81, 4))
    assert m["2"].merge_reason == "merged from transcript_cleaned"
    assert m["3"].merge_reason == "merged from transcript_structured" and m["3"].dataLineage[-1].likeness is None
    assert m["4"].transcript == "raw only"
    assert m["5"].merge_reason == "no transcript found" and m["5"].transcript is None
    assert [x.stage for x in m["5"].dataLineage] == ["audio_original"]
    log = sorted((r.talk_id, r.candidate_stage, r.status) for r in pub.log.collect())
    assert log == [("1", "transcript_structured", "succeeded"), ("2", "transcript_cleaned", "succeeded"),
                   ("2", "transcript_structured", "failed")]
    idx = [r.id for r in M.sorted_index(pub.index).collect()]
    assert idx == sorted(idx)


def test_gate_monotone_in_threshold(spark):
    cat, tr = _merge_fixture(spark)
    passes = []
    for t in (0.5, 0.9, 0.99, 1.0):
        passes.append(publish(cat, tr, M.MergeParams(threshold=t)).log.where("status = 'succeeded'").count())
    assert passes == sorted(passes, reverse=True)


def test_export_roundtrip(spark, tmp_path):
    cat, tr = _merge_fixture(spark)
    merged = publish(cat, tr).merged
    docs = talk_json(merged)
    out = tmp_path / "talks"
    write_talk_files(spark, docs, str(out), trailing_newline=True)
    files = sorted(p.name for p in out.iterdir())
    assert files == ["1.json", "2.json", "3.json", "4.json", "5.json"]
    d1 = json.loads((out / "1.json").read_text())
    assert list(d1) == sorted(d1) and d1["dataLineage"][-1]["stage"] == "transcript_structured"
    assert "transcript" not in json.loads((out / "5.json").read_text())
    pretty = {r.safe_name: r.json for r in talk_json(merged, pretty=True).collect()}
    compact = {r.safe_name: r.json for r in docs.collect()}
    for k in compact:  # byte-identical to Python's json.dumps layouts
        obj = json.loads(compact[k])
        assert pretty[k] == json.dumps(obj, ensure_ascii=False, indent=2, sort_keys=True) + "\n"
        assert compact[k] == json.dumps(obj, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    back = {r.id: r for r in read_talk_documents(spark, str(out)).collect()}
    assert back["1"].dataLineage[-1].likeness == d1["dataLineage"][-1]["likeness"]
    assert back["5"].dataLineage[0].stage == "audio_original"


def test_export_bytes_special_values(spark):
    from scriptorium.functions.lineage import LINEAGE_TYPE

    keys = ["audioUrl", "caption", "catalogId", "date", "duration", "id", "koanCase", "koanCollection",
            "location", "speaker", "summary", "title", "track", "trainingQuarter"]
    row = {k: "" for k in keys}
    row.update(id="7", title='Título "ñ" \\ back/slash\ttab', speaker="Ünïcode", summary="line1\nline2")
    df = spark.createDataFrame([(row, ["zen", "talk \"x\""], "text é\n\nmore")],
                               "r struct<" + ",".join(f"{k}:string" for k in keys) + ">, tags array<string>, "
                               "transcript string")
    df = df.select("r.*", "tags", "transcript", F.lit("7").alias("safe_name"),
                   F.array(F.struct(F.lit("audio_original").alias("stage"),
                                    F.lit(None).cast("double").alias("likeness")),
                           F.struct(F.lit("transcript_structured").alias("stage"),
                                    F.lit(0.9123).alias("likeness"))).cast(LINEAGE_TYPE).alias("dataLineage"))
    compact = talk_json(df).first().json
    pretty = talk_json(df, pretty=True).first().json
    obj = json.loads(compact)
    assert obj["tags"] == ["zen", 'talk "x"'] and obj["dataLineage"][1]["likeness"] == 0.9123
    assert compact == json.dumps(obj, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    assert pretty == json.dumps(obj, ensure_ascii=False, indent=2, sort_keys=True) + "\n"


def test_publish_independent_of_partitions(spark):
    from tests.conftest import SF
    from scriptorium.functions.lineage import lineage_json as lj
    from scriptorium.sources.tables import catalog_rows, stage_transcripts

    out = []
    for parts in ("3", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        pub = publish(catalog_rows(spark, SF), stage_transcripts(spark, SF))
        merged = {r.safe_name: (r.merge_reason, r.j, r.transcript)
                  for r in pub.merged.select("safe_name", "merge_reason", lj("dataLineage").alias("j"),
                                             "transcript").collect()}
        log = sorted(tuple(r) for r in pub.log.collect())
        out.append((merged, log))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1] and len(out[0][0]) > 100 and len(out[0][1]) > 50


def test_stored_transcripts_join_without_a_shuffle_of_texts(spark, tmp_path):
    """Merging over the stored table gives the rows of the pivot; the plan shuffles the catalog only."""
    from scriptorium.operators import catalog as K

    cat, tr = _merge_fixture(spark)
    later = tr.withColumn("template_rank", F.col("template_rank") + 1).withColumn("text", F.lit("a later template"))
    params = M.MergeParams()
    stages = [M.RAW_STAGE, *params.candidate_order, *params.fallback_stages()]
    talks = K.latest_per_name(K.to_talks(K.validate(cat))).drop("n_rows")
    M.store_transcripts(tr.unionByName(later), "stored_transcripts", str(tmp_path / "stored"), buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        attached = M.attach_stored(talks, spark.table("stored_transcripts"), stages)
        plan = attached._jdf.queryExecution().executedPlan().toString()
        scans = [part for part in plan.split("Exchange") if "stored" in part.split("FileScan")[0]]
        assert not scans and plan.count("SelectedBucketsCount: 4 out of 4") == len(stages)
        rows = lambda df: sorted((r.safe_name, r.merge_reason, r.transcript or "", str(r.dataLineage)) for r in df.collect())
        got = rows(M.finalize_merge(M.score_candidates(attached, params), params))
        assert got == rows(M.merge_talks(talks, M.pivot_stages(tr, stages), params)) and len(got) == 5
        for line in plan.splitlines():  # every exchange stands over the catalog side
            if "Exchange hashpartitioning" in line:
                assert "_join" in line or "safe_name" in line, line
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS stored_transcripts")
