"""Likeness and diff spans: goldens and agreement with difflib on whole texts."""

import random
from collections import Counter
import re
from difflib import SequenceMatcher

import pytest

from scriptorium.operators import scoring as S
from scriptorium.sources.tables import edited_pairs

WORD_RE = re.compile(r"\b[\w']+\b")


def ref_likeness(a, b):
    x, y = WORD_RE.findall(a.lower()), WORD_RE.findall(b.lower())
    if not x and not y:
        return 1.0
    return SequenceMatcher(None, x, y, autojunk=False).ratio()


GOLDEN = [
    ("Hello, world!", "hello world", 1.0),
    ("", "", 1.0),
    ("", "x", 0.0),
    ("a b c d", "a b x d", 0.75),
    ("a b c d e f g h", "a b c d", 0.666667),
    ("a b c a", "b a", 0.333333),
    ("b a", "a b c a", 0.666667),
    ("c b a c", "b c", 0.333333),
    ("the quick brown fox jumps over the lazy dog", "the quick red fox jumps the very lazy dog", 0.777778),
]


def _pairs(spark, rows):
    return spark.createDataFrame([(str(i), a, b) for i, (a, b) in enumerate(rows)],
                                 "pair_id string, a_text string, b_text string")


def test_golden_scores(spark):
    got = {r.pair_id: r.likeness for r in S.score_pairs(_pairs(spark, [(a, b) for a, b, _ in GOLDEN])).collect()}
    for i, (_, _, want) in enumerate(GOLDEN):
        assert got[str(i)] == pytest.approx(want, abs=1e-6)


def test_golden_spans(spark):
    rows = [("the quick brown fox jumps over the lazy dog", "the quick red fox jumps the very lazy dog")]
    spans = S.diff_spans(_pairs(spark, rows)).orderBy("a_start").collect()
    assert [(s.tag, s.a_start, s.a_end, s.b_start, s.b_end) for s in spans] == [
        ("replace", 2, 3, 2, 3), ("delete", 5, 6, 5, 5), ("insert", 7, 7, 6, 7)]


def test_random_edits_match_difflib(spark):
    rnd = random.Random(3)
    vocab = ["the", "a", "of", "talk", "zen", "mind", "breath", "sit", "is", "and"]
    rows = []
    for _ in range(200):
        a = [rnd.choice(vocab) for _ in range(rnd.randint(0, 60))]
        b = list(a)
        for _ in range(rnd.randint(0, 8)):
            op = rnd.random()
            if op < 0.3 and b:
                del b[rnd.randrange(len(b))]
            elif op < 0.6:
                b.insert(rnd.randint(0, len(b)), rnd.choice(vocab))
            elif b:
                b[rnd.randrange(len(b))] = rnd.choice(vocab).upper()
        if rnd.random() < 0.2:
            b = b[rnd.randint(0, max(len(b) - 1, 0)):]  # contiguous run: closed form
        rows.append((" ".join(a), ", ".join(b)))
    got = {r.pair_id: r.likeness for r in S.score_pairs(_pairs(spark, rows)).collect()}
    for i, (a, b) in enumerate(rows):
        assert got[str(i)] == pytest.approx(ref_likeness(a, b), abs=1e-12), (a, b)


def test_whole_document_edits_match_difflib(spark):
    """Whole driver documents against their stutter-removed edit (brute force)."""
    from tests.conftest import SF

    p = edited_pairs(spark, SF)
    got = S.score_pairs(p).select("pair_id", "a_text", "b_text", "likeness").collect()
    assert len(got) > 100
    for r in got:
        assert r.likeness == pytest.approx(ref_likeness(r.a_text, r.b_text), abs=1e-12)


def test_bound_never_below_score_and_gate(spark):
    rows = [(a, b) for a, b, _ in GOLDEN]
    g = S.gate_pairs(_pairs(spark, rows), threshold=0.9).collect()
    exact = {str(i): ref_likeness(a, b) for i, (a, b) in enumerate(rows)}
    for r in g:
        assert r.passed == (exact[r.pair_id] >= 0.9)
        if r.upper_bound is not None:
            assert r.upper_bound >= exact[r.pair_id] - 1e-12


def test_native_bounds_equal_counters(spark):
    rnd = random.Random(9)
    rows = [([], []), (["a"], []), (["a", "a", "b"], ["a", "b", "b"]), (["é", "it's"] * 5, ["it's"] * 7)]
    for _ in range(300):
        words = [f"{k}" for k in range(rnd.choice([1, 3, 40]))] + ["1", "1 1", "ﬀ", "\u10ffff"]
        rows.append(([rnd.choice(words) for _ in range(rnd.randint(0, 60))], [rnd.choice(words) for _ in range(rnd.randint(0, 60))]))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a array<string>, b array<string>")
    for r in df.select("i", S.overlap_bound("a", "b").alias("overlap"), S.length_bound("a", "b").alias("length")).collect():
        a, b = rows[r.i]
        shared = sum((Counter(a) & Counter(b)).values())
        assert r.overlap == (2.0 * shared / (len(a) + len(b)) if a or b else 1.0)
        assert r.length == (2.0 * min(len(a), len(b)) / (len(a) + len(b)) if a or b else 1.0) and r.overlap <= r.length


def test_gate_has_one_python_node(spark):
    """Random pairs: the gate agrees with the exact score, and only pairs the bounds leave open are aligned."""
    rnd = random.Random(10)
    word = lambda: f"w{rnd.randrange(30)}"
    rows = []
    for _ in range(200):
        a = [word() for _ in range(rnd.randint(1, 40))]
        b = [x if rnd.random() < 0.93 else word() for x in a] + [word()] * rnd.randint(0, 6)
        rows.append((" ".join(a), " ".join(b)))
    gate = S.gate_pairs(_pairs(spark, rows), threshold=0.9)
    plan = gate._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    for r in gate.collect():
        exact = ref_likeness(*rows[int(r.pair_id)])
        assert r.passed == (exact >= 0.9)
        assert r.upper_bound is None or r.upper_bound >= exact - 1e-12
        assert r.likeness is None or r.likeness == pytest.approx(exact, abs=1e-12)
        assert (r.likeness is None) == (r.upper_bound is not None and r.upper_bound < 0.9)


def test_closed_form_only_no_python_for_contained(spark):
    rows = [("a b c d e", "x a b c d e y"), ("a b c", "a b c"), ("p q", "")]
    df = _pairs(spark, rows)
    from scriptorium.functions.text import normalize_tokens
    from pyspark.sql import functions as F

    cf = df.select(S.closed_form_likeness(normalize_tokens("a_text"), normalize_tokens("b_text")).alias("c"))
    vals = [r.c for r in cf.collect()]
    assert vals[0] == pytest.approx(10 / 12) and vals[1] == 1.0 and vals[2] == 0.0


def test_pairs_are_cut_into_words_once(spark):
    """Scores and the gate leave the words to the worker that aligns them; equal texts settle without it."""
    rows = [(a, b) for a, b, _ in GOLDEN] + [("same words", "Same words"), ("don't 'quote' ''", "don't quote"), ("''", "")]
    for df in (S.score_pairs(_pairs(spark, rows)), S.gate_pairs(_pairs(spark, rows), threshold=0.0)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "regexp_extract_all" not in plan and "sort_array" not in plan and plan.count("ArrowEvalPython") == 1
        for r in df.collect():
            assert r.likeness == pytest.approx(ref_likeness(*rows[int(r.pair_id)]), abs=1e-12)
    bounds = {int(r.pair_id): r.upper_bound for r in S.gate_pairs(_pairs(spark, rows), threshold=0.0).collect()}
    contained = lambda x, y: f" {' '.join(x)} " in f" {' '.join(y)} "
    for k, (a, b) in enumerate(rows):
        x, y = WORD_RE.findall(a.lower()), WORD_RE.findall(b.lower())
        closed = not x or not y or contained(x, y) or contained(y, x)
        assert bounds[k] == (None if closed else 2.0 * sum((Counter(x) & Counter(y)).values()) / (len(x) + len(y)))
