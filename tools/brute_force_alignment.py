"""Brute-force check of the exact-alignment queries (no SQL oracle exists).

Recomputes every pair with plain difflib over the same whole texts and
compares: pair_scores_edited, incremental_scores (stream == batch) and the
top-10 spans of diff_spans_top.  Usage: python tools/brute_force_alignment.py [sf_dir]
"""
import sys, re
sys.path.insert(0, '.')
from difflib import SequenceMatcher
from scriptorium.session import build_session
from scriptorium.sources.tables import edited_pairs
from scriptorium.plans import registry
spark = build_session("local[8]", shuffle_partitions=16)
sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
W = re.compile(r"\b[\w']+\b")
texts = {r.pair_id: (r.a_text, r.b_text) for r in edited_pairs(spark, sf).collect()}
def ref(a, b):
    x, y = W.findall(a.lower()), W.findall(b.lower())
    return 1.0 if not x and not y else SequenceMatcher(None, x, y, autojunk=False).ratio()
q = registry.all_queries()
got = {r.pair_id: r.likeness for r in q["pair_scores_edited"](spark, sf).collect()}
inc = {r.pair_id: r.likeness for r in q["incremental_scores"](spark, sf).collect()}
bad = [k for k, (a, b) in texts.items() if got[k] != ref(a, b)]
print("pairs", len(texts), "mismatch", len(bad), "stream==batch", inc == got)
spans = q["diff_spans_top"](spark, sf).collect()
bad2 = 0
by = {}
for s in spans: by.setdefault(s.pair_id, []).append(s)
for k, lst in by.items():
    a, b = texts[k]
    x, y = W.findall(a.lower()), W.findall(b.lower())
    ops = [o for o in SequenceMatcher(None, x, y, autojunk=False).get_opcodes() if o[0] != "equal"]
    ops = sorted(ops, key=lambda o: o[2] - o[1], reverse=True)[:10]
    mine = sorted(lst, key=lambda s: s.rank)
    if [(o[0], o[1], o[2], o[3], o[4]) for o in ops] != [(s.tag, s.a_start, s.a_end, s.b_start, s.b_end) for s in mine]:
        bad2 += 1
print("span pairs", len(by), "mismatch", bad2)
