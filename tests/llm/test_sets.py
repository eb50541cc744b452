"""Operators that compare documents, against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from scriptorium.llm import base, components, decontaminate, ngram_jaccard, packing, suffix_dedup
from scriptorium.llm.base import from_varints, varints


def test_varints():
    for v in ([], [0], [1, 127, 128, 300, 2**40, 0, 16384]):
        assert from_varints(varints(np.asarray(v, np.int64))).tolist() == v


def test_components(spark):
    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(40)] + [(rnd.randrange(100, 200), rnd.randrange(100, 200)) for _ in range(60)] + [(7, None), (5, 5)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if b is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    got = {r.id: r.root for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up}


def test_components_of_few_edges_make_few_files(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        before = len(base.SCRATCH)
        edges = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 7], "a long, b long")
        got = {r.id: r.root for r in components.components(edges, rows=300).collect()}
        assert got == {i: max(7 * ((i - 1) // 7) + 1, 1) for i in range(1, 301) if i in got} and len(got) >= 250
        for path in base.SCRATCH[before:]:
            assert len(spark.read.parquet(path).inputFiles()) <= 1, path
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def _classes(rows, words, percent):
    sets = defaultdict(set)
    for doc_id, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] |= {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = [d for d in sets if d is not None]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_ngram_jaccard(docs, rows, empty):
    got = ngram_jaccard.classes_of(docs).collect()
    want = _classes(rows, 4, 85)
    assert len(got) == len(rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] for r in got if r.doc_id is not None)
    assert ngram_jaccard.classes_of(empty).count() == 0


def test_large_families_are_cut(docs, rows, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "CHUNK", 300)
    monkeypatch.setattr(ngram_jaccard, "SIGNED_CHUNK", 7)
    link = ngram_jaccard.Link(words=5, percent=80)
    want = _classes(rows, 5, 80)
    assert {r.doc_id: r.component_id for r in ngram_jaccard.classes_of(docs, link).collect()} == {d: c for d, (_, c) in want.items()}


def test_first_of_class(spark, docs, rows):
    twice = docs.unionByName(docs)
    kept = ngram_jaccard.first_of_class(twice)
    want = {d for d, (_, c) in _classes(rows, 4, 85).items() if d is not None and d == c}
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect() if r.doc_id is not None) == Counter(dict.fromkeys(want, 1))


def test_first_of_class_leaves_texts_in_place(spark, docs, rows, monkeypatch):
    unique = docs.dropDuplicates(["doc_id"])
    expected = sorted({d for d, (_, c) in _classes(rows, 4, 85).items() if d is not None and d == c})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for limit in (base.SENT_BYTES, 0):
            monkeypatch.setattr(base, "SENT_BYTES", limit)
            kept = ngram_jaccard.first_of_class(unique, ngram_jaccard.Link(4, 85))
            plan = kept._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan) == (not limit) and ("BroadcastHashJoin" in plan) == bool(limit)
            assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_cells_hold_every_link():
    rnd = random.Random(4)
    for percent in (80, 85, 95):
        link = ngram_jaccard.Link(4, percent)
        for size in (1, 2, 6, 7, 12, 40, 150):
            a = np.unique(np.asarray([rnd.getrandbits(64) for _ in range(size)], np.uint64))
            for _ in range(20):
                b = set(a.tolist())
                for _ in range(rnd.randint(0, size // 8 + 1)):
                    b ^= {rnd.choice(sorted(b))} if rnd.random() < 0.5 and len(b) > 1 else {rnd.getrandbits(64)}
                b = np.asarray(sorted(b), np.uint64)
                if link.holds(len(set(a.tolist()) & set(b.tolist())), len(a), len(b)):
                    classes = ngram_jaccard._classes(link, 2 * size + 10)
                    every = np.asarray(sorted(set(a.tolist()) | set(b.tolist())), np.uint64)
                    for share in (0.0, 0.3, 0.8, 1.0):
                        often = np.sort(rnd.sample(every.tolist(), int(share * len(every))))
                        with np.errstate(over="ignore"):
                            x, y = (set(ngram_jaccard.cell_keys(s, link, classes, np.asarray(often, np.uint64))) for s in (a, b))
                        assert x & y


def test_sketches_bound_the_difference():
    rnd = random.Random(6)
    for size in (1, 3, 64, 65, 700, 3000):
        a = {rnd.getrandbits(64) for _ in range(size)}
        for changes in (0, 1, size // 10, size, 3 * size):
            b = set(a) ^ {rnd.choice(sorted(a)) for _ in range(changes // 2)} ^ {rnd.getrandbits(64) for _ in range(changes)}
            x, y = (ngram_jaccard.sketch_of(np.asarray(sorted(s), np.uint64)) for s in (a, b or {1}))
            width = min(len(x), len(y))
            own = ngram_jaccard._folded(pa.array([x, y], pa.binary()), np.arange(2), width)
            assert int(np.bitwise_count(own[0] ^ own[1]).sum()) <= len(a ^ (b or {1}))


def test_small_limits_keep_every_link(docs, rows, monkeypatch):
    """Large cells pointing to their least id, and shuffles instead of broadcasts, give the same classes."""
    monkeypatch.setattr(ngram_jaccard, "PAIRED", 2)
    monkeypatch.setattr(ngram_jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ngram_jaccard, "PAIR_BUCKETS", 1)
    want = _classes(rows, 4, 85)
    assert {r.doc_id: r.component_id for r in ngram_jaccard.classes_of(docs).collect() if r.doc_id is not None} == {d: c for d, (_, c) in want.items() if d is not None}


def _removed(rows):
    first, out = {}, Counter()
    own = sorted(((d, (t or "").encode()) for d, t, *_ in rows if d is not None), key=lambda r: r[0])
    at = 0
    while at < len(own):
        same = [b for d, b in own if d == own[at][0]]
        fresh = set()
        for data in same:
            gone = np.zeros(len(data), bool)
            for s in range(len(data) - 49):
                if data[s:s + 50] in first:
                    gone[s:s + 50] = True
                else:
                    fresh.add(data[s:s + 50])
            kept = bytes(np.frombuffer(data, np.uint8)[~gone])
            runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
            out[own[at][0], len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
        first.update(dict.fromkeys(fresh))
        at += len(same)
    for d, t, *_ in rows:
        if d is None:
            data = (t or "").encode()
            out[None, len(data), 0, 0, hashlib.sha256(data).hexdigest()] += 1
    return out


def test_suffix_dedup(docs, rows, empty):
    want = _removed(rows)
    for hot in (suffix_dedup.HOT, 3):
        assert Counter(map(tuple, suffix_dedup.deduplicated(docs, hot).collect())) == want
    assert suffix_dedup.deduplicated(empty).count() == 0


def test_suffix_dedup_by_shuffles_alone(docs, rows, monkeypatch):
    """Lists too large to be sent are joined by a shuffle, with the same result on both paths."""
    from scriptorium.llm import base

    monkeypatch.setattr(base, "SENT_BYTES", -1)
    assert Counter(map(tuple, suffix_dedup.deduplicated(docs, 2).collect())) == _removed(rows)


def test_suffix_dedup_equal_ids(spark):
    text = "a text of more than fifty bytes that stands in every one of them "
    rows = [(2, text), (2, text + "2"), (1, "1" + text), (3, text), (3, text), (4, "short")]
    got = suffix_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == _removed(rows)


def test_suffix_dedup_short_names_of_both_paths(spark):
    rnd = random.Random(11)
    noise = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))
    common, shared = noise(400), [noise(60) for _ in range(40)]
    mixed = lambda: "".join(s + noise(30) for s in shared)
    # Anchors of ``common`` are hot, those of ``shared`` are not; document 1 holds both, document 9 only the latter.
    rows = [(1, common + mixed()), (9, mixed()), *((i, noise(60) + common) for i in range(2, 8))]
    got = suffix_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), 3, brief=1)
    assert Counter(map(tuple, got.collect())) == _removed(rows)


def test_words_held_while_packing_are_bounded(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    words = packing.Words(path)
    monkeypatch.setattr(words, "_encode", lambda w: bytes(4))
    for k in range(700_000):
        words[f"w{k}"]
    assert len(words) + len(words.old) <= 1 << 19
    words["w" * 10_000]
    assert "w" * 10_000 not in words and "w" * 10_000 not in words.old


def test_words_that_recur_stay_held(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 50)
    path = public_tokenizers.path("word_bpe_49k.json")
    words, tokenizer = packing.Words(path), Tokenizer.from_file(path)
    rng = random.Random(5)
    text = " ".join(f"Late {rng.choice('abc')}{k}x{k}. {'long' * 30}" for k in range(400))
    assert np.frombuffer(packing.encoded(words, text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    asked = []
    encode = words._encode
    monkeypatch.setattr(words, "_encode", lambda w: asked.append(w) or encode(w))
    packing.encoded(words, "Later " + " Later ".join(f"z{k}" for k in range(400)))
    assert len(words) <= 50 and asked.count("later") == 1


def test_packing_asks_the_library_once_for_a_word_and_its_forms(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    words, asked = packing.Words(path), []
    encode = words._encode
    monkeypatch.setattr(words, "_encode", lambda w: asked.append(w) or encode(w))
    text = "Queréeau quatre, quatre. QUATRE%%% queréeau; queréeau### (quatre) QUERÉEAU"
    got = packing.encoded(words, text)
    assert np.frombuffer(got, "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert asked.count("queréeau") == asked.count("quatre") == 1
    assert not any(w.lower().startswith("quer") and w != "queréeau" for w in asked)


def test_encoded_texts_are_those_of_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, words, rng = Tokenizer.from_file(path), packing.Words(path), random.Random(9)
    some = ["it's", "'S", "don't.", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|>b", "H\u0331e", "h\u0331.", "e\u0301t\u00e9", "\u00c5\u030a", "\u0130stanbul.",
            "\u03a3\u03a3.", "stra\u00dfe,", "\u00c0\u00d6\u00de\u00ff!", "\u00d7\u00f7", "a\tb", "x\r", "\u00a0y", "12,5", "a1.", "...", "\u2014", "\u4e2d\u6587.", "\ud83d\ude00".encode("utf-16", "surrogatepass").decode("utf-16"), "<=\u0338", "w" * 90, ""]
    letters = "abcdeABCDE\u00e9\u00c9\u00fc.,;'%#\u0301"
    texts = ["", " ", "\n\n", *(rng.choice([" ", "\n"]).join(rng.choice(some) if rng.random() < 0.5 else "".join(rng.choices(letters, k=rng.randrange(9))) for _ in range(rng.randrange(60))) for _ in range(300))]
    ids, bounds = packing.encoded_texts(words, pa.array(texts))
    for text, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_cells_of_many_texts_take_bounded_memory():
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(1 << 20)}" for _ in range(400)) for _ in range(3000)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": list(range(k, k + 500)), "text": texts[k:k + 500]}) for k in range(0, 3000, 500)]
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in ngram_jaccard._cells(ngram_jaccard.Link(), 8, b"")(iter(batches)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n >= 3000
    assert peak < 110 << 20, peak


def test_packing(docs, rows, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    import zlib

    want, total = Counter(), 0
    for d, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = np.asarray(ids[a:a + 2048], "<u4")
            want[d, k, a, len(part), zlib.crc32(part.tobytes())] += 1
    got = packing.packed(docs, path).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-total // 2048) + 1
    assert packing.packed(empty, path).count() == 0


def test_best_two_fit_replaces_the_smallest():
    # Greedy takes 60 and 30; 20 + 20 fill the gap that 30 leaves.
    bins = packing.best_two_fit(np.asarray([60, 30, 20, 20]), 100)
    assert sorted(map(sorted, bins)) == [[0, 2, 3], [1]]


def _least(item, text):
    column, best = list(range(len(item) + 1)), len(item)
    for c in text:
        was, column[0] = column[:], 0
        for i in range(1, len(item) + 1):
            column[i] = min(was[i - 1] + (item[i - 1] != c), was[i] + 1, column[i - 1] + 1)
        best = min(best, column[-1])
    return best


def test_decontamination_finds_edited_items():
    rnd = random.Random(3)
    for _ in range(150):
        item = ("".join(rnd.choice("ab ") for _ in range(rnd.randint(20, 60)))).strip() or "x"
        edited = list(item)
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randrange(len(edited))
            edited[at:at + 1] = rnd.choice(["a", "", "bb"])
            edited = edited or ["x"]
        pad = lambda: "".join(rnd.choice("abc ") for _ in range(rnd.randint(0, 60)))
        text = pad() + "".join(edited) + pad()
        got, least = list(decontaminate.Matcher([(7, item)], 8).matches(text)), _least(item, text)
        if least <= len(item) // 8:
            assert got[0][1] == least and _least(item, text[got[0][2]:got[0][3]]) == least
        else:
            assert not got


def test_decontamination_of_short_items_at_word_edges():
    short = decontaminate.Matcher([(1, "the"), (2, "Saw it?"), (3, "東京都"), (4, "x"), (5, "the")])
    found = lambda text: sorted((i, a, b) for i, _, a, b in short.matches(text))
    assert found("Others bathe; saw items") == []
    assert found("breathe the air") == [(1, 8, 11), (5, 8, 11)]
    assert found("I saw\tit? Yes") == [(2, 2, 9)] and found("resaw it?") == []
    assert found("私は東京都に住む") == [(3, 2, 5)]
    assert found("x") == [(4, 0, 1)] and found("xx x2 (x)") == [(4, 7, 8)]


def test_decontamination_rows(spark, docs, empty):
    items = spark.createDataFrame(
        [(1, "A PASSAGE of words\tthat repeats across many documents"), (2, None), (3, " "), (4, "never in any text of this table, not once")],
        "item_id long, text string",
    )
    text = "It says: a pasage of words that repeats across many documents!"
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string"))
    got = decontaminate.matched(more, items).collect()
    assert Counter((r.doc_id, r.item_id, r.distance) for r in got if r.doc_id in (1, None)) == Counter({(1, 1, 1): 2, (None, 1, 1): 1})
    assert {text[r.start:r.stop] for r in got if r.doc_id == 1} == {"a pasage of words that repeats across many documents"}
    clean = decontaminate.clean(docs, items)
    assert clean.columns == docs.columns
    assert decontaminate.matched(docs, items.limit(0)).count() == 0 and decontaminate.clean(empty, items).count() == 0


def test_ngram_jaccard_equal_ids(spark):
    words = [f"w{i}" for i in range(40)]
    x, y = " ".join(words), " ".join(reversed(words))
    rows = [(1, x), (5, x), (5, y), (9, y + " end"), (9, y + " end"), (11, "alone in this table"), (None, x)]
    got = ngram_jaccard.classes_of(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component_id) for r in got if r.doc_id) == Counter({(1, 1): 1, (5, 1): 2, (9, 1): 2, (11, 11): 1})


def test_least_of_hot_groups(spark):
    from scriptorium.llm import base

    df = spark.createDataFrame([(i, i % 3 if i < 20 else i) for i in range(25)], "id long, k long")
    got = {r.id: r.least for r in base.with_least(df, ["k"], "id", "least").collect()}
    assert got == {i: i % 3 for i in range(20)}


def test_suffix_dedup_sorts_or_lists_hot_contexts(docs, rows, monkeypatch):
    """Distinct hot contexts go to sorted buckets and are not listed; buckets above the bound are listed: equal results."""
    want = _removed(rows)
    tables = {}
    keep = lambda df, name, f=suffix_dedup.written: tables.setdefault(name, []).append(out := f(df, name)) or out
    monkeypatch.setattr(suffix_dedup, "written", keep)
    monkeypatch.setattr("scriptorium.llm.base.written", keep)
    for most in (suffix_dedup.HOT_BYTES, 400, 0):
        tables.clear()
        assert Counter(map(tuple, suffix_dedup.deduplicated(docs, 2, most=most).collect())) == want
        assert tables["suffix-hot"][0].count() > 0
        assert (tables["suffix-large"][0].count() > 0) == (most < suffix_dedup.HOT_BYTES)
        assert (tables["least"][-1].count() > 0) == (most == 0) or most == 400
