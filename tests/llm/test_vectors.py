"""The operators over embeddings against brute force."""

import hashlib
import math

import numpy as np
import pytest

from scriptorium.llm import bidiagonal, small_world, vector_codes, vector_dedup, whitening

LENGTH = 32
SCHEMA = "vec_id long, embedding array<float>, label int, component_id string, x string, n long, v string, rep int"


def planted() -> list[tuple]:
    """(vec_id, vector, label): noise, near copies around 0.9, chains, copies, scaled copies, one big group, odd rows."""
    rng, out = np.random.default_rng(3), []

    def add(v, label=0):
        out.append((len(out) + 10, None if v is None else [None if c is None else float(np.float32(c)) for c in v], label))

    unit = lambda: (lambda x: x / np.linalg.norm(x))(rng.standard_normal(LENGTH))
    for k in range(300):
        add(unit(), k % 5)
    for cosine in (0.8, 0.88, 0.899, 0.901, 0.92, 0.99):
        for _ in range(6):
            a, b = unit(), unit()
            b -= (a @ b) * a
            add(a, 1)
            add(cosine * a + math.sqrt(1 - cosine**2) * b / np.linalg.norm(b), 2)
    for _ in range(3):  # chains whose ends do not link
        a, b = unit(), unit()
        for step in range(8):
            add(a + 0.3 * step * b)
    centre = unit()
    for _ in range(200):  # a third of the rows
        add(centre + 0.02 * rng.standard_normal(LENGTH), 3)
    for _ in range(40):
        add(centre, None)
    same = unit()
    add(same), add(same), add(2 * same), add(-same), add(1e-30 * same)
    for odd in (None, [], [0.0] * LENGTH, [-0.0] * LENGTH, [None] + [1.0] * (LENGTH - 1), [float("nan")] + [1.0] * (LENGTH - 1), [float("inf")] * LENGTH, [1.0, 2.0], [2.0, 4.0]):
        add(odd)
    return out


@pytest.fixture(scope="module")
def rows():
    return planted()


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", 1, "own", 5) for r in rows], SCHEMA).repartition(5)


def usable(v) -> bool:
    return bool(v) and all(c is not None and math.isfinite(c) for c in v)


def classes(rows: list[tuple], least: float) -> dict[int, tuple]:
    """vec_id to (links, class) of rows with distinct ids, all pairs compared."""
    good = [(i, np.asarray(v, float)) for i, v, *_ in rows if usable(v) and any(v)]
    up = {i: i for i, *_ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = dict.fromkeys(up, 0)
    for k, (i, a) in enumerate(good):
        for j, b in good[:k]:
            if len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: (links[i], find(i)) for i in up}


@pytest.mark.parametrize("shard_rows", [100, 100_000])
def test_near_duplicates_equal_all_pairs(vectors, rows, shard_rows):
    want = classes(rows, 0.9)
    got = {r.vec_id: r for r in vector_dedup.classes_of(vectors, shard_rows=shard_rows).collect()}
    assert len(got) == len(rows)
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == want[i][1]) for i, r in got.items())


def test_near_duplicates_repeated_and_missing_ids(spark, rows):
    a, b, c = [1.0, 0.0], [0.0, 1.0], [0.0, 2.0]
    df = spark.createDataFrame([(1, a), (1, a), (2, a), (3, b), (2, b), (4, c), (None, a), (5, None)], "vec_id long, embedding array<double>")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in vector_dedup.classes_of(df).collect())
    # the id 2 stands for two vectors, so their classes are one; rows without an id have no part
    assert got == [(0, 0, 0, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 2, 1, False), (4, 2, 1, False), (5, 0, 5, True)]
    assert vector_dedup.classes_of(df.limit(0)).collect() == []


def test_audits_widen_the_beam_until_links_are_found():
    """A beam of one misses links; the audits' beams do not."""
    rng = np.random.default_rng(1)
    units = rng.standard_normal((3000, 48))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    graph = small_world.SmallWorld.built(units.astype(np.float32))
    assert [len(layer) for layer in graph.layers] == [187, 3000]
    beam = vector_dedup._probed(graph, units, 0.9)
    turn = rng.standard_normal(units.shape)
    turn -= (turn * units).sum(1, keepdims=True) * units
    probes = 0.9 * units + math.sqrt(0.19) * turn / np.linalg.norm(turn, axis=1, keepdims=True)
    recall = lambda width: sum(int((row == node).sum()) for row, node, _ in graph.reaching(probes, 0.89, width)) / 3000
    assert recall(1) < recall(beam) and recall(beam) >= 0.99


def test_graph_follows_groups_beyond_the_beam():
    rng = np.random.default_rng(2)
    group = np.r_[np.ones((600, 24)) + 0.02 * rng.standard_normal((600, 24)), rng.standard_normal((900, 24))]
    units = group / np.linalg.norm(group, axis=1, keepdims=True)
    units = units[rng.permutation(1500)].astype(np.float32)
    graph = small_world.SmallWorld.built(units)
    found = sum(len(row) for row, _, _ in graph.reaching(units, 0.9, 16))
    assert found == int((units @ units.T >= 0.9).sum()) > 600 * 600


def test_searches_mark_a_byte_for_each_pair():
    seen = small_world._Seen(3, 10)
    assert seen.mark.nbytes == 30
    row, node = seen.new(np.array([2, 0, 2, 0, 1]), np.array([9, 4, 9, -1, 0], np.int32))
    assert list(zip(row.tolist(), node.tolist(), strict=True)) == [(0, 4), (1, 0), (2, 9)]
    row, node = seen.new(np.array([0, 1, 2]), np.array([4, 1, 9], np.int32))
    assert (row.tolist(), node.tolist()) == ([1], [1])
    assert not len(seen.new(np.array([0]), np.array([-1], np.int32))[0])


def test_wide_searches_equal_all_cosines():
    random = np.random.default_rng(8)
    near = random.standard_normal((5, 16)).repeat(120, 0) + 0.2 * random.standard_normal((600, 16))
    units = vector_dedup._units(random.permutation(near)).astype(np.float32)
    graph = small_world.SmallWorld.built(units)
    got = {(r, n) for row, node, _ in graph.reaching(units, 0.9, len(units)) for r, n in zip(row.tolist(), node.tolist(), strict=True)}
    value = units @ units.T
    assert {(r, n) for r, n in got if abs(value[r, n] - 0.9) > 1e-5} == {(r, n) for r, n in zip(*map(np.ndarray.tolist, np.nonzero(value >= 0.9)), strict=True) if abs(value[r, n] - 0.9) > 1e-5}


def test_rounding_near_the_threshold():
    side = object.__new__(vector_dedup._Side)
    side.units = np.asarray([[1.0, 0.0], [0.9, math.sqrt(0.19)], [0.9 - 1e-12, math.sqrt(1 - (0.9 - 1e-12) ** 2)]])
    met = [(np.zeros(2, np.int64), np.asarray([1, 2]), np.asarray([0.9, 0.9], np.float32))]
    assert [node.tolist() for _, node in vector_dedup._verified(side, side, 0.9, iter(met))] == [[1]]


def test_trie_walk_equals_all_distances():
    rng = np.random.default_rng(4)
    for count, width, entries, spread in [(1, 1, 1, 3), (5000, 4, 64, 6), (700, 3, 7, 400), (3000, 6, 20, 2)]:
        parts = np.unique(rng.integers(-spread, spread, (count, width)), axis=0)
        book = rng.integers(-spread, spread, (entries, width))
        book[-1] = book[0]  # a tie goes to the lower index
        every = np.square(parts[:, None] - book[None]).sum(2)
        index, distance = vector_codes.nearest(parts, book)
        assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()


def codes(rows: list[tuple], parts: int, entries: int, rounds: int) -> tuple[dict, str]:
    kept = sorted((i, [math.floor(256 * c) for c in v], label) for i, v, label in rows if usable(v) and len(v) == LENGTH)
    x, width = np.asarray([v for _, v, _ in kept]), LENGTH // parts
    book = [x[:entries, p * width : (p + 1) * width].copy() for p in range(parts)]
    for last in range(rounds + 1):
        code, error = [[] for _ in kept], [0] * len(kept)
        for p in range(parts):
            own = x[:, p * width : (p + 1) * width]
            far = np.square(own[:, None] - book[p][None]).sum(2)
            for k in range(len(kept)):
                code[k].append("%02x" % far[k].argmin())
                error[k] += int(far[k].min())
            if last < rounds:
                at = far.argmin(1)
                for e in range(len(book[p])):
                    if (at == e).any():
                        book[p][e] = own[at == e].sum(0) // (at == e).sum()
    total: dict = {}
    for (_, _, label), err in zip(kept, error, strict=True):
        total[label] = total.get(label, 0) + err
    digest = hashlib.sha256(",".join(str(c) for b in book for c in b.ravel()).encode()).hexdigest()
    return {i: ("".join(c), err, total[label]) for (i, _, label), c, err in zip(kept, code, error, strict=True)}, digest


def test_codes_equal_brute_force(vectors, rows):
    want, digest = codes(rows, 16, 64, 2)
    got = vector_codes.coded(vectors).collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_codes_do_not_depend_on_broadcasts_or_blocks(vectors, rows, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(vector_codes, "SIBLINGS", 3)
    want, _ = codes(rows, 4, 10, 1)
    got = vector_codes.coded(vectors.repartition(2), parts=4, entries=10, rounds=1).collect()
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in got} == want


def test_codes_edge_cases(spark, vectors):
    assert vector_codes.coded(vectors.limit(0)).collect() == []
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.coded(vectors, parts=7)
    few = spark.createDataFrame([(2, [1.0, 2.0], "a"), (None, [1.0, 2.0], None), (1, [0.5, -0.001], None), (1, [1e9, 0.0], "a")], "vec_id long, embedding array<double>, label string")
    got = {(r.vec_id, r.code, r.error, r.label_error) for r in vector_codes.coded(few, parts=2).collect()}
    assert got == {(2, "0101", 0, 0), (None, "0101", 0, 0), (1, "0000", 0, 0)}  # out of range rows are dropped


def test_singular_values_and_vectors():
    rng = np.random.default_rng(5)
    rank = rng.standard_normal((500, 24))
    rank[:, 3], rank[:, 7] = 0, rank[:, 8]
    u, v = (np.linalg.qr(rng.standard_normal((24, 24)))[0] for _ in range(2))
    close = u @ np.diag(np.r_[np.full(6, 5.0), np.full(6, 5 - 1e-9), np.linspace(4, 1e-6, 12)]) @ v.T
    for r in (np.linalg.qr(rng.standard_normal((900, 24)), "r"), np.linalg.qr(rank, "r"), close, np.eye(9), np.diag([3.0, 0, 2]), np.asarray([[2.0]]),
              np.diag(np.abs(np.arange(-10, 11.0)) + 1) + np.diag(np.ones(20), 1)):
        values, z, total = bidiagonal.leading(r, 16)
        true = np.linalg.svd(r, compute_uv=False) ** 2
        assert len(values) == min(16, int((true > 1e-18 * true[0]).sum()))
        assert np.allclose(values, true[: len(values)], rtol=1e-8, atol=1e-13 * true[0]) and math.isclose(total, true.sum(), rel_tol=1e-12)
        assert np.abs(z.T @ z - np.eye(len(values))).max() < 1e-10
        assert np.abs(r.T @ (r @ z) - z * values).max() < 1e-11 * true[0]
    assert len(bidiagonal.leading(np.zeros((4, 4)), 16)[0]) == 0


def test_whitening_equals_dense_eigenvectors(vectors, rows, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 50)
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v, _ in rows if usable(v) and len(v) == LENGTH]
    x = np.asarray([v for _, v in kept])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    apart = fit - s / n
    e, vec = np.linalg.eigh(apart.T @ apart / n)
    e, vec = e[::-1], vec[:, ::-1]
    want = (x - s / n) @ vec[:, :16] / np.sqrt(e[:16])
    got = np.zeros_like(want)
    at = {i: k for k, (i, _) in enumerate(kept)}
    out = whitening.whitened(vectors).collect()
    assert len(out) == 16 * len(kept)
    for r in out:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == int(((n * x[at[r.vec_id]] - s) ** 2).sum())
        assert r.identity_error < 1e-9 and math.isclose(r.explained, e[r.component - 1] / e.sum(), rel_tol=1e-9)
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-8


def test_whitening_edge_cases(spark, vectors):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whitened(vectors.limit(0)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    two = spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 2.0]), (1, [1.0, 2.0]), (4, [float("nan"), 1.0]), (5, [1.0])], schema)
    got = sorted((r.vec_id or 0, r.component, r.n, r.deviation, round(abs(r.whitened), 9), round(r.explained, 9)) for r in whitening.whitened(two).collect())
    assert got == [(0, 1, 2, 128**2, 1.0, 1.0), (1, 1, 2, 128**2, 1.0, 1.0), (1, 1, 2, 128**2, 1.0, 1.0)]
    wide = spark.createDataFrame([(1, [2.0**29]), (2, [-(2.0**29)]), (3, [0.0])], schema)
    assert {r.deviation for r in whitening.whitened(wide).where("vec_id = 1").collect()} == {None}
