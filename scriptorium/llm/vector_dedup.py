"""Embedding near-duplicates: navigable small-world graphs per shard, searched by all vectors.

Two vectors link when their cosine, in double precision, reaches ``least``.

1. Equal vectors are one with a weight (aggregated map-side), so exact copies are
   never compared.  Distinct vectors are dealt to shards by a hash of them; a shard
   is bounded in rows and bytes, whatever the input.
2. Each shard builds a graph (``small_world``) and audits it: probes turned from its
   own vectors to exactly the threshold must find them.  The beam is widened until
   they do; the graph and its beam are written.
3. Each pair of shards is one task: the vectors of one search the graph of the other
   (a shard also searches its own).  A second audit compares some of the real
   searches with all cosines and widens the beam until they agree; a beam as wide
   as the shard is exhaustive, so the widening always ends.  What a search meets is
   verified in double precision unless its single-precision cosine is farther from
   the threshold than rounding can carry it.  Groups larger than a beam are followed
   outside it.
4. A task returns one row for each vector with links (their number, by weight) and a
   spanning forest of its links, never the pairs.  Components join the forests.

Work grows with vectors times shards: every shard is searched.  ``shard_rows`` is
the bound to raise where tasks have more memory.

Cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are their own class.  A row without an id has no links and
a null class and is not kept.  Rows with equal vectors link with each other.  Rows
with equal ids and different vectors merge their classes; each keeps its row and
its own count.  Vectors of different lengths do not link.  Ids are read as long,
other columns are not read.  Building the frame runs the jobs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .base import written
from .components import components, join_all
from .small_world import ROOM, SmallWorld
from .vectors import finite

SHARD_ROWS = 1 << 15  # every shard is searched, so larger ones mean less work; the table of links of a shard takes their square in bits
SHARD_COMPONENTS = 1 << 24  # 64 MB in single precision
PROBES, AUDITED = 512, 64  # searches that an audit runs for each graph, and for each pair of shards
BEAM, RECALL = 16, 0.998  # first width of the beam; what an audit has to find

_GRAPH = "shard int, length int, ids binary, h1 binary, h2 binary, weights binary, vectors binary, layers array<binary>, beam int"
_FOUND = "h1 long, h2 long, links long, a long, b long, found long, wanted long"


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so squares neither overflow nor vanish."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _probed(graph: SmallWorld, units: np.ndarray, least: float) -> int:
    """The beam that finds vectors from probes at the threshold."""
    random = np.random.default_rng(len(units))
    chosen = random.permutation(len(units))[:PROBES]
    source = units[chosen]
    turn = random.standard_normal(source.shape)
    turn -= (turn * source).sum(1, keepdims=True) * source
    length = np.linalg.norm(turn, axis=1, keepdims=True)
    probes = least * source + np.sqrt(1 - least * least) * turn / np.maximum(length, 1e-30)
    beam = BEAM
    while beam < len(units):
        hit = np.zeros(len(chosen), bool)
        for row, node, _ in graph.reaching(probes, least - 1e-3, beam):
            hit[row[node == chosen[row]]] = True
        if hit.mean() >= RECALL:
            break
        beam *= 2
    return min(beam, len(units))


def _built(least: float, dtype: str):
    """Vectors of a shard to one graph for each of their lengths."""

    def run(table: pa.Table) -> pa.Table:
        out: dict[str, list] = {c.split()[0]: [] for c in _GRAPH.split(", ")}
        column = table["v"].combine_chunks()
        lengths = np.diff(np.asarray(column.offsets))
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            h2 = np.asarray(table["h2"])[rows]
            rows = rows[np.argsort(h2, kind="stable")]  # a hash decides the levels
            vectors = np.asarray(column.take(pa.array(rows)).flatten(), dtype).reshape(len(rows), -1)
            units = _units(vectors)
            graph = SmallWorld.built(units.astype(np.float32))
            out["shard"].append(table["shard"][0].as_py())
            out["length"].append(int(length))
            for name, source in (("ids", "rep"), ("h1", "h1"), ("h2", "h2"), ("weights", "weight")):
                out[name].append(np.asarray(table[source])[rows].astype("<i8").tobytes())
            out["vectors"].append(vectors.tobytes())
            out["layers"].append([links.astype("<i4").tobytes() for links in graph.layers])
            out["beam"].append(_probed(graph, units, least))
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.binary()), pa.int32()]
        return pa.table({name: pa.array(out[name], t) for name, t in zip(out, types, strict=True)})

    return run


class _Side:
    """One shard's vectors of one length, as a task reads them."""

    def __init__(self, row: dict, dtype: str):
        self.ids, self.h1, self.h2, self.weights = (np.frombuffer(row[c], "<i8") for c in ("ids", "h1", "h2", "weights"))
        self.units = _units(np.frombuffer(row["vectors"], dtype).reshape(len(self.ids), -1))
        self.single = self.units.astype(np.float32)
        self.layers, self.beam = row["layers"], row["beam"]

    def graph(self) -> SmallWorld:
        sizes = [np.frombuffer(layer, "<i4") for layer in self.layers]
        return SmallWorld(self.single, [s.reshape(-1, ROOM) for s in sizes])


def _verified(query: _Side, graph: _Side, least: float, batches: Iterator[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The (query, node) whose cosine reaches ``least`` in double precision."""
    margin = 4e-7 * query.units.shape[1] ** 0.5 + 1e-6
    for row, node, value in batches:
        sure = value >= least + margin
        doubt = np.flatnonzero(~sure)
        for at in range(0, len(doubt), 1 << 16):
            some = doubt[at : at + (1 << 16)]
            sure[some] = np.einsum("ij,ij->i", query.units[row[some]], graph.units[node[some]]) >= least
        yield row[sure].astype(np.int64), node[sure].astype(np.int64)


def _audited(query: _Side, side: _Side, graph: SmallWorld, least: float) -> tuple[int, int, int]:
    """(beam, links found, links there) of some of the real searches, the beam wide enough for them."""
    chosen = np.unique(np.linspace(0, len(query.ids) - 1, AUDITED).astype(np.int64))
    part = _Part(query, chosen)
    wanted = sum(int((query.units[chosen[k : k + 8]] @ side.units.T >= least).sum()) for k in range(0, len(chosen), 8))
    beam = max(1, min(side.beam, len(side.ids)))
    while True:
        found = sum(len(row) for row, _ in _verified(part, side, least, graph.reaching(part.single, least - 1e-4, beam)))
        if found >= RECALL * wanted or beam >= len(side.ids):
            return beam, found, wanted
        beam = min(2 * beam, len(side.ids))


class _Part(_Side):
    """Some rows of a side."""

    def __init__(self, side: _Side, rows: np.ndarray):
        self.ids, self.units, self.single = side.ids[rows], side.units[rows], side.single[rows]


class _Bits:
    """A symmetric table of links among the vectors of one shard: a pair that two searches met counts once."""

    def __init__(self, size: int):
        self.bits = np.zeros((size, (size + 7) // 8), np.uint8)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in ((a, b), (b, a)):
            np.bitwise_or.at(self.bits, (x, y >> 3), (1 << (y & 7)).astype(np.uint8))

    def counts(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(weights), np.int64)
        for at in range(0, len(out), 256):
            held = np.unpackbits(self.bits[at : at + 256], axis=1, bitorder="little")[:, : len(weights)]
            out[at : at + 256] = (held * weights).sum(1)
        return out


def _matched(least: float, dtype: str):
    """One pair of shards: links of each vector with the other shard, a spanning forest, the audit."""

    def run(table: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        rows = table.to_pylist()
        for length in sorted({r["length"] for r in rows}):
            sides = {r["shard"]: r for r in rows if r["length"] == length}
            if low not in sides or high not in sides:
                continue
            side = _Side(sides[high], dtype)
            query = side if low == high else _Side(sides[low], dtype)
            graph = side.graph()
            beam, found, wanted = _audited(query, side, graph, least)
            size, shift = len(query.ids), 0 if query is side else len(query.ids)
            up = np.arange(size if query is side else size + len(side.ids))
            links, back = np.zeros(size, np.int64), np.zeros(len(side.ids), np.int64)
            bits = _Bits(size) if query is side else None
            for row, node in _verified(query, side, least, graph.reaching(query.single, least - 1e-4, beam)):
                if bits is not None:
                    row, node = row[row != node], node[row != node]
                    bits.add(row, node)
                else:
                    links += np.bincount(row, side.weights[node], size).astype(np.int64)
                    back += np.bincount(node, query.weights[row], len(back)).astype(np.int64)
                join_all(up, row, node + shift)
            if bits is not None:
                links = bits.counts(side.weights)
            ids = query.ids if query is side else np.concatenate((query.ids, side.ids))
            for own, count in ((query, links), (side, back)):
                some = np.flatnonzero(count)
                out.append(pa.table({"h1": own.h1[some], "h2": own.h2[some], "links": count[some]}))
            moved = np.flatnonzero(up != np.arange(len(up)))
            out.append(pa.table({"a": ids[moved], "b": ids[up[moved]]}))
            out.append(pa.table({"found": [found], "wanted": [wanted]}))
        schema = pa.schema([(c.split()[0], pa.int64()) for c in _FOUND.split(", ")])
        return pa.concat_tables([schema.empty_table(), *out], promote_options="default").select(schema.names)

    return run


class Linked:
    """What the searches found: ``vectors`` (h1, h2, rep, weight, links, component_id) and ``audits`` (found, wanted)."""

    def __init__(self, vectors: DataFrame, audits: DataFrame):
        self.vectors, self.audits = vectors, audits


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(7), F.reverse("v"))})


def linked(rows: DataFrame, least: float, shard_rows: int = SHARD_ROWS) -> Linked:
    """The distinct vectors of ``rows`` (vec_id, v, h1, h2; usable ones only) with their links and classes."""
    dtype = "<f4" if isinstance(rows.schema["v"].dataType.elementType, FloatType) else "<f8"
    distinct = rows.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    size = F.size("v")
    distinct = written(_hashed(distinct), "vectors-distinct")
    total = distinct.agg(F.count("*").alias("n"), F.sum(size.cast("long")).alias("components")).first()
    shards = max(total["n"] // shard_rows, (total["components"] or 0) // SHARD_COMPONENTS) + 1
    dealt = distinct.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    graphs = written(dealt.groupBy("shard").applyInArrow(_built(least, dtype), _GRAPH), "vectors-graphs")
    others = graphs.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    tasks = others.withColumns({"low": F.least("shard", "other"), "high": F.greatest("shard", "other")}).drop("other")
    found = written(tasks.groupBy("low", "high").applyInArrow(_matched(least, dtype), _FOUND), "vectors-found")

    counts = found.where("links is not null").groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    edges = found.where("a is not null").select("a", "b")
    several = rows.groupBy("vec_id").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x <> y").select("vec_id")
    same = rows.select("vec_id", "h1", "h2").join(several, "vec_id").distinct()
    edges = edges.unionByName(same.join(distinct.select("h1", "h2", "rep"), ["h1", "h2"]).select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    roots = components(edges, "vectors-classes").select(F.col("id").alias("rep"), "root")
    vectors = (
        distinct.select("h1", "h2", "rep", "weight").join(counts, ["h1", "h2"], "left").join(roots, "rep", "left")
        .select("h1", "h2", "rep", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("component_id"))
    )
    return Linked(written(vectors, "vectors-linked"), found.where("wanted is not null").select("found", "wanted"))


def usable(vectors: DataFrame) -> DataFrame:
    """``vectors`` (vec_id, embedding) as (vec_id, v, ok); -0.0 is 0.0."""
    element = vectors.schema["embedding"].dataType.elementType
    kind = "float" if isinstance(element, FloatType) else "double"
    e = F.col("embedding")
    ok = F.col("vec_id").isNotNull() & finite(e) & F.exists(e, lambda c: c != 0)
    v = F.transform(e, lambda c: c.cast(kind) + F.lit(0.0).cast(kind))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(ok, F.lit(False)).alias("ok"))


def classes_of(vectors: DataFrame, least: float = 0.9, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    every = usable(vectors)
    rows = _hashed(every.where("ok").drop("ok"))
    found = linked(rows, least, shard_rows).vectors
    good = rows.select("vec_id", "h1", "h2").join(found, ["h1", "h2"]).select("vec_id", (F.col("links") + F.col("weight") - 1).alias("n_links"), "component_id")
    bad = every.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
