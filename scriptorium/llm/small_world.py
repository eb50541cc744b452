"""A hierarchical navigable small-world graph over unit vectors, built and searched for many vectors at a time.

Layers hold fewer vectors the higher they are.  Vectors are ordered by level, so a
layer holds a prefix of them and those that enter it early are the ones that the
layer above holds too.  A search goes down the layers and keeps a beam of the best
vectors seen; what reaches the wanted cosine is also followed outside the beam, so
a group larger than the beam is found whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

DEGREE = 16  # links that a vector chooses on a layer
ROOM = 48  # links that a vector holds before they are chosen anew
BUILD_BEAM = 48
RATIO = 16  # between the sizes of layers
SEED = 256  # vectors of a layer that are linked by comparing all
GROUP = 1 << 15  # components of the vectors that are inserted or searched at a time
STEP = 4  # beam entries followed at once
FLOOD = 1 << 14  # entries followed at once outside the beam
PAIRS = 1 << 11  # cosines taken at once


def _group(vectors: np.ndarray) -> int:
    return max(32, GROUP // max(1, vectors.shape[1]))


def _diverse(vectors: np.ndarray, near: np.ndarray, cosine: np.ndarray, most: int) -> np.ndarray:
    """For each row the ``most`` candidates to link: those closer to it than to any chosen one first, then the nearest of the rest."""
    order = np.argsort(-cosine, 1, kind="stable")
    near, cosine = np.take_along_axis(near, order, 1), np.take_along_axis(cosine, order, 1)
    out = np.full((len(near), most), -1, np.int32)
    step = max(8, _group(vectors) // 2)
    for at in range(0, len(near), step):
        some, own = near[at : at + step], cosine[at : at + step]
        v = vectors[np.maximum(some, 0)]
        between = v @ v.transpose(0, 2, 1)
        real, count = some >= 0, np.zeros(len(some), np.int64)
        shadowed, chosen = np.zeros(some.shape, bool), np.zeros(some.shape, bool)
        for k in range(some.shape[1]):
            take = real[:, k] & ~shadowed[:, k] & (count < most)
            chosen[take, k] = True
            count += take
            shadowed[take] |= between[take, k] > own[take]
        rank = np.argsort(np.where(chosen, 0, np.where(real, 1, 2)), 1, kind="stable")[:, :most]
        picked = np.take_along_axis(some, rank, 1)
        out[at : at + step, : picked.shape[1]] = picked
    return out


def _cosines(queries: np.ndarray, row: np.ndarray, vectors: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Of each pair, in slices that stay in a processor's cache."""
    out = np.empty(len(row), np.float32)
    for at in range(0, len(row), PAIRS):
        x, y = queries.take(row[at : at + PAIRS], 0, mode="clip"), vectors.take(node[at : at + PAIRS], 0, mode="clip")
        out[at : at + PAIRS] = np.einsum("ij,ij->i", x, y)
    return out


class _Seen:
    """Which vectors a group of searches has met; equal pairs inside one call are met once."""

    def __init__(self, rows: int, size: int):
        self.size, self.mark = size, np.zeros(rows * size, bool)  # a byte each: the table is what a search reads most

    def new(self, row: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        there = node >= 0
        at = row[there] * self.size + node[there]
        at = np.sort(at[~self.mark[at]])
        if len(at):
            at = at[np.concatenate(([True], at[1:] != at[:-1]))]
        self.mark[at] = True
        row = at // self.size
        return row, (at - row * self.size).astype(np.int32)


def _beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int, least: float | None = None):
    """(nodes, cosines) of each query's beam, best first, and the (row, node, cosine) met that reach ``least``."""
    rows = len(queries)
    seen = _Seen(rows, len(vectors))
    nodes, cosine = np.full((rows, width), -1, np.int32), np.full((rows, width), -np.inf, np.float32)
    followed = np.zeros((rows, width), bool)
    hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def meet(row: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, node = seen.new(row, node)
        value = _cosines(queries, row, vectors, node)
        if least is not None:
            held = value >= least
            if held.any():
                hits.append((row[held], node[held], value[held]))
        return row, node, value

    def merge(row: np.ndarray, node: np.ndarray, value: np.ndarray) -> None:
        nonlocal nodes, cosine, followed
        better = value > cosine.min(1)[row]  # the others would leave the beam at once
        row, node, value = row[better], node[better], value[better]
        if not len(row):
            return
        order = np.lexsort((-value, row))
        row, node, value = row[order], node[order], value[order]
        first = np.concatenate(([True], row[1:] != row[:-1]))
        rank = np.arange(len(row)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        kept = rank < width
        row, node, value, rank = row[kept], node[kept], value[kept], rank[kept]
        own, at = np.unique(row, return_inverse=True)
        more = int(rank.max()) + 1
        add_node, add_value = np.full((len(own), more), -1, np.int32), np.full((len(own), more), -np.inf, np.float32)
        add_node[at, rank], add_value[at, rank] = node, value
        all_value = np.concatenate((cosine[own], add_value), 1)
        best = np.argpartition(-all_value, width - 1, 1)[:, :width] if all_value.shape[1] > width else np.argsort(-all_value, 1)
        cosine[own] = np.take_along_axis(all_value, best, 1)
        nodes[own] = np.take_along_axis(np.concatenate((nodes[own], add_node), 1), best, 1)
        followed[own] = np.take_along_axis(np.concatenate((followed[own], np.zeros(add_node.shape, bool)), 1), best, 1)

    merge(*meet(np.repeat(np.arange(rows), entry.shape[1]), entry.ravel()))
    while True:
        open_ = np.where(followed | (nodes < 0), -np.inf, cosine)
        few = min(STEP, width)
        best = np.argpartition(-open_, few - 1, 1)[:, :few]
        row, slot = np.nonzero(np.take_along_axis(open_, best, 1) > -np.inf)
        if not len(row):
            break
        slot = best[row, slot]
        followed[row, slot] = True
        next_ = links[nodes[row, slot]]
        merge(*meet(np.repeat(row, next_.shape[1]), next_.ravel()))
    if least is not None:
        at = 0
        while at < len(hits):  # what reaches ``least`` is followed whether or not the beam kept it
            row, node, _ = hits[at]
            at += 1
            for k in range(0, len(row), FLOOD):
                next_ = links[node[k : k + FLOOD]]
                meet(np.repeat(row[k : k + FLOOD], next_.shape[1]), next_.ravel())
    order = np.argsort(-cosine, 1, kind="stable")
    found = tuple(np.concatenate(c) for c in zip(*hits, strict=True)) if hits else (np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32))
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(cosine, order, 1), found


def _grown(vectors: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Links of one layer over all of ``vectors``; ``entry`` is where the layer above leads to."""
    size = len(vectors)
    links, degree = np.full((size, ROOM), -1, np.int32), np.zeros(size, np.int64)

    def chosen(new: np.ndarray, near: np.ndarray, cosine: np.ndarray) -> None:
        picked = _diverse(vectors, near, cosine, DEGREE)
        links[new, :DEGREE], degree[new] = picked, (picked >= 0).sum(1)
        # links back, in rounds of one for each target; a full row chooses its own links anew
        row, slot = np.nonzero(picked >= 0)
        source, target = new[row].astype(np.int32), picked[row, slot]
        known = (links[target] == source[:, None]).any(1)
        source, target = source[~known], target[~known]
        while len(target):
            _, first = np.unique(target, return_index=True)
            now = np.zeros(len(target), bool)
            now[first] = True
            full = np.unique(target[now][degree[target[now]] >= ROOM])
            if len(full):
                own = np.einsum("ij,ikj->ik", vectors[full], vectors[np.maximum(links[full], 0)])
                again = _diverse(vectors, links[full], np.where(links[full] >= 0, own, -np.inf), 2 * DEGREE)
                links[full] = -1
                links[full, : 2 * DEGREE], degree[full] = again, (again >= 0).sum(1)
            links[target[now], degree[target[now]]] = source[now]
            degree[target[now]] += 1
            source, target = source[~now], target[~now]

    def among(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = vectors[new] @ vectors[new].T
        np.fill_diagonal(own, -np.inf)
        best = np.argsort(-own, 1, kind="stable")[:, : 2 * DEGREE]
        value = np.take_along_axis(own, best, 1)
        return np.where(value > -np.inf, new[best], -1).astype(np.int32), value

    done = min(size, SEED)
    chosen(np.arange(done), *among(np.arange(done)))
    while done < size:
        new = np.arange(done, min(size, done + min(_group(vectors), done)))
        nodes, cosine, _ = _beam(vectors[:done], links, vectors[new], np.where(entry[new] < done, entry[new], 0)[:, None], BUILD_BEAM)
        beside, value = among(new)
        chosen(new, np.concatenate((nodes, beside), 1), np.concatenate((cosine, value), 1))
        done = int(new[-1]) + 1
    return links


class SmallWorld:
    """The graph: unit ``vectors`` in order of level and the links of each layer, the highest first."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]):
        self.vectors, self.layers = np.ascontiguousarray(vectors, np.float32), layers

    @classmethod
    def built(cls, vectors: np.ndarray) -> SmallWorld:
        """A graph over ``vectors``, whose order must not depend on their content (it decides their levels)."""
        sizes = [len(vectors)]
        while sizes[-1] > RATIO * RATIO:
            sizes.append(sizes[-1] // RATIO)
        out = cls(vectors, [])
        for size in reversed(sizes):
            entry = out._descended(out.vectors[:size])
            out.layers.append(_grown(out.vectors[:size], entry))
        return out

    def _descended(self, queries: np.ndarray) -> np.ndarray:
        """The best vector of the layers so far for each query, 0 without a layer."""
        entry, step = np.zeros(len(queries), np.int32), _group(self.vectors)
        for links in self.layers:
            for at in range(0, len(queries), step):
                nodes, _, _ = _beam(self.vectors[: len(links)], links, queries[at : at + step], entry[at : at + step, None], 4)
                entry[at : at + step] = nodes[:, 0]
        return entry

    def reaching(self, queries: np.ndarray, least: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query, node, cosine) of what the searches met of a cosine of ``least`` or more, a group of queries at a time."""
        top, step = SmallWorld(self.vectors, self.layers[:-1]), _group(self.vectors)
        for at in range(0, len(queries), step):
            some = np.ascontiguousarray(queries[at : at + step], np.float32)
            entry = top._descended(some)
            _, _, (row, node, cosine) = _beam(self.vectors, self.layers[-1], some, entry[:, None], width, least)
            yield row + at, node, cosine
