"""Singular values and right vectors of a small square matrix: Householder bidiagonal form, dqds, twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
NEGLIGIBLE = (100 * EPS) ** 2  # of a squared off-diagonal, against the squared values beside it
CLUSTER = 1e-6  # relative gap of squared values whose vectors are made orthogonal to each other


def bidiagonalised(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, p) with R = Q B p' for orthogonal Q and p."""
    a, size = np.array(r, np.float64), len(r)
    p = np.eye(size)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0:
            return None
        v = x / norm
        v[0] += np.copysign(1.0, v[0])
        return v / np.linalg.norm(v)

    for k in range(size):
        if (v := reflector(a[k:, k].copy())) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 2 < size and (v := reflector(a[k, k + 1 :].copy())) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _transformed(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential quotient-difference step: (q, e, d) of the shifted matrix; a negative d means a shift too large."""
    d, new_q, new_e, every = q[0] - shift, [], [], []
    for k in range(len(e)):
        every.append(d)
        top = d + e[k]
        t = q[k + 1] / top if top else 0.0
        new_q.append(top)
        new_e.append(e[k] * t)
        d = d * t - shift
    every.append(d)
    new_q.append(d)
    return new_q, new_e, every


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling, by dqds.

    Shifts are lower bounds of the smallest value left (the Newton step from a
    zero-shift transform), pushed further where the result stays positive, so no
    digit is lost to cancellation.
    """
    out: list[float] = []
    todo = [((diagonal**2).tolist(), (above**2).tolist(), 0.0)]
    while todo:
        q, e, shifted = todo.pop()
        while q:
            if len(q) == 1:
                out.append(shifted + q[0])
                break
            if e[-1] <= NEGLIGIBLE * (shifted + q[-1]) or q[-1] == e[-1] == 0:
                out.append(shifted + q.pop())
                e.pop()
                continue
            cut = next((k for k in range(len(e) - 1) if e[k] <= NEGLIGIBLE * (shifted + min(q[k], q[k + 1]))), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            zero_q, zero_e, d = _transformed(q, e, 0.0)
            low = 1 / sum(1 / x for x in d) if min(d) > 0 else 0.0
            for shift in (0.5 * (low + min(d)), low * (1 - 8 * EPS * len(q))):
                if shift <= 4 * EPS * shifted * EPS or shift <= 0:
                    continue
                next_q, next_e, d = _transformed(q, e, shift)
                if min(d) >= 0:
                    q, e, shifted = next_q, next_e, shifted + shift
                    break
            else:
                q, e = zero_q, zero_e
    return np.sort(np.asarray(out))[::-1]


class _Twisted:
    """L D L' - x for the bidiagonal factor's squares, factored from above and from below."""

    def __init__(self, a: np.ndarray, b: np.ndarray, x: float):
        size = len(a)
        d, l, tiny = a**2, b / a[:-1], EPS * EPS * float(np.max(a**2)) + np.finfo(np.float64).tiny
        self.down, self.up = np.zeros(size - 1), np.zeros(size - 1)
        self.pivot = np.zeros(size)
        s, p = np.zeros(size), np.zeros(size)
        s[0] = -x
        for k in range(size - 1):
            self.pivot[k] = s[k] + d[k]
            if abs(self.pivot[k]) < tiny:
                self.pivot[k] = tiny
            self.down[k] = d[k] * l[k] / self.pivot[k]
            s[k + 1] = self.down[k] * l[k] * s[k] - x
        self.pivot[-1] = s[-1] + d[-1]
        if abs(self.pivot[-1]) < tiny:
            self.pivot[-1] = tiny
        p[-1] = d[-1] - x
        for k in range(size - 2, -1, -1):
            below = d[k] * l[k] ** 2 + p[k + 1]
            if abs(below) < tiny:
                below = tiny
            t = d[k] / below
            self.up[k] = l[k] * t
            p[k] = p[k + 1] * t - x
        self.twist = int(np.argmin(np.abs(s + p + x)))

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.pivot))
        z[self.twist] = 1.0
        for k in range(self.twist - 1, -1, -1):
            z[k] = -self.down[k] * z[k + 1]
        for k in range(self.twist, len(z) - 1):
            z[k + 1] = -self.up[k] * z[k]
        return z / np.linalg.norm(z)

    def solved(self, y: np.ndarray) -> np.ndarray:
        w = y.copy()
        for k in range(len(w) - 1):
            w[k + 1] -= self.down[k] * w[k]
        w /= self.pivot
        for k in range(len(w) - 2, -1, -1):
            w[k] -= self.down[k] * w[k + 1]
        return w / np.linalg.norm(w)


def _block_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Vectors (columns) of the falling squared ``values`` of one unreduced block."""
    scale = float(np.max(np.abs(np.concatenate((a, b))))) or 1.0
    a = np.where(np.abs(a) < EPS * scale * EPS, EPS * scale * EPS, a)
    out = np.zeros((len(a), len(values)))
    random, first = np.random.default_rng(7), 0
    for k, x in enumerate(values):
        if k and values[k - 1] - x > CLUSTER * max(values[0], EPS):
            first = k
        near = out[:, first:k]
        apart = lambda v: v - near @ (near.T @ v)
        factors = _Twisted(a, b, float(x)) if len(a) > 1 else None
        z = factors.vector() if factors else np.ones(1)
        if k > first:
            z = apart(apart(z))
            if np.linalg.norm(z) < 0.5:  # a value so close that the twisted vector repeats: inverse iteration
                z = random.standard_normal(len(a))
                for _ in range(4):
                    z = apart(apart(z))
                    z = factors.solved(z / np.linalg.norm(z))
                z = apart(apart(z))
        out[:, k] = z / np.linalg.norm(z)
    return out


def leading(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values, right vectors as columns, sum of all squared values) of the ``most`` largest non-zero values of ``r``."""
    a, b, p = bidiagonalised(r)
    size = len(a)
    squares = np.concatenate((a, b)) ** 2
    total, largest = float(squares.sum()), float(squares.max(initial=0.0))
    b[np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:]))] = 0.0
    edges = np.concatenate(([0], np.flatnonzero(b == 0) + 1, [size]))
    values, spans = [], []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        own = squared_values(a[low:high], b[low : high - 1])
        values += own.tolist()
        spans += [(int(low), int(high), k) for k in range(len(own))]
    order = [k for k in np.argsort(-np.asarray(values), kind="stable") if values[k] > size * EPS * EPS * largest * size][:most]
    vectors = np.zeros((size, len(order)))
    for low, high in {(spans[k][0], spans[k][1]) for k in order}:
        mine = [(c, k) for c, k in enumerate(order) if spans[k][:2] == (low, high)]
        own = _block_vectors(a[low:high], b[low : high - 1], np.asarray([values[k] for _, k in mine]))
        for j, (c, _) in enumerate(mine):
            vectors[low:high, c] = own[:, j]
    return np.asarray([values[k] for k in order]), p @ vectors, total
