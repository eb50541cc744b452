"""Connected components: by joins over tables of any size, and by arrays inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import written


def join_all(up: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of positions ``a`` and ``b`` in the forest ``up``: every position leads to the smallest that it reaches."""
    while True:
        x, y = up[a], up[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(up, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            jumped = up[up]
            if (jumped == up).all():
                break
            up[:] = jumped


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges between ids: (id, the smallest id that it reaches), ids that differ only."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    up = np.arange(len(ids))
    join_all(up, at[: len(a)], at[len(a) :])
    moved = np.flatnonzero(up != np.arange(len(ids)))
    return ids[moved], ids[up[moved]]


def components(edges: DataFrame, name: str = "components", rows: int | None = None) -> DataFrame:
    """(id, root): every id of ``edges`` (a, b) with the smallest id that it reaches.

    Each round leads every id to its smallest neighbour, follows these steps to
    their ends by pointer jumping, and contracts the edges: ends become what they
    lead to, loops and repeated edges go.  What is left at least halves its ids, so
    all rounds together read little more than the first.  Rounds are written to the
    shared folder, which cuts the lineage.  Nulls link nothing.  ``rows`` says about
    how many edges there are, where a caller knows.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    live = edges.where("a is not null and b is not null and a <> b").select(high.alias("a"), low.alias("b")).distinct()
    live = written(live, f"{name}-edges", rows)
    rounds: list[DataFrame] = []
    most = left = live.count()
    while left:
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("up")).where("up < id")
        moved = written(moved, f"{name}-{len(rounds)}-up", 2 * left)
        while True:
            step = lambda name: moved.select(F.col("id").alias("up"), F.col("up").alias(name))  # noqa: E731, B023
            farther = moved.join(step("far"), "up", "left").select("id", F.col("far").isNotNull().alias("went"), F.coalesce("far", "up").alias("up"))
            farther = farther.join(step("farther"), "up", "left").select("id", "went", F.coalesce("farther", "up").alias("up"))
            farther = written(farther, f"{name}-{len(rounds)}-up", 2 * left)
            moved = farther.select("id", "up")
            if farther.where("went").isEmpty():
                break
        rounds.append(moved)
        for end in ("a", "b"):
            to = moved.select(F.col("id").alias(end), "up")
            live = live.join(to, end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
        live = written(live.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), f"{name}-{len(rounds)}", left)
        left = live.count()
    if not rounds:
        return live.select(F.col("a").alias("id"), F.col("b").alias("root"))
    found = rounds[-1].select("id", F.col("up").alias("root"))
    for moved in reversed(rounds[:-1]):  # an id moves in one round; where it went to may have moved on
        later = found.select(F.col("id").alias("up"), "root")
        found = found.unionByName(moved.join(later, "up", "left").select("id", F.coalesce("root", "up").alias("root")))
    found = written(found, f"{name}-roots", 2 * most)
    return found.unionByName(found.select(F.col("root").alias("id"), "root").distinct())
