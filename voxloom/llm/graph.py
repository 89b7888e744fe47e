"""Connected components as tables: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, materialize

MOST_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node): a row for each node of the edges a, b, of any type that has an order.

    Each round points every neighbour above a node to the smallest neighbour and
    then every node to its smallest; edges only ever shrink towards stars, and
    it ends when a round changes nothing. Edges with a null and loops say nothing.
    The centre of a large star is a hot key, so smallest neighbours are looked up
    as hot keys are.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and a <> b")
    e = materialize(e.distinct(), "edges")
    state = _state(e)
    for _ in range(MOST_ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        above = lookup(both.where("v > u"), "u", low, "n")
        large = above.select(F.col("v").alias("u"), F.col("_found.m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = lookup(large, "u", low, "n").where("v <> _found.m").select(F.col("v").alias("u"), F.col("_found.m").alias("v"))
        low = low.select("u", "m")
        e = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state, before = _state(e), state
        if state == before:
            break
    else:
        raise RuntimeError(f"components haven't settled in {MOST_ROUNDS} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def grown(label, i: int, others) -> None:
    """Labels, a number for each member, after i is joined with the others."""
    import numpy as np

    old = np.unique(np.append(label[others], label[i]))
    label[np.isin(label, old)] = old[0]


def forest(n: int, pairs) -> list[int]:
    """The smallest member's index for each of n members joined by pairs (i, j)."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
