"""Connected components of an edge list, distributed.

Alternating large-star and small-star steps (Kiveris et al. 2014). Each step
is an aggregation with map-side combining and an equi-join, so the centre of a
star that holds a third of all edges is neither a window nor a group in one
task. Edges stay on the executors; only two numbers a round reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest's worth of links with the same components as links a-b."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(nodes))
    for i, j in zip(flat[: len(a)].tolist(), flat[len(a) :].tolist(), strict=True):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        while parent[j] != j:
            parent[j] = parent[parent[j]]
            j = parent[j]
        if i != j:
            parent[max(i, j)] = min(i, j)
    linked = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[linked], nodes[parent[linked]]


def _hook(pairs: DataFrame, *, small: bool) -> DataFrame:
    """One star step over directed pairs (u, v): v, or u's smaller neighbours, to u's minimum."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = pairs.join(least, "u")
    if not small:
        return joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own).where("a <> b")


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, component) for every node that has an edge; component is its smallest node.

    ``edges`` has long columns a, b. Nulls and self-links are ignored, repeated
    and reversed edges count once; no edges give no rows. Raises after
    ``max_rounds`` rounds (they grow with the logarithm of the nodes).
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, before = checkpointed(e), None
    for _ in range(max_rounds):
        n, mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if n == 0 or (n, mark) == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = (n, mark)
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _hook(both, small=False).distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        e = checkpointed(_hook(down, small=True).distinct())
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
