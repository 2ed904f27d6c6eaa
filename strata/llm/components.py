"""Connected components over a table of edges, by joins and minima only.

Alternates the large-star and small-star steps: every round hooks each node's
neighbours to the smallest node known to it. No neighbour list is ever
gathered, the edges stay distributed, and each round is written to the shared
folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import scratch

MAX_ROUNDS = 100


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inside one tile: for each of ``n`` nodes, the smallest node that the links ``a``-``b`` join it to."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _largest_first(edges: DataFrame) -> DataFrame:
    """Edges as (u, v) with u > v, without loops and repeats."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hooked = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, a: str = "u", b: str = "v") -> DataFrame:
    """``(node, root)`` for every node with an edge; ``root`` is the component's smallest node.

    Nodes may be of any orderable type. Edges in either direction, loops and
    repeats are fine; edges with a null end are ignored. A node with only a
    loop has no row.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    edges = scratch(_largest_first(edges), "edges")
    state = None
    for _ in range(MAX_ROUNDS):
        edges = scratch(_largest_first(_small_star(_largest_first(_large_star(edges)))), "edges")
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if tuple(seen) == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = tuple(seen)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
