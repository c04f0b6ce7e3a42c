"""Connected components of a graph held as an edge table, without the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import store


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node in its neighbourhood."""
    sym = _both(edges)
    low = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return sym.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("low"))
    moved = down.join(low, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    ``edges`` has long columns ``u`` and ``v``.  Alternating star contractions:
    each round replaces the edges by others of the same components until every
    node points at its smallest one, which takes few rounds (their number grows
    with the logarithm of the diameter).  Each round's edges are written to the
    shared folder.  Self loops and null ends are ignored.
    """
    now = store(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    for _ in range(rounds):
        after = store(_small_star(_large_star(now).distinct()).filter("u <> v").distinct(), "edges")
        # Stars only: every node has one edge, and no centre is itself a leaf of another.
        sizes = after.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
            after.select("v", F.lit(0), F.lit(1)))
        odd = sizes.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
        now = after
        if odd.filter("leaf > 1 or (leaf > 0 and centre > 0)").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(leaves.select("component", "component").distinct())
