"""Connected components of a graph that is never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewtide.session import materialise


def _lowest(edges: DataFrame) -> DataFrame:
    """Each node's lowest neighbour or itself, combined before the shuffle."""
    return edges.groupBy(F.col("u").alias("hub")).agg(F.least(F.min("v"), F.first("u")).alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every higher neighbour of a node to its lowest one."""
    both = edges.union(edges.select("v", "u"))
    linked = both.join(_lowest(both), F.col("u") == F.col("hub")).filter("v > u")
    return linked.select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its lower neighbours to the lowest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = down.join(_lowest(down), F.col("u") == F.col("hub"))
    lower = linked.select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = down.groupBy("u").agg(F.min("v").alias("v"))
    return lower.union(own).filter("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """Rows (node, component) of all nodes that ``edges`` (u, v) names; the lowest node names it.

    Alternating star contractions (large, then small) until the edges stay the same; the
    number of rounds grows with the logarithm of the longest path. Each round is written.
    Loops and repeated edges do no harm; null ends are dropped.
    """
    edges = edges.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct()
    edges = materialise(edges, "edges")
    before = None
    for _ in range(most_rounds):
        edges = materialise(_small_star(materialise(_large_star(edges), "edges")), "edges")
        now = tuple(edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    own = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own.select("node", "node"))
