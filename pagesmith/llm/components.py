"""Connected components of a graph that may be larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesmith.cluster import cut_lineage


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One round: every node sends its neighbours to the smallest node next to it.

    Pairs are aggregated before they are shuffled, so a hub's edges don't meet in one task; only its
    smallest neighbour, one row for each node, is joined back (a skewed join that Spark can split)."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger_only else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = both.join(least, "u")
    if larger_only:
        linked = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.where("u != m").select("u", F.col("m").alias("v")))
    return linked.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node reachable from every node of ``edges`` (``u, v``; any direction,
    repeats and loops allowed). Nodes without an edge to another node are not listed.

    Alternates large-star and small-star rounds until the edges stay the same; the number of rounds
    grows with the logarithm of the longest chain. Each round's edges are written to the shared folder,
    so lineage stays short and a lost executor repeats one round at most."""
    ordered = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = cut_lineage(ordered.distinct())
    state = _state(current)
    while state[0]:
        current = cut_lineage(_stars(_stars(current, True), False))
        now = _state(current)
        if now == state:
            break
        state = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    digest = F.bit_xor(F.xxhash64("u", "v"))
    return tuple(edges.agg(F.count("*"), digest).first())
