"""Connected components by alternating large and small stars, on links of any degree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut, discard, sent


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(edges: DataFrame) -> tuple[DataFrame, int]:
    """(u, m): each node's least one of itself and its neighbours, written; and how many nodes are no part of a star.

    In a star the centre has greater neighbours only, and each other node has the centre only.
    """
    seen = Observation()
    low, high = F.min("v"), F.max("v")
    apart = F.count_if((F.col("low") < F.col("u")) & (F.col("low") < F.col("high"))).alias("apart")
    found = _neighbours(edges).groupBy("u").agg(low.alias("low"), high.alias("high")).observe(seen, apart)
    stored = cut(found.select("u", F.least("low", "u").alias("m")), "least")
    return stored, seen.get["apart"]


def _large_star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Each node's greater neighbours are linked to its least one."""
    return _neighbours(edges).where("v > u").join(sent(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours are linked to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lesser = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lesser.unionByName(least.select("u", F.col("m").alias("v")))


def contracted(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """Edges (u, v) from a greater node to a lesser one that join the same nodes as ``links`` (a, b).

    Without ``rounds`` they are stars around the least node of each component; else at most so many rounds
    are run, and nodes of one component may still have several lesser ones. Links with a null or the same node
    at both ends count for nothing. Each round is written to the shared folder; the number of rounds grows with
    the logarithm of the longest path.
    """
    edges = cut(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    done = 0
    while rounds is None or done < rounds:
        least, apart = _least(edges)
        if not apart:
            discard(least)
            break
        now = cut(_small_star(_large_star(edges, least)).distinct(), "edges")
        discard(edges, least)
        edges, done = now, done + 1
    return edges


def least_known(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a lesser one among ``edges``: the least of these."""
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is a component's least node."""
    edges = contracted(links).distinct()
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
