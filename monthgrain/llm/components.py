"""Connected components of links by alternating stars, with narrow rows only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthgrain.llm.scratch import stored


def _flat(edges: DataFrame) -> bool:
    """Whether each node has one parent that has none itself."""
    n, children = edges.agg(F.count("*"), F.countDistinct("u")).first()
    if n != children:
        return False
    return edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def _least(edges: DataFrame) -> DataFrame:
    """The least neighbour of each ``u``; written, so that joins with hot nodes can be split."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (u, v); the component is its least node.

    Nodes are numbers; links with a null end, loops and repeats are ignored. Each round points
    the larger neighbours of a node to its least neighbour, then each node and its smaller
    neighbours to the least of them, which takes about log2 of the longest path rounds. Every
    round is written to the shared folder; the driver sees counts only.
    """
    edges = stored(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    while not _flat(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.where("v > u")
            .join(_least(both), "u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        )
        large = stored(large.distinct(), "edges")
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
