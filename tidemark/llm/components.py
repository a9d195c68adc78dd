"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_side, stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v, longs); root is the smallest id.

    Large stars join a node's larger neighbours to its smallest one, small stars
    its smaller ones; both keep the components and end in one star each. The
    number of rounds grows with the logarithm of the number of nodes, and no
    round holds more edges than the first but for one a node. The smallest
    neighbour is found by partial aggregation, and the join that follows has one
    row a node on its small side, so adaptive execution can split a hot centre.
    Loops do not count; no edges, no rows.
    """
    edges = edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    now = stage(edges.distinct(), "edges")
    mark = _mark(now)
    while True:
        # A round's large stars are one for an edge at most, its small stars two.
        size = 16 * mark[0]
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), 2 * size)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), "large-stars", size)
        least = _least(large.groupBy("u").agg(F.min("v").alias("m")), size)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = least.select("u", F.col("m").alias("v"))
        now = stage(small.unionByName(star).where("u <> v").distinct(), "edges", 2 * size)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )


def _least(nodes: DataFrame, size: int) -> DataFrame:
    """One row a node: broadcast if they are few, else joined apart from their grouping."""
    return small_side(stage(nodes, "least", size), 16)


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge sets, and for others with negligible chance only."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
