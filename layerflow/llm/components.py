"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerflow.llm.training import release, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("least"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (``a > b``)."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least"))
    return moved.union(least).select("a", F.col("least").alias("b")).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a, b``); the component is its smallest node.

    Each round is two joins on the links alone, written to the shared folder; the number of
    rounds grows with the logarithm of the longest chain. Stars with a hot centre are a skewed
    join, which adaptive execution splits. Links of a node to itself are left out; no links
    give no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state, before = None, None
    for _ in range(max_rounds):
        edges = stored(_small_star(_large_star(edges)), "components")
        release(before)
        before = edges
        # a star forest: sums of its links' hashes tell whether the round changed anything
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
