"""Connected components by alternating large and small stars, on edges that are never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import landed


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """`node` and `root`, the smallest node that edges (columns a, b) lead to, for every node of an edge.

    Each round links nodes to the smallest node near them, so a chain of n nodes takes about log(n) rounds. A node with
    very many edges costs no more than these: minima are combined before the shuffle, and its join can be split.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = landed(now, "edges")
    before = None
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        # the minima are landed, so that the join below has rows of its own to shuffle and a large node can be split
        least = landed(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "large-least")
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = landed(large, "large-star")
        least = landed(large.groupBy("a").agg(F.min("b").alias("m")), "small-least")
        pairs = large.join(least, "a")
        small = pairs.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        now = landed(small, "small-star")
        sums = [F.coalesce(F.sum(F.hash("a", "b", F.lit(k)).cast("long")), F.lit(0)) for k in (1, 2)]
        state = tuple(now.agg(F.count(F.lit(1)), *sums).first())
        if state == before or not state[0]:
            break
        before = state
    else:
        raise RuntimeError("components didn't settle")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
