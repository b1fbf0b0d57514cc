"""Connected components of a graph too large for one machine.

Alternating star contractions: each round links every node's larger neighbours, then its smaller ones, to the smallest
node near it, until the forest is one star a component. Degrees and depths shrink each round, and no group's
neighbours are ever gathered: only minima are aggregated, with partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node with an edge to another, component being the smallest node reachable.

    ``edges`` has long columns ``a`` and ``b``; direction, repeats, self-links and nulls don't matter. An empty input
    gives an empty result. The input should be small in each partition; rounds are about the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    (now, mark), before = _marked(edges, scratch), None
    for _ in range(max_rounds):
        if mark == before or not mark[0]:
            break
        before, old = mark, now
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # every edge now points from the larger node to a smaller one
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now, mark = _marked(rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), scratch)
        scratch.drop(old)
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _marked(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, tuple[int, int | None]]:
    """The edges, stored, with their count and an order-free sum of hashes, taken while they are written: equal marks, equal edges."""
    seen = Observation()
    out = scratch.store(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "edges")
    return out, (seen.get["n"], seen.get["sum"])
