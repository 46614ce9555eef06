"""Connected components of a graph given as an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.shared import written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges (a long, b long)``; root is the least node.

    Each round hangs every larger neighbour on the least of its neighbourhood (large
    star), then every node and its smaller neighbours on the least of them (small star).
    Minima come from grouped aggregation, which combines before the shuffle, and are
    joined back, so a hub's neighbourhood is never held by one task. Rounds grow with the
    logarithm of the longest path. Loops and nulls are ignored; an empty table gives none.
    """
    sides = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(sides.distinct(), "edges")
    mark = _fingerprint(now)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        hung = large.join(least, "a")
        small = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            hung.select("a", F.col("low").alias("b"))
        )
        now = written(small.filter("a <> b").distinct(), "edges")
        before, mark = mark, _fingerprint(now)
        if before == mark:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _fingerprint(edges: DataFrame) -> tuple:
    """Two equal edge sets have equal counts and sums."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )
