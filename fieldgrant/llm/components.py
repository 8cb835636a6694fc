"""Connected components of an edge table, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise


def connected(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``; two nodes share a root if a path joins them.

    Each round every node points to the neighbour of lowest pseudo-random rank, itself included;
    edges move to what their ends point to and loops go. Ranks change every round, so chains of
    pointers stay short and the number of nodes falls by a constant factor: O(log n) rounds. Only
    minima are taken per node, so a hub arrives at its reducer as one partial row per task. Nulls and
    loops in ``edges`` are ignored; an empty table gives an empty result.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter(F.col("a") != F.col("b"))
    pairs = materialise(pairs.distinct(), "edges")
    found, turn = None, 0
    while not pairs.isEmpty():
        def rank(c, salt=turn):
            return F.struct(F.xxhash64(F.lit(salt), c).alias("r"), F.col(c).alias("n"))

        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        step = materialise(
            best.select(F.col("a").alias("node"), F.least(F.col("m"), rank("a"))["n"].alias("root")), "step"
        )
        moved = (
            pairs.join(step.select(F.col("node").alias("a"), F.col("root").alias("p")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("root").alias("q")), "b")
            .select(F.col("p").alias("a"), F.col("q").alias("b"))
            .filter("a != b")
        )
        if found is None:
            found = step
        else:
            later = step.select(F.col("node").alias("root"), F.col("root").alias("top"))
            found = materialise(
                found.join(later, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "found"
            )
        pairs = materialise(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        turn += 1
    return found if found is not None else pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
