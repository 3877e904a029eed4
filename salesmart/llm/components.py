"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import checkpointed

#: Rounds after which a run is given up; the number needed grows with the logarithm of the longest path.
MAX_ROUNDS = 60


def _hang(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Hang neighbours below the least node each one sees.

    larger_only: every node's larger neighbours go to the least node around it.  Else every node and
    its smaller neighbours go to the least of them.  Minima are aggregates, joined back, so that a
    node with very many neighbours is no single task.
    """
    if larger_only:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("x"), F.col("root").alias("y"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("root"))
        moved = down.join(least, "a").select(F.col("b").alias("x"), F.col("root").alias("y"))
        moved = moved.union(least.select(F.col("a").alias("x"), F.col("root").alias("y")))
    return moved.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node of its component.

    Alternates two steps that keep the components and shorten every path to the root (large-star and
    small-star); ends when a round changes nothing, so each component is a star around its root.
    """
    current = checkpointed(edges.where("a <> b").select("a", "b").distinct())
    before = None
    for _ in range(MAX_ROUNDS):
        current = checkpointed(_hang(_hang(current, larger_only=True), larger_only=False))
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")
        ).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
