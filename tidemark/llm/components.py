"""Connected components of an edge table, in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store

MAX_ROUNDS = 60


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Link the neighbours of each node to the node's smallest neighbour.

    `larger`: only neighbours above the node move, else the node and those below it.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    joined = pairs.join(least, "a")
    if larger:
        return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    own = least.select("a", F.col("least").alias("b"))
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return own.unionByName(moved).filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component.

    Alternates the two star operations until nothing changes; each halves the depth of the trees, so the
    number of rounds grows with the logarithm of the longest chain. Every round is written to the shared
    folder. Edges stay at one or two per node, and no node's neighbours meet in one row.
    """
    ordered = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = store(ordered.distinct(), "edges")
    seen = None
    for _ in range(MAX_ROUNDS):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, larger=True)
        current = store(_star(large, larger=False), "edges")
        state = tuple(current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
