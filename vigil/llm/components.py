"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import write_table


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with an edge; ``root`` is the smallest node it can reach.

    Rows with a null end and loops are no edges. Each round is written to the shared folder,
    so plans stay short and a lost executor costs one round. The number of rounds grows with
    the logarithm of the longest path.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = write_table(edges, "edges")
    state = _state(edges)
    while state[0]:
        edges = write_table(_small_star(_large_star(edges)), "star")
        state, last = _state(edges), state
        if state == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
