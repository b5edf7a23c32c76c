"""Connected components as alternating star joins (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.util import pinned

# Edges that one task reads; a small edge set is not spread over as many tasks as it was written by.
EDGES_PER_TASK = 250_000


def _stars(edges: DataFrame) -> DataFrame:
    """One round on edges (a, b), a > b: neighbours above a node, then those below it, move to its smallest neighbour."""
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    low = (edges.select(F.explode(ends).alias("e")).groupBy(F.col("e.a").alias("b"))
           .agg(F.min("e.b").alias("m")).select("b", F.least("b", "m").alias("m")))
    # repeated rows are left to the end of the round: there are never more than edges
    large = edges.join(low, "b").select("a", F.col("m").alias("b"))
    moved = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
    made = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.select(F.explode(made).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of every component, for nodes of at least one edge (a, b).

    Edges stay distributed; each round is pinned, and only a count and a
    checksum of the edge set reach the driver to see that it stopped changing.
    """
    cores = max(1, edges.sparkSession.sparkContext.defaultParallelism)
    edges = pinned(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        mark = edges.coalesce(cores).agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = edges.coalesce(1 + mark[0] // EDGES_PER_TASK)
        if mark == last or not mark[0]:
            break
        last, edges = mark, pinned(_stars(edges))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
