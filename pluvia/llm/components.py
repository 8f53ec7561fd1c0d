"""Connected components of a graph given as edges, by alternating large and small stars.

Both steps are joins-free: neighbours of a node are grouped, and the node's smallest neighbour becomes
the new end of its edges. Every round is written below the shared folder, so a lost executor repeats one
round at most. A hub of any size costs two aggregations with partial sums, never one collected list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvia.session import new_folder


def _save(df: DataFrame, label: str) -> DataFrame:
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _least(edges: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours; edges in both directions."""
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge (u, v) can reach.

    Nulls take no part; loops and repeated edges do no harm; without edges the result is empty.
    """
    edges = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    edges = _save(edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour of a node moves to its smallest one
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(_least(both), "u")
            .where(F.col("v") != F.col("least"))
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .distinct()
        )
        large = _save(large, "large")
        # small star: a node and its smaller neighbours move to the smallest of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("least"))
        moved = down.join(least, "u").where(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = _save(moved.union(least.select("u", F.col("least").alias("v"))).distinct(), "small")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
