"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.workspace import new_path, remove


def _store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the node, is linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(lowest, "u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        lowest.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the smallest node it reaches.

    Each round aggregates before it shuffles and joins a node with one row. Links are read from
    stored tables, so that the join can split the links of a node with very many. Rounds are stored; there are about as many as the
    logarithm of the longest path. Loops and repeated links do no harm.
    """
    spark = edges.sparkSession
    edges, path = _store(edges.where("u <> v").select("u", "v").distinct(), "edges")
    while True:
        stepped = _small_star(_large_star(edges)).where("u <> v").distinct()
        new, new_path_ = _store(stepped, "edges")
        changed = not (new.exceptAll(edges).isEmpty() and new.count() == edges.count())
        remove(spark, path)
        edges, path = new, new_path_
        if not changed:
            nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return nodes.union(edges.select("v", "v").distinct())
