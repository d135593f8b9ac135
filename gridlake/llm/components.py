"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import written


def _is_stars(edges: DataFrame) -> bool:
    """Whether each node has either one edge, to a lesser node, or edges to greater nodes only: then the lesser ends are the least of their components."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e"))
    return ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count("*").alias("n")).where("up > 0 AND n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Of edges (a, b): each node that has an edge, as ``node``, and the least node that it reaches, as ``root``.

    Every step is a grouped minimum and a join on the node, so no component is held in one place. Minima are written, so
    that the join's sides are plain exchanges and Spark can split the partition of a node with very many edges.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = written(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
