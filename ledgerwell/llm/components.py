"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.shared import stage


def _mark(edges: DataFrame) -> tuple:
    """Tells two edge tables apart."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b). Nodes without edges are absent.

    Each step points nodes to the smallest neighbour known (aggregated before the shuffle) and never
    gathers a node's neighbours; a hub's rows are only joined with its one minimum. Every step is
    written to the shared folder. Loops, repeated and reversed edges do no harm.
    """
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage(edges.select(high, low).where("a <> b").distinct(), name)
    mark = _mark(edges)
    while mark[0]:
        # Large star: a node's larger neighbours go to its smallest neighbour (or itself).
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), name)
        # Small star: a node and its smaller neighbours go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(small.union(least.withColumnRenamed("m", "b")).distinct(), name)
        new = _mark(edges)
        if new == mark:
            break
        mark = new
    least = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return least.withColumnRenamed("a", "node").union(roots.join(least, roots["node"] == least["a"], "left_anti"))
