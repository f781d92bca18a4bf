"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest node, for every node of the edges ``a``, ``b``.

    In each round every node points at its smallest neighbour if that is smaller. Such pointers
    form trees, which pointer jumping flattens; then each tree becomes one node. All steps are
    joins and partial aggregations of narrow rows, and each is written before the next reads it.
    With ids that are hashes the trees and the number of rounds grow with the logarithm of the data.
    """
    tie = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    left = stored(edges.filter(F.col("a") != F.col("b")).select(*tie).distinct(), "edges")
    labels = left.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        tree = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up")), "tree")
        while True:
            above = tree.select(F.col("node").alias("up"), F.col("up").alias("top"))
            tree = stored(tree.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "tree")
            if tree.filter("moved").isEmpty():
                break
            tree = tree.select("node", "up")
        top = tree.select("node", "up")
        labels = labels.join(top.withColumnRenamed("node", "component"), "component", "left").select(
            "node", F.coalesce("up", "component").alias("component")
        )
        a, b = top.select(F.col("node").alias("a"), F.col("up").alias("top_a")), top.select(F.col("node").alias("b"), F.col("up").alias("top_b"))
        joined = left.join(a, "a").join(b, "b").select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))
        left = stored(joined.filter(F.col("a") != F.col("b")).select(*tie).distinct(), "edges")
    return stored(labels, "components")
