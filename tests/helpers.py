from collections import Counter

from pyspark.sql import functions as F


def one(spark, column, value, kind="string"):
    """The value of an expression over a one-row table with column ``x``."""
    table = spark.createDataFrame([(value,)], f"x {kind}")
    return table.select(column(F.col("x")).alias("y")).first()["y"]


def rows(table):
    """The rows of a table as a multiset of tuples."""
    return Counter(tuple(r) for r in table.collect())


def plan(table):
    """The physical plan as text."""
    return table._jdf.queryExecution().executedPlan().toString()
