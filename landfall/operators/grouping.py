"""Unions and grouped aggregates.

All of them aggregate before they shuffle, so a key that holds a large share of
the rows reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_union(*tables: DataFrame) -> DataFrame:
    """The distinct rows of some tables, their columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), tables).dropDuplicates()


def one_row_per(table: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key with the largest of each value column.

    Meant for tables that repeat a key's figures on several rows.
    """
    return table.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def group_stats(table: DataFrame, keys: Sequence[str], means: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The mean of some columns and the sum of others, per group."""
    return table.groupBy(*keys).agg(
        *[F.avg(m).alias(m) for m in means],
        *[F.sum(s).alias(s) for s in sums],
    )
