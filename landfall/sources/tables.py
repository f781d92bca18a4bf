"""Parquet lake tables: scans and repeatable writes.

A table that a snapshot of its lake has is read from there, and written by a commit of its own. Any other is the folder of its path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from landfall.sources.snapshots import MONTH, Transaction, found


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A lake table. With ``schema`` it may also be one that no month has filled yet."""
    held = found(spark, path)
    if held is not None:
        return held[0].read(spark, held[1])
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def read_months(spark: SparkSession, path: str, months: str | Sequence[str]) -> DataFrame:
    """The rows of some months; other partitions are not opened."""
    keys = [months] if isinstance(months, str) else list(months)
    held = found(spark, path)
    table = spark.read.parquet(path) if held is None else held[0].read(spark, held[1], keys)
    return table.filter(F.col(MONTH) == keys[0] if len(keys) == 1 else F.col(MONTH).isin(keys))


def write_table(table: DataFrame, path: str) -> None:
    """Replace the whole table."""
    held = found(table.sparkSession, path)
    if held is not None:
        with Transaction(table.sparkSession, held[0].root) as run:
            run.write_table(held[1], table)
            run.commit()
        return
    table.write.mode("overwrite").parquet(path)


def write_months(
    table: DataFrame, path: str, *, mode: str = "replace", rebalance: bool = False, watch: bool = False
) -> set[str] | None:
    """Write a month-partitioned table.

    ``replace`` swaps the months present in ``table`` and leaves all others alone,
    so a repeated run gives the same lake; ``append`` adds to them. A month without
    rows keeps what it had; ``watch`` has the write return the months that got rows.
    ``rebalance`` is for tables whose tasks each hold many months, such as the result
    of a join: AQE then gathers each month into files of the advisory size, splitting
    a month that is larger than that over several tasks.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    held = found(table.sparkSession, path)
    if held is not None:
        if mode == "append":
            raise ValueError(f"{path} is published by snapshots, which replace months and append to none")
        with Transaction(table.sparkSession, held[0].root) as run:
            run.write_months(held[1], table, rebalance=rebalance)
            run.commit()
            return run.filled(held[1]) if watch else None
    out = table.hint("rebalance", MONTH) if rebalance else table
    if watch:
        seen = Observation()
        out = out.observe(seen, F.collect_set(MONTH).alias("months"))
    writer = out.write.partitionBy(MONTH)
    if mode == "append":
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return set(seen.get["months"]) if watch else None
