"""Checks on finished tables, as reports with one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.joins import DEFAULT, JoinPolicy, as_type, common_types

PASS, FAIL = "SUCCESS", "FAIL"
MONTH = "i94_dt"


class QualityError(RuntimeError):
    """A check failed."""


def _status(good: Column) -> Column:
    return F.when(good, PASS).otherwise(FAIL)


def _stack(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), reports)


def table_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns, rows and status of each table; one without either fails."""
    return _stack(
        [
            table.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table"),
                F.lit(len(table.columns)).alias("n_cols"),
                "n_rows",
                _status((F.col("n_rows") > 0) & F.lit(len(table.columns) > 0)).alias("status"),
            )
            for name, table in tables.items()
        ]
    )


def month_report(
    tables: Mapping[str, DataFrame],
    months: Sequence[str],
    written: Mapping[str, set[str]] | None = None,
) -> DataFrame:
    """The same check for each of some months of month-partitioned tables.

    ``written`` gives, for some tables, the months that a run has just filled. Any
    other month fails even when the table still holds its rows from an earlier run.
    """
    reports = []
    for name, table in tables.items():
        fresh = [m for m in months if written is None or m in written.get(name, months)]
        asked = table.sparkSession.range(1).select(F.explode(F.array(*[F.lit(m) for m in months])).alias(MONTH))
        counts = table.filter(F.col(MONTH).isin(fresh)).groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"))
        n_rows = F.coalesce("n", F.lit(0)).cast("bigint")
        reports.append(
            asked.join(counts, MONTH, "left").select(
                F.lit(name).alias("table"),
                MONTH,
                F.lit(len(table.columns)).alias("n_cols"),
                n_rows.alias("n_rows"),
                _status(n_rows > 0).alias("status"),
            )
        )
    return _stack(reports)


def key_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, distinct keys and status of each table that a column should identify."""
    reports = []
    for name, (table, key) in tables.items():
        per_key = table.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        counts = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
            F.count(F.lit(1)).alias("n_keys"),
            F.count_if(F.col(key).isNull()).alias("n_null"),
        )
        good = (F.col("n_rows") == F.col("n_keys")) & (F.col("n_null") == 0)
        reports.append(
            counts.select(F.lit(name).alias("table"), "n_rows", "n_keys", _status(good).alias("status"))
        )
    return _stack(reports)


@dataclass(frozen=True)
class Reference:
    """Columns of a table that should name a row of another one, by its columns of the same or of ``parent_keys`` names."""

    name: str
    child: DataFrame
    keys: Sequence[str]
    parent: DataFrame
    parent_keys: Sequence[str] | None = None


def orphan_report(references: Sequence[Reference], *, policy: JoinPolicy = DEFAULT) -> DataFrame:
    """For each reference the rows, those with a null in the key, those whose key the parent lacks, such keys, and the status.

    Rows of both tables are counted by key together, so each is read and shuffled once, after it was counted in its own task: a key
    that holds much of a table weighs no more than another, and keys of the parent are few where they are few in number. So there is
    nothing to broadcast or to spread, whatever the ``policy``. A null refers to nothing and is no orphan. Keys of two types are compared as in a join.
    """
    reports = []
    for r in references:
        keys = [f"k{i}" for i in range(len(r.keys))]
        own = r.child.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(r.keys, keys)])
        there = r.parent.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(r.parent_keys or r.keys, keys)])
        types = common_types(own, there, keys)
        one = F.lit(1).cast("bigint")
        if types:
            # Keys of the child that are one in the common type are still as many keys.
            own = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        else:
            own = own.withColumn("n", one)
        complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])

        def read(table: DataFrame) -> list[Column]:
            return [as_type(F.col(k), table.schema[k].dataType, types[k]).alias(k) if k in types else F.col(k) for k in keys]

        full = F.when(complete, F.col("n")).otherwise(0)
        asked = own.select(*read(own), (F.col("n") - full).alias("n_null"), full.alias("n_full"), F.when(complete, 1).otherwise(0).cast("bigint").alias("n_keys"), F.lit(False).alias("there"))
        none = F.lit(0).cast("bigint")
        given = there.select(*read(there), none.alias("n_null"), none.alias("n_full"), none.alias("n_keys"), F.lit(True).alias("there"))
        met = asked.union(given).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n_null", "n_full", "n_keys")], F.max("there").alias("there"))
        # A key that the common type cannot hold is null here and equals nothing.
        lacking = ~(F.col("there") & complete)
        n_keys = F.col("n_keys") if types else F.when(F.col("n_keys") > 0, 1).otherwise(0)

        def total(n: Column) -> Column:
            return F.coalesce(F.sum(n), F.lit(0)).cast("bigint")

        counts = met.agg(
            total(F.col("n_null") + F.col("n_full")).alias("n_rows"),
            total(F.col("n_null")).alias("n_null"),
            total(F.when(lacking, F.col("n_full"))).alias("n_orphans"),
            total(F.when(lacking, n_keys)).alias("n_orphan_keys"),
        )
        reports.append(counts.select(F.lit(r.name).alias("reference"), "*", _status(F.col("n_orphans") == 0).alias("status")))
    return _stack(reports)


def differing_report(table: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """For each value column, how many keys there are and on how many of them the rows disagree.

    Meant for tables that repeat a key's figures on several rows, before one row per key is made of them.
    A null beside a value is a difference.
    """
    counts = []
    for i, v in enumerate(values):
        column = F.col(f"`{v}`")
        counts.append(((F.min(column) != F.max(column)) | ((F.count(column) > 0) & (F.count(column) < F.count(F.lit(1))))).alias(f"d{i}"))
    per_key = table.groupBy(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).agg(*counts)
    totals = per_key.agg(F.count(F.lit(1)).alias("n_keys"), *[F.count_if(f"d{i}").alias(f"d{i}") for i in range(len(values))])
    rows = F.explode(F.array(*[F.struct(F.lit(v).alias("column"), F.col(f"d{i}").alias("n_differing")) for i, v in enumerate(values)]))
    return totals.select("n_keys", rows.alias("r")).select("r.column", "n_keys", "r.n_differing", _status(F.col("r.n_differing") == 0).alias("status"))


def require_pass(report: DataFrame) -> DataFrame:
    """Stop with an error that names the failed checks; otherwise give the report.

    The checks run once: what comes back is a table of the rows found.
    """
    found = collected(report)
    failed = [row for row in found.collect() if row["status"] == FAIL]
    if failed:
        raise QualityError("; ".join(str(row.asDict()) for row in failed))
    return found


def collected(report: DataFrame) -> DataFrame:
    """The report as a local table, so that reading it again counts nothing again."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)
