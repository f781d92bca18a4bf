"""What several operators share."""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.sources.scratch import scratch_path

# The characters that part words, and the letters that are folded.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The most rows and bytes of a table that is broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8 << 20
#: The most bytes of a batch of rows that a Python worker gets, but for a single row.
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
#: How many tasks a key of the larger side is spread over where the table is too large for that.
SALTS = 16
#: A key that holds more than one in so many rows of a table is hot, so there are fewer hot keys than this.
HOT_KEYS = 4096


def prepared(spark: SparkSession) -> None:
    """Readies a session for the operators that work in Python.

    Workers may import this package from where the driver did, if they see that folder, and get rows in batches
    of bounded size unless the session says otherwise, so that long texts do not fill their memory.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written once to the shared folder and read back, so that no later step computes them again."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fresh(rows: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``rows`` does not have."""
    taken, out = {c.lower() for c in rows.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def trimmed(text: Column) -> Column:
    """``text`` without white space at both ends."""
    return F.trim(text, F.lit(WHITE))


def n_words(text: Column) -> Column:
    """The number of words of a text; none in a null."""
    inner = trimmed(text)
    words = F.size(F.split(inner, r"[\x20\x09-\x0D]+")).cast("bigint")
    return F.when(F.coalesce(inner, F.lit("")) == "", F.lit(0).cast("bigint")).otherwise(words)


def attach(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], spread: str) -> DataFrame:
    """A left join with a stored table that has one row per combination of ``keys``; null equals null.

    The table is broadcast if its counted rows and bytes are within the bounds above. Otherwise
    every row of it is repeated ``SALTS`` times and the rows of a key are dealt by ``spread``, so
    that a key with a third of all rows is shared by that many tasks, and each of these can still
    be split by AQE. Both ways give the same rows.
    """
    width = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(F.col(quoted(k)).cast("string")), F.lit(0)) for k in keys])
    bound = lookup.agg(F.count(F.lit(1)).alias("n"), F.sum(width + 16 * len(lookup.columns)).alias("b")).first()
    named = lookup.withColumnsRenamed({k: f"__{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(quoted(k)).eqNullSafe(F.col(quoted(f"__{k}"))) for k in keys])
    drop = [f"__{k}" for k in keys]
    if bound["n"] <= BROADCAST_ROWS and (bound["b"] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(named), on, "left").drop(*drop)
    every = named.withColumn("__salt_b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("__salt_a", F.pmod(F.xxhash64(F.col(quoted(spread))), F.lit(SALTS)).cast("int"))
    return dealt.join(every, on & (F.col("__salt_a") == F.col("__salt_b")), "left").drop(*drop, "__salt_a", "__salt_b")


def join_counted(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], held: str, total: int) -> DataFrame:
    """An inner join of two stored tables. ``lookup`` has one row per combination of ``keys``, and in ``held`` how many of
    the ``total`` rows of ``rows`` have it; null equals no key.

    Hot keys would make a shuffle by key uneven, so their rows stay where they are and get the few hot rows of
    ``lookup`` by broadcast. All other rows are shuffled.
    """
    hot = F.col(held) * HOT_KEYS > total
    many = F.broadcast(lookup.filter(hot))
    rest = rows.join(many.select(*keys), list(keys), "left_anti").join(lookup.filter(~hot), list(keys))
    return rows.join(many, list(keys)).unionByName(rest)
