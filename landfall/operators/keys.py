"""Surrogate keys that are kept, so that they stay unique and never change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from landfall.functions import key_text, text_key
from landfall.sources.scratch import scratch_path

TEXT, KEY = "__key_text", "__key"


def _probe(text: Column, place: int, bits: int) -> Column:
    """The key that a name asks for in its turn ``place``: that of its text, then of its text with a number."""
    return text_key(text if not place else F.concat(text, F.lit(f"#{place}")), bits)


def key_map(names: DataFrame, columns: Sequence[str], known: DataFrame | None = None, *, key: str = "id", bits: int = 60) -> DataFrame:
    """Every name of ``known`` and of ``names`` once, with a bigint key that no other has.

    ``known`` is an earlier result; its keys stay as they are, also those of names that ``names`` lacks. A new name takes the hash of its
    text. If that key is taken, or a lesser new name asks for it too, it asks for the next of its own row of hashes, until all have one. So
    the keys depend on the known ones and on which names are new, not on the order or the partitions of either. Usually
    one turn is enough: each is two joins and a grouping of the names that still have none. Null is a value like any other.
    """
    columns = list(columns)
    spark, wanted = names.sparkSession, [F.col(f"`{c}`") for c in columns]

    def stored(rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    text = key_text(*wanted).alias(TEXT)
    pending = names.select(*wanted, text).dropDuplicates([TEXT])
    if known is None:
        held = spark.createDataFrame([], StructType([*pending.schema.fields, StructField(KEY, LongType())]))
    else:
        held = known.select(*wanted, text, F.col(f"`{key}`").cast("bigint").alias(KEY))
        pending = pending.join(held.select(TEXT), TEXT, "left_anti").select(*columns, TEXT)
    pending = stored(pending, "new-names")
    left = pending.count()
    n_held = 0 if known is None else held.count()
    if n_held + left > 1 << bits:
        raise ValueError(f"{n_held + left} names do not fit in keys of {bits} bits")
    turn = 0
    while left:
        asked = pending.withColumn(KEY, _probe(F.col(TEXT), turn, bits)).join(held.select(KEY), KEY, "left_anti")
        first = asked.groupBy(KEY).agg(F.min_by(F.struct(*columns, TEXT), TEXT).alias("name"))
        given = stored(first.select("name.*", KEY), "new-keys")
        held = held.unionByName(given)
        left, turn = left - given.count(), turn + 1
        if left:
            pending = stored(pending.join(given.select(TEXT), TEXT, "left_anti").select(*columns, TEXT), "new-names")
    return held.select(*columns, F.col(KEY).alias(key))


def keyed(names: DataFrame, columns: Sequence[str], keys: DataFrame, key: str = "id") -> DataFrame:
    """``names`` with their key of a map that ``key_map`` gave for these or more; nulls in a name match."""
    held = keys.select(key_text(*[F.col(f"`{c}`") for c in columns]).alias(TEXT), F.col(f"`{key}`"))
    return names.withColumn(TEXT, key_text(*[F.col(f"`{c}`") for c in columns])).join(held, TEXT).drop(TEXT)
