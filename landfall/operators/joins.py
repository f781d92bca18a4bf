"""Equi-joins that stay whole and even when one key holds much of the data.

A dimension is broadcast only after its rows and bytes were counted. Beyond that bound, and for facts,
the join is shuffled. Where AQE splits skewed partitions the rest is left to it, but for the right side of a left join, which it
never splits. There, and on both sides where it is off, keys that
hold a large share of a side are found first, and their rows are spread over as many tasks as they
would fill, while the rows of the other side are repeated once per task, within a bound on all copies.
Where keys are hot on both sides, their rows meet in blocks, so that the result is small in columnar files.

Keys of different types are brought to one type before any of this, so the way taken never decides which
keys are equal. No row is dropped or limited on any path.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegerType,
    IntegralType,
    LongType,
    MapType,
    StringType,
    StructType,
)

from landfall.functions import key_text

LEFT_SALT, RIGHT_SALT, MATCHED, NAMED = "__left_salt", "__right_salt", "__matched", "__key_name"
BUCKETS = 4096
BLOCK = 128


@dataclass(frozen=True)
class JoinPolicy:
    """When to broadcast, and which keys to spread.

    ``hot_share`` is the share of a side's rows that makes a key hot, which also
    bounds the number of hot keys by its inverse. By default it is a few times the
    size of an average shuffle partition. A hot key is spread over as many tasks as its rows
    would fill average partitions; for all hot keys of a side together the other side's rows are
    repeated at most ``copies`` times the number of rows that are spread. ``spread`` is whether to
    spread at all, by default only where AQE does not split skewed joins.
    """

    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 32 * 1024 * 1024
    hot_share: float | None = None
    copies: float = 1.0
    spread: bool | None = None

    def allows(self, right: Profile) -> bool:
        """Whether a table may be broadcast."""
        return right.size is not None and right.rows <= self.broadcast_rows and right.size <= self.broadcast_bytes

    def share(self, table: DataFrame) -> float:
        return self.hot_share or min(0.05, max(0.001, 4 / _partitions(table)))

    def spreads(self, table: DataFrame) -> bool:
        if self.spread is not None:
            return self.spread
        names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
        return not all(table.sparkSession.conf.get(name) == "true" for name in names)


DEFAULT = JoinPolicy()


def _partitions(table: DataFrame) -> int:
    return int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def attach_lookup(
    left: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    policy: JoinPolicy = DEFAULT,
    spread: Sequence[str] = ("left",),
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join a table that is normally small, such as a dimension.

    ``spread`` names the sides that may have hot keys; a side with one row per key
    has none. ``keys_from`` is a cheaper table with the key distribution of ``left``,
    such as the scan it was joined from.
    """
    return _joined(left, lookup, keys, how, policy, spread, keys_from, small=True)


def join_facts(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    *,
    policy: JoinPolicy = DEFAULT,
    unique: bool = False,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join two tables that both grow with the data, either of which may have hot keys.

    Neither side is counted for a broadcast, which would read a fact once more. ``unique``
    says that the keys identify the rows of both sides, so that none can be hot.
    """
    return _joined(left, right, keys, how, policy, () if unique else ("left", "right"), keys_from, small=False)


def _joined(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    policy: JoinPolicy,
    spread: Sequence[str],
    keys_from: DataFrame | None,
    small: bool,
) -> DataFrame:
    if how not in ("inner", "left"):
        raise ValueError(f"unknown join {how!r}")
    columns = [*keys, *[c for c in [*left.columns, *right.columns] if c not in keys]]
    types = common_types(left, right, keys)
    if types:
        named = {k: f"__key_{k}" for k in types}
        source = left if keys_from is None else keys_from

        def read(table: DataFrame) -> DataFrame:
            return table.withColumns({named[k]: as_type(F.col(f"`{k}`"), table.schema[k].dataType, t) for k, t in types.items()})

        left, right, keys_from = read(left), read(right).drop(*types), read(source)
        keys = [named.get(k, k) for k in keys]
    keys = list(keys)
    if small and policy.allows(profile(right, widths=True)):
        return left.join(F.broadcast(right), keys, how).select(*columns)
    if not (spread and policy.spreads(left)):
        if how == "left" and "right" in spread and policy.spread is None:
            frequent = frequent_keys(right, keys, policy.share(left))
            if frequent:
                named_left, named_right = (t.withColumn(NAMED, _named(t, keys)) for t in (left, right))
                return _spread_join(named_left, named_right, keys, how, HotKeys((NAMED,)), frequent, policy).select(*columns)
        return left.join(right, keys, how).select(*columns)
    share, none = policy.share(left), HotKeys(tuple(keys))
    hot_left = hot_keys(left if keys_from is None else keys_from, keys, share) if "left" in spread else none
    hot_right = hot_keys(right, keys, share) if "right" in spread else none
    return _spread_join(left, right, keys, how, hot_left, hot_right, policy).select(*columns)


def common_types(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> dict[str, DataType]:
    """The one type to compare each key in whose types differ.

    Text is read as the type of the other side, and equals nothing where it cannot be read; beside a decimal, as one of 38 digits
    that has all those of the other side before the point. Whole numbers and floating ones meet as whole numbers, so that no two of them are taken
    for one; a fraction equals none. Other types meet in what Spark takes both to, a decimal and a floating number
    as the latter; types that have nothing in common raise ``ValueError``.
    """
    found = {}
    for key in keys:
        a, b = left.schema[key].dataType, right.schema[key].dataType
        if a == b:
            continue
        text = [t for t in (a, b) if isinstance(t, StringType)]
        other = b if text and text[0] is a else a
        if len(text) == 2:
            found[key] = StringType()
        elif text and isinstance(other, (ArrayType, MapType, StructType, BinaryType)):
            raise ValueError(f"key {key!r} cannot be compared as {a.simpleString()} and {b.simpleString()}")
        elif text:
            if isinstance(other, DecimalType):
                found[key] = DecimalType(38, 38 - other.precision + other.scale)
            elif isinstance(other, IntegralType):
                found[key] = LongType()
            else:
                found[key] = DoubleType() if isinstance(other, FractionalType) else other
        elif {isinstance(a, IntegralType), isinstance(b, IntegralType)} == {True, False} and isinstance(b if isinstance(a, IntegralType) else a, (DoubleType, FloatType)):
            found[key] = LongType()
        elif isinstance(a, BooleanType) or isinstance(b, BooleanType):
            raise ValueError(f"key {key!r} cannot be compared as {a.simpleString()} and {b.simpleString()}")
        else:
            empty = left.sparkSession.range(0)
            try:
                found[key] = empty.select(F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("k")).schema["k"].dataType
            except AnalysisException:
                raise ValueError(f"key {key!r} cannot be compared as {a.simpleString()} and {b.simpleString()}") from None
    return found


def as_type(column: Column, own: DataType, wanted: DataType) -> Column:
    """A key column as the type to compare it in; null where it has no such value."""
    read = column.try_cast(wanted)
    if isinstance(own, (DoubleType, FloatType)) and isinstance(wanted, LongType):
        return F.when(column == F.floor(column), read)
    return read


def decode(
    facts: DataFrame,
    codes: DataFrame,
    key: str,
    labels: dict[str, str] | None = None,
    *,
    code: str = "code",
    policy: JoinPolicy = DEFAULT,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Attach the labels of a code table by ``key``; unknown codes get null labels.

    ``labels`` renames label columns, by default they keep their names.
    """
    named = codes.withColumnsRenamed({code: key, **(labels or {})})
    return attach_lookup(facts, named, [key], "left", policy=policy, keys_from=keys_from)


@dataclass(frozen=True)
class Profile:
    """Rows and bytes of a table, and its rows per bucket of key hashes."""

    rows: int
    size: int | None
    nulls: int
    buckets: dict[int, int]


def profile(table: DataFrame, keys: Sequence[str] = (), *, widths: bool = False) -> Profile:
    """Count a table in one pass that ships a row per bucket and task, and no key."""
    width = _width(table) if widths else None
    counts = [F.count(F.lit(1)).alias("n"), F.sum(F.lit(0) if width is None else width).alias("size")]
    if keys:
        found = table.groupBy(_bucket(keys).alias("bucket")).agg(*counts).collect()
    else:
        found = table.agg(*counts, F.lit(None).alias("bucket")).collect()
    return Profile(
        rows=sum(r["n"] for r in found),
        size=None if width is None else sum(r["size"] or 0 for r in found),
        nulls=sum(r["n"] for r in found if keys and r["bucket"] is None),
        buckets={r["bucket"]: r["n"] for r in found if r["bucket"] is not None},
    )


def _bucket(keys: Sequence[str]) -> Column:
    return F.when(_complete(keys), F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)))


def _width(table: DataFrame) -> Column | None:
    """The bytes of a row, or nothing for a table with nested columns."""
    width = F.lit(0).cast("bigint")
    for column in table.schema.fields:
        if isinstance(column.dataType, (ArrayType, MapType, StructType)):
            return None
        width += 8
        if isinstance(column.dataType, (StringType, BinaryType)):
            width += F.coalesce(F.octet_length(F.col(f"`{column.name}`")), F.lit(0))
    return width


@dataclass(frozen=True)
class HotKeys:
    """Keys with very many rows and how many, the rows of the side, and whether its null keys are many."""

    keys: tuple[str, ...]
    values: dict[tuple, int] = field(default_factory=dict)
    rows: int = 0
    nulls: bool = False

    def __bool__(self) -> bool:
        return bool(self.values)


def hot_keys(table: DataFrame, keys: Sequence[str], share: float) -> HotKeys:
    """The keys that hold more than ``share`` of the rows, at most ``1 / share`` of them.

    A hot key makes its bucket of key hashes hot, so the keys themselves are counted
    in such buckets only, and in the usual case not at all.
    """
    keys = tuple(keys)
    narrow = table.select(*keys)
    counted = profile(narrow, keys)
    bar = share * counted.rows
    buckets = [b for b, n in counted.buckets.items() if n > bar]
    values = {}
    if buckets:
        per_key = narrow.filter(_bucket(keys).isin(buckets)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        values = {tuple(r[k] for k in keys): r["n"] for r in per_key.filter(F.col("n") > bar).collect()}
    return HotKeys(keys, values, counted.rows, counted.nulls > bar)


def _named(table: DataFrame, keys: Sequence[str]) -> Column:
    """Complete keys as one text, by which equal keys are equal; null for others."""
    parts = []
    for key in keys:
        column, kind = F.col(f"`{key}`"), table.schema[key].dataType
        # Both zeros are one key.
        parts.append(column + F.lit(0.0).cast(kind) if isinstance(kind, (DoubleType, FloatType)) else F.hex(column) if isinstance(kind, BinaryType) else column)
    return F.when(_complete(keys), key_text(*parts))


def frequent_keys(table: DataFrame, keys: Sequence[str], share: float) -> HotKeys:
    """The keys that hold more than ``share`` of the rows, as texts, with estimates of their rows, in one pass.

    Every task summarises its keys in a table of bounded size, which loses count of a key only as far as the other keys crowd it out,
    and such tables merge. They hold eight times as many keys as can be frequent, so none of these is missed, and none is
    named that the table does not have.
    """
    limit = math.ceil(1 / share)
    complete = table.select(_named(table, keys).alias(NAMED))
    found = complete.agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k({NAMED}, {limit}, {min(1_000_000, 8 * limit)}) filter (where {NAMED} is not null)").alias("top"),
    ).first()
    return HotKeys((NAMED,), {(top["item"],): top["count"] for top in found["top"] or () if top["count"] > share * found["rows"]}, found["rows"])


def _complete(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def _salt(table: DataFrame, salts: Column) -> Column:
    # A function of the row and its partition, so a task that runs again sends its
    # rows to the same places, and copies of one row in several partitions part ways.
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in table.columns], F.spark_partition_id()), salts).cast("int")


def salts(hot: HotKeys, other: dict[tuple, int], partitions: int, copies: float) -> dict[tuple, int]:
    """Over how many tasks to spread each hot key, given the rows of the other side with that key.

    The copies of the other side's rows stay within ``copies`` times the rows that are spread.
    """
    wanted = {k: max(2, math.ceil(n * partitions / max(1, hot.rows))) for k, n in hot.values.items()}
    cost = sum((w - 1) * other.get(k, 0) for k, w in wanted.items())
    part = min(1.0, copies * sum(hot.values.values()) / cost) if cost else 1.0
    return {k: 1 + math.floor((w - 1) * part) for k, w in wanted.items()}


def _matching(table: DataFrame, hot: HotKeys) -> dict[tuple, int]:
    """The rows of a table for each hot key of the other side."""
    keys = list(hot.keys)
    found = table.select(*keys).join(F.broadcast(_small(table, hot, {k: 1 for k in hot.values}, "n")), keys, "left_semi")
    return {tuple(r[k] for k in keys): r["count"] for r in found.groupBy(*keys).count().collect()}


def _small(table: DataFrame, hot: HotKeys, numbers: dict[tuple, int], name: str) -> DataFrame:
    """A table of hot keys, at most one for each ``1 / share``, with a number each."""
    schema = StructType([table.schema[k] for k in hot.keys]).add(name, IntegerType())
    return table.sparkSession.createDataFrame([(*k, n) for k, n in numbers.items()], schema)


def _multiplies(hot_left: HotKeys, hot_right: HotKeys) -> bool:
    """Whether the keys that are hot on both sides make more rows than both sides have."""
    return sum(n * hot_right.values.get(k, 0) for k, n in hot_left.values.items()) > hot_left.rows + hot_right.rows


def _blocks(table: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str) -> DataFrame:
    """The rows of each key in arrays of at most ``BLOCK`` rows, which hold ``columns``."""
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0)))
    numbered = table.withColumn("__block", F.floor((number - 1) / BLOCK))
    rows = F.collect_list(F.struct(*[F.col(f"`{c}`") for c in columns]))
    return numbered.groupBy(*keys, "__block").agg(rows.alias(name)).drop("__block")


def _join_blocks(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join that meets a block of left rows with one block of right rows after the other.

    A plain join goes through all partners of each row, so a column of the right side comes back to a value only after all others of
    the key, and a page of a columnar file finds nothing to compress in it. Here some ten thousand rows in
    succession have few values of either side. Left keys are taken from the rows, as grouping makes equal ones the same.
    """
    others = [c for c in right.columns if c not in on]
    marked = right.withColumn("__row", F.lit(True))
    met = _blocks(left, on, left.columns, "__left").join(_blocks(marked, on, [*others, "__row"], "__right"), on, how)
    return met.select("__right", F.inline("__left")).select(*[F.col(f"`{c}`") for c in left.columns], F.inline_outer("__right")).drop("__row")


def _spread_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, hot_left: HotKeys, hot_right: HotKeys, policy: JoinPolicy
) -> DataFrame:
    scattered = hot_left.nulls and how == "left"
    if not (hot_left or hot_right or scattered):
        return left.join(right, keys, how)
    on, partitions, a, b = list(keys), _partitions(left), left, right
    if NAMED in hot_right.keys:
        on.append(NAMED)

    def dealt(table: DataFrame, hot: HotKeys, found: dict[tuple, int], salt: str) -> DataFrame:
        marked = table.join(F.broadcast(_small(table, hot, found, "__n")), list(hot.keys), "left")
        return marked.withColumn(salt, F.coalesce(_salt(table, F.col("__n")), F.lit(0))).drop("__n")

    def repeated(table: DataFrame, hot: HotKeys, found: dict[tuple, int], salt: str) -> DataFrame:
        marked = table.join(F.broadcast(_small(table, hot, found, "__n")), list(hot.keys), "left")
        return marked.withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce("__n", F.lit(1)) - 1))).drop("__n")

    if hot_left or scattered:
        found = salts(hot_left, _matching(right, hot_left) if hot_left else {}, partitions, policy.copies)
        a, b = dealt(a, hot_left, found, LEFT_SALT), repeated(b, hot_left, found, LEFT_SALT)
        if scattered:
            # Null keys meet nothing, so they may go anywhere.
            anywhere = _salt(left, F.lit(partitions))
            a = a.withColumn(LEFT_SALT, F.when(_complete(keys), F.col(LEFT_SALT)).otherwise(anywhere))
        on.append(LEFT_SALT)

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        if NAMED in on:
            return a.join(b, on, how)
        # Few bytes may make very many rows here, so AQE must not put the tasks together by their bytes.
        a, b = a.repartition(partitions, *on), b.repartition(partitions, *on)
        return _join_blocks(a, b, on, how) if _multiplies(hot_left, hot_right) else a.join(b, on, how)

    found = salts(hot_right, _matching(left, hot_right), partitions, policy.copies) if hot_right else {}
    if all(n == 1 for n in found.values()):
        return met(a, b)
    b, a = dealt(b, hot_right, found, RIGHT_SALT), repeated(a, hot_right, found, RIGHT_SALT)
    on.append(RIGHT_SALT)
    if how == "inner":
        return met(a, b)
    # A hot key of the right side has partners, so a repeated left row that met none
    # under its own salt is no result of its own.
    many = a.join(F.broadcast(_small(left, hot_right, found, "__n")), list(hot_right.keys), "left").withColumn("__n", F.coalesce("__n", F.lit(1)))
    return met(many, b.withColumn(MATCHED, F.lit(True))).filter(F.col(MATCHED).isNotNull() | (F.col("__n") == 1))
