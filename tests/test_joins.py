"""All join paths must give the rows of a plain join."""

import uuid

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from landfall.operators import JoinPolicy, attach_lookup, decode, join_facts
from landfall.operators.joins import LEFT_SALT, RIGHT_SALT, HotKeys, frequent_keys, hot_keys, profile, salts

SHUFFLED = JoinPolicy(broadcast_rows=0, hot_share=0.05, spread=True, copies=1e9)


def sides(spark, left_hot, right_hot, nulls=False):
    """Two tables that share some keys; key 7 may hold a third of either."""
    n = F.col("id")

    def key(hot, cold):
        k = F.when(n % 3 == 0, F.lit(7)).otherwise(cold) if hot else cold
        return F.when(n % 3 == 1, None).otherwise(k) if nulls else k

    left = spark.range(3000).select(key(left_hot, n % 997).alias("k"), F.lit("x").alias("s"), n.alias("a"))
    right = spark.range(300).select(
        key(right_hot, n * 5 % 1201).alias("k"), F.lit("x").alias("s"), (-n).alias("b")
    )
    return left, right


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("left_hot", [False, True])
@pytest.mark.parametrize("right_hot", [False, True])
@pytest.mark.parametrize("nulls", [False, True])
def test_spread_join_is_a_plain_join(spark, how, left_hot, right_hot, nulls):
    left, right = sides(spark, left_hot, right_hot, nulls)
    got = join_facts(left, right, ["k", "s"], how, policy=SHUFFLED)
    want = left.join(right, ["k", "s"], how)
    assert got.columns == want.columns
    assert rows(got) == rows(want)
    assert (LEFT_SALT in plan(got)) == (left_hot or (nulls and how == "left"))
    assert (RIGHT_SALT in plan(got)) == right_hot


def test_hot_right_key_without_left_rows(spark):
    left, right = sides(spark, False, True)
    left = left.filter("k <> 7")
    for how in ("left", "inner"):
        assert rows(join_facts(left, right, ["k", "s"], how, policy=SHUFFLED)) == rows(
            left.join(right, ["k", "s"], how)
        )


def test_hot_key_goes_to_several_tasks(spark):
    left, right = sides(spark, True, False)
    policy = JoinPolicy(broadcast_rows=0, hot_share=0.05, spread=True)
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    off["spark.sql.shuffle.partitions"] = "32"
    kept = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)

        def largest(table):
            return (
                table.filter("k = 7")
                .groupBy(F.spark_partition_id().alias("task"))
                .count()
                .agg(F.max("count"))
                .first()[0]
            )

        on = ["k", "s"]
        plain = largest(left.join(right, on, "left"))
        spread = largest(join_facts(left, right, on, "left", policy=policy))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert spread * 3 < plain


def test_copies_of_one_row_part_ways(spark):
    left = spark.range(0, 8000, 1, 8).select(F.lit(7).alias("k"))
    right = spark.createDataFrame([(7, "seven"), (8, "eight")], "k int, name string")
    got = join_facts(left, right, ["k"], "left", policy=SHUFFLED)
    assert LEFT_SALT in plan(got)
    assert rows(got) == {(7, "seven"): 8000}


def test_hot_keys_are_exact(spark):
    left, _ = sides(spark, True, False)
    found = hot_keys(left, ["k", "s"], 0.05)
    assert found.values == {(7, "x"): 1003} and found.rows == 3000 and not found.nulls
    assert not hot_keys(spark.range(5000).withColumn("s", F.lit("x")), ["id", "s"], 0.01)
    assert hot_keys(sides(spark, False, False, True)[0], ["k"], 0.05).nulls
    assert not hot_keys(spark.range(0), ["id"], 0.01)


def test_broadcast_only_within_the_bound(spark):
    def allowed(table, **bounds):
        return JoinPolicy(**bounds).allows(profile(table, widths=True))

    table = spark.range(100).withColumn("text", F.lit("x" * 100))
    assert allowed(table, broadcast_rows=100, broadcast_bytes=12000)
    assert not allowed(table, broadcast_rows=99)
    assert not allowed(table, broadcast_bytes=11000)
    assert not allowed(table.withColumn("many", F.array("id")))
    assert allowed(table.limit(0))
    by_key = profile(table, ["id"], widths=True)
    assert (by_key.rows, by_key.size, by_key.nulls) == (100, 11600, 0)
    assert sum(by_key.buckets.values()) == 100


def test_small_lookup_is_broadcast(spark):
    left, right = sides(spark, True, False)
    assert "BroadcastHashJoin" in plan(attach_lookup(left, right, ["k", "s"]))
    assert "_salt" not in plan(join_facts(left, right, ["k", "s"]))


def test_decode_keeps_unknown_codes(spark):
    facts = spark.createDataFrame([(1, "PA"), (2, "ZZ"), (3, None)], "id int, state_code string")
    codes = spark.createDataFrame([("PA", "Pennsylvania"), ("99", "other")], "code string, label string")
    want = {("PA", 1, "Pennsylvania"): 1, ("ZZ", 2, None): 1, (None, 3, None): 1}
    assert rows(decode(facts, codes, "state_code", {"label": "state"})) == want
    assert rows(decode(facts, codes, "state_code", policy=SHUFFLED)) == want


def test_keys_from_another_table(spark):
    left, right = sides(spark, True, False)
    source = left.select("k", "s")
    got = attach_lookup(left, right, ["k", "s"], policy=SHUFFLED, keys_from=source)
    assert LEFT_SALT in plan(got)
    assert rows(got) == rows(left.join(right, ["k", "s"], "left"))


def test_other_joins_are_refused(spark):
    left, right = sides(spark, False, False)
    with pytest.raises(ValueError):
        join_facts(left, right, ["k"], "full", policy=SHUFFLED)


PAIRS = [
    ("string", "int", ["07", "7", "x", None], [7, 8, None]),
    ("string", "bigint", ["07", "7", "x", None], [7, 8, None]),
    ("int", "bigint", [7, 8, None], [7, 9, None]),
    ("float", "double", [0.5, 2.0, None], [0.5, 3.0, None]),
    ("date", "timestamp", ["2016-01-01", None], ["2016-01-01 00:00:00", "2016-01-01 01:00:00"]),
    ("string", "decimal(20,3)", ["07", "7.000", "7.0001", "x", None], [7, 8, None]),
    ("bigint", "double", [7, 9007199254740993, None], [7.0, 9007199254740992.0, 7.5, None]),
    ("int", "float", [7, 16777217, None], [7.0, 16777216.0, None]),
    ("bigint", "decimal(20,1)", [7, 9007199254740993, None], [7.0, "9007199254740992.5", None]),
    ("string", "date", ["2016-01-01", "x"], ["2016-01-01", "2016-01-02"]),
]


@pytest.mark.parametrize("a, b, lefts, rights", PAIRS + [(b, a, r, x) for a, b, x, r in PAIRS])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_keys_of_two_types_join_alike_on_every_path(spark, a, b, lefts, rights, how):
    many = lambda values, kind: spark.createDataFrame([(str(v) if v is not None else None,) for v in values], "k string").select(
        F.explode(F.array_repeat(F.coalesce("k", F.lit("-")), 40)).alias("k")
    ).select(F.nullif("k", F.lit("-")).cast(kind).alias("k"))
    left, right = many(lefts, a).withColumn("l", F.lit(1)), many(rights, b).withColumn("r", F.lit(2))
    found = [
        rows(attach_lookup(left, right, ["k"], how, policy=policy, spread=("left", "right")))
        for policy in (JoinPolicy(), JoinPolicy(broadcast_rows=0, spread=False), SHUFFLED)
    ]
    assert found[0] == found[1] == found[2]
    assert sum(n for row, n in found[0].items() if row[2] is not None) >= 40 * 40
    assert attach_lookup(left, right, ["k"], how).schema["k"].dataType == left.schema["k"].dataType


def test_keys_that_cannot_be_compared_are_refused(spark):
    left = spark.createDataFrame([(True,)], "k boolean")
    with pytest.raises(ValueError, match="'k'"):
        attach_lookup(left, spark.range(2).withColumnRenamed("id", "k"), ["k"])


def test_copies_stay_within_their_bound():
    hot = HotKeys(("k",), {(i,): 5000 for i in range(20)}, 100_000)
    other = {(i,): 100 for i in range(20)}
    free = salts(hot, other, 2000, 1e9)
    assert set(free.values()) == {100}
    bound = salts(hot, other, 2000, 1.0)
    assert sum((n - 1) * 100 for n in bound.values()) <= 100_000
    assert all(1 < n < 100 for n in bound.values())
    assert salts(hot, {}, 2000, 1.0) == free


def test_copied_rows_of_a_join_are_bounded(spark):
    left = spark.range(10_000).select((F.col("id") % 20).alias("k"), "id")
    right = spark.range(2000).select((F.col("id") % 20).alias("k"), F.col("id").alias("r"))
    got = join_facts(left, right, ["k"], "inner", policy=JoinPolicy(hot_share=0.04, spread=True))
    assert LEFT_SALT in plan(got)
    assert got.count() == 1_000_000 == left.join(right, "k").count()


def jobs_of(spark, build):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "passes before a join")
    try:
        table = build()
        return table, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_skew_is_left_to_adaptive_execution(spark):
    left, right = sides(spark, True, True)
    got, jobs = jobs_of(spark, lambda: join_facts(left, right, ["k", "s"], "inner"))
    assert jobs == 0
    assert rows(got) == rows(left.join(right, ["k", "s"]))
    assert jobs_of(spark, lambda: join_facts(left, right, ["k", "s"], "left", unique=True))[1] == 0


def hot_right(spark):
    """A right side with a third of its rows on one key and a tenth on another one; the left side has few rows of these."""
    n = F.col("id")
    key = F.when(n % 3 == 0, F.lit(-1)).when(n % 10 == 1, F.lit(-2)).when(n % 101 == 1, None).otherwise(n % 4000)
    right = spark.range(60_000).select(key.cast("string").alias("k"), n.cast("double").alias("r"))
    left = spark.range(5000).select(F.when(n < 1, F.lit(-1)).when(n < 3, F.lit(-2)).when(n < 40, None).otherwise(n + 1000).cast("string").alias("k"), n.alias("l"))
    return left, right


def test_hot_right_keys_of_a_left_join_are_spread_with_adaptive_execution_on(spark):
    left, right = hot_right(spark)
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold")
    kept = {name: spark.conf.get(name) for name in names}
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    spark.conf.set(names[0], "false")
    spark.conf.set(names[1], "-1")

    def tasks(table):
        return sorted(r["count"] for r in table.groupBy(F.spark_partition_id().alias("p")).count().collect())

    try:
        plain = left.join(right, ["k"], "left")
        got = join_facts(left, right, ["k"], "left")
        assert RIGHT_SALT in plan(got) and RIGHT_SALT not in plan(plain)
        assert rows(got) == rows(plain)
        even, uneven = tasks(got), tasks(plain)
        assert even[-1] <= 3 * even[len(even) // 2] < uneven[-1]
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


@pytest.mark.parametrize("kind", ["string", "double", "binary", "decimal(20,2)", "timestamp"])
def test_frequent_keys_are_found_in_one_pass(spark, kind):
    values = ["1", "-0.0", "2"] if kind == "double" else ["1", "1.50", "2"] if kind.startswith("decimal") else ["2020-01-01 00:00:01.5", "2020-01-01 00:00:01", "2020"] if kind == "timestamp" else ["a|b", "", "c"]
    hot = spark.range(5000).select(F.when(F.col("id") % 2 == 0, F.lit(values[0])).when(F.col("id") % 5 == 0, F.lit(values[1])).when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).cast("string").alias("t"))
    table = hot.select(F.col("t").try_cast(kind).alias("k"), F.lit(1).alias("s"))
    found, jobs = jobs_of(spark, lambda: frequent_keys(table, ["k", "s"], 0.05))
    assert jobs <= 2 and found.rows == 5000
    assert len(found.values) == 2
    assert sorted(found.values.values(), reverse=True) == pytest.approx([2500, 500], rel=0.02)
    assert frequent_keys(table.limit(0), ["k"], 0.05).values == {}


def test_whole_numbers_and_decimals_are_compared_exactly(spark):
    big = 9007199254740993
    left = spark.createDataFrame([(big,), (5,), (None,)], "k bigint")
    right = spark.createDataFrame([(9007199254740992.0, "near"), (5.0, "five"), (5.5, "more"), (float("nan"), "nan"), (1e300, "far")], "k double, r string")
    assert rows(attach_lookup(left, right, ["k"])) == {(big, None): 1, (5, "five"): 1, (None, None): 1}
    text = spark.createDataFrame([("12345678901234567891",), ("1.50",), ("007",), ("x",), ("123456789012345678901234567890123456789",)], "k string")
    exact = spark.sql("select cast(k as decimal(22,2)) as k, r from values ('12345678901234567892', 'next'), ('1.5', 'half'), ('7', 'seven') t(k, r)")
    for policy in (JoinPolicy(), SHUFFLED):
        assert {(r["k"], r["r"]) for r in attach_lookup(text, exact, ["k"], policy=policy).collect()} == {
            ("12345678901234567891", None), ("1.50", "half"), ("007", "seven"), ("x", None), ("123456789012345678901234567890123456789", None)
        }
        assert {r["k"] for r in attach_lookup(exact, text.withColumn("there", F.lit(1)), ["k"], "inner", policy=policy).select(F.col("r").alias("k")).collect()} == {"half", "seven"}


def test_tasks_of_hot_keys_are_not_put_together_again(spark):
    """Few bytes of hot keys on both sides make very many rows, so each unit stays a task of its own."""
    left = spark.range(4000).selectExpr("id % 5 as k", "id as a")
    right = spark.range(500).selectExpr("id % 5 as k", "id as b")
    joined = attach_lookup(left, right, ["k"], policy=JoinPolicy(broadcast_rows=0, hot_share=0.02, spread=True), spread=("left", "right"))
    sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in sizes) == 4000 * 100
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 4000 * 100 / 2


@pytest.mark.parametrize("how", ["left", "inner"])
def test_blocks_of_hot_keys_are_a_plain_join(spark, how):
    """Keys hot on both sides, of two zeros, nulls, copies of rows, more rows than a block and a side of keys alone."""
    policy = JoinPolicy(broadcast_rows=0, hot_share=0.05, spread=True)
    zeros = "case when id % 5 = 0 then null when id % 5 < 3 then 0D when id % 5 = 3 then -0D else id end"
    left = spark.range(1500).selectExpr(f"{zeros} as k", "id % 400 as a", "case when id % 2 = 0 then id end as c")
    right = spark.range(700).selectExpr(f"{zeros} as k", "'x' as s", "id % 90 as b")
    signed = F.col("k").cast("string").alias("k")
    for there in (right, right.select("k")):
        got, want = attach_lookup(left, there, ["k"], how, policy=policy, spread=("left", "right")), left.join(there, ["k"], how)
        assert "__right" in plan(got)
        assert got.schema.simpleString() == want.schema.simpleString()
        others = [F.col(f"`{c}`") for c in want.columns if c != "k"]
        assert rows(got.select(signed, *others).groupBy("k", *others).count()) == rows(want.select(signed, *others).groupBy("k", *others).count())


def test_many_rows_of_hot_keys_are_small_in_a_file(spark, tmp_path):
    """Rows come in blocks of few values of both sides, so that the pages of a columnar file compress."""
    left = spark.range(1000).selectExpr("id % 2 as k", "id as a")
    right = spark.range(10000).selectExpr("id % 2 as k", "id as b")
    policy = JoinPolicy(broadcast_rows=0, hot_share=0.02, spread=True)
    joined = attach_lookup(left, right, ["k"], policy=policy, spread=("left", "right"))
    joined.write.option("parquet.page.row.count.limit", 5000).parquet(str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1000 * 5000
    assert size < 0.4 * 1000 * 5000
