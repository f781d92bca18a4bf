import datetime as dt
import math

import pytest
from helpers import one, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from landfall import functions as X


@pytest.mark.parametrize(
    "text, part",
    [
        ("US-PA", "PA"),
        ("  US-PA\t\n", "PA"),
        ("A-B-C", "C"),
        ("PA", "PA"),
        ("US-", ""),
        ("", ""),
        (None, None),
    ],
)
def test_last_part(spark, text, part):
    assert one(spark, X.last_part, text) == part


@pytest.mark.parametrize(
    "text, first, second",
    [
        ("-75.2, 39.9", -75.2, 39.9),
        ("  1,2 ", 1.0, 2.0),
        ("1e2,.5,9", 100.0, 0.5),
        ("7", 7.0, None),
        ("north, 3", None, 3.0),
        ("1.0d, nan", None, None),
        (",", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_pair_part(spark, text, first, second):
    assert one(spark, lambda c: X.pair_part(c, 1), text) == first
    assert one(spark, lambda c: X.pair_part(c, 2), text) == second


@pytest.mark.parametrize(
    "text, north, east",
    [
        ("42.59N", 42.59, -42.59),
        ("42.59S", -42.59, -42.59),
        ("83.2E", -83.2, 83.2),
        ("83.2W", -83.2, -83.2),
        (" 5N ", 5.0, -5.0),
        ("N", None, None),
        ("xxN", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_hemisphere_degrees(spark, text, north, east):
    assert one(spark, lambda c: X.hemisphere_degrees(c, "N"), text) == north
    assert one(spark, lambda c: X.hemisphere_degrees(c, "E"), text) == east


@pytest.mark.parametrize(
    "days, day",
    [
        (0.0, dt.date(1960, 1, 1)),
        (20574.0, dt.date(2016, 4, 30)),
        (20574.9, dt.date(2016, 4, 30)),
        (-0.9, dt.date(1960, 1, 1)),
        (-1.0, dt.date(1959, 12, 31)),
        (float((dt.date.max - dt.date(1960, 1, 1)).days), dt.date.max),
        (float((dt.date.max - dt.date(1960, 1, 1)).days + 1), None),
        (float((dt.date.min - dt.date(1960, 1, 1)).days), dt.date.min),
        (float((dt.date.min - dt.date(1960, 1, 1)).days - 1), None),
        (1e18, None),
        (math.nan, None),
        (math.inf, None),
        (None, None),
    ],
)
def test_days_to_date(spark, days, day):
    assert one(spark, X.days_to_date, days, "double") == day


@pytest.mark.parametrize(
    "text, day",
    [
        ("10292016", dt.date(2016, 10, 29)),
        ("02292016", dt.date(2016, 2, 29)),
        ("02302016", None),
        ("1012016", None),
        ("102920161", None),
        ("10292016\n", None),
        (" 1029201", None),
        ("015T2016", None),
        ("015 2016", None),
        ("+1012016", None),
        ("12319999", dt.date.max),
        ("01010000", None),
        ("D/S", None),
        ("", None),
        (None, None),
    ],
)
def test_text_to_date(spark, text, day):
    assert one(spark, X.text_to_date, text) == day


def test_month_keys(spark):
    for month in range(1, 13):
        day = dt.date(2016, month, 17)
        assert one(spark, X.month_key, day, "date") == X.month_key_of(day)
    assert X.month_key_of(dt.date(2016, 1, 1)) == "jan16"
    assert X.month_key_of(dt.date(2009, 12, 1)) == "dec09"
    assert one(spark, X.month_key, None, "date") is None
    assert X.months_between(dt.date(2015, 11, 30), dt.date(2016, 2, 1)) == ["nov15", "dec15", "jan16", "feb16"]


def test_surrogate_key_separates_look_alikes(spark):
    pairs = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("~", "c"), ("", "c"), ("a", None), ("a", "~"), ("ä", "c")]
    table = spark.createDataFrame(pairs, "a string, b string")
    keys = [r["k"] for r in table.select(X.surrogate_key(F.col("a"), F.col("b")).alias("k")).collect()]
    assert len(set(keys)) == len(pairs)
    assert all(0 <= k < 2**60 for k in keys)


def test_surrogate_key_ignores_partitioning(spark):
    table = spark.range(1000).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    keyed = [
        rows(t.withColumn("k", X.surrogate_key(F.col("a"), F.col("b"))))
        for t in (table.repartition(7), table.orderBy(F.desc("a")).coalesce(1))
    ]
    assert keyed[0] == keyed[1]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(), st.floats(-800000, 3000000)), min_size=1, max_size=50))
def test_days_to_date_follows_python(spark, values):
    def expected(x):
        try:
            return dt.date(1960, 1, 1) + dt.timedelta(days=int(x))
        except (TypeError, ValueError, OverflowError):
            return None

    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = table.select("i", X.days_to_date(F.col("x")).alias("d")).orderBy("i").collect()
    assert [r["d"] for r in got] == [expected(v) for v in values]


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.dates().map(lambda d: f"{d.month:02d}{d.day:02d}{d.year:04d}"),
            st.integers(0, 99999999).map(lambda n: f"{n:08d}"),
            st.text("0123456789/DS T-+\t.", min_size=8, max_size=8),
        ),
        min_size=1,
        max_size=50,
    )
)
def test_text_to_date_follows_python(spark, values):
    def expected(x):
        # Python also reads a blank and one digit as a day.
        if x is None or not x.isdigit():
            return None
        try:
            return dt.datetime.strptime(x, "%m%d%Y").date()
        except ValueError:
            return None

    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = table.select("i", X.text_to_date(F.col("x")).alias("d")).orderBy("i").collect()
    assert [r["d"] for r in got] == [expected(v) for v in values]
