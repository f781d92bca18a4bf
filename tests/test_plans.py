"""The plans the builders should get: pruned scans, pushed filters, no Python, few shuffles."""

import feeds
import pytest
from helpers import plan
from pyspark.sql import functions as F

from landfall import plans as P
from landfall import sources as S
from landfall.operators import JoinPolicy


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("plans")
    raw = feeds.file_raw(spark, root / "raw")
    layout = S.LakeLayout(str(root / "lake"))
    P.refresh_dimensions(spark, raw, layout)
    P.backfill(spark, raw, layout, ["jan16", "feb16"])
    return raw, layout


def mart(spark, layout, policy=JoinPolicy()):
    def table(name):
        return S.read_table(spark, layout.path(name))

    return P.immigration_demographic(
        S.read_months(spark, layout.path("immigrant"), "jan16"),
        S.read_months(spark, layout.path("immigration"), "jan16"),
        table("country_code"),
        table("state_code"),
        table("city"),
        table("us_cities_demographics"),
        policy=policy,
    )


def test_facts_are_plain_projections(spark, lake):
    raw, _ = lake
    arrivals = S.read_arrivals(spark, raw.path("arrivals"), ["jan16", "feb16"])
    for build in (P.immigrant, P.immigration):
        text = plan(build(arrivals, F.col("i94_dt")))
        assert "Exchange" not in text and "Python" not in text
    scan = plan(P.immigrant(arrivals, F.col("i94_dt")))
    assert "i94res" in scan and "arrdate" not in scan and "fltno" not in scan


def test_mart_reads_narrow_and_shuffles_the_facts_once(spark, lake):
    _, layout = lake
    text = plan(mart(spark, layout))
    assert "Python" not in text
    assert text.count("PartitionFilters: [isnotnull(i94_dt") == 2
    assert "visa_type" not in text and "arrival_date" not in text and "num_veterans" not in text
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = plan(mart(spark, layout, JoinPolicy(broadcast_rows=3)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    exchanges = [line for line in shuffled.splitlines() if "Exchange hashpartitioning(cicid" in line]
    assert len(exchanges) == 2


def test_single_filter_reaches_the_scan(spark, lake):
    _, layout = lake
    airports = S.read_table(spark, layout.path("airport_code"))
    weather = P.airport_weather(
        airports,
        S.read_table(spark, layout.path("city")),
        S.read_table(spark, layout.path("state_code")),
        S.read_table(spark, layout.path("us_cities_temperatures")),
    )
    text = plan(weather)
    assert "PushedFilters: [IsNotNull(city_id)" in text
    assert "airport_latitude" not in text


def test_temperatures_filter_before_the_join(spark, lake, tmp_path):
    _, layout = lake
    feeds.temperatures(spark).write.parquet(str(tmp_path / "t"))
    city = S.read_table(spark, layout.path("city"))
    text = plan(P.city_temperatures(S.read_table(spark, str(tmp_path / "t")), city))
    assert "GreaterThan(dt,2013-08-01)" in text
    assert "EqualTo(Country,United States)" in text
    assert "IsNotNull(AverageTemperature)" in text
    assert "Latitude" not in text
