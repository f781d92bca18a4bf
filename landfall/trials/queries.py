"""One query per operator, source, sink, builder and run, over the test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from landfall import functions as X
from landfall import operators as O
from landfall import plans as P
from landfall import sources as S
from landfall.sources.feeds import read_csv
from landfall.sources.scratch import scratch_path
from landfall.trials import standins
from landfall.trials.standins import Star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The month that one-month queries read or repeat, and the threshold and country of
# the temperature filter.
MONTH = "jan96"
AFTER = dt.date(2000, 12, 31)
COUNTRY = "AMERICA"


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Star(spark, folder))
    return build


# Scalar expressions


@query
def surrogate_key(star: Star) -> DataFrame:
    pairs = star.customer.select("c_mktsegment", "c_nationkey").dropDuplicates()
    return pairs.withColumn("pair_id", X.surrogate_key(F.col("c_mktsegment"), F.col("c_nationkey")))


@query
def suffix(star: Star) -> DataFrame:
    region = F.concat(F.lit(" US-"), F.col("c_nationkey").cast("string"), F.lit(" "))
    return star.customer.select("c_custkey", X.last_part(region).alias("state_code"))


@query
def pair_split(star: Star) -> DataFrame:
    pair = F.col("coordinates")
    return standins.airports(star).select(
        "ident", X.pair_part(pair, 1).alias("first"), X.pair_part(pair, 2).alias("second")
    )


@query
def hemisphere_degrees(star: Star) -> DataFrame:
    return standins.temperatures(star).select(
        "dt",
        "City",
        "Country",
        X.hemisphere_degrees(F.col("Latitude"), "N").alias("latitude"),
        X.hemisphere_degrees(F.col("Longitude"), "E").alias("longitude"),
    )


@query
def epoch_days_to_date(star: Star) -> DataFrame:
    days = standins.order_days() + 0.9
    signed = F.when(F.col("o_orderstatus") == "F", days).when(F.col("o_orderstatus") == "O", -days)
    return star.orders.select("o_orderkey", X.days_to_date(signed).alias("day"))


@query
def text_to_date(star: Star) -> DataFrame:
    digits = F.date_format("o_orderdate", "MMddyyyy")
    text = (
        F.when(F.col("o_orderstatus") == "O", "D/S")
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("0230"), F.right(digits, F.lit(4))))
        .otherwise(digits)
    )
    return star.orders.select("o_orderkey", X.text_to_date(text).alias("day"))


@query
def month_key(star: Star) -> DataFrame:
    return star.orders.groupBy(X.month_key(F.col("o_orderdate")).alias("i94_dt")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def typed_projection(star: Star) -> DataFrame:
    return (
        star.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_tax")
        .withColumnsRenamed({"l_orderkey": "order_id", "l_returnflag": "flag", "l_absent": "absent"})
        .withColumns({"FLAG": F.lower("flag"), "percent": F.col("l_tax") * 100})
        .drop("l_tax", "l_absent")
        .select(
            "order_id",
            "l_linenumber",
            F.col("FLAG").alias("flag"),
            F.round("percent").try_cast("int").alias("percent"),
            F.col("l_quantity").try_cast("int").alias("quantity"),
            F.col("l_extendedprice").try_cast("bigint").alias("price"),
            F.lit("lines").alias("tag"),
        )
    )


@query
def filter_stack(star: Star) -> DataFrame:
    return star.orders.filter(
        (F.col("o_orderstatus") == "F")
        & (F.col("o_orderdate") > F.lit(dt.date(1996, 1, 1)))
        & F.col("o_totalprice").isNotNull()
    ).select("o_orderkey", "o_custkey", "o_totalprice")


# Sources and sinks


def _by_month(star: Star) -> DataFrame:
    return star.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", X.month_key(F.col("o_orderdate")).alias("i94_dt")
    )


def _month_counts(table: DataFrame) -> DataFrame:
    return table.groupBy("i94_dt").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def partition_scan(star: Star) -> DataFrame:
    path = scratch_path(star.spark, "orders_by_month")
    S.write_months(_by_month(star), path, rebalance=True)
    return S.read_months(star.spark, path, MONTH)


@query
def partition_rewrite(star: Star) -> DataFrame:
    path = scratch_path(star.spark, "orders_rewritten")
    orders = _by_month(star)
    S.write_months(orders, path, rebalance=True)
    S.write_months(orders, path, rebalance=True)
    S.write_months(orders.filter(F.col("i94_dt") == MONTH), path)
    return _month_counts(S.read_table(star.spark, path))


@query
def partition_append(star: Star) -> DataFrame:
    path = scratch_path(star.spark, "orders_appended")
    orders = _by_month(star)
    S.write_months(orders, path, mode="append", rebalance=True)
    S.write_months(orders.filter(F.col("i94_dt") == MONTH), path, mode="append")
    return _month_counts(S.read_table(star.spark, path))


@query
def full_refresh(star: Star) -> DataFrame:
    path = scratch_path(star.spark, "part")
    S.write_table(star.part, path)
    S.write_table(star.part, path)
    return S.read_table(star.spark, path)


def _through_csv(table: DataFrame, name: str, separator: str) -> DataFrame:
    path = scratch_path(table.sparkSession, name)
    table.write.option("header", True).option("sep", separator).csv(path)
    return read_csv(table.sparkSession, path, table.schema, separator)


@query
def csv_comma(star: Star) -> DataFrame:
    return _through_csv(star.customer, "customer", ",")


@query
def csv_semicolon(star: Star) -> DataFrame:
    return _through_csv(star.part, "part", ";")


@query
def format_source(star: Star) -> DataFrame:
    path = scratch_path(star.spark, "arrivals_orc")
    arrivals = standins.arrivals(star)
    months = sorted(r["i94_dt"] for r in arrivals.select("i94_dt").dropDuplicates().collect())
    arrivals.hint("rebalance", "i94_dt").write.partitionBy("i94_dt").orc(path)
    read = S.read_arrivals(star.spark, path + "/i94_dt={month}", months, "orc")
    return read.select(F.col("cicid").cast("bigint").alias("o_orderkey"), F.col("i94res").cast("bigint").alias("o_custkey"), "dtaddto", "i94addr", "i94_dt")


# Joins, grouping, set operations


def _towns(star: Star) -> DataFrame:
    """The distinct cities that have an airport."""
    return (
        standins.airports(star)
        .select(F.col("municipality").alias("city"), X.last_part(F.col("iso_region")).alias("state_code"))
        .dropDuplicates()
        .withColumn("has_airport", F.lit(True))
    )


def _households(star: Star) -> DataFrame:
    return star.customer.join(star.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", standins.city_name().alias("city"), F.col("n_name").alias("state_code")
    )


@query
def two_key_left(star: Star) -> DataFrame:
    return O.attach_lookup(_households(star), _towns(star), ["city", "state_code"])


@query
def two_key_inner(star: Star) -> DataFrame:
    return O.attach_lookup(_households(star), _towns(star), ["city", "state_code"], "inner")


@query
def fanout_left(star: Star) -> DataFrame:
    towns = _towns(star).select("city", F.col("state_code").alias("town_state"))
    return O.attach_lookup(_households(star), towns, ["city"], spread=("left", "right"))


@query
def code_lookup(star: Star) -> DataFrame:
    coded = star.customer.join(star.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(F.col("c_acctbal") < 0, "99").otherwise(F.col("n_name")).alias("state_code")
    )
    return O.decode(coded, standins.states(star), "state_code")


@query
def fact_fact(star: Star) -> DataFrame:
    raw = standins.arrivals(star)
    person = P.immigrant(raw, F.col("i94_dt")).select("cicid", "i94_dt", "age")
    left_again = raw.filter(F.col("depdate").isNotNull())
    trip = P.immigration(left_again, F.col("i94_dt")).select("cicid", "i94_dt", "state_code", "departure_date")
    return O.join_facts(person, trip, ["cicid", "i94_dt"], "left", unique=True)


@query
def union_distinct_by_name(star: Star) -> DataFrame:
    return O.distinct_union(
        star.supplier.select(F.col("s_name").alias("place"), F.col("s_nationkey").alias("nation")),
        star.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("place")),
    )


@query
def group_stats(star: Star) -> DataFrame:
    cents = F.round(F.col("c_acctbal") * 100)
    rows = star.customer.select(
        "c_nationkey", cents.alias("mean_cents"), cents.alias("sum_cents"), F.col("c_custkey").alias("sum_keys")
    )
    return O.group_stats(rows, ["c_nationkey"], ["mean_cents"], ["sum_cents", "sum_keys"])


@query
def per_key_then_group(star: Star) -> DataFrame:
    lines = star.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_quantity").alias("mean_quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("sum_cents"),
    )
    per_order = O.one_row_per(lines, ["o_orderkey"], ["mean_quantity", "sum_cents"])
    ranked = O.attach_lookup(
        per_order, star.orders.select("o_orderkey", "o_orderpriority"), ["o_orderkey"], "inner", spread=()
    )
    return O.group_stats(ranked, ["o_orderpriority"], ["mean_quantity"], ["sum_cents"])


@query
def key_left(star: Star) -> DataFrame:
    city = _city(star)
    sites = P.airport_dim(standins.airports(star), city).select("icao_code", "city_id")
    return O.attach_lookup(sites, city, ["city_id"])


@query
def key_inner(star: Star) -> DataFrame:
    city = _city(star)
    sites = P.airport_dim(standins.airports(star), city).select("icao_code", "city_id")
    weather = _stored(star, "temperatures", _temperatures(star, city))
    return O.join_facts(sites, weather, ["city_id"], "inner")


@query
def country_lookup(star: Star) -> DataFrame:
    person = P.immigrant(standins.arrivals(star), F.col("i94_dt")).select("cicid", "i94_dt", "from_country_code")
    solvent = star.customer.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("int").alias("code"), F.col("c_name").alias("country")
    )
    return O.decode(person, solvent, "from_country_code", {"country": "from_country"})


@query
def known_states(star: Star) -> DataFrame:
    trip = P.immigration(standins.arrivals(star), F.col("i94_dt")).select("cicid", "i94_dt", "state_code")
    return O.attach_lookup(trip, _profile(star), ["state_code"], "inner")


# Table builders


def _stored(star: Star, name: str, table: DataFrame) -> DataFrame:
    """A table that several later steps use, written once as in a real lake."""
    path = scratch_path(star.spark, name)
    S.write_table(table, path)
    return S.read_table(star.spark, path)


def _city(star: Star) -> DataFrame:
    return _stored(star, "city", P.city_dim(standins.airports(star), standins.demographics(star)))


def _demographics(star: Star, city: DataFrame) -> DataFrame:
    return _stored(star, "demographics", P.city_demographics(standins.demographics(star), city))


def _temperatures(star: Star, city: DataFrame, **options) -> DataFrame:
    return P.city_temperatures(standins.temperatures(star), city, after=AFTER, country=COUNTRY, **options)


@query
def city_dim(star: Star) -> DataFrame:
    return P.city_dim(standins.airports(star), standins.demographics(star))


@query
def code_table(star: Star) -> DataFrame:
    return P.code_table(standins.countries(star))


@query
def airport_dim(star: Star) -> DataFrame:
    return P.airport_dim(standins.airports(star), _city(star))


@query
def city_demographics(star: Star) -> DataFrame:
    return P.city_demographics(standins.demographics(star), _city(star))


@query
def city_temperatures(star: Star) -> DataFrame:
    return _temperatures(star, _city(star))


@query
def city_temperatures_flagged(star: Star) -> DataFrame:
    return _temperatures(star, _city(star), coordinates=True, flag_ambiguous=True)


@query
def airport_weather(star: Star) -> DataFrame:
    city = _city(star)
    return P.airport_weather(
        _stored(star, "airports", P.airport_dim(standins.airports(star), city)),
        city,
        standins.states(star),
        _stored(star, "temperatures", _temperatures(star, city)),
    )


@query
def immigrant(star: Star) -> DataFrame:
    return P.immigrant(standins.arrivals(star), F.col("i94_dt"))


@query
def immigration(star: Star) -> DataFrame:
    return P.immigration(standins.arrivals(star), F.col("i94_dt"))


def _profile(star: Star, **options) -> DataFrame:
    city = _city(star)
    return P.state_profile(_demographics(star, city), city, **options)


@query
def state_profile(star: Star) -> DataFrame:
    return _profile(star)


@query
def state_profile_per_row(star: Star) -> DataFrame:
    return _profile(star, per_row=True)


def _mart(star: Star, **options) -> DataFrame:
    raw, city = standins.arrivals(star), _city(star)
    return P.immigration_demographic(
        P.immigrant(raw, F.col("i94_dt")),
        P.immigration(raw, F.col("i94_dt")),
        standins.countries(star),
        standins.states(star),
        city,
        _demographics(star, city),
        **options,
    )


@query
def monthly_mart(star: Star) -> DataFrame:
    return _mart(star)


@query
def monthly_mart_per_row(star: Star) -> DataFrame:
    return _mart(star, per_row=True)


# Checks and runs


@query
def quality_report(star: Star) -> DataFrame:
    unknown = star.orders.filter(F.col("o_orderstatus") == "X")
    return O.table_report(
        {"orders": star.orders, "lineitem": star.lineitem, "customer": star.customer, "unknown_orders": unknown}
    )


@query
def month_quality(star: Star) -> DataFrame:
    unfinished = _by_month(star).filter(F.col("o_totalprice") < 0)
    return O.month_report({"orders": _by_month(star), "unfinished": unfinished}, [MONTH, "feb96", "jan16"])


@query
def key_quality(star: Star) -> DataFrame:
    return O.key_report(
        {
            "orders": (star.orders, "o_orderkey"),
            "lineitem": (star.lineitem, "l_orderkey"),
            "city": (_city(star), "city_id"),
        }
    )


@query
def differing_figures(star: Star) -> DataFrame:
    """Cities whose survey rows give different figures."""
    return O.differing_report(standins.demographics(star), ["City", "State Code"], ["Median Age", "Total Population", "Number of Veterans", "Count"])


@query
def unread_texts(star: Star) -> DataFrame:
    """Texts of a delimited file that are no numbers."""
    path = scratch_path(star.spark, "flags")
    table = star.customer.select("c_custkey", F.when(F.col("c_acctbal") < 0, "debt").otherwise("1").alias("flag"))
    table.write.option("header", True).csv(path)
    return S.unread_report(star.spark, path, StructType().add("c_custkey", LongType()).add("flag", IntegerType()))


@query
def dimension_refresh(star: Star) -> DataFrame:
    """The seven dimension tables from CSV files; the weather of each airport read back."""
    raw = S.RawLayout(scratch_path(star.spark, "raw"))
    lake = S.LakeLayout(scratch_path(star.spark, "lake"))
    feeds = {
        "airports": (standins.airports, ","),
        "states": (standins.states, ","),
        "countries": (standins.countries, ";"),
        "demographics": (standins.demographics, ";"),
        "temperatures": (standins.temperatures, ","),
    }
    for name, (build, separator) in feeds.items():
        build(star).write.option("header", True).option("sep", separator).csv(raw.path(name))
    P.refresh_dimensions(star.spark, raw, lake, after=AFTER, country=COUNTRY)
    return S.read_table(star.spark, lake.path("us_airports_weather"))


def _monthly_lake(star: Star) -> tuple[S.RawLayout, S.LakeLayout, list[str]]:
    """Arrivals filed by month, and a lake with the tables the mart looks up.

    In a month in which nobody went to a listed state the mart has no rows, which its check reports.
    """
    raw = S.RawLayout(scratch_path(star.spark, "raw"), arrivals="arrivals/i94_dt={month}")
    lake = S.LakeLayout(scratch_path(star.spark, "lake"))
    S.write_months(standins.arrivals(star), f"{raw.root}/arrivals", rebalance=True)
    filed = S.read_table(star.spark, f"{raw.root}/arrivals")
    months = sorted(r["i94_dt"] for r in filed.select("i94_dt").dropDuplicates().collect())
    S.write_table(standins.countries(star), lake.path("country_code"))
    S.write_table(standins.states(star), lake.path("state_code"))
    S.write_table(_city(star), lake.path("city"))
    city = S.read_table(star.spark, lake.path("city"))
    demographics = P.city_demographics(standins.demographics(star), city)
    S.write_table(demographics, lake.path("us_cities_demographics"))
    return raw, lake, months


@query
def backfill(star: Star) -> DataFrame:
    """All months in one pass; the mart read back."""
    raw, lake, months = _monthly_lake(star)
    P.backfill(star.spark, raw, lake, months, together=len(months), gate=False)
    return S.read_table(star.spark, lake.path("immigration_demographic"))


@query
def backfill_in_parts(star: Star) -> DataFrame:
    """All months in order, some at a time; the reports of all passes."""
    raw, lake, months = _monthly_lake(star)
    reports = P.backfill(star.spark, raw, lake, months, together=16, gate=False)
    return reduce(lambda a, b: a.unionByName(b), reports)


@query
def run_month(star: Star) -> DataFrame:
    """All months in one pass, then one of them twice more; rows per table and month."""
    raw, lake, months = _monthly_lake(star)
    P.run_months(star.spark, raw, lake, months, gate=False)
    P.run_month(star.spark, raw, lake, MONTH)
    report = P.run_month(star.spark, raw, lake, MONTH)
    everything = {t: S.read_table(star.spark, lake.path(t)) for t in S.layout.MONTHLY}
    return O.month_report(everything, months).unionByName(report.withColumn("table", F.concat("table", F.lit(" again"))))


@query
def failed_month(star: Star) -> DataFrame:
    """All months, then one again from a feed of which nobody went to a listed state. Its gate stops that run.

    Rows per table and month after it, and whether the run was stopped.
    """
    raw, lake, months = _monthly_lake(star)
    P.run_months(star.spark, raw, lake, months, gate=False)
    unlisted = S.read_months(star.spark, f"{raw.root}/arrivals", MONTH).withColumn("i94addr", F.lit("99"))
    again = S.RawLayout(scratch_path(star.spark, "raw"))
    S.write_table(unlisted.drop("i94_dt"), again.path("arrivals").format(month=MONTH))
    try:
        P.run_month(star.spark, again, lake, MONTH)
        stopped = False
    except O.QualityError:
        stopped = True
    everything = {t: S.read_table(star.spark, lake.path(t)) for t in S.layout.MONTHLY}
    return O.month_report(everything, months).withColumn("stopped", F.lit(stopped))


@query
def row_format_month(star: Star) -> DataFrame:
    """All months from delimited files with a header and reader options; the trips read back."""
    _, lake, months = _monthly_lake(star)
    raw = S.RawLayout(
        scratch_path(star.spark, "raw"),
        arrivals="arrivals/i94_dt={month}",
        arrivals_format="csv",
        arrivals_options={"header": "true", "sep": "|"},
    )
    feed = standins.arrivals(star).hint("rebalance", "i94_dt").write.partitionBy("i94_dt")
    feed.option("header", True).option("sep", "|").csv(f"{raw.root}/arrivals")
    P.run_months(star.spark, raw, lake, months, gate=False)
    return S.read_table(star.spark, lake.path("immigration"))


@query
def mixed_key_types(star: Star) -> DataFrame:
    """Nations by a number against a text with a leading zero, spread over tasks as the third nation is hot."""
    numbered = star.customer.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, 3).otherwise(F.col("c_nationkey")).alias("nation"))
    texts = star.supplier.select("s_suppkey", F.lpad(F.col("s_nationkey").cast("string"), 3, "0").alias("nation"))
    policy = O.JoinPolicy(broadcast_rows=0, hot_share=0.02, spread=True)
    return O.attach_lookup(numbered, texts, ["nation"], policy=policy, spread=("left", "right"))


# Snapshots, feeds of several files, kept keys, places and references


@query
def interrupted_publish(star: Star) -> DataFrame:
    """All months, then one again from half of its arrivals: once stopped between two tables, once whole.

    Rows per table and month after each of the three runs.
    """
    raw, lake, months = _monthly_lake(star)
    half = S.RawLayout(scratch_path(star.spark, "raw"))
    arrived = S.read_months(star.spark, f"{raw.root}/arrivals", MONTH).filter(F.col("cicid") % 2 == 0)
    S.write_table(arrived.drop("i94_dt"), half.path("arrivals").format(month=MONTH))

    def stop(table: str) -> None:
        if table == "immigration":
            raise InterruptedError(table)

    def counts(stage: str) -> DataFrame:
        tables = {t: S.read_table(star.spark, lake.path(t)) for t in S.layout.MONTHLY}
        return O.collected(O.month_report(tables, months)).select(F.lit(stage).alias("stage"), "table", "i94_dt", "n_rows")

    P.run_months(star.spark, raw, lake, months, gate=False)
    stages = [counts("before")]
    try:
        P.run_month(star.spark, half, lake, MONTH, gate=False, progress=stop)
    except InterruptedError:
        stages.append(counts("interrupted"))
    P.run_month(star.spark, half, lake, MONTH, gate=False)
    stages.append(counts("again"))
    return reduce(lambda a, b: a.unionByName(b), stages)


@query
def backfill_restart(star: Star) -> DataFrame:
    """A backfill, the same again, one after the feed of a month changed, and one after a table to look up changed.

    The months that each of them ran, with the rows of their facts.
    """
    raw, lake, months = _monthly_lake(star)
    feed = f"{raw.root}/arrivals"

    def run(stage: str) -> DataFrame:
        reports = P.backfill(star.spark, raw, lake, months, together=len(months), skip_unchanged=True, gate=False)
        shape = "table string, i94_dt string, n_cols int, n_rows bigint, status string"
        ran = reports[0] if reports else star.spark.createDataFrame([], shape)
        return ran.filter("table = 'immigrant'").select(F.lit(stage).alias("stage"), "i94_dt", "n_rows")

    stages = [run("first"), run("again")]
    once = S.read_months(star.spark, feed, MONTH).filter(F.col("cicid") % 2 == 0)
    path = scratch_path(star.spark, "half")
    S.write_table(once, path)
    S.write_months(S.read_table(star.spark, path), feed)
    stages.append(run("one feed changed"))
    S.write_table(standins.states(star).filter(F.col("code") != "FRANCE"), lake.path("state_code"))
    stages.append(run("a lookup changed"))
    return reduce(lambda a, b: a.unionByName(b), stages)


@query
def csv_headers(star: Star) -> DataFrame:
    """A feed of several files whose headers have the columns in three orders, one of them with a column more."""
    path = scratch_path(star.spark, "customer")
    columns = star.customer.columns
    for part in range(3):
        own = star.customer.filter(F.col("c_custkey") % 3 == part).select(*columns[part:], *columns[:part])
        own = own.withColumn("c_note", F.lit("late")) if part == 2 else own
        own.write.mode("append").option("header", True).csv(path)
    return read_csv(star.spark, path, star.customer.schema)


def _latitude(cents: Column) -> Column:
    """A number that grows with an amount and runs through 180 degrees, in tenths."""
    turned = cents - 180 * F.floor(cents / 180) - 90
    return F.floor(turned * 10) / 10


def _longitude(cents: Column) -> Column:
    turned = cents * 7 - 360 * F.floor(cents * 7 / 360) - 180
    return F.floor(turned * 10) / 10


def _marked(degrees: Column, positive: str, negative: str) -> Column:
    return F.concat(F.abs(degrees).cast("string"), F.when(degrees >= 0, positive).otherwise(negative))


@query
def city_temperatures_by_position(star: Star) -> DataFrame:
    """Each measurement with the city of its name whose airport is the nearest in reach, or the only one of the name."""
    city = _city(star)
    sited = standins.airports(star).withColumn("amount", F.col("elevation_ft").cast("double"))
    pair = F.concat(_latitude(F.col("amount")).cast("string"), F.lit(", "), _longitude(F.col("amount")).cast("string"))
    airports = P.airport_dim(sited.withColumn("coordinates", pair).drop("amount"), city)
    amount = F.col("AverageTemperatureUncertainty")
    raw = standins.temperatures(star).withColumns(
        {"Latitude": _marked(_latitude(amount), "N", "S"), "Longitude": _marked(_longitude(amount), "E", "W")}
    )
    stored = _stored(star, "airports", airports)
    return P.city_temperatures(raw, city, after=AFTER, country=COUNTRY, airports=stored, reach=25.0, coordinates=True, flag_ambiguous=True)


@query
def city_temperatures_latest(star: Star) -> DataFrame:
    """The last measurement of each city of the feed, for every state that has the name."""
    return P.city_temperatures(standins.temperatures(star), _city(star), after=None, country=COUNTRY, latest=True)


@query
def key_collisions(star: Star) -> DataFrame:
    """Keys of so few bits that hashes meet: of some pairs, then of all, and all anew from other partitions.

    Per segment the pairs, their keys, how many keys are out of range or changed when pairs came, or by the partitions.
    """
    columns, bits = ["c_mktsegment", "c_nationkey"], 9
    pairs = star.customer.select(*columns).dropDuplicates()
    some = _stored(star, "some-keys", O.key_map(pairs.filter("c_nationkey < 13"), columns, key="pair_id", bits=bits))
    every = _stored(star, "every-key", O.key_map(pairs, columns, some, key="pair_id", bits=bits))
    again = _stored(star, "again", O.key_map(pairs.repartition(7), columns, some.repartition(5), key="pair_id", bits=bits))
    before, other = some.withColumnRenamed("pair_id", "before"), again.withColumnRenamed("pair_id", "other")
    met = every.join(before, columns, "left").join(other, columns, "left")
    return met.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.countDistinct("pair_id").alias("n_keys"),
        F.count_if((F.col("pair_id") < 0) | (F.col("pair_id") >= 1 << bits)).alias("n_outside"),
        F.count_if(F.col("before") != F.col("pair_id")).alias("n_moved"),
        F.count_if(~F.col("other").eqNullSafe(F.col("pair_id"))).alias("n_differing"),
    )


@query
def orphan_report(star: Star) -> DataFrame:
    """The references of all tables of the lake; solvent customers are the listed countries, and one nation is not listed."""
    raw, city = standins.arrivals(star), _city(star)
    month = F.col("i94_dt")
    person = _stored(star, "immigrant", P.immigrant(raw, month).select("cicid", "from_country_code", "i94_dt"))
    trip = _stored(star, "immigration", P.immigration(raw, month).select("cicid", "state_code", "i94_dt"))
    airports, temperatures = _stored(star, "airports", P.airport_dim(standins.airports(star), city)), _stored(star, "temperatures", _temperatures(star, city))
    states = standins.states(star).filter(F.col("code") != "FRANCE")
    tables = {
        "city": city,
        "state_code": states,
        "country_code": standins.countries(star).join(star.customer.filter("c_acctbal >= 0").select(F.col("c_custkey").cast("int").alias("code")), "code"),
        "airport_code": airports,
        "us_cities_demographics": _demographics(star, city),
        "us_cities_temperatures": temperatures,
        "us_airports_weather": P.airport_weather(airports, city, states, temperatures),
        "immigrant": person.filter(F.col("cicid") % 5 != 0),
        "immigration": trip,
        "immigration_demographic": _stored(star, "mart", _mart(star)),
    }
    return O.orphan_report(P.lake_references(tables))


@query
def hot_right_side(star: Star) -> DataFrame:
    """Customers with their orders, a third of which are of one of them, by a join that spreads that one's orders."""
    buyer = F.when(F.col("o_orderkey") % 3 == 0, 1).otherwise(F.col("o_custkey")).cast("bigint").alias("c_custkey")
    return O.join_facts(star.customer.select("c_custkey", "c_name"), star.orders.select(buyer, "o_orderkey"), ["c_custkey"], "left")


@query
def exact_key_types(star: Star) -> DataFrame:
    """Customers by a number of 20 digits, as text of one and as decimal of the next, which only some share."""
    far = F.lit("12345678901234567000").cast("decimal(22,2)")
    texts = star.customer.select("c_custkey", (far + F.col("c_custkey")).cast("decimal(20,0)").cast("string").alias("number"))
    numbers = star.customer.filter(F.col("c_nationkey") < 13).select((far + F.col("c_custkey") + 1).cast("decimal(22,2)").alias("number"), F.col("c_custkey").alias("before"))
    return O.attach_lookup(texts, numbers, ["number"], spread=("left", "right"))
