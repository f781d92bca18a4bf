"""Raw feeds shaped from the star-schema tables.

Every feed covers all rows of its tables, so it grows with them. Nulls, unknown
codes and malformed text come from the values themselves: customers in debt live in
unlisted places, open orders carry ``D/S`` in place of a date, and so on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import month_key


class Star:
    """The test tables of one folder, each opened when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        opened = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        setattr(self, table, opened)
        return opened


def city_name() -> Column:
    return F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(F.col("c_mktsegment"))


def residents(star: Star) -> DataFrame:
    """Customers with the names of their nation and region."""
    return (
        star.customer.join(star.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(star.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def airports(star: Star) -> DataFrame:
    """Suppliers as airports; the customer of the same number names the city."""
    owners = star.customer.select(F.col("c_custkey").alias("s_suppkey"), "c_mktsegment")
    return (
        star.supplier.join(star.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(owners, "s_suppkey", "left")
        .select(
            F.col("s_name").alias("ident"),
            F.when(F.col("s_acctbal") < 0, "closed").otherwise("open").alias("type"),
            F.concat("s_name", F.lit(" Field")).alias("name"),
            F.col("s_acctbal").cast("int").alias("elevation_ft"),
            F.lit("NA").alias("continent"),
            F.when(F.col("s_acctbal") > 9000, "CA").otherwise("US").alias("iso_country"),
            F.concat(F.lit("US-"), "n_name").alias("iso_region"),
            F.when(F.col("s_acctbal") >= 8000, F.col("s_name"))
            .when(F.col("s_acctbal") >= 0, F.col("c_mktsegment"))
            .alias("municipality"),
            F.col("s_name").alias("gps_code"),
            F.col("s_suppkey").cast("string").alias("iata_code"),
            F.col("s_name").alias("local_code"),
            F.concat(F.col("s_acctbal").cast("string"), F.lit(", "), F.col("s_nationkey").cast("string")).alias(
                "coordinates"
            ),
        )
    )


def demographics(star: Star) -> DataFrame:
    """Customers as survey rows of their city."""
    return star.customer.join(star.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        city_name().alias("City"),
        F.lower("n_name").alias("State"),
        F.floor(F.col("c_acctbal") / 100).cast("double").alias("Median Age"),
        F.round(F.col("c_acctbal") * 100).alias("Male Population"),
        F.col("c_custkey").cast("double").alias("Female Population"),
        (F.col("c_custkey") * 7).cast("double").alias("Total Population"),
        F.when(F.col("c_acctbal") <= 9000, F.col("c_custkey").cast("double")).alias("Number of Veterans"),
        (F.col("c_custkey") * 3 + 0.5).cast("double").alias("Foreign-born"),
        F.col("c_acctbal").alias("Average Household Size"),
        F.col("n_name").alias("State Code"),
        F.col("c_name").alias("Race"),
        F.lit(1.0).alias("Count"),
    )


def temperatures(star: Star) -> DataFrame:
    """Orders as one measurement per city, country and month.

    A month with pending orders only has no value. City names repeat across states,
    each of which gets the measurement, so the rows per city stay bounded by months.
    """
    bought = star.orders.join(residents(star), F.col("o_custkey") == F.col("c_custkey"))
    monthly = bought.groupBy(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("dt"),
        city_name().alias("City"),
        F.col("r_name").alias("Country"),
    ).agg(
        F.max(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))).alias("AverageTemperature"),
        F.max("c_acctbal").alias("AverageTemperatureUncertainty"),
        F.max("o_totalprice").alias("degrees"),
    )
    text = F.round(F.col("degrees") / 1000, 1).cast("string")
    warm = F.col("degrees") >= 250000
    return monthly.withColumns(
        {
            "Latitude": F.concat(text, F.when(warm, "N").otherwise("S")),
            "Longitude": F.concat(text, F.when(warm, "W").otherwise("E")),
        }
    ).drop("degrees")


def countries(star: Star) -> DataFrame:
    """A country code for every customer."""
    return star.customer.select(F.col("c_custkey").cast("int").alias("code"), F.col("c_name").alias("country"))


def states(star: Star) -> DataFrame:
    return star.nation.select(F.col("n_name").alias("code"), F.lower("n_name").alias("state"))


def order_days() -> Column:
    return F.date_diff(F.col("o_orderdate").cast("date"), F.lit(dt.date(1960, 1, 1)))


def arrivals(star: Star) -> DataFrame:
    """Orders as arrivals, each with its month. Pending orders name no state."""
    status = F.col("o_orderstatus")
    return star.orders.join(residents(star), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.col("o_custkey").cast("double").alias("i94res"),
        (F.col("c_acctbal") / 100).alias("i94bir"),
        F.col("n_regionkey").cast("double").alias("i94visa"),
        F.col("n_name").alias("visapost"),
        F.col("o_orderpriority").alias("occup"),
        F.col("c_mktsegment").alias("visatype"),
        (F.year("o_orderdate") - 30).cast("double").alias("biryear"),
        status.alias("gender"),
        (order_days() + 0.9).cast("double").alias("arrdate"),
        F.when(status != "P", (order_days() + 14).cast("double")).alias("depdate"),
        F.when(status == "O", "D/S").otherwise(F.date_format("o_orderdate", "MMddyyyy")).alias("dtaddto"),
        F.col("r_name").alias("i94port"),
        F.when(status != "P", F.when(F.col("c_acctbal") < 0, "99").otherwise(F.col("n_name"))).alias("i94addr"),
        F.col("o_orderpriority").alias("airline"),
        (F.col("o_orderkey") * 1000 + 7).cast("double").alias("admnum"),
        F.col("o_custkey").cast("string").alias("fltno"),
        status.alias("entdepa"),
        F.when(status != "P", status).alias("entdepd"),
        F.lit(None).cast("string").alias("entdepu"),
        F.when(status == "F", "M").alias("matflag"),
        month_key(F.col("o_orderdate")).alias("i94_dt"),
    )
