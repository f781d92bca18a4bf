"""Builders of the monthly fact tables from the arrivals feed.

Each is one narrow projection: the two tables read almost disjoint columns of the
feed, so scanning it twice costs little more than once on a columnar format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import days_to_date, text_to_date


def _tag(month: str | Column) -> Column:
    return (F.lit(month) if isinstance(month, str) else month).alias("i94_dt")


def immigrant(raw: DataFrame, month: str | Column) -> DataFrame:
    """Who arrived. ``month`` is the month's key, or a column that holds it."""
    return raw.select(
        F.col("cicid").try_cast("int").alias("cicid"),
        F.col("i94res").try_cast("int").alias("from_country_code"),
        F.col("i94bir").try_cast("int").alias("age"),
        F.col("i94visa").try_cast("int").alias("visa_code"),
        F.col("visapost").alias("visa_post"),
        F.col("occup").alias("occupation"),
        F.col("visatype").alias("visa_type"),
        F.col("biryear").try_cast("int").alias("birth_year"),
        "gender",
        _tag(month),
    )


def immigration(raw: DataFrame, month: str | Column) -> DataFrame:
    """How and when they came, and until when they may stay."""
    return raw.select(
        F.col("cicid").try_cast("int").alias("cicid"),
        F.col("i94port").alias("iata_code"),
        F.col("i94addr").alias("state_code"),
        "airline",
        F.col("admnum").try_cast("bigint").alias("admnum"),
        "fltno",
        "entdepa",
        "entdepd",
        "entdepu",
        "matflag",
        days_to_date(F.col("arrdate")).alias("arrival_date"),
        days_to_date(F.col("depdate")).alias("departure_date"),
        text_to_date(F.col("dtaddto")).alias("deadline_departure"),
        _tag(month),
    )
