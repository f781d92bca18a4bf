"""Builders of the dimension tables. Each takes and returns DataFrames."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import hemisphere_degrees, last_part, pair_part, surrogate_key
from landfall.operators import DEFAULT, JoinPolicy, attach_lookup, distinct_union, keyed, nearest_site

# Columns of the airport feed that the airport table leaves out, and
# the population columns of the demographics feed with their names in the lake.
AIRPORT_RAW_ONLY = (
    "coordinates",
    "gps_code",
    "local_code",
    "continent",
    "iso_region",
    "iso_country",
    "municipality",
)
POPULATIONS = {
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Total Population": "total_population",
    "Number of Veterans": "num_veterans",
    "Foreign-born": "foreign_born",
}
CITY_KEY = ("city", "state_code")


def code_table(raw: DataFrame) -> DataFrame:
    """A code list enters the lake with all its columns."""
    return raw.select("*")


def city_names(airports: DataFrame, demographics: DataFrame, *, country: str = "US") -> DataFrame:
    """The cities named by either source, one row per name and state."""
    with_airport = airports.filter(F.col("iso_country") == country).select(
        F.col("municipality").alias("city"),
        last_part(F.col("iso_region")).alias("state_code"),
    )
    surveyed = demographics.select(F.col("State Code").alias("state_code"), F.col("City").alias("city"))
    named = [t.filter(F.col("city").isNotNull()) for t in (with_airport, surveyed)]
    return distinct_union(*named).select(*CITY_KEY)


def city_dim(airports: DataFrame, demographics: DataFrame, *, country: str = "US", keys: DataFrame | None = None) -> DataFrame:
    """The cities named by either source with a key.

    The key depends on the two names alone, so ids stored elsewhere stay valid when
    the table is built anew. ``keys`` is a map that ``operators.key_map`` keeps; with it no two cities can have the same key.
    """
    cities = city_names(airports, demographics, country=country)
    if keys is not None:
        return keyed(cities, CITY_KEY, keys, "city_id").select(*CITY_KEY, "city_id")
    return cities.select(*CITY_KEY, surrogate_key(*[F.col(c) for c in CITY_KEY]).alias("city_id"))


def airport_dim(
    airports: DataFrame,
    city: DataFrame,
    *,
    country: str = "US",
    pair_order: Sequence[str] = ("airport_latitude", "airport_longitude"),
    policy: JoinPolicy = DEFAULT,
) -> DataFrame:
    """The airports of a country with coordinates and, where known, their city.

    ``pair_order`` names the two numbers of the coordinate text.
    """
    kept = [c for c in airports.columns if c not in AIRPORT_RAW_ONLY]
    first, second = pair_order
    located = airports.filter(F.col("iso_country") == country).select(
        *[F.col(c).alias("icao_code") if c == "ident" else F.col(c) for c in kept],
        pair_part(F.col("coordinates"), 1).alias(first),
        pair_part(F.col("coordinates"), 2).alias(second),
        F.col("municipality").alias("city"),
        last_part(F.col("iso_region")).alias("state_code"),
    )
    keyed = attach_lookup(located, city, CITY_KEY, policy=policy)
    return keyed.drop(*CITY_KEY)


def city_demographics(raw: DataFrame, city: DataFrame, *, policy: JoinPolicy = DEFAULT) -> DataFrame:
    """Demographic rows, one per city and race, of the cities that have a key."""
    typed = raw.select(
        F.col("City").alias("city"),
        F.col("State Code").alias("state_code"),
        F.col("Median Age").alias("median_age"),
        F.col("Average Household Size").alias("avg_household_size"),
        F.col("Race").alias("race"),
        *[F.col(c).try_cast("bigint").alias(name) for c, name in POPULATIONS.items()],
    )
    keyed = attach_lookup(typed, city, CITY_KEY, "inner", policy=policy)
    return keyed.drop(*CITY_KEY)


def city_temperatures(
    raw: DataFrame,
    city: DataFrame,
    *,
    after: dt.date | None = dt.date(2013, 8, 1),
    country: str = "United States",
    coordinates: bool = False,
    flag_ambiguous: bool = False,
    latest: bool = False,
    airports: DataFrame | None = None,
    reach: float = 2.0,
    policy: JoinPolicy = DEFAULT,
) -> DataFrame:
    """Temperatures measured after a day in the cities of a country.

    The feed names no state, so a measurement goes to every city of that name, and
    one whose city has no key keeps a null ``city_id``. ``flag_ambiguous`` adds
    whether several cities share the name, ``coordinates`` adds the position.

    ``airports`` (the airport table) tells cities of one name apart: a measurement goes to the city whose airport is the nearest within ``reach``
    degrees of it, or else to the only city of the name. If there are several and none is in reach it keeps a
    null ``city_id``, and only then is it ambiguous. So every measurement gives one row.

    ``latest`` keeps the last measurement of each city of the feed, or of each position of a city where positions are looked at; of several on one
    day the warmest counts, then the one with the largest uncertainty. ``after`` may then be null for all days.
    """
    known = F.col("AverageTemperature").isNotNull() & (F.col("Country") == country)
    measured = raw.filter(known if after is None else (F.col("dt") > F.lit(after)) & known).select(
        F.col("AverageTemperature").alias("avg_temp"),
        F.col("AverageTemperatureUncertainty").alias("std_temp"),
        F.col("City").alias("city"),
        *([F.col("dt")] if latest else []),
        *(
            [
                hemisphere_degrees(F.col("Latitude"), "N").alias("latitude"),
                hemisphere_degrees(F.col("Longitude"), "E").alias("longitude"),
            ]
            if coordinates or airports is not None
            else []
        ),
    )
    if latest:
        places = [c for c in measured.columns if c in ("city", "latitude", "longitude")]
        last = measured.groupBy(*places).agg(F.max(F.struct("dt", "avg_temp", "std_temp")).alias("last"))
        measured = last.select("last.avg_temp", "last.std_temp", *places)
    named = city.select("city", "city_id")
    if airports is not None:
        placed = _by_position(measured, named, airports, reach, policy)
        return placed.drop("city", *([] if coordinates else ["latitude", "longitude"]), *([] if flag_ambiguous else ["ambiguous"]))
    if flag_ambiguous:
        states = city.groupBy("city").agg((F.count(F.lit(1)) > 1).alias("ambiguous"))
        named = attach_lookup(named, states, ["city"], policy=policy)
    placed = attach_lookup(measured, named, ["city"], policy=policy, spread=("left", "right"))
    if flag_ambiguous:
        placed = placed.withColumn("ambiguous", F.coalesce("ambiguous", F.lit(False)))
    return placed.drop("city")


def _by_position(measured: DataFrame, named: DataFrame, airports: DataFrame, reach: float, policy: JoinPolicy) -> DataFrame:
    """Measurements with the one city they are of, and whether that could not be told."""
    sited = airports.select("city_id", F.col("airport_latitude").alias("latitude"), F.col("airport_longitude").alias("longitude"))
    sites = attach_lookup(sited.dropna(), named, ["city_id"], "inner", policy=policy)
    found = nearest_site(measured, sites, ["city"], "city_id", reach=reach).withColumnRenamed("city_id", "nearest")
    namesakes = named.groupBy("city").agg(F.when(F.count(F.lit(1)) == 1, F.max("city_id")).alias("only"), (F.count(F.lit(1)) > 1).alias("several"))
    placed = attach_lookup(measured, found, ["city", "latitude", "longitude"], policy=policy)
    placed = attach_lookup(placed, namesakes, ["city"], policy=policy, keys_from=measured)
    one = F.coalesce("nearest", "only").alias("city_id")
    unclear = F.coalesce(F.col("nearest").isNull() & F.col("several"), F.lit(False)).alias("ambiguous")
    return placed.select(*measured.columns, one, unclear)
