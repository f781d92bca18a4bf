import datetime as dt

import feeds
import pytest
from helpers import rows
from pyspark.sql import functions as F

from landfall import plans as P
from landfall.operators import JoinPolicy

SHUFFLED = JoinPolicy(broadcast_rows=0, hot_share=0.05, spread=True, copies=1e9)


@pytest.fixture(scope="module")
def city(spark):
    return P.city_dim(feeds.airports(spark), feeds.demographics(spark)).cache()


@pytest.fixture(scope="module")
def ids(city):
    return {(r["city"], r["state_code"]): r["city_id"] for r in city.collect()}


def test_city_dim_has_each_named_city_once(city, ids):
    # A city of the demographics alone (Erie) counts as well as one of the airports
    # alone (Flyover); rows without a city and foreign airports do not.
    assert set(ids) == {
        ("Pittsburgh", "PA"),
        ("Erie", "PA"),
        ("Springfield", "IL"),
        ("Springfield", "MA"),
        ("Flyover", "WY"),
        ("Lostville", None),
    }
    assert city.count() == len(ids) == len(set(ids.values()))
    assert city.columns == ["city", "state_code", "city_id"]


def test_city_ids_survive_a_rebuild(spark, ids):
    again = P.city_dim(feeds.airports(spark).repartition(5).limit(3), feeds.demographics(spark).repartition(3))
    assert all(ids[r["city"], r["state_code"]] == r["city_id"] for r in again.collect())


@pytest.mark.parametrize("policy", [JoinPolicy(), SHUFFLED])
def test_airport_dim(spark, city, ids, policy):
    table = P.airport_dim(feeds.airports(spark), city, policy=policy)
    assert table.columns == [
        "icao_code",
        "name",
        "elevation_ft",
        "iata_code",
        "airport_latitude",
        "airport_longitude",
        "city_id",
    ]
    found = {r["icao_code"]: r for r in table.collect()}
    assert set(found) == {"KPIT", "KAGC", "KSPI", "KCEF", "KFLY", "KNOC", "KNOR"}
    assert found["KPIT"]["city_id"] == found["KAGC"]["city_id"] == ids["Pittsburgh", "PA"]
    assert (found["KPIT"]["airport_latitude"], found["KPIT"]["airport_longitude"]) == (40.49, -80.23)
    assert found["KFLY"]["airport_latitude"] is None and found["KFLY"]["city_id"] == ids["Flyover", "WY"]
    assert found["KNOC"]["city_id"] is None and found["KNOR"]["city_id"] is None
    assert (found["KNOR"]["airport_latitude"], found["KNOR"]["airport_longitude"]) == (1.0, None)


def test_airport_dim_keeps_further_columns_and_swaps_the_pair(spark, city):
    more = feeds.airports(spark).withColumn("type", F.lit("small"))
    table = P.airport_dim(more, city, pair_order=("airport_longitude", "airport_latitude"))
    row = table.filter("icao_code = 'KPIT'").first()
    assert row["type"] == "small"
    assert (row["airport_longitude"], row["airport_latitude"]) == (40.49, -80.23)


def test_code_table_is_the_list(spark):
    assert rows(P.code_table(feeds.states(spark))) == rows(feeds.states(spark))


@pytest.mark.parametrize("policy", [JoinPolicy(), SHUFFLED])
def test_city_demographics(spark, city, ids, policy):
    table = P.city_demographics(feeds.demographics(spark), city, policy=policy)
    assert table.dtypes == [
        ("median_age", "double"),
        ("avg_household_size", "double"),
        ("race", "string"),
        ("male_population", "bigint"),
        ("female_population", "bigint"),
        ("total_population", "bigint"),
        ("num_veterans", "bigint"),
        ("foreign_born", "bigint"),
        ("city_id", "bigint"),
    ]
    assert table.count() == 6
    erie = table.filter(F.col("city_id") == ids["Erie", "PA"]).collect()
    assert [tuple(r) for r in erie] == [
        (33.1, 2.3, "White", 48000, 51000, 99000, 5000, None, ids["Erie", "PA"])
    ]


@pytest.mark.parametrize("policy", [JoinPolicy(), SHUFFLED])
def test_city_temperatures(spark, city, ids, policy):
    table = P.city_temperatures(feeds.temperatures(spark), city, policy=policy)
    assert table.columns == ["avg_temp", "std_temp", "city_id"]
    # Strictly after the day, with a value, of the country; to every state that has
    # the name; an unlisted city keeps a null id.
    assert rows(table) == {
        (17.2, 0.6, ids["Pittsburgh", "PA"]): 1,
        (18.9, 1.2, ids["Springfield", "IL"]): 1,
        (18.9, 1.2, ids["Springfield", "MA"]): 1,
        (9.5, 0.3, None): 1,
    }


def test_city_temperatures_with_flag_and_position(spark, city, ids):
    table = P.city_temperatures(
        feeds.temperatures(spark), city, after=dt.date(2013, 7, 1), coordinates=True, flag_ambiguous=True
    )
    assert rows(table) == {
        (20.1, 0.5, 40.99, -80.95, ids["Pittsburgh", "PA"], False): 1,
        (17.2, 0.6, 40.99, -80.95, ids["Pittsburgh", "PA"], False): 1,
        (18.9, 1.2, 39.38, -89.48, ids["Springfield", "IL"], True): 1,
        (18.9, 1.2, 39.38, -89.48, ids["Springfield", "MA"], True): 1,
        (9.5, 0.3, -50.0, 3.0, None, False): 1,
    }


@pytest.mark.parametrize("policy", [JoinPolicy(), SHUFFLED])
def test_airport_weather(spark, city, policy):
    table = P.airport_weather(
        P.airport_dim(feeds.airports(spark), city),
        city,
        feeds.states(spark),
        P.city_temperatures(feeds.temperatures(spark), city),
        policy=policy,
    )
    assert table.columns == ["name", "elevation_ft", "city", "state", "avg_temp", "std_temp"]
    assert rows(table) == {
        ("Pittsburgh Intl", 1203, "Pittsburgh", "Pennsylvania", 17.2, 0.6): 1,
        ("Allegheny County", 1252, "Pittsburgh", "Pennsylvania", 17.2, 0.6): 1,
        ("Abraham Lincoln", 598, "Springfield", "Illinois", 18.9, 1.2): 1,
        # No label for MA in the state table.
        ("Westover", 241, "Springfield", None, 18.9, 1.2): 1,
    }


def test_immigrant(spark):
    table = P.immigrant(feeds.arrivals(spark, feeds.JANUARY + feeds.FEBRUARY), "jan16")
    assert table.dtypes == [
        ("cicid", "int"),
        ("from_country_code", "int"),
        ("age", "int"),
        ("visa_code", "int"),
        ("visa_post", "string"),
        ("occupation", "string"),
        ("visa_type", "string"),
        ("birth_year", "int"),
        ("gender", "string"),
        ("i94_dt", "string"),
    ]
    got = rows(table)
    assert got[(1, 245, 40, 2, "SHG", None, "B2", 1976, "F", "jan16")] == 1
    assert got[(1, 245, None, 2, "SHG", None, "B2", 1976, "M", "jan16")] == 1
    assert got[(None, None, 40, 2, "SHG", None, "B2", 1976, "F", "jan16")] == 1
    assert sum(got.values()) == 9


def test_immigration(spark):
    table = P.immigration(feeds.arrivals(spark, feeds.JANUARY + feeds.FEBRUARY), "jan16")
    assert table.columns == [
        "cicid",
        "iata_code",
        "state_code",
        "airline",
        "admnum",
        "fltno",
        "entdepa",
        "entdepd",
        "entdepu",
        "matflag",
        "arrival_date",
        "departure_date",
        "deadline_departure",
        "i94_dt",
    ]
    day = dt.date(2016, 1, 1)
    assert dict(table.dtypes)["admnum"] == "bigint"
    dates = {
        r["cicid"]: (r["arrival_date"], r["departure_date"], r["deadline_departure"])
        for r in table.filter("cicid in (2, 3, 5, 6, 8)").collect()
    }
    assert dates == {
        2: (day, dt.date(2016, 1, 7), None),
        3: (day, None, dt.date(2016, 6, 30)),
        5: (day, dt.date(2016, 1, 7), None),
        6: (None, None, None),
        8: (day, dt.date(1959, 12, 31), None),
    }


def demographics(spark, city):
    return P.city_demographics(feeds.demographics(spark), city)


@pytest.mark.parametrize("policy", [JoinPolicy(), SHUFFLED])
def test_state_profile_counts_each_city_once(spark, city, policy):
    got = rows(P.state_profile(demographics(spark, city), city, policy=policy))
    assert got == {
        ("PA", 33.0, 304385 + 99000, 28187): 1,
        ("IL", 38.8, 117809, 4264): 1,
        ("MA", 31.8, 154336, 16226): 1,
    }


def test_state_profile_per_row(spark, city):
    row = P.state_profile(demographics(spark, city), city, per_row=True).filter("state_code = 'PA'").first()
    assert row["median_age"] == pytest.approx((3 * 32.9 + 33.1) / 4)
    assert (row["total_population"], row["foreign_born"]) == (3 * 304385 + 99000, 3 * 28187)


@pytest.mark.parametrize("policy", [JoinPolicy(), SHUFFLED])
def test_immigration_demographic(spark, city, policy):
    raw = feeds.arrivals(spark, feeds.JANUARY)
    table = P.immigration_demographic(
        P.immigrant(raw, "jan16"),
        P.immigration(raw, "jan16").filter("cicid <> 5"),
        feeds.countries(spark),
        feeds.states(spark),
        city,
        demographics(spark, city),
        policy=policy,
    )
    pa, il, ma = (33.0, 403385, 28187), (38.8, 117809, 4264), (31.8, 154336, 16226)
    # Without a row: 3 (no state), 4 (a code without figures), 5 (no trip), 7 (no id).
    assert rows(table) == {
        (1, 40, None, "F", "CHINA, PRC", "Pennsylvania", *pa, "jan16"): 1,
        (2, 40, None, "F", "MEXICO", "Illinois", *il, "jan16"): 1,
        (6, 40, None, "F", "INVALID: PANAMA", None, *ma, "jan16"): 1,
    }
    assert table.columns == [
        "cicid",
        "age",
        "occupation",
        "gender",
        "from_country",
        "state",
        "median_age",
        "total_population",
        "foreign_born",
        "i94_dt",
    ]


def test_mart_pairs_within_a_month(spark, city):
    january, february = feeds.arrivals(spark, feeds.JANUARY), feeds.arrivals(spark, feeds.FEBRUARY)
    person = P.immigrant(january, "jan16").unionByName(P.immigrant(february, "feb16"))
    trip = P.immigration(january, "jan16").unionByName(P.immigration(february, "feb16"))
    table = P.immigration_demographic(
        person, trip, feeds.countries(spark), feeds.states(spark), city, demographics(spark, city)
    )
    found = sorted((r["cicid"], r["i94_dt"], r["gender"]) for r in table.filter("cicid in (1, 5, 8)").collect())
    assert found == [(1, "feb16", "M"), (1, "jan16", "F"), (5, "jan16", "F"), (8, "feb16", "F")]
    unknown = table.filter("cicid = 5").first()
    assert unknown["from_country"] is None
