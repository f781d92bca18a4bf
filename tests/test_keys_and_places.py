"""Kept keys, nearest sites, latest measurements and references."""

import datetime as dt
import hashlib
import math
import random

import feeds
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from landfall import operators as O
from landfall import plans as P
from landfall.functions import surrogate_key
from landfall.operators import JoinPolicy, Reference


def first_keys(names, known, bits):
    """What the rule gives: in each turn the least of the new names that ask for a free key gets it."""
    held, left, turn = dict(known), sorted(set(names) - set(known)), 0
    while left:
        asked = {}
        for name in left:
            text = "|".join("~" if part is None else f"{len(str(part))}:{part}" for part in name)
            key = int(hashlib.md5((text + (f"#{turn}" if turn else "")).encode()).hexdigest()[:15], 16) >> (60 - bits)
            if key not in held.values():
                asked.setdefault(key, []).append((text, name))
        held |= {min(asking)[1]: key for key, asking in asked.items()}
        left, turn = [name for name in left if name not in held], turn + 1
    return held


def test_keys_are_unique_kept_and_of_the_names_alone(spark):
    names = [(f"city {i}", None if i % 7 == 0 else i % 5) for i in range(60)]
    shape = "city string, state int"

    def keys(frame, known=None, bits=7):
        table = O.key_map(frame, ["city", "state"], known, bits=bits)
        return {(r["city"], r["state"]): r["id"] for r in table.collect()}

    some = keys(spark.createDataFrame(names[20:] + names[20:], shape))
    assert some == first_keys(names[20:], {}, 7)
    known = spark.createDataFrame([(*n, k) for n, k in some.items()], shape + ", id bigint")
    every = keys(spark.createDataFrame(names[::-1], shape).repartition(5), known)
    assert every == first_keys(names, some, 7)
    assert len(set(every.values())) == 60 and all(every[n] == k for n, k in some.items())
    assert any(every[n] != first_keys([n], {}, 7)[n] for n in names)
    # Names that are not asked for any more keep their keys.
    assert keys(spark.createDataFrame(names[:1], shape), known) == some | {names[0]: every[names[0]]}
    whole = keys(spark.createDataFrame([(f"n{i}", None) for i in range(16)], shape), bits=4)
    assert sorted(whole.values()) == list(range(16))
    with pytest.raises(ValueError, match="17 names"):
        keys(spark.createDataFrame([(f"n{i}", None) for i in range(17)], shape), bits=4)


def test_a_key_of_60_bits_is_the_hash(spark):
    names = spark.createDataFrame([("a", "x"), ("b", None)], "city string, state_code string")
    table = O.key_map(names, ["city", "state_code"], key="city_id")
    assert rows(O.keyed(names, ["city", "state_code"], table, "city_id")) == rows(table)
    hashed = names.select("city", "state_code", surrogate_key(F.col("city"), F.col("state_code")))
    assert rows(hashed) == rows(table)


def brute_nearest(points, sites, reach):
    out = {}
    for name, lat, lon in points:
        near = []
        for other, a, b, pick in sites:
            if None in (name, lat, lon, other, a, b) or name != other:
                continue
            east = lon - b
            east = abs(east - 360 * math.floor((east + 180) / 360))
            if abs(lat - a) <= reach and east <= reach:
                near.append(((lat - a) ** 2 + (math.cos(math.radians(lat)) * east) ** 2, pick))
        if near:
            out[name, lat, lon] = min(near)[1]
    return out


@pytest.mark.parametrize("reach", [0.5, 7.0, 100.0, 180.0])
def test_nearest_site_equals_all_pairs(spark, reach):
    r = random.Random(2)
    place = lambda: (r.choice("ab"), round(r.uniform(-90, 90), 1), round(r.choice([r.uniform(-180, 180), r.uniform(175, 185), r.uniform(-182, -178)]), 1))
    points = [place() for _ in range(150)] + [("a", None, 1.0), (None, 1.0, 1.0), ("a", 90.0, 180.0), ("a", -90.0, -180.0)]
    sites = [(*place(), i) for i in range(60)] + [("a", 90.0, 180.0, 100), ("a", 90.0, -180.0, 99), ("b", None, 0.0, 101)]
    sites += [(n, lat + 0.1, lon - 0.2, 200 + i) for i, (n, lat, lon) in enumerate(points[:40])]
    shape = "name string, latitude double, longitude double"
    got = O.nearest_site(spark.createDataFrame(points * 2, shape), spark.createDataFrame(sites, shape + ", site int"), ["name"], "site", reach=reach)
    assert {(x["name"], x["latitude"], x["longitude"]): x["site"] for x in got.collect()} == brute_nearest(points, sites, reach)
    assert "CartesianProduct" not in plan(got) and "NestedLoop" not in plan(got)
    with pytest.raises(ValueError):
        O.nearest_site(got, got, [], "site", reach=0)


@pytest.fixture(scope="module")
def city(spark):
    return P.city_dim(feeds.airports(spark), feeds.demographics(spark)).cache()


@pytest.fixture(scope="module")
def ids(city):
    return {(r["city"], r["state_code"]): r["city_id"] for r in city.collect()}


@pytest.mark.parametrize("policy", [JoinPolicy(), JoinPolicy(broadcast_rows=0, hot_share=0.05, spread=True, copies=1e9)])
def test_cities_of_one_name_are_told_apart_by_their_airports(spark, city, ids, policy):
    airports = P.airport_dim(feeds.airports(spark), city)
    later = dt.date(2013, 10, 1)
    more = feeds.TEMPERATURES + [
        (later, 10.0, 0.1, "Springfield", "United States", "42.0N", "72.0W"),
        (later, 11.0, 0.1, "Springfield", "United States", "10.0N", "10.0W"),
        (later, 12.0, 0.1, "Springfield", "United States", "bad", "72.0W"),
        (later, 13.0, 0.1, "Erie", "United States", "10.0N", "10.0W"),
    ]
    table = P.city_temperatures(feeds.feed(spark, "temperatures", more), city, airports=airports, flag_ambiguous=True, policy=policy)
    assert rows(table) == {
        (17.2, 0.6, ids["Pittsburgh", "PA"], False): 1,
        (18.9, 1.2, ids["Springfield", "IL"], False): 1,
        (9.5, 0.3, None, False): 1,
        (10.0, 0.1, ids["Springfield", "MA"], False): 1,
        (11.0, 0.1, None, True): 1,
        (12.0, 0.1, None, True): 1,
        (13.0, 0.1, ids["Erie", "PA"], False): 1,
    }
    plain = P.city_temperatures(feeds.feed(spark, "temperatures", more), city, airports=airports, coordinates=True)
    assert plain.columns == ["avg_temp", "std_temp", "latitude", "longitude", "city_id"]


def test_latest_measurement_with_ties(spark, city, ids):
    day, later = dt.date(2013, 9, 1), dt.date(2013, 10, 1)
    feed = [
        (day, 50.0, 0.1, "Erie", "United States", "42.0N", "80.0W"),
        (later, 10.0, 0.1, "Erie", "United States", "42.0N", "80.0W"),
        (later, 11.0, None, "Erie", "United States", "42.0N", "80.0W"),
        (later, 11.0, 0.2, "Erie", "United States", "41.0N", "80.0W"),
        (dt.date(2014, 1, 1), None, 0.2, "Erie", "United States", "42.0N", "80.0W"),
        (None, 99.0, 0.2, "Erie", "United States", "42.0N", "80.0W"),
        (dt.date(1900, 1, 1), 1.0, 0.2, "Springfield", "United States", "42.0N", "80.0W"),
    ]
    raw = feeds.feed(spark, "temperatures", feed)
    table = P.city_temperatures(raw, city, after=None, latest=True)
    assert rows(table) == {(11.0, 0.2, ids["Erie", "PA"]): 1, (1.0, 0.2, ids["Springfield", "IL"]): 1, (1.0, 0.2, ids["Springfield", "MA"]): 1}
    placed = P.city_temperatures(raw, city, latest=True, coordinates=True)
    assert rows(placed) == {(11.0, None, 42.0, -80.0, ids["Erie", "PA"]): 1, (11.0, 0.2, 41.0, -80.0, ids["Erie", "PA"]): 1}


@pytest.mark.parametrize("policy", [JoinPolicy(), JoinPolicy(broadcast_rows=0)])
def test_orphans_with_hot_and_null_keys(spark, policy):
    parent = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b"), ("03", "c"), ("3", "c"), (None, "d")], "id string, x string")
    child = spark.createDataFrame([(1, "a")] * 500 + [(7, "a")] * 300 + [(3, "c"), (None, "b"), (2, None), (9, "q")], "id int, x string")
    empty = child.limit(0)
    report = O.orphan_report(
        [Reference("one", child, ["id"], parent), Reference("two", child, ["id", "x"], parent), Reference("renamed", parent, ["x"], child, ["x"]), Reference("empty", empty, ["id"], parent)],
        policy=policy,
    )
    assert rows(report) == {
        ("one", 804, 1, 301, 2, "FAIL"): 1,
        ("two", 804, 2, 301, 2, "FAIL"): 1,
        ("renamed", 6, 0, 1, 1, "FAIL"): 1,
        ("empty", 0, 0, 0, 0, "SUCCESS"): 1,
    }


def test_orphans_are_found_by_one_count_of_both_tables(spark):
    parent = spark.createDataFrame([(1, 2.0), (3, None), (3, 4.5)], "id bigint, x double")
    child = spark.createDataFrame([("1", 2), ("01", 2), ("x", 2), ("x", 4), (None, 9), ("3", None)], "id string, x bigint")
    spark.sparkContext.setJobGroup("orphans", "building the report")
    report = O.orphan_report([Reference("one", child, ["id"], parent), Reference("two", child, ["id", "x"], parent), Reference("same", parent, ["id"], parent)])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("orphans")
    assert "Join" not in report._jdf.queryExecution().optimizedPlan().toString()
    assert rows(report) == {("one", 6, 1, 2, 1, "FAIL"): 1, ("two", 6, 2, 2, 2, "FAIL"): 1, ("same", 3, 0, 0, 0, "SUCCESS"): 1}
