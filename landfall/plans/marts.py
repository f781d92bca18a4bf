"""Builders of the denormalized tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from landfall.operators import (
    DEFAULT,
    JoinPolicy,
    attach_lookup,
    decode,
    group_stats,
    join_facts,
    one_row_per,
)

# The figures of a state.
PROFILE = ("median_age", "total_population", "foreign_born")


def _labels(codes: DataFrame) -> list[str]:
    return [c for c in codes.columns if c != "code"]


def airport_weather(
    airports: DataFrame,
    city: DataFrame,
    states: DataFrame,
    temperatures: DataFrame,
    *,
    policy: JoinPolicy = DEFAULT,
) -> DataFrame:
    """The weather at each airport whose city has temperatures."""
    sited = attach_lookup(
        airports.select("name", "elevation_ft", "city_id"),
        city.select("city_id", "city", "state_code"),
        ["city_id"],
        policy=policy,
    )
    labelled = decode(sited, states, "state_code", policy=policy)
    weather = temperatures.select("city_id", "avg_temp", "std_temp")
    placed = attach_lookup(labelled, weather, ["city_id"], "inner", policy=policy, spread=("left", "right"), keys_from=airports)
    return placed.select("name", "elevation_ft", "city", *_labels(states), "avg_temp", "std_temp")


def state_profile(
    demographics: DataFrame,
    city: DataFrame,
    *,
    per_row: bool = False,
    policy: JoinPolicy = DEFAULT,
) -> DataFrame:
    """Mean age, population and foreign-born of each state.

    The demographics repeat a city's figures on one row per race; counting each city
    once keeps the sums right. ``per_row`` adds up all rows as they are.
    """
    figures = demographics.select("city_id", *PROFILE)
    if not per_row:
        figures = one_row_per(figures, ["city_id"], PROFILE)
    placed = attach_lookup(
        figures,
        city.select("city_id", "state_code"),
        ["city_id"],
        "inner",
        policy=policy,
        spread=("left",) if per_row else (),
    )
    return group_stats(placed, ["state_code"], ["median_age"], ["total_population", "foreign_born"])


def immigration_demographic(
    person: DataFrame,
    trip: DataFrame,
    countries: DataFrame,
    states: DataFrame,
    city: DataFrame,
    demographics: DataFrame,
    *,
    per_row: bool = False,
    policy: JoinPolicy = DEFAULT,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Each arrival with its origin and the figures of the state it went to.

    Arrivals without a trip or to a state without figures have no row. The two fact
    tables meet first, as narrow rows and in the only join that shuffles them; all
    per-state columns then come in one lookup. As a lookup is counted before it is joined,
    ``keep`` may store that one and read it back, so that it is not computed twice.
    """
    per_state = decode(
        state_profile(demographics, city, per_row=per_row, policy=policy), states, "state_code", policy=policy
    )
    if keep is not None:
        per_state = keep(per_state)
    went = join_facts(
        person.select("cicid", "i94_dt", "from_country_code", "age", "occupation", "gender"),
        trip.select("cicid", "i94_dt", "state_code"),
        ["cicid", "i94_dt"],
        "inner",
        policy=policy,
        unique=True,
    )
    profiled = attach_lookup(went, per_state, ["state_code"], "inner", policy=policy, keys_from=trip)
    named = decode(
        profiled, countries, "from_country_code", {"country": "from_country"}, policy=policy, keys_from=person
    )
    origin = ["from_country" if c == "country" else c for c in _labels(countries)]
    return named.select("cicid", "age", "occupation", "gender", *origin, *_labels(states), *PROFILE, "i94_dt")
