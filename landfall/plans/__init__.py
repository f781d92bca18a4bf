"""The builders of the lake tables and the runs that write them."""

from landfall.plans.dimensions import (
    airport_dim,
    city_demographics,
    city_dim,
    city_names,
    city_temperatures,
    code_table,
)
from landfall.plans.facts import immigrant, immigration
from landfall.plans.marts import airport_weather, immigration_demographic, state_profile
from landfall.plans.runs import backfill, lake_orphans, lake_references, refresh_dimensions, run_month, run_months

__all__ = [
    "airport_dim",
    "airport_weather",
    "backfill",
    "city_demographics",
    "city_dim",
    "city_names",
    "city_temperatures",
    "code_table",
    "immigrant",
    "immigration",
    "immigration_demographic",
    "lake_orphans",
    "lake_references",
    "refresh_dimensions",
    "run_month",
    "run_months",
    "state_profile",
]
