"""Where the raw feeds and the lake tables lie, relative to a root path."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


# The file names of the raw area and the table names of the lake.
@dataclass(frozen=True)
class RawLayout:
    root: str
    airports: str = "codes/airport_code.csv"
    states: str = "codes/state_code.csv"
    countries: str = "codes/country_code.csv"
    demographics: str = "demographics/us-cities-demographics.csv"
    temperatures: str = "temperatures/GlobalLandTemperaturesByCity.csv"
    arrivals: str = "i94_immigration_data/i94_{month}_sub"
    arrivals_format: str = "parquet"
    arrivals_options: Mapping[str, str] = field(default_factory=dict)

    def path(self, feed: str) -> str:
        return f"{self.root.rstrip('/')}/{getattr(self, feed)}"


@dataclass(frozen=True)
class LakeLayout:
    root: str
    city: str = "city"
    state_code: str = "codes/state_code"
    country_code: str = "codes/country_code"
    airport_code: str = "codes/airport_code"
    us_cities_demographics: str = "us_cities_demographics"
    us_cities_temperatures: str = "us_cities_temperatures"
    us_airports_weather: str = "us_airports_weather"
    immigrant: str = "immigrant"
    immigration: str = "immigration"
    immigration_demographic: str = "immigration_demographic"
    city_key: str = "keys/city"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{getattr(self, table)}"


# The tables of a full refresh and of a monthly run, in the order they are built.
DIMENSIONS = (
    "city",
    "state_code",
    "country_code",
    "airport_code",
    "us_cities_demographics",
    "us_cities_temperatures",
    "us_airports_weather",
)
MONTHLY = ("immigrant", "immigration", "immigration_demographic")
