"""The runs that fill the lake: a full refresh of the dimensions, and months of facts.

Every table is written before the next one reads it, to a folder that no reader knows yet; the tables of a run are checked there and
then published together by one commit (``sources.snapshots``). So a run can fail or be stopped anywhere, and be repeated from its
start: readers see all tables as before it or all as after it, and nothing is written twice.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators import (
    DEFAULT,
    JoinPolicy,
    Reference,
    collected,
    key_map,
    key_report,
    month_report,
    orphan_report,
    require_pass,
    table_report,
)
from landfall.plans.dimensions import CITY_KEY, airport_dim, city_demographics, city_dim, city_names, city_temperatures, code_table
from landfall.plans.facts import immigrant, immigration
from landfall.plans.marts import airport_weather, immigration_demographic
from landfall.sources import LakeLayout, RawLayout, Transaction, read_arrivals, read_feed, read_table, snapshot, write_months, write_table
from landfall.sources.feeds import fingerprints
from landfall.sources.files import listed, make, remove
from landfall.sources.layout import DIMENSIONS, MONTHLY
from landfall.sources.snapshots import WHOLE

# The tables that the mart looks up.
LOOKED_UP = ("country_code", "state_code", "city", "us_cities_demographics")

# Formats of which a scan reads only the columns it needs.
COLUMNAR = ("parquet", "orc")


def _looked_up(spark: SparkSession, run: Transaction, lake: LakeLayout, name: str) -> DataFrame:
    """A table as it was when the run began."""
    held = run.base.read(spark, getattr(lake, name))
    return spark.read.parquet(lake.path(name)) if held is None else held


def _nothing(_: str) -> None:
    pass


def refresh_dimensions(
    spark: SparkSession,
    raw: RawLayout,
    lake: LakeLayout,
    *,
    after: dt.date | None = dt.date(2013, 8, 1),
    country: str = "United States",
    latest: bool = False,
    reach: float | None = None,
    policy: JoinPolicy = DEFAULT,
    progress: Callable[[str], None] = _nothing,
) -> DataFrame:
    """Rebuild the seven dimension tables, check and publish them, and return the report.

    City keys are kept in a table of their own, so a city has the same one after every refresh. With ``reach`` cities of one
    name are told apart by their airports; ``latest`` keeps the last temperature of each city. ``progress`` is called
    with the name of each table before it is written. If anything fails, the lake keeps the tables it had.
    """

    def feed(name: str) -> DataFrame:
        return read_feed(spark, name, raw.path(name))

    with Transaction(spark, lake.root) as run:
        tables = {}

        def store(name: str, table: DataFrame) -> DataFrame:
            progress(name)
            tables[name] = run.write_table(getattr(lake, name), table)
            return tables[name]

        airports_raw, demographics_raw = feed("airports"), feed("demographics")
        known = run.base.read(spark, lake.city_key)
        keys = run.write_table(lake.city_key, key_map(city_names(airports_raw, demographics_raw), CITY_KEY, known, key="city_id"))
        # Without earlier keys the map holds just the cities of this refresh.
        city = store("city", keys if known is None else city_dim(airports_raw, demographics_raw, keys=keys))
        require_pass(key_report({"city": (city, "city_id")}))
        states = store("state_code", code_table(feed("states")))
        store("country_code", code_table(feed("countries")))
        airports = store("airport_code", airport_dim(airports_raw, city, policy=policy))
        store("us_cities_demographics", city_demographics(demographics_raw, city, policy=policy))
        told = {} if reach is None else {"airports": airports, "reach": reach}
        temperatures = store(
            "us_cities_temperatures",
            city_temperatures(feed("temperatures"), city, after=after, country=country, latest=latest, policy=policy, **told),
        )
        store("us_airports_weather", airport_weather(airports, city, states, temperatures, policy=policy))
        report = require_pass(table_report({name: tables[name] for name in DIMENSIONS}))
        run.commit()
        return report


def run_months(
    spark: SparkSession,
    raw: RawLayout,
    lake: LakeLayout,
    months: Sequence[str],
    *,
    gate: bool = True,
    per_row: bool = False,
    policy: JoinPolicy = DEFAULT,
    progress: Callable[[str], None] = _nothing,
    inputs: dict[str, str] | None = None,
) -> DataFrame:
    """Fill some months of the facts and their mart in one pass, check, publish and report.

    If a check fails or anything else stops the run the lake keeps what it had, in all tables. Otherwise, or with ``gate`` off, the
    months of all three tables are replaced at once; a month that has no rows in a table then has none in the lake.
    A row format is decoded once, into a folder of the run, and the figures of the states are kept there; columnar files are read per fact. ``progress`` is called with the
    name of each table before it is written, ``inputs`` says what each month is made from and is kept with it.
    """
    months = list(months)
    scratch = f"{lake.root.rstrip('/')}/_runs/{uuid.uuid4().hex}"
    make(spark, scratch)
    try:
        with Transaction(spark, lake.root) as run:
            arrivals = read_arrivals(spark, raw.path("arrivals"), months, raw.arrivals_format, **raw.arrivals_options)
            if raw.arrivals_format not in COLUMNAR:
                write_months(arrivals, f"{scratch}/arrivals")
                arrivals = read_table(spark, f"{scratch}/arrivals", arrivals.schema)
            tables = {}

            def store(name: str, table: DataFrame, **options) -> DataFrame:
                progress(name)
                tables[name] = run.write_months(getattr(lake, name), table, months, inputs=inputs, **options)
                return tables[name]

            def kept(figures: DataFrame) -> DataFrame:
                write_table(figures, f"{scratch}/state_figures")
                return read_table(spark, f"{scratch}/state_figures", figures.schema)

            person = store("immigrant", immigrant(arrivals, F.col("i94_dt")))
            trip = store("immigration", immigration(arrivals, F.col("i94_dt")))
            if gate and run.filled(lake.immigrant) != set(months):
                require_pass(month_report({"arrivals": person}, months))
            lookups = [_looked_up(spark, run, lake, name) for name in LOOKED_UP]
            mart = immigration_demographic(person, trip, *lookups, per_row=per_row, policy=policy, keep=kept)
            store("immigration_demographic", mart, rebalance=len(months) > 1)
            report = month_report(tables, months)
            report = require_pass(report) if gate else collected(report)
            run.commit()
            return report
    finally:
        remove(spark, scratch)


def run_month(spark: SparkSession, raw: RawLayout, lake: LakeLayout, month: str, **options) -> DataFrame:
    """Fill one month. Repeating it gives the same lake."""
    return run_months(spark, raw, lake, [month], **options)


def month_inputs(spark: SparkSession, raw: RawLayout, lake: LakeLayout, months: Sequence[str], *, per_row: bool = False) -> dict[str, str]:
    """For each month that has arrivals what its tables are made from: its files, the tables the mart looks up, and the options."""
    base, looked = snapshot(spark, lake.root), []
    for name in LOOKED_UP:
        entry = base.tables.get(getattr(lake, name))
        files = listed(spark, lake.path(name)) if entry is None else {entry.folders[WHOLE]: 0}
        looked.append(f"{name} {sorted(files.items())}")
    shared = f"{raw.arrivals_format} {sorted(raw.arrivals_options.items())}, per row {per_row}, " + ", ".join(looked)
    return {month: f"{files}, {shared}" for month, files in fingerprints(spark, raw.path("arrivals"), months).items()}


def unchanged_months(spark: SparkSession, lake: LakeLayout, inputs: dict[str, str]) -> list[str]:
    """The months that all three tables were last filled with from just these inputs."""
    base = snapshot(spark, lake.root)
    kept = [base.tables[getattr(lake, name)].inputs if getattr(lake, name) in base.tables else {} for name in MONTHLY]
    return [month for month, files in inputs.items() if all(known.get(month) == files for known in kept)]


def backfill(
    spark: SparkSession,
    raw: RawLayout,
    lake: LakeLayout,
    months: Sequence[str],
    *,
    together: int = 1,
    skip_unchanged: bool = False,
    **options,
) -> list[DataFrame]:
    """Fill many months in order, ``together`` of them per pass.

    A failed check stops at its pass; earlier months are complete by then. ``skip_unchanged`` leaves out the months that an earlier
    backfill of this kind filled from files of the same names, lengths and times and with the same tables to look up, so that
    one that was stopped goes on where it was, and one whose feeds changed runs those months only.
    """
    months = list(months)
    if len(set(months)) < len(months):
        raise ValueError("months given twice")
    inputs: dict[str, str] = {}
    if skip_unchanged and months:
        inputs = month_inputs(spark, raw, lake, months, per_row=options.get("per_row", False))
        done = set(unchanged_months(spark, lake, inputs))
        months = [month for month in months if month not in done]
    parts = [months[i : i + together] for i in range(0, len(months), together)]
    return [run_months(spark, raw, lake, part, inputs={m: inputs[m] for m in part if m in inputs}, **options) for part in parts]


def lake_references(tables: Mapping[str, DataFrame]) -> list[Reference]:
    """The columns of the lake's tables that name rows of other ones of them."""
    named = [
        ("city", ["state_code"], "state_code", ["code"]),
        ("airport_code", ["city_id"], "city", None),
        ("us_cities_demographics", ["city_id"], "city", None),
        ("us_cities_temperatures", ["city_id"], "city", None),
        ("us_airports_weather", ["city"], "city", None),
        ("immigrant", ["from_country_code"], "country_code", ["code"]),
        ("immigration", ["state_code"], "state_code", ["code"]),
        ("immigration", ["cicid", "i94_dt"], "immigrant", None),
        ("immigration_demographic", ["cicid", "i94_dt"], "immigrant", None),
    ]
    return [Reference(f"{child}.{'+'.join(keys)} in {parent}", tables[child], keys, tables[parent], there) for child, keys, parent, there in named]


def lake_orphans(spark: SparkSession, lake: LakeLayout, *, policy: JoinPolicy = DEFAULT) -> DataFrame:
    """The rows of the published tables that name none of another table (``operators.orphan_report``)."""
    base = snapshot(spark, lake.root)
    tables = {}
    for name in (*DIMENSIONS, *MONTHLY):
        held = base.read(spark, getattr(lake, name))
        tables[name] = spark.read.parquet(lake.path(name)) if held is None else held
    return orphan_report(lake_references(tables), policy=policy)
