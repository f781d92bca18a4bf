"""Every trial query against its SQL on the test tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as contract
from landfall.operators import JoinPolicy
from landfall.trials.queries import QUERIES
from landfall.trials.sql import SQL

FOLDER = os.environ.get("TRIAL_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem".split()
SPARK_TO_SQL = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def compare(spark, sql, name):
    result = contract.queries()[name](spark, FOLDER)
    expected = sql.execute(contract.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in expected.description}
    assert {c: SPARK_TO_SQL[t] for c, t in result.dtypes} == types
    columns = sorted(types)
    order = [list(types).index(c) for c in columns]
    wanted = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    got = Counter(tuple(row) for row in result.select(*columns).collect())
    assert wanted, "an empty result proves nothing"
    assert got == wanted


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sql, name):
    compare(spark, sql, name)


JOINING = (
    "two_key_left",
    "two_key_inner",
    "fanout_left",
    "code_lookup",
    "country_lookup",
    "fact_fact",
    "key_inner",
    "city_temperatures_flagged",
    "airport_weather",
    "monthly_mart",
)


@pytest.mark.parametrize("name", JOINING)
def test_query_equals_sql_when_nothing_fits_a_broadcast(spark, sql, name, monkeypatch):
    monkeypatch.setattr(JoinPolicy, "allows", lambda self, right: False)
    monkeypatch.setattr(JoinPolicy, "share", lambda self, table: 0.02)
    monkeypatch.setattr(JoinPolicy, "spreads", lambda self, table: True)
    compare(spark, sql, name)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert result.columns[0] == "cicid" and result.columns[-1] == "i94_dt"
