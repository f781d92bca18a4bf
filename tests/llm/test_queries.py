import os
from collections import Counter

import pytest

from landfall.llm.queries import QUERIES
from landfall.llm.sql import SQL

FOLDER = os.environ.get("TRIAL_SF_DIR", "/root/testdata/sf0.01")
duckdb = pytest.importorskip("duckdb")


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for name_ in ("documents", "benchmark", "embeddings"):
        connection.execute(f"create view {name_} as select * from '{FOLDER}/{name_}.parquet'")
    expected = connection.execute(SQL[name])
    columns = [c[0] for c in expected.description]
    got = QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(expected.fetchall())
