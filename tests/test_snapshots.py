"""Tables that change together, whatever fails in between."""

import json
import os
import shutil

import feeds
import pytest
from helpers import rows
from pyspark.sql import functions as F

from landfall import plans as P
from landfall import sources as S
from landfall.operators import QualityError
from landfall.sources.files import listed, put_text, read_text
from landfall.sources.layout import DIMENSIONS, MONTHLY
from landfall.sources.snapshots import found


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return feeds.file_raw(spark, tmp_path_factory.mktemp("raw"))


@pytest.fixture(scope="module")
def refreshed(spark, raw, tmp_path_factory):
    layout = S.LakeLayout(str(tmp_path_factory.mktemp("lakes") / "lake"))
    P.refresh_dimensions(spark, raw, layout)
    return layout


@pytest.fixture
def lake(refreshed, tmp_path):
    """A lake of its own. Manifests name folders relative to it, so a copy is as good."""
    shutil.copytree(refreshed.root, tmp_path / "lake")
    return S.LakeLayout(str(tmp_path / "lake"))


def contents(spark, lake, names):
    return {name: rows(S.read_table(spark, lake.path(name))) for name in names}


def numbers(spark, *values):
    return spark.createDataFrame([(v, "jan16" if v < 10 else "feb16") for v in values], "id int, i94_dt string")


def test_small_files_are_put_whole_and_once(spark, tmp_path):
    path = str(tmp_path / "x" / "1.json")
    assert put_text(spark, path, "é one") and read_text(spark, path) == "é one"
    assert not put_text(spark, path, "two") and read_text(spark, path) == "é one"
    assert [name for name in listed(spark, str(tmp_path / "x")) if not name.endswith(".crc")] == ["1.json"]
    assert listed(spark, str(tmp_path / "none")) == {}


def test_nothing_is_seen_before_the_commit_and_all_after(spark, tmp_path):
    root = str(tmp_path)
    with S.Transaction(spark, root) as run:
        run.write_table("a", numbers(spark, 1))
        run.write_months("deep/b", numbers(spark, 2, 12), ["jan16", "feb16", "mar16"])
        assert S.snapshot(spark, root).tables == {}
        assert run.commit() == 1
    assert rows(S.read_table(spark, f"{root}/a")) == {(1, "jan16"): 1}
    assert rows(S.read_table(spark, f"{root}/deep/b")) == {(2, "jan16"): 1, (12, "feb16"): 1}
    assert rows(S.read_months(spark, f"{root}/deep/b", "feb16")) == {(12, "feb16"): 1}
    assert S.read_months(spark, f"{root}/deep/b", ["mar16"]).columns == ["id", "i94_dt"]
    assert found(spark, f"{root}/c") is None


def test_what_is_not_committed_is_taken_back(spark, tmp_path):
    root = str(tmp_path)
    with S.Transaction(spark, root) as run:
        run.write_table("a", numbers(spark, 1))
        run.commit()
    with pytest.raises(ZeroDivisionError), S.Transaction(spark, root) as run:
        run.write_table("a", numbers(spark, 2))
        run.write_months("b", numbers(spark, 3), ["jan16"])
        raise ZeroDivisionError
    assert rows(S.read_table(spark, f"{root}/a")) == {(1, "jan16"): 1}
    assert list(S.snapshot(spark, root).tables) == ["a"]
    assert len(listed(spark, f"{root}/_data/a")) == 1 and not listed(spark, f"{root}/_data/b")


def test_months_are_replaced_and_others_stay(spark, tmp_path):
    root = str(tmp_path)
    for values, months in (((1, 2, 11), ["jan16", "feb16"]), ((3,), ["jan16"]), ((), ["feb16"])):
        with S.Transaction(spark, root) as run:
            run.write_months("t", numbers(spark, *values) if values else numbers(spark, 1).limit(0), months)
            run.commit()
    assert rows(S.read_table(spark, f"{root}/t")) == {(3, "jan16"): 1}
    assert rows(S.snapshot(spark, root, 1).read(spark, "t")) == {(1, "jan16"): 1, (2, "jan16"): 1, (11, "feb16"): 1}
    with S.Transaction(spark, root) as run, pytest.raises(ValueError, match="feb16"):
        run.write_months("t", numbers(spark, 11), ["jan16"])


def test_two_runs_at_once_both_stay(spark, tmp_path):
    root = str(tmp_path)
    with S.Transaction(spark, root) as one, S.Transaction(spark, root) as two:
        one.write_months("t", numbers(spark, 1), ["jan16"])
        two.write_months("t", numbers(spark, 11), ["feb16"])
        two.write_table("u", numbers(spark, 5))
        assert (two.commit(), one.commit()) == (1, 2)
    assert rows(S.read_table(spark, f"{root}/t")) == {(1, "jan16"): 1, (11, "feb16"): 1}
    assert rows(S.read_table(spark, f"{root}/u")) == {(5, "jan16"): 1}


def test_plain_writers_of_published_tables_commit(spark, tmp_path):
    root = str(tmp_path)
    with S.Transaction(spark, root) as run:
        run.write_table("a", numbers(spark, 1))
        run.write_months("t", numbers(spark, 1, 11), ["jan16", "feb16"])
        run.commit()
    table = S.read_table(spark, f"{root}/a")
    S.write_table(table.withColumn("id", F.col("id") + 1), f"{root}/a")
    assert rows(S.read_table(spark, f"{root}/a")) == {(2, "jan16"): 1}
    assert S.write_months(numbers(spark, 4), f"{root}/t", watch=True) == {"jan16"}
    assert rows(S.read_table(spark, f"{root}/t")) == {(4, "jan16"): 1, (11, "feb16"): 1}
    with pytest.raises(ValueError, match="append"):
        S.write_months(numbers(spark, 4), f"{root}/t", mode="append")
    # A reader that began before still reads what it began with.
    assert rows(table) == {(1, "jan16"): 1}


def test_months_in_a_plain_path_are_taken_in_and_never_hidden(spark, tmp_path):
    root = str(tmp_path)
    S.write_months(numbers(spark, 1, 11), f"{root}/t")
    with S.Transaction(spark, root) as run, pytest.raises(ValueError, match="adopt"):
        run.write_months("t", numbers(spark, 2), ["jan16"])
    assert S.adopt(spark, root, ["t", "u"]) == 1 and S.adopt(spark, root, ["t", "u"]) is None
    with S.Transaction(spark, root) as run:
        run.write_months("t", numbers(spark, 2), ["jan16"])
        run.commit()
    assert rows(S.read_table(spark, f"{root}/t")) == {(2, "jan16"): 1, (11, "feb16"): 1}


def test_old_snapshots_expire_with_what_only_they_have(spark, tmp_path):
    root = str(tmp_path)
    for value in range(1, 5):
        with S.Transaction(spark, root) as run:
            run.write_table("a", numbers(spark, value))
            run.write_months("t", numbers(spark, value, 10 + value) if value == 1 else numbers(spark, value), ["jan16", "feb16"] if value == 1 else ["jan16"])
            run.commit()
    open_run = S.Transaction(spark, root)
    open_run.write_table("a", numbers(spark, 9))
    gone = S.expire(spark, root, keep=2)
    assert len(gone) == 4 and sum(g.endswith("i94_dt=jan16") for g in gone) == 1
    assert rows(S.read_table(spark, f"{root}/a")) == {(4, "jan16"): 1}
    assert rows(S.snapshot(spark, root, 3).read(spark, "t")) == {(3, "jan16"): 1, (11, "feb16"): 1}
    assert len(listed(spark, f"{root}/_data/a")) == 3
    assert len(S.expire(spark, root, keep=1, orphans_after=-1)) == 3
    with pytest.raises(ValueError):
        S.expire(spark, root, keep=0)


def test_a_refresh_that_fails_keeps_all_tables(spark, raw, lake):
    before = contents(spark, lake, DIMENSIONS)

    def stop(name):
        if name == "us_airports_weather":
            raise InterruptedError

    other = S.RawLayout(raw.root, states="codes/country_code.csv", countries="codes/country_code.csv")
    with pytest.raises(InterruptedError):
        P.refresh_dimensions(spark, raw, lake, progress=stop)
    with pytest.raises((QualityError, ValueError)):
        P.refresh_dimensions(spark, other, lake)
    assert contents(spark, lake, DIMENSIONS) == before
    assert len(S.snapshot(spark, lake.root).tables) == len(DIMENSIONS) + 1


@pytest.mark.parametrize("table", MONTHLY)
def test_a_month_that_stops_anywhere_is_published_in_no_table(spark, raw, lake, tmp_path, table):
    P.run_months(spark, raw, lake, ["jan16", "feb16"])
    before = contents(spark, lake, MONTHLY)
    fewer = S.RawLayout(str(tmp_path / "fewer"))
    feeds.arrivals(spark, feeds.JANUARY[:2]).write.parquet(fewer.path("arrivals").format(month="jan16"))

    def stop(name):
        if name == table:
            raise InterruptedError

    with pytest.raises(InterruptedError):
        P.run_month(spark, fewer, lake, "jan16", progress=stop)
    assert contents(spark, lake, MONTHLY) == before
    P.run_month(spark, fewer, lake, "jan16")
    after = contents(spark, lake, MONTHLY)
    assert [sum(n for row, n in after[name].items() if "jan16" in row) for name in MONTHLY] == [2, 2, 2]


def test_a_month_is_written_once(spark, raw, lake):
    P.run_month(spark, raw, lake, "jan16")
    files = [f for f in os.popen(f"find {lake.root}/_data/immigrant -name '*.parquet'").read().split()]
    entry = S.snapshot(spark, lake.root).tables["immigrant"]
    assert len(files) == spark.read.parquet(*[f"{lake.root}/_data/immigrant/{folder}" for folder in entry.folders.values()]).inputFiles().__len__()
    assert not os.path.exists(lake.path("immigrant"))
    with open(f"{lake.root}/_snapshots/{2:020d}.json") as manifest:
        assert json.load(manifest)["tables"]["immigrant"]["folders"].keys() == {"jan16"}


def test_a_backfill_runs_only_what_changed(spark, raw, lake, tmp_path):
    own = S.RawLayout(str(tmp_path / "own"))
    months = ["jan16", "feb16", "mar16"]
    for month, people in zip(months, (feeds.JANUARY, feeds.FEBRUARY, feeds.JANUARY[:2])):
        feeds.arrivals(spark, people).write.parquet(own.path("arrivals").format(month=month))

    def ran(**options):
        reports = P.backfill(spark, own, lake, months, skip_unchanged=True, **options)
        return sorted({r["i94_dt"] for report in reports for r in report.collect()})

    assert ran() == sorted(months)
    assert ran() == [] and ran(together=3) == []
    feeds.arrivals(spark, feeds.JANUARY[:3]).write.mode("overwrite").parquet(own.path("arrivals").format(month="mar16"))
    assert ran() == ["mar16"] and ran() == []
    P.refresh_dimensions(spark, raw, lake)
    assert ran(together=2) == sorted(months)
    assert ran(per_row=True) == sorted(months)


def test_a_backfill_that_was_stopped_goes_on(spark, raw, lake):
    months, seen = ["jan16", "feb16", "mar16"], []

    def stop(name):
        seen.append(name)
        if len(seen) == 5:
            raise InterruptedError

    with pytest.raises(InterruptedError):
        P.backfill(spark, raw, lake, months, skip_unchanged=True, progress=stop)
    reports = P.backfill(spark, raw, lake, months, skip_unchanged=True)
    assert [report.first()["i94_dt"] for report in reports] == ["feb16", "mar16"]


def test_city_keys_are_kept(spark, raw, lake, tmp_path):
    city = rows(S.read_table(spark, lake.path("city")))
    P.refresh_dimensions(spark, raw, lake)
    assert rows(S.read_table(spark, lake.path("city"))) == city
    assert rows(S.read_table(spark, lake.path("city_key"))) == city


def test_references_of_the_lake(spark, raw, lake):
    P.run_months(spark, raw, lake, ["jan16", "feb16"])
    report = {r["reference"]: (r["n_rows"], r["n_null"], r["n_orphans"], r["n_orphan_keys"], r["status"]) for r in P.lake_orphans(spark, lake).collect()}
    assert report["immigrant.from_country_code in country_code"] == (9, 1, 1, 1, "FAIL")
    assert report["immigration.state_code in state_code"] == (9, 1, 1, 1, "FAIL")
    assert report["immigration.cicid+i94_dt in immigrant"] == (9, 1, 0, 0, "SUCCESS")
    assert report["us_cities_temperatures.city_id in city"][1:] == (1, 0, 0, "SUCCESS")
