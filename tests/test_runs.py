import datetime as dt

import feeds
import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from landfall import plans as P
from landfall import sources as S
from landfall.__main__ import main
from landfall.operators import QualityError, key_report, month_report, require_pass, table_report
from landfall.sources.feeds import FEEDS, read_csv
from landfall.sources.layout import DIMENSIONS, MONTHLY
from landfall.sources.scratch import scratch_path, scratch_root


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return feeds.file_raw(spark, tmp_path_factory.mktemp("raw"))


@pytest.fixture
def lake(spark, raw, tmp_path):
    layout = S.LakeLayout(str(tmp_path / "lake"))
    P.refresh_dimensions(spark, raw, layout)
    return layout


def table(spark, lake, name):
    return S.read_table(spark, lake.path(name))


def contents(spark, lake):
    return {name: rows(table(spark, lake, name)) for name in MONTHLY}


def test_csv_is_read_by_name_in_any_order(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("extra;country;code\nfoo;MEXICO;582\nbar;;no number\n")
    got = read_csv(spark, str(path), FEEDS["countries"].schema, ";")
    assert got.dtypes == [("extra", "string"), ("country", "string"), ("code", "int")]
    assert rows(got) == {("foo", "MEXICO", 582): 1, ("bar", None, None): 1}


def test_csv_without_a_needed_column_is_refused(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("code\n1\n")
    with pytest.raises(ValueError, match="country"):
        read_csv(spark, str(path), FEEDS["countries"].schema, ";")


def test_arrivals_carry_their_month(spark, raw):
    both = S.read_arrivals(spark, raw.path("arrivals"), ["jan16", "feb16"])
    assert rows(both.groupBy("i94_dt").count()) == {("jan16", 7): 1, ("feb16", 2): 1}
    assert S.read_arrivals(spark, raw.path("arrivals"), "feb16").count() == 2
    with pytest.raises(ValueError):
        S.read_arrivals(spark, raw.path("arrivals"), [])


def test_months_are_replaced_or_appended(spark, tmp_path):
    path = str(tmp_path / "t")
    two = spark.createDataFrame([(1, "jan16"), (2, "jan16"), (3, "feb16")], "id int, i94_dt string")
    january = two.filter("i94_dt = 'jan16'")
    assert S.write_months(two, path, rebalance=True, watch=True) == {"jan16", "feb16"}
    assert S.write_months(january.filter("id = 1"), path, watch=True) == {"jan16"}
    assert rows(S.read_table(spark, path)) == {(1, "jan16"): 1, (3, "feb16"): 1}
    S.write_months(january, path, mode="append")
    assert rows(S.read_table(spark, path)) == {(1, "jan16"): 2, (2, "jan16"): 1, (3, "feb16"): 1}
    assert S.write_months(two.filter("id > 9"), path, watch=True) == set()
    assert S.read_table(spark, path).count() == 4
    with pytest.raises(ValueError):
        S.write_months(two, path, mode="upsert")


def test_month_scan_opens_its_partition_only(spark, tmp_path):
    path = str(tmp_path / "t")
    S.write_months(spark.createDataFrame([(1, "jan16"), (3, "feb16")], "id int, i94_dt string"), path)
    one = S.read_months(spark, path, "jan16")
    assert rows(one) == {(1, "jan16"): 1}
    assert "PartitionFilters: [isnotnull(i94_dt" in plan(one)
    assert rows(S.read_months(spark, path, ["jan16", "feb16"])) == {(1, "jan16"): 1, (3, "feb16"): 1}


def test_refresh_builds_and_checks_all_dimensions(spark, raw, lake):
    report = P.refresh_dimensions(spark, raw, lake)
    found = {r["table"]: (r["n_rows"], r["status"]) for r in report.collect()}
    assert found == {
        "city": (6, "SUCCESS"),
        "state_code": (3, "SUCCESS"),
        "country_code": (3, "SUCCESS"),
        "airport_code": (7, "SUCCESS"),
        "us_cities_demographics": (6, "SUCCESS"),
        "us_cities_temperatures": (4, "SUCCESS"),
        "us_airports_weather": (4, "SUCCESS"),
    }
    assert set(found) == set(DIMENSIONS)


def test_refresh_with_an_empty_table_stops(spark, raw, tmp_path):
    with pytest.raises(QualityError, match="us_cities_temperatures"):
        P.refresh_dimensions(spark, raw, S.LakeLayout(str(tmp_path)), after=dt.date(2020, 1, 1))


def test_a_month_run_twice_is_a_month_run_once(spark, raw, lake):
    report = P.run_month(spark, raw, lake, "jan16")
    assert {(r["table"], r["i94_dt"], r["n_rows"]) for r in report.collect()} == {
        ("immigrant", "jan16", 7),
        ("immigration", "jan16", 7),
        ("immigration_demographic", "jan16", 4),
    }
    once = contents(spark, lake)
    P.run_month(spark, raw, lake, "jan16")
    assert contents(spark, lake) == once


def test_state_figures_are_computed_once_in_a_run(spark, raw, lake, monkeypatch):
    from landfall.plans import runs

    read, build = [], runs.immigration_demographic

    def watched(*tables, **options):
        mart = build(*tables, **options)
        read.extend(mart.inputFiles())
        return mart

    monkeypatch.setattr(runs, "immigration_demographic", watched)
    P.run_month(spark, raw, lake, "jan16")
    assert any("/state_figures/" in f for f in read) and any("/immigrant/" in f for f in read)
    assert not any("/us_cities_demographics/" in f or "/city/" in f for f in read)
    assert rows(table(spark, lake, "immigration_demographic")) == rows(
        build(*[table(spark, lake, t) for t in ("immigrant", "immigration", "country_code", "state_code", "city", "us_cities_demographics")])
    )


def test_a_lake_without_state_figures_gives_an_empty_mart(spark, raw, lake):
    S.write_table(table(spark, lake, "us_cities_demographics").limit(0), lake.path("us_cities_demographics"))
    P.run_month(spark, raw, lake, "jan16", gate=False)
    assert table(spark, lake, "immigrant").count() == 7 and table(spark, lake, "immigration_demographic").count() == 0


def test_other_months_stay(spark, raw, lake):
    P.run_month(spark, raw, lake, "jan16")
    january = contents(spark, lake)
    P.run_month(spark, raw, lake, "feb16")
    both = contents(spark, lake)
    assert all(both[name] & january[name] == january[name] for name in MONTHLY)
    assert sum(both["immigrant"].values()) == 9
    trips = table(spark, lake, "immigration").filter("i94_dt = 'feb16'")
    assert {r["cicid"] for r in trips.collect()} == {1, 8}


def test_months_given_twice_are_refused(spark, raw, lake):
    for run in (P.run_months, P.backfill):
        with pytest.raises(ValueError, match="twice"):
            run(spark, raw, lake, ["jan16", "jan16"])
    with pytest.raises(ValueError, match="twice"):
        S.read_arrivals(spark, raw.path("arrivals"), ["jan16", "feb16", "jan16"])


def test_each_month_is_read_as_declared(spark, raw, lake, tmp_path):
    drifted = S.RawLayout(str(tmp_path / "drifted"))
    full = S.read_arrivals(spark, raw.path("arrivals"), "jan16").drop("i94_dt")
    full.withColumn("extra", F.lit(1)).withColumn("cicid", F.col("cicid").cast("string")).write.parquet(drifted.path("arrivals").format(month="jan16"))
    full.drop("gender").write.parquet(drifted.path("arrivals").format(month="feb16"))
    assert S.read_arrivals(spark, drifted.path("arrivals"), "jan16").schema == S.read_arrivals(spark, raw.path("arrivals"), "jan16").schema
    for months in ("feb16", ["jan16", "feb16"]):
        with pytest.raises(ValueError, match="feb16.*gender"):
            S.read_arrivals(spark, drifted.path("arrivals"), months)


def test_a_row_format_with_options_gives_the_same_lake(spark, raw, lake, tmp_path):
    P.run_month(spark, raw, lake, "jan16")
    once = contents(spark, lake)
    text = S.RawLayout(str(tmp_path / "text"), arrivals_format="csv", arrivals_options={"header": "true", "sep": "|"})
    january = S.read_arrivals(spark, raw.path("arrivals"), "jan16").drop("i94_dt")
    january.write.option("header", True).option("sep", "|").csv(text.path("arrivals").format(month="jan16"))
    P.run_month(spark, text, lake, "jan16")
    assert contents(spark, lake) == once


@pytest.mark.parametrize("together", [1, 2, 3])
def test_backfill_equals_single_months(spark, raw, lake, tmp_path, together):
    months = ["jan16", "feb16", "mar16"]
    other = S.LakeLayout(lake.root, *[f"b/{getattr(lake, n)}" if n in MONTHLY else getattr(lake, n) for n in (*DIMENSIONS, *MONTHLY)])
    for month in months:
        P.run_month(spark, raw, lake, month)
    reports = P.backfill(spark, raw, other, months, together=together)
    assert len(reports) == -(-3 // together)
    assert contents(spark, other) == contents(spark, lake)


def test_an_empty_month_stops_the_run_and_keeps_the_lake(spark, raw, lake, tmp_path):
    P.run_month(spark, raw, lake, "jan16")
    before = contents(spark, lake)
    empty = S.RawLayout(str(tmp_path / "empty"))
    feeds.arrivals(spark, []).write.parquet(empty.path("arrivals").format(month="jan16"))
    with pytest.raises(QualityError, match="arrivals"):
        P.run_month(spark, empty, lake, "jan16")
    assert contents(spark, lake) == before


def test_a_month_without_mart_rows_is_published_whole_or_not_at_all(spark, raw, lake, tmp_path):
    P.run_months(spark, raw, lake, ["jan16", "feb16"])
    before = contents(spark, lake)
    bare = S.RawLayout(str(tmp_path / "r"))
    feeds.arrivals(spark, feeds.JANUARY[2:4]).write.parquet(bare.path("arrivals").format(month="jan16"))
    with pytest.raises(QualityError, match="immigration_demographic"):
        P.run_month(spark, bare, lake, "jan16")
    assert contents(spark, lake) == before
    report = P.run_month(spark, bare, lake, "jan16", gate=False)
    assert {(r["table"], r["n_rows"], r["status"]) for r in report.collect()} == {
        ("immigrant", 2, "SUCCESS"),
        ("immigration", 2, "SUCCESS"),
        ("immigration_demographic", 0, "FAIL"),
    }
    mart = table(spark, lake, "immigration_demographic")
    assert rows(mart.select("i94_dt").distinct()) == {("feb16",): 1}
    assert not list((tmp_path / "lake" / "_runs").iterdir())


def test_reports(spark):
    full, none = spark.range(3), spark.range(0)
    report = table_report({"full": full, "none": none})
    assert rows(report) == {("full", 1, 3, "SUCCESS"): 1, ("none", 1, 0, "FAIL"): 1}
    with pytest.raises(QualityError, match="none"):
        require_pass(report)
    monthly = full.withColumn("i94_dt", F.when(F.col("id") < 2, "jan16").otherwise("feb16"))
    assert rows(month_report({"t": monthly}, ["jan16", "mar16"])) == {
        ("t", "jan16", 2, 2, "SUCCESS"): 1,
        ("t", "mar16", 2, 0, "FAIL"): 1,
    }
    assert rows(month_report({"t": monthly}, ["jan16", "feb16"], {"t": {"feb16"}})) == {
        ("t", "jan16", 2, 0, "FAIL"): 1,
        ("t", "feb16", 2, 1, "SUCCESS"): 1,
    }
    keyed = key_report({"good": (full, "id"), "twice": (full.union(full), "id"), "none": (none, "id")})
    assert rows(keyed) == {("good", 3, 3, "SUCCESS"): 1, ("twice", 6, 3, "FAIL"): 1, ("none", 0, 0, "SUCCESS"): 1}


def test_scratch_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and a != b
    assert spark.sparkContext.applicationId in a


def test_command_line(spark, raw, tmp_path, capsys):
    base = ["--raw", raw.root, "--lake", str(tmp_path / "lake")]
    main([*base, "refresh"])
    main([*base, "month", "jan16"])
    main([*base, "backfill", "2016-02", "2016-03", "--together", "2"])
    assert "SUCCESS" in capsys.readouterr().out
    main([*base, "backfill", "2016-02", "2016-03", "--skip-unchanged"])
    main([*base, "backfill", "2016-02", "2016-03", "--skip-unchanged"])
    assert capsys.readouterr().out.count("immigration_demographic") == 2
    main(["--lake", base[3], "references"])
    assert "immigration.state_code in state_code" in capsys.readouterr().out
    main(["--lake", base[3], "expire", "--keep", "1"])
    assert "removed immigrant/run=" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["--lake", base[3], "month", "jan16"])
    lake = S.LakeLayout(str(tmp_path / "lake"))
    months = table(spark, lake, "immigration_demographic").select("i94_dt").distinct()
    assert rows(months) == {("jan16",): 1, ("feb16",): 1, ("mar16",): 1}
