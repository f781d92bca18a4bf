"""Feeds of several files and of many months."""

import gzip

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from landfall import sources as S
from landfall.sources.feeds import ARRIVALS, FEEDS, _month_of, fingerprints, headers, read_csv, unread_report

import feeds

SCHEMA = FEEDS["countries"].schema


def write(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_files_may_order_their_columns_differently(spark, tmp_path):
    path = write(tmp_path / "c[1] {x}", a="code;country\n1;ONE\n", b="n;code;country\n7;2;beta\n", c="country;n;code\nTHREE;;3\n", d="code;country\n4;\n", e="")
    got = read_csv(spark, path.replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}"), SCHEMA, ";")
    assert got.dtypes == [("code", "int"), ("country", "string"), ("n", "string")]
    assert rows(got) == {(1, "ONE", None): 1, (2, "beta", "7"): 1, (3, "THREE", None): 1, (4, None, None): 1}
    text = plan(got)
    assert text.count("FileScan csv") == 3


def test_a_lacking_column_names_the_file(spark, tmp_path):
    path = write(tmp_path / "c", a="code;country\n1;ONE\n", b="code;nation\n2;beta\n")
    with pytest.raises(ValueError, match="b.csv.*country"):
        read_csv(spark, path, SCHEMA, ";")


def test_quoted_headers_and_blank_first_lines(spark, tmp_path):
    path = write(tmp_path / "c", a='"code";"the; country"\n1;ONE\n', b='\n"the; country";code\nTWO;2\n')
    found = headers(spark, [path], ";")
    assert [h.names for h in found] == [("code", "the; country"), ("the; country", "code")]
    assert [len(h.files) for h in found] == [1, 1]
    same = write(tmp_path / "d", a='"code";"country"\n1;ONE\n', b="code;country\n2;TWO\n")
    assert [(h.names, len(h.files)) for h in headers(spark, [same], ";")] == [(("code", "country"), 2)]


def test_headers_read_first_lines_only(spark, tmp_path):
    path = write(tmp_path / "c", a="code;country\n1;ONE\n", b="code;country\n" + "2;two\n" * 100_000, c="country;code\n" + "three;3\n" * 100_000)
    spark.sparkContext.setJobGroup("headers-only", "headers of three files")
    try:
        found = headers(spark, [path], ";")
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            spark.sparkContext.setLocalProperty(key, None)
    assert [(h.names, len(h.files)) for h in found] == [(("code", "country"), 2), (("country", "code"), 1)]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("headers-only")


def test_headers_of_odd_files(spark, tmp_path):
    folder = tmp_path / "c"
    folder.mkdir()
    odd = {
        "a 1.csv": b"\xef\xbb\xbfcode;country\r\n1;ONE\r\n",
        "b%41.csv": b"\xef\xbb\xbf\n  \ncountry;code\n",
        "c[1].csv.gz": gzip.compress(b"code;country\n1;ONE\n"),
        "d.csv": b"",
        "e.csv": b"\n \n",
        "f.csv": b"country;code",
        "_hidden.csv": b"x;y\n",
    }
    for name, content in odd.items():
        (folder / name).write_bytes(content)
    found = {h.names: [f.rpartition("/")[2] for f in h.files] for h in headers(spark, [str(folder)], ";")}
    assert found == {("code", "country"): ["a 1.csv", "c\\[1\\].csv.gz"], ("country", "code"): ["b%41.csv", "f.csv"]}
    ended = write(tmp_path / "d", a="code;country||1;ONE||", b=" ||country;code||TWO;2||")
    assert [h.names for h in headers(spark, [ended], ";", lineSep="||")] == [("code", "country"), ("country", "code")]


def test_unread_texts_of_several_files(spark, tmp_path):
    path = write(tmp_path / "c", a="code;country\nx;ONE\n", b="country;code\ny;2\n")
    assert rows(unread_report(spark, path, SCHEMA, ";")) == {("code", 2, 1): 1}


def arrivals_of(spark, root, months, people=feeds.FEBRUARY):
    raw = S.RawLayout(str(root))
    feeds.arrivals(spark, people).coalesce(1).write.parquet(raw.path("arrivals").format(month=months[0]))
    import shutil

    for month in months[1:]:
        shutil.copytree(raw.path("arrivals").format(month=months[0]), raw.path("arrivals").format(month=month))
    return raw


def test_two_hundred_months_are_as_many_scans_as_schemas(spark, tmp_path):
    months = [f"m{i:03d}" for i in range(200)]
    raw = arrivals_of(spark, tmp_path, months[:150])
    first = spark.read.parquet(raw.path("arrivals").format(month="m000"))
    other = first.withColumn("cicid", F.col("cicid").cast("int")).withColumn("more", F.lit(1)).coalesce(1)
    other.write.parquet(raw.path("arrivals").format(month="m150"))
    import shutil

    for month in months[151:]:
        shutil.copytree(raw.path("arrivals").format(month="m150"), raw.path("arrivals").format(month=month))
    read = S.read_arrivals(spark, raw.path("arrivals"), months)
    assert plan(read).count("FileScan parquet") == 2
    assert rows(read.groupBy("i94_dt").count()) == {(month, 2): 1 for month in months}
    assert read.dtypes == S.read_arrivals(spark, raw.path("arrivals"), "m000").dtypes


def test_delimited_months_with_differing_headers(spark, tmp_path):
    raw = S.RawLayout(str(tmp_path), arrivals="a b/i94_dt={month}")
    names = [f.name for f in ARRIVALS.fields]
    for month, columns in (("jan16", names), ("feb16", names[::-1]), ("mar16", [*names, "more"])):
        people = feeds.arrivals(spark, feeds.JANUARY[:2]).withColumn("more", F.lit("x")).select(*columns)
        people.repartition(2).write.option("header", True).option("sep", "|").csv(raw.path("arrivals").format(month=month))
    options = {"header": "true", "sep": "|"}
    whole = S.read_arrivals(spark, raw.path("arrivals"), ["jan16", "feb16", "mar16"], "csv", **options)
    assert rows(whole.groupBy("i94_dt").count()) == {(m, 2): 1 for m in ("jan16", "feb16", "mar16")}
    assert len(set(rows(whole.drop("i94_dt")))) == 2
    one = S.read_arrivals(spark, raw.path("arrivals"), "feb16", "csv", **options)
    assert rows(one) == rows(whole.filter("i94_dt = 'feb16'"))


def test_the_month_is_found_in_the_address(spark):
    paths = ["file:/x/i94_jan16_sub/part-0", "s3a://b/in%20put/i94_jan16_sub", "file:/x/i94_jan161_sub/part", "file:/x/i94_feb16_sub/p"]
    table = spark.createDataFrame([(p,) for p in paths if "jan161" not in p], "p string")
    months = table.select(_month_of("/x/in put/i94_{month}_sub", ["jan16", "feb16"], F.col("p")).alias("m"))
    assert [r["m"] for r in months.collect()] == ["jan16", "jan16", "feb16"]
    with pytest.raises(Exception, match="no month in"):
        spark.createDataFrame([(paths[2],)], "p string").select(_month_of("i94_{month}_sub", ["jan16"], F.col("p"))).collect()


def test_fingerprints_follow_names_lengths_and_times(spark, tmp_path):
    import os

    raw = arrivals_of(spark, tmp_path, ["jan16", "feb16"])
    template = raw.path("arrivals")
    first = fingerprints(spark, template, ["jan16", "feb16", "mar16"])
    assert first.keys() == {"jan16", "feb16"} and fingerprints(spark, template, ["mar16"]) == {}
    assert fingerprints(spark, template, ["jan16", "feb16"]) == first
    folder = template.format(month="feb16")
    part = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    os.utime(f"{folder}/{part}", (1, 1))
    later = fingerprints(spark, template, ["jan16", "feb16"])
    assert later["jan16"] == first["jan16"] and later["feb16"] != first["feb16"]
