"""Readers of the raw feeds.

Text feeds are read without type inference, which would cost a pass with a parser over
the files: the header gives the names, ``FEEDS`` the types of the columns the
builders use. Columns not listed there pass through as text. A feed may be of several files, each of which may have the columns in
an order of its own: the headers are gathered first, and there is one scan for each that differs.
"""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from landfall.sources.files import first_lines, matches

TEXT, INT, DOUBLE, DATE = StringType(), IntegerType(), DoubleType(), DateType()


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


@dataclass(frozen=True)
class Feed:
    separator: str
    schema: StructType


# Separators, column names and types of the text feeds.
FEEDS = {
    "states": Feed(",", _schema(("code", TEXT))),
    "countries": Feed(";", _schema(("code", INT), ("country", TEXT))),
    "airports": Feed(
        ",",
        _schema(
            ("ident", TEXT),
            ("name", TEXT),
            ("elevation_ft", INT),
            ("continent", TEXT),
            ("iso_country", TEXT),
            ("iso_region", TEXT),
            ("municipality", TEXT),
            ("gps_code", TEXT),
            ("iata_code", TEXT),
            ("local_code", TEXT),
            ("coordinates", TEXT),
        ),
    ),
    "demographics": Feed(
        ";",
        _schema(
            ("City", TEXT),
            ("State", TEXT),
            ("Median Age", DOUBLE),
            ("Male Population", DOUBLE),
            ("Female Population", DOUBLE),
            ("Total Population", DOUBLE),
            ("Number of Veterans", DOUBLE),
            ("Foreign-born", DOUBLE),
            ("Average Household Size", DOUBLE),
            ("State Code", TEXT),
            ("Race", TEXT),
            ("Count", DOUBLE),
        ),
    ),
    "temperatures": Feed(
        ",",
        _schema(
            ("dt", DATE),
            ("AverageTemperature", DOUBLE),
            ("AverageTemperatureUncertainty", DOUBLE),
            ("City", TEXT),
            ("Country", TEXT),
            ("Latitude", TEXT),
            ("Longitude", TEXT),
        ),
    ),
}

# The columns of a monthly arrivals file that the fact tables use.
ARRIVALS = _schema(
    ("cicid", DOUBLE),
    ("i94res", DOUBLE),
    ("i94bir", DOUBLE),
    ("i94visa", DOUBLE),
    ("visapost", TEXT),
    ("occup", TEXT),
    ("visatype", TEXT),
    ("biryear", DOUBLE),
    ("gender", TEXT),
    ("arrdate", DOUBLE),
    ("depdate", DOUBLE),
    ("dtaddto", TEXT),
    ("i94port", TEXT),
    ("i94addr", TEXT),
    ("airline", TEXT),
    ("admnum", DOUBLE),
    ("fltno", TEXT),
    ("entdepa", TEXT),
    ("entdepd", TEXT),
    ("entdepu", TEXT),
    ("matflag", TEXT),
)


#: Options of a delimited reader that decide what its lines are.
LINE_OPTIONS = ("encoding", "lineSep")


@dataclass(frozen=True)
class Header:
    """The column names of some files."""

    names: tuple[str, ...]
    files: tuple[str, ...]


def _escaped(path: str) -> str:
    """A file's path, such that no character of it is taken for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def headers(spark: SparkSession, paths: Sequence[str], separator: str = ",", quote: str = '"', **options: str) -> list[Header]:
    """The different headers of delimited files, each with its files. A file without any line has none.

    The driver reads the first line of each file and no more, so the cost grows with the number of files and not with their rows.
    """
    addresses = sorted(spark.read.options(**options).text(list(paths)).inputFiles())
    ends = options.get("lineSep")
    ends = None if ends is None else spark._jvm.org.apache.commons.lang3.StringUtils.getBytes(ends, options.get("encoding", "UTF-8"))
    alike: dict[str, list[str]] = {}
    for path, line in first_lines(spark, addresses, ends):
        if line is not None:
            alike.setdefault(line, []).append(_escaped(path))
    found: dict[tuple[str, ...], list[str]] = {}
    for line, files in alike.items():
        names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=separator, quotechar=quote))
        found.setdefault(tuple(names), []).extend(files)
    return [Header(names, tuple(files)) for names, files in found.items()]


def _text_schema(names: Sequence[str]) -> StructType:
    return StructType([StructField(name, TEXT, True) for name in names])


def _texts(spark: SparkSession, path: str, schema: StructType, separator: str) -> DataFrame:
    """All columns of a delimited feed as text, by name. A file that lacks a column of ``schema`` raises ``ValueError``."""
    reader = spark.read.option("header", True).option("sep", separator)
    whole = reader.csv(path)
    files = whole.inputFiles()
    if len(files) < 2:
        _require(schema, whole.columns, path)
        return whole
    found = headers(spark, [path], separator)
    for header in found:
        _require(schema, header.names, f"{header.files[0]} and {len(header.files) - 1} more files" if len(header.files) > 1 else header.files[0])
    if len(found) < 2:
        return whole
    scans = [reader.schema(_text_schema(h.names)).csv(list(h.files)) for h in found]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _require(schema: StructType, names: Sequence[str], where: str) -> None:
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{where} lacks the columns {missing}")


def read_csv(spark: SparkSession, path: str, schema: StructType, separator: str = ",") -> DataFrame:
    """Delimited files with a header, their columns typed by name, in any order that each file has them in.

    A column that only some files have is null in the others, but those of ``schema`` must be in every file.
    """
    text = _texts(spark, path, schema, separator)
    types = {f.name: f.dataType for f in schema.fields}
    return text.select(
        *[
            F.col(f"`{name}`").try_cast(types[name]).alias(name)
            if name in types and types[name] != TEXT
            else F.col(f"`{name}`")
            for name in text.columns
        ]
    )


def unread_report(spark: SparkSession, path: str, schema: StructType, separator: str = ",") -> DataFrame:
    """For each typed column of a delimited file, how many texts there are and how many its type cannot read."""
    text = _texts(spark, path, schema, separator)
    typed = [f for f in schema.fields if f.dataType != TEXT]
    counts = []
    for i, f in enumerate(typed):
        filled = F.trim(F.col(f"`{f.name}`")) != ""
        counts += [F.count_if(filled).alias(f"n{i}"), F.count_if(filled & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f"u{i}")]
    rows = [F.struct(F.lit(f.name).alias("column"), F.col(f"n{i}").alias("n_texts"), F.col(f"u{i}").alias("n_unread")) for i, f in enumerate(typed)]
    return text.agg(*counts).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def read_feed(spark: SparkSession, feed: str, path: str) -> DataFrame:
    return read_csv(spark, path, FEEDS[feed].schema, FEEDS[feed].separator)


def _months(months: str | Sequence[str]) -> list[str]:
    keys = [months] if isinstance(months, str) else list(months)
    if not keys:
        raise ValueError("no months given")
    if len(set(keys)) < len(keys):
        raise ValueError(f"months given twice: {sorted({k for k in keys if keys.count(k) > 1})}")
    return keys


def _month_of(template: str, keys: Sequence[str], path: Column) -> Column:
    """The month of a file by its address, which holds the template's path from the folder with ``{month}`` on."""

    def pattern(text: str) -> str:
        # A file system may write other characters, such as a space, in its own way.
        return re.sub(r"[^A-Za-z0-9_./=-]+", "[^/]*", text).replace(".", "\\.")

    before, _, after = template.partition("{month}")
    one = "|".join(re.escape(key) for key in sorted(keys, key=len, reverse=True))
    found = F.regexp_extract(path, f"/{pattern(before.rpartition('/')[2])}({one}){pattern(after.rstrip('/'))}(?:/|$)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.raise_error(F.concat(F.lit("no month in "), path)).cast("string"))


def read_arrivals(
    spark: SparkSession,
    template: str,
    months: str | Sequence[str],
    file_format: str = "parquet",
    **options: str,
) -> DataFrame:
    """The arrivals of one or more months, each row tagged with its month.

    ``template`` holds ``{month}`` once. Months whose files have the same columns are one scan, however many they are, and
    the file that a row comes from tells its month. A task reads files of few months, so the month-partitioned write
    that follows needs no shuffle. ``file_format`` names any installed data source and ``options`` go to it; one
    that does not tell the file of a row gives a scan for each month.
    The columns of ``ARRIVALS`` are found by name and typed as they are in each month, in delimited files as in each file; others are
    left out. A month that lacks one, and a month that is given twice, raise ``ValueError``.
    """
    keys = _months(months)
    reader = spark.read.format(file_format).options(**options)
    paths = {key: template.format(month=key) for key in keys}
    if file_format == "csv" and str(options.get("header", "")).lower() == "true":
        lines = {k: v for k, v in options.items() if k in LINE_OPTIONS}
        found = headers(spark, list(paths.values()), options.get("sep", ","), options.get("quote", '"'), **lines)
        for header in found:
            _require(ARRIVALS, header.names, f"{header.files[0]} of the arrivals")
        groups = [(_text_schema(h.names), list(h.files), keys) for h in found]
        if not groups:
            raise ValueError(f"the arrivals of {keys} have no lines")
    else:
        groups = _alike(reader, paths)
    scans = []
    for schema, files, members in groups:
        if len(members) == 1:
            scan = (reader.load if schema is None else reader.schema(schema).load)(files).withColumn("__month", F.lit(members[0]))
        else:
            scan = reader.schema(schema).load(files)
            scan = scan.select("*", _month_of(template, members, F.col("_metadata.file_path")).alias("__month"))
        typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in ARRIVALS.fields]
        scans.append(scan.select(*typed, F.col("__month").alias("i94_dt")))
    return reduce(lambda a, b: a.unionByName(b), scans)


def _alike(reader: DataFrameReader, paths: dict[str, str]) -> list[tuple[StructType | None, list[str], list[str]]]:
    """The months in groups that one scan can read: the schema, the paths and the months of each."""
    alike: dict[str, list[str]] = {}
    for key, path in paths.items():
        scan = reader.load(path)
        _require(ARRIVALS, scan.columns, f"the month {key} of the arrivals")
        kinds = scan.select(*[F.col(f"`{f.name}`") for f in ARRIVALS.fields]).schema
        try:
            scan.select("_metadata.file_path")
        except AnalysisException:
            alike[key] = [key]
        else:
            alike.setdefault(kinds.json(), []).append(key)
    return [
        (None if len(members) == 1 else StructType.fromJson(json.loads(kind)), [paths[key] for key in members], members)
        for kind, members in alike.items()
    ]


def fingerprints(spark: SparkSession, template: str, months: Sequence[str]) -> dict[str, str]:
    """For each month what its files are like: how many, and a digest of their names, lengths and times. No file is opened.

    A month without files has none.
    """
    present = [key for key in _months(months) if matches(spark, template.format(month=key))]
    if not present:
        return {}
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = reader.load([template.format(month=key) for key in present]).select("path", "length", "modificationTime")
    one = F.xxhash64(F.element_at(F.split("path", "/"), -1), "length", "modificationTime").cast("decimal(38,0)")
    counted = files.groupBy(_month_of(template, present, F.col("path")).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("size"), F.sum(one).alias("digest")
    )
    return {r["month"]: f"{r['n']} files, {r['size']} bytes, {r['digest']}" for r in counted.collect()}
