"""Hand-written raw feeds."""

import datetime as dt
import math

from landfall.sources.feeds import ARRIVALS, FEEDS

AIRPORTS = [
    # ident, name, elevation_ft, continent, iso_country, iso_region, municipality, gps, iata, local, coordinates
    ("KPIT", "Pittsburgh Intl", 1203, "NA", "US", "US-PA", "Pittsburgh", "KPIT", "PIT", "PIT", "40.49, -80.23"),
    ("KAGC", "Allegheny County", 1252, "NA", "US", "US-PA", "Pittsburgh", "KAGC", "AGC", "AGC", "40.35, -79.93"),
    ("KSPI", "Abraham Lincoln", 598, "NA", "US", "US-IL", "Springfield", "KSPI", "SPI", "SPI", "39.84, -89.67"),
    ("KCEF", "Westover", 241, "NA", "US", "US-MA", "Springfield", "KCEF", "CEF", "CEF", "42.19, -72.53"),
    ("KFLY", "Lone Strip", 10, "NA", "US", "US-WY", "Flyover", "KFLY", None, None, "bad text"),
    ("KNOC", "Nowhere Field", None, "NA", "US", "US-WY", None, None, None, None, None),
    ("KNOR", "No Region", 5, "NA", "US", None, "Lostville", None, None, None, "1"),
    ("CYYZ", "Toronto Pearson", 569, "NA", "CA", "CA-ON", "Toronto", "CYYZ", "YYZ", None, "43.67, -79.63"),
]

DEMOGRAPHICS = [
    # City, State, Median Age, Male, Female, Total, Veterans, Foreign-born, Household, State Code, Race, Count
    ("Pittsburgh", "Pennsylvania", 32.9, 149690.0, 154695.0, 304385.0, 17728.0, 28187.0, 2.13, "PA", "White", 208863.0),
    ("Pittsburgh", "Pennsylvania", 32.9, 149690.0, 154695.0, 304385.0, 17728.0, 28187.0, 2.13, "PA", "Asian", 22466.0),
    ("Pittsburgh", "Pennsylvania", 32.9, 149690.0, 154695.0, 304385.0, 17728.0, 28187.0, 2.13, "PA", "Black", 77056.0),
    ("Erie", "Pennsylvania", 33.1, 48000.0, 51000.0, 99000.0, 5000.0, None, 2.3, "PA", "White", 80000.0),
    ("Springfield", "Illinois", 38.8, 55639.0, 62170.0, 117809.0, 7525.0, 4264.0, 2.22, "IL", "White", 91000.0),
    ("Springfield", "Massachusetts", 31.8, 74744.0, 79592.0, 154336.0, 5723.0, 16226.0, 2.81, "MA", "White", 80000.0),
    (None, "Pennsylvania", 30.0, 1.0, 1.0, 2.0, 0.0, 0.0, 1.0, "PA", "White", 2.0),
]

TEMPERATURES = [
    # dt, AverageTemperature, uncertainty, City, Country, Latitude, Longitude
    (dt.date(2013, 8, 1), 20.1, 0.5, "Pittsburgh", "United States", "40.99N", "80.95W"),
    (dt.date(2013, 9, 1), 17.2, 0.6, "Pittsburgh", "United States", "40.99N", "80.95W"),
    (dt.date(2013, 9, 1), 18.9, 1.2, "Springfield", "United States", "39.38N", "89.48W"),
    (dt.date(2013, 9, 1), None, None, "Erie", "United States", "42.59N", "80.95W"),
    (dt.date(2013, 9, 1), 12.0, 0.4, "Pittsburgh", "Elsewhere", "1.0S", "2.0E"),
    (dt.date(2013, 9, 1), 9.5, 0.3, "Unlisted", "United States", "50.0S", "3.0E"),
]

STATES = [("PA", "Pennsylvania"), ("IL", "Illinois"), ("99", "All Other Codes")]
COUNTRIES = [(245, "CHINA, PRC"), (582, "MEXICO"), (403, "INVALID: PANAMA")]


def person(number, **values):
    base = dict(
        cicid=float(number),
        i94res=245.0,
        i94bir=40.0,
        i94visa=2.0,
        visapost="SHG",
        occup=None,
        visatype="B2",
        biryear=1976.0,
        gender="F",
        arrdate=20454.0,
        depdate=20460.0,
        dtaddto="06302016",
        i94port="PIT",
        i94addr="PA",
        airline="AA",
        admnum=9.2e10,
        fltno="123",
        entdepa="G",
        entdepd="O",
        entdepu=None,
        matflag="M",
    )
    base.update(values)
    return tuple(base[f.name] for f in ARRIVALS.fields)


JANUARY = [
    person(1),
    person(2, i94addr="IL", i94res=582.0, dtaddto="D/S"),
    person(3, i94addr=None, depdate=None),
    person(4, i94addr="99"),
    person(5, i94res=999.0, dtaddto="02302016", arrdate=20454.9),
    person(6, i94addr="MA", i94res=403.0, arrdate=math.nan, depdate=1e12, dtaddto=None),
    person(7, i94res=None, cicid=None),
]
FEBRUARY = [person(1, gender="M", i94bir=math.nan), person(8, dtaddto="1012016", depdate=-1.0)]


def feed(spark, name, rows):
    return spark.createDataFrame(rows, FEEDS[name].schema)


def airports(spark):
    return feed(spark, "airports", AIRPORTS)


def demographics(spark):
    return feed(spark, "demographics", DEMOGRAPHICS)


def temperatures(spark):
    return feed(spark, "temperatures", TEMPERATURES)


def states(spark):
    return spark.createDataFrame(STATES, "code string, state string")


def countries(spark):
    return spark.createDataFrame(COUNTRIES, "code int, country string")


def arrivals(spark, rows):
    return spark.createDataFrame(rows, ARRIVALS)


def file_raw(spark, root):
    """The feeds as files below ``root``; the layout that reads them."""
    from landfall.sources import RawLayout

    raw = RawLayout(str(root))
    for name, build, separator in [
        ("airports", airports, ","),
        ("states", states, ","),
        ("countries", countries, ";"),
        ("demographics", demographics, ";"),
        ("temperatures", temperatures, ","),
    ]:
        build(spark).write.option("header", True).option("sep", separator).csv(raw.path(name))
    for month, rows in (("jan16", JANUARY), ("feb16", FEBRUARY), ("mar16", JANUARY[:2])):
        arrivals(spark, rows).write.parquet(raw.path("arrivals").format(month=month))
    return raw
