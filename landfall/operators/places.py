"""The nearest of some sites, found by a grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATITUDE, LONGITUDE = "latitude", "longitude"


def _round(longitude: Column) -> Column:
    """A longitude between 0 and 360."""
    return longitude - 360 * F.floor(longitude / 360)


def nearest_site(points: DataFrame, sites: DataFrame, on: Sequence[str], pick: str, *, reach: float) -> DataFrame:
    """``on``, the position and ``pick`` of the nearest site, for each different point that has one in reach.

    Points and sites have ``latitude``, ``longitude`` and the columns ``on``, which must be equal. A site is in reach within ``reach``
    degrees of latitude and of longitude, also across the date line. Distance is that on a plane that touches at the point; of
    equally near sites the one with the smallest ``pick`` counts. A null position or key has none.

    The globe is divided into cells a little larger than the reach, and a site stands in its own and the cells around it. So a
    point meets the sites of its cell only, in an equi-join, and partial minima go before the one shuffle that follows.
    """
    if not 0 < reach <= 180:
        raise ValueError("reach is between 0 and 180 degrees")
    on, around = list(on), int(360 // reach)
    width = 360 / around
    row = F.floor(F.col(LATITUDE) / reach)
    column = F.least(F.floor(_round(F.col(LONGITUDE)) / width), F.lit(around - 1))
    steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
    asked = points.select(*on, LATITUDE, LONGITUDE).dropna().distinct().withColumns({"__row": row, "__column": column})
    placed = sites.select(*on, F.col(LATITUDE), F.col(LONGITUDE), F.col(pick)).dropna()
    spread = placed.withColumns({"__rows": F.transform(steps, lambda s: row + s), "__columns": F.array_distinct(F.transform(steps, lambda s: F.pmod(column + s, F.lit(around))))})
    spread = spread.withColumn("__row", F.explode("__rows")).withColumn("__column", F.explode("__columns"))
    near = spread.select(*on, "__row", "__column", F.col(LATITUDE).alias("__latitude"), F.col(LONGITUDE).alias("__longitude"), F.col(pick).alias("__pick"))
    north = F.abs(F.col(LATITUDE) - F.col("__latitude"))
    east = F.col(LONGITUDE) - F.col("__longitude")
    east = F.abs(east - 360 * F.floor((east + 180) / 360))
    flat = F.cos(F.radians(LATITUDE)) * east
    met = asked.join(near, [*on, "__row", "__column"]).filter((north <= reach) & (east <= reach))
    best = met.groupBy(*on, LATITUDE, LONGITUDE).agg(F.min(F.struct((north * north + flat * flat).alias("distance"), "__pick")).alias("best"))
    return best.select(*on, LATITUDE, LONGITUDE, F.col("best.__pick").alias(pick))
