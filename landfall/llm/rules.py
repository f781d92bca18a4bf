"""Quality rules with thresholds that follow the language and source of a document.

Every document that passes the base rules adds its figures to the sketches of its language and
source: counts of values in bins that grow by a fixed ratio, so a quantile is off by at most that ratio.
Sketches merge by adding counts, in any order, so a group of any size is combined within tasks before
the shuffle. The quartiles of a group are blended with those of its language, and these with those of all documents, by a weight that
grows with the square of the number of documents, so that one document more never changes much. A threshold lies some quartile distances beyond the
quartiles; thresholds are joined to the documents, which are then filtered.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import attach, stored
from landfall.llm.stats import with_stats

LEAST_WORDS = 20
MOST_REPEATED = 30  # percent
#: Documents with which a group weighs as much as the larger group it is part of.
HALF = 100
#: Quartile distances between a quartile and the threshold beyond it.
REACH = 5.0
SMALLEST, RATIO = 1e-4, 1.02


@dataclass(frozen=True)
class Figure:
    """A figure with an upper and perhaps a lower threshold, and the least distance of the quartiles assumed."""

    name: str
    value: Column
    spread: float
    low: bool = False


def _figures() -> list[Figure]:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return [
        Figure("word_length", F.col("word_chars") / words, 0.5, low=True),
        Figure("symbols", F.col("n_symbols") / words, 0.06),
        Figure("dup_lines", F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), 0.08),
        Figure("repeats", F.col("n_repeat_words") / words, 0.055),
        Figure("upper", F.col("n_upper") / chars, 0.06),
    ]


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)


def sketches(stats: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``figure``, ``bin`` and the number ``n`` of documents in the bin."""
    bins = [
        F.struct(
            F.lit(f.name).alias("figure"),
            F.when(f.value <= SMALLEST, 0).otherwise(F.ceil(F.log(f.value / SMALLEST) / math.log(RATIO))).cast("int").alias("bin"),
        )
        for f in _figures()
    ]
    return (
        stats.filter(~base_failed())
        .select("lang", "source", F.explode(F.array(*bins)).alias("b"))
        .groupBy("lang", "source", "b.figure", "b.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartiles of every figure of every group, and its documents."""
    counts = sketch.groupBy(*keys, "figure", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "figure")
    upto = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("upto", upto).withColumn("total", F.sum("n").over(group))
    value = F.when(F.col("bin") == 0, 0.0).otherwise(SMALLEST * F.pow(F.lit(RATIO), F.col("bin") - 0.5))
    return ranked.groupBy(*keys, "figure").agg(
        F.max("total").alias("docs"),
        *[F.min(F.when(F.col("upto") >= F.col("total") * q, value)).alias(name) for q, name in ((0.25, "q1"), (0.75, "q3"))],
    )


def thresholds(sketch: DataFrame, half: int = HALF, reach: float = REACH) -> DataFrame:
    """``lang``, ``source`` and for each figure its ``_high`` and ``_low`` threshold; one row per group."""
    own = _quartiles(sketch, ["lang", "source"])
    by_lang = _quartiles(sketch, ["lang"]).select(
        F.col("lang").alias("l"), F.col("figure").alias("f"), *[F.col(c).alias(f"{c}_l") for c in ("docs", "q1", "q3")]
    )
    overall = _quartiles(sketch, []).select(F.col("figure").alias("g"), F.col("q1").alias("q1_g"), F.col("q3").alias("q3_g"))
    merged = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("figure") == F.col("f"))).join(
        overall, F.col("figure") == F.col("g")
    )

    def blended(q: str) -> Column:
        own, lang = (F.col(n) * F.col(n) / (F.col(n) * F.col(n) + half * half) for n in ("docs", "docs_l"))
        return own * F.col(q) + (1 - own) * (lang * F.col(f"{q}_l") + (1 - lang) * F.col(f"{q}_g"))

    quartiles = merged.select("lang", "source", "figure", blended("q1").alias("q1"), blended("q3").alias("q3"))
    columns = []
    for f in _figures():
        here = F.col("figure") == f.name
        distance = F.greatest(F.col("q3") - F.col("q1"), F.lit(f.spread)) * reach
        columns.append(F.max(F.when(here, F.col("q3") + distance)).alias(f"{f.name}_high"))
        columns.append(F.max(F.when(here & F.lit(f.low), F.col("q1") - distance)).alias(f"{f.name}_low"))
    return quartiles.groupBy("lang", "source").agg(*columns)


def judged(docs: DataFrame, half: int = HALF, reach: float = REACH) -> DataFrame:
    """Per document: ``doc_id``, the counts, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails the base rules. Null languages and sources are
    groups like others. A group none of whose documents passes the base rules has no thresholds and
    needs none. Repeated rows are judged each by itself, very long texts whole. An empty table gives no rows. Other columns are not looked at.
    """
    named = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    stats = stored(with_stats(named, ("doc_id", "lang", "source")), "rule-stats")
    limits = stored(thresholds(stored(sketches(stats), "sketches"), half, reach), "thresholds")
    within = F.lit(True)
    for f in _figures():
        within = within & F.coalesce(f.value <= F.col(f"{f.name}_high"), F.lit(True))
        within = within & F.coalesce(f.value >= F.col(f"{f.name}_low"), F.lit(True))
    joined = attach(stats, limits, ["lang", "source"], "doc_id")
    return joined.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & within)
