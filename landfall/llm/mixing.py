"""Mixing sources to target weights.

Sources in code point order, null last, weigh 5, 2, 1, 5, 2, 1, ... Their targets are shares of
all words in proportion to the weights. No target exceeds ``most`` times the words of its source;
what a source cannot take is shared by the others by weight. So all targets below that bound are
one common level times the weight, and the level follows from running sums over the sources in the
order in which they meet the bound.

A source's rate is its target over its words. A document is taken floor(rate) times, and once more
if a number drawn from a hash is below the fraction. The hash is of its id, its text and the seed; rows that are
alike in id, source and text are numbered and draw each for itself, so that a source comes near its target also
where ids are null or repeat. Which of such rows has which number makes no difference to what is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import attach, fresh, n_words, quoted, stored

WEIGHTS = (5, 2, 1)
MOST = 3
SEED = 7
#: Parts in which rows that are alike are numbered.
PARTS = 64


def draw(key: Column, mark: Column, number: Column, seed: int) -> Column:
    """A number in [0, 1) that is a function of an id, the digest of a text, a number and the seed: 52 bits of an MD5 digest."""
    text = F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), mark, number.cast("string"), F.lit(seed))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def numbered(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``rows`` with a number from 1 on in ``number``, by which those alike in ``keys`` differ; null is alike to null.

    Rows that are like no other have 1 at once. The others are stored, dealt to parts by where they stand, and numbered
    part after part, so that very many alike rows are sorted by many tasks.
    """
    many, spot, part, shift = fresh(rows, "mix_many", "mix_spot", "mix_part", "mix_shift")
    counts = rows.groupBy(*[F.col(quoted(k)) for k in keys]).agg(F.count(F.lit(1)).alias(many)).filter(F.col(many) > 1)
    placed = rows.withColumn(spot, F.monotonically_increasing_id())
    told = attach(placed, stored(counts, "mix-alike"), keys, spot)
    columns = [F.col(quoted(c)) for c in rows.columns]
    single = told.filter(F.col(many).isNull()).select(*columns, F.lit(1).cast("bigint").alias(number))
    alike = stored(told.filter(F.col(many).isNotNull()).withColumn(part, F.pmod(F.xxhash64(spot), F.lit(PARTS)).cast("int")).drop(many), "mix-alike-rows")
    if alike.isEmpty():
        return single
    own = [F.col(quoted(k)) for k in keys]
    sizes = alike.groupBy(*own, part).agg(F.count(F.lit(1)).alias(shift))
    earlier = Window.partitionBy(*own).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = stored(sizes.withColumn(shift, F.coalesce(F.sum(shift).over(earlier), F.lit(0))), "mix-shifts")
    place = F.row_number().over(Window.partitionBy(*own, part).orderBy(spot)).cast("bigint")
    dealt = attach(alike.withColumn(number, place), shifts, [*keys, part], spot)
    return single.unionByName(dealt.select(*columns, (F.col(number) + F.col(shift)).alias(number)))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``source_size``, one per source.

    The windows see one narrow row per source, not the documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place).cast("bigint"))
    limit = F.col("source_size") * most
    by_limit = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def rest(total: Column, part: Column) -> Column:
        return F.sum(total).over(everything) - F.coalesce(F.sum(part).over(before), F.lit(0))

    levels = weighed.select(
        "source",
        "source_size",
        "weight",
        F.row_number().over(by_limit).alias("place"),
        (rest(F.col("source_size"), limit).cast("double") / rest(F.col("weight"), F.col("weight"))).alias("level"),
        (limit.cast("double") / F.col("weight")).alias("bound"),
    )
    # The level that holds is the first that the next source in line can bear.
    first = F.min(F.when(F.col("level") <= F.col("bound"), F.struct("place", "level"))).over(everything)
    return levels.withColumn("found", first).select(
        "source",
        "source_size",
        F.when(F.col("place") < F.col("found.place"), limit.cast("double"))
        .otherwise(F.col("found.level") * F.col("weight"))
        .alias("target"),
    )


def copies(docs: DataFrame, seed: int = SEED, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``copies``.

    A null text has no words. A null id draws like an id of its own; rows that repeat an id draw each for itself. A source without words
    has the target 0. Very long texts are counted whole. An empty table gives no rows. Other columns
    than ``doc_id``, ``text`` and ``source`` are not looked at.
    """
    sizes = stored(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), digest(F.col("text")).alias("mark")), "mix-sizes")
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(per_source, weights, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (draw(F.col("doc_id"), F.col("mark"), F.col("number"), seed) < rate - F.floor(rate)).cast("bigint")
    rated = attach(numbered(sizes, ["doc_id", "source", "mark"], "number"), goals, ["source"], "mark")
    return rated.withColumn("copies", F.floor(rate) + extra).drop("mark", "number")


def mixed(docs: DataFrame, seed: int = SEED, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents, with all their columns, each as often as the mix takes it; see ``copies`` for nulls, repeats and empty tables.

    Column names that are used inside may be among those of ``docs``.
    """
    rate, per_source, mark, number = fresh(docs, "mix_rate", "mix_source", "mix_mark", "mix_number")
    sizes = docs.groupBy("source").agg(F.sum(n_words(F.col("text"))).alias("source_size"))
    goals = targets(stored(sizes, "mix-sizes"), weights, most)
    rates = goals.select(
        "source",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias(rate),
    )
    drawn = numbered(docs.withColumn(mark, digest(F.col("text"))), ["doc_id", "source", mark], number)
    rated = attach(drawn, stored(rates, "mix-rates"), ["source"], mark)
    whole = F.floor(F.col(rate))
    times = (whole + (draw(F.col("doc_id"), F.col(mark), F.col(number), seed) < F.col(rate) - whole).cast("bigint")).cast("int")
    return rated.withColumn(per_source, F.explode(F.array_repeat(F.lit(0), times))).select(
        *[F.col(quoted(c)) for c in docs.columns]
    )
