"""Hard negatives: rows of another label that score high, but not too near a positive, by segment summary filtering.

A vector is divided into segments, and of each the mean and the deviation are stored. Of two vectors the product of the means and
that of the deviations, times the length of the segment, give what the segment adds to their inner product: the
first, at most the second more and at most the second less. Summed over all segments that bounds the score from both sides.
Bounds of few long segments are taken for all pairs of a block; pairs that can still matter get the tighter
bounds of the next level, whose segments are shorter, and only what no level settles is scored exactly, in whole numbers.

Two such searches follow each other: the best rows of an anchor's own label, and then, for each of these positives, the best rows of
other labels between two shares of its score. Rows and anchors are dealt into blocks of bounded size; a unit of work is a
block of each, and gives its best rows, of which Spark keeps the best.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import stored

#: Segments of each level of summaries, few first.
LEVELS = (4, 16)
#: Rows and anchors of a unit, on average.
ROWS, ANCHORS = 8192, 1024
#: Components are taken so many times and rounded down.
SCALE = 256
#: The shares of a positive's score, in percent, between which a negative's score lies.
LEAST, MOST = 50, 95
#: Sums of products beyond this may not fit a long; such pairs are not bounded but scored. Those below the other one are exact in doubles.
SAFE, EXACT = float(1 << 62), float(1 << 53)

INDEX = "row bigint, vec_id bigint, label bigint, dim int, parts binary, summary binary"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``parts`` (whole numbers) of the rows that take part, each once."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    numbers = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return rows.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), numbers.alias("parts")).distinct()


def edges(dim: int, segments: int) -> np.ndarray:
    """Where the segments of a vector begin and end; there are no empty ones."""
    return np.unique(np.linspace(0, dim, min(segments, max(1, dim)) + 1).round().astype(int))


def summaries(parts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each level the means and deviations of all segments, both times the root of the segment's length."""
    out = []
    for segments in LEVELS:
        cuts = edges(parts.shape[1], segments)
        length = np.diff(cuts)
        if not parts.shape[1]:
            out.append((np.zeros((len(parts), 0)), np.zeros((len(parts), 0))))
            continue
        numbers = parts.astype(np.float64)
        mean = np.add.reduceat(numbers, cuts[:-1], axis=1) / length
        apart = numbers - np.repeat(mean, length, axis=1)
        deviation = np.sqrt(np.add.reduceat(apart * apart, cuts[:-1], axis=1) / length)
        out.append((mean * np.sqrt(length), deviation * np.sqrt(length)))
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def indexed(rows: DataFrame) -> DataFrame:
    """The rows with a number of their own, their whole numbers and the summaries of all levels, packed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(3).to_numpy()
            for dim in np.unique(dims):
                some = batch.take(pa.array(np.flatnonzero(dims == dim)))
                parts = _matrix(some.column(4), int(dim))
                packed = np.concatenate([x for pair in summaries(parts) for x in pair], axis=1)
                columns = [pa.array([row.tobytes() for row in table], pa.binary()) for table in (parts.astype("<i8"), packed.astype("<f8"))]
                yield pa.record_batch([*some.columns[:4], *columns], names=["row", "vec_id", "label", "dim", "parts", "summary"])

    own = rows.select(F.xxhash64("vec_id", "label", "parts").alias("row"), "vec_id", "label", F.size("parts").alias("dim"), "parts")
    return own.mapInArrow(work, INDEX)


@dataclass
class Side:
    """Rows of one length of a block."""

    row: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    parts: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]
    norm: np.ndarray

    def take(self, rows: np.ndarray) -> Side:
        return Side(self.row[rows], self.vec_id[rows], self.label[rows], self.parts[rows], [(m[rows], d[rows]) for m, d in self.levels], self.norm[rows])


def side(table: pa.Table, dim: int) -> Side:
    """The rows of a unit that have a length."""
    table = table.filter(pc.equal(table.column("dim"), dim)).sort_by([("vec_id", "ascending"), ("row", "ascending")])

    def packed(name: str, kind: str, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(table.num_rows, width)

    parts = packed("parts", "<i8", dim)
    widths = [len(edges(dim, segments)) - 1 if dim else 0 for segments in LEVELS]
    summary = packed("summary", "<f8", 2 * sum(widths))
    levels, at = [], 0
    for width in widths:
        levels.append((summary[:, at : at + width], summary[:, at + width : at + 2 * width]))
        at += 2 * width
    norm = np.sqrt((parts.astype(np.float64) ** 2).sum(axis=1))
    return Side(*[table.column(c).to_numpy() for c in ("row", "vec_id", "label")], parts, levels, norm)


def _dot(matrix: np.ndarray, vector: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The products of some rows of a matrix with a vector. Where they are most rows, all are computed, which saves gathering them."""
    return (matrix @ vector)[rows] if 2 * len(rows) > len(matrix) else matrix[rows] @ vector


class Bounds:
    """Scores of one anchor with the rows of a block, as closely as they are known: between ``low`` and ``high``."""

    def __init__(self, rows: Side, anchors: Side):
        self.rows, self.anchors = rows, anchors
        (mean, deviation), (mean_, deviation_) = anchors.levels[0], rows.levels[0]
        self.middle, self.apart = mean @ mean_.T, deviation @ deviation_.T
        self.numbers = rows.parts.astype(np.float64)
        self.exact = rows.norm.max(initial=0.0) * anchors.norm.max(initial=0.0) < EXACT

    def start(self, anchor: int) -> None:
        size = self.anchors.norm[anchor] * self.rows.norm
        #: What rounding can add, and no bounds at all where whole numbers could wrap.
        self.slack = np.where(size < SAFE, size * 1e-12 + 1e-6, np.inf)
        self.anchor, self.level = anchor, np.zeros(len(size), np.int8)
        self.low = self.middle[anchor] - self.apart[anchor] - self.slack
        self.high = self.middle[anchor] + self.apart[anchor] + self.slack
        self.score = np.zeros(len(size), np.int64)

    def refine(self, rows: np.ndarray, level: int) -> None:
        """Bounds of the next level for some rows; at the last one their scores."""
        if level < len(LEVELS):
            (mean, deviation), (mean_, deviation_) = self.anchors.levels[level], self.rows.levels[level]
            middle, apart = _dot(mean_, mean[self.anchor], rows), _dot(deviation_, deviation[self.anchor], rows) + self.slack[rows]
            self.low[rows] = np.maximum(self.low[rows], middle - apart)
            self.high[rows] = np.minimum(self.high[rows], middle + apart)
        else:
            anchor = self.anchors.parts[self.anchor]
            if self.exact:
                # All sums are whole numbers that a double holds, in whatever order they are added.
                self.score[rows] = _dot(self.numbers, anchor.astype(np.float64), rows).astype(np.int64)
            else:
                self.score[rows] = (self.rows.parts[rows] * anchor).sum(axis=1)
            self.low[rows] = self.high[rows] = self.score[rows]
        self.level[rows] = level

    def best(self, among: np.ndarray, k: int, least: float = -np.inf, most: float = np.inf) -> np.ndarray:
        """The ``k`` rows with the highest scores from ``least`` to ``most``, ties by smaller number (rows follow ``vec_id``)."""
        for level in range(1, len(LEVELS) + 1):
            sure = among[(self.high[among] <= most) & (self.low[among] >= least)]
            bar = np.partition(self.low[sure], len(sure) - k)[len(sure) - k] if len(sure) >= k else -np.inf
            among = among[(self.high[among] >= max(bar, least)) & (self.low[among] <= most)]
            self.refine(among[self.level[among] < level], level)
        score = self.score[among]
        among = among[(score >= least) & (score <= most)]
        return among[np.lexsort((among, -self.score[among]))[:k]]


def _upto(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def dealt(index: DataFrame, anchors: DataFrame, total: int, asked: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows and anchors in units, a block of each, and the columns that name a unit."""
    blocks, teams = 1 + total // ROWS, 1 + asked // ANCHORS
    own = F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(blocks)).alias("block")
    rows = index.select("*", own, F.explode(_upto(teams)).alias("team"))
    team = F.pmod(F.xxhash64(F.lit(2), "row"), F.lit(teams)).alias("team")
    asking = anchors.select("*", team, F.explode(_upto(blocks)).alias("block"))
    return rows, asking, ["block", "team"]


def _pairs(rows: pa.Table, anchors: pa.Table) -> Iterator[tuple[Side, Side]]:
    """Rows and anchors of the same length; others have no inner product."""
    if rows.num_rows and anchors.num_rows:
        rows, anchors = rows.combine_chunks(), anchors.combine_chunks()
        for dim in sorted(set(rows.column("dim").to_pylist()) & set(anchors.column("dim").to_pylist())):
            yield side(rows, dim), side(anchors, dim)


FOUND = [("anchor", pa.int64()), ("other", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
_SHAPE = "anchor bigint, other bigint, vec_id bigint, score bigint"


def _table(out: list[tuple]) -> pa.Table:
    return pa.table({name: pa.array([r[i] for r in out], kind) for i, (name, kind) in enumerate(FOUND)})


def positives_of(index: DataFrame, anchors: DataFrame, total: int, asked: int, k: int) -> DataFrame:
    """``anchor``, ``other``, ``vec_id``, ``score`` and ``place`` of the best ``k`` other rows of each anchor's label."""

    def look(rows: pa.Table, anchors_: pa.Table) -> pa.Table:
        out = []
        for own, asking in _pairs(rows, anchors_):
            for label in np.intersect1d(own.label, asking.label):
                same, ask = own.take(np.flatnonzero(own.label == label)), asking.take(np.flatnonzero(asking.label == label))
                bounds = Bounds(same, ask)
                for a, row in enumerate(ask.row):
                    bounds.start(a)
                    for i in bounds.best(np.flatnonzero(same.row != row), k):
                        out.append((row, same.row[i], same.vec_id[i], bounds.score[i]))
        return _table(out)

    dealt_rows, asking, unit = dealt(index, anchors, total, asked)
    found = dealt_rows.groupBy(*unit).cogroup(asking.groupBy(*unit)).applyInArrow(look, _SHAPE)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "other")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def negatives_of(index: DataFrame, anchors: DataFrame, total: int, asked: int, k: int) -> DataFrame:
    """``anchor``, ``other`` (the positive), ``vec_id``, ``score`` and ``place`` of the best ``k`` rows of other labels for each positive.

    ``anchors`` have ``positives``, pairs of a row and its score.
    """

    def look(rows: pa.Table, anchors_: pa.Table) -> pa.Table:
        out = []
        held = dict(zip(anchors_.column("row").to_pylist(), anchors_.column("positives").to_pylist()))
        for own, asking in _pairs(rows, anchors_.drop_columns(["positives"])):
            bounds = Bounds(own, asking)
            for a, row in enumerate(asking.row):
                bounds.start(a)
                others = np.flatnonzero(own.label != asking.label[a])
                for positive in held[int(row)]:
                    score = positive["score"]
                    least, most = -(-LEAST * score // 100), MOST * score // 100
                    if least > most:
                        continue
                    for i in bounds.best(others, k, least, most):
                        out.append((row, positive["other"], own.vec_id[i], bounds.score[i]))
        return _table(out)

    dealt_rows, asking, unit = dealt(index, anchors, total, asked)
    found = dealt_rows.groupBy(*unit).cogroup(asking.groupBy(*unit)).applyInArrow(look, _SHAPE)
    order = Window.partitionBy("anchor", "other").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def relabelled(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """``vectors`` with the next label where the id is divisible by ``every``."""
    moved = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    return vectors.withColumn("label", F.when(moved, F.pmod(F.col("label") + 1, F.lit(labels))).otherwise(F.col("label")))


def mined(vectors: DataFrame, every: int, positives: int = 5, negatives: int = 3) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``. Rows without id, label or vector, or with a null or non-finite
    component, take no part; rows that repeat id, label and vector are one, other rows of one id are rows of their own. A score is
    the inner product of the components times ``SCALE``, rounded down; such numbers end at those of a long, and sums beyond wrap. Ties go to the
    smaller id. Vectors of different lengths have no score together; those without components score 0. A positive without
    negatives between the shares, as any with a score below 0, has no rows; where there are fewer than asked for, all
    are returned. An empty table gives no rows. Only ``vec_id``, ``label`` and ``embedding`` are looked at.
    """
    index = stored(indexed(usable(vectors)), "summaries")
    anchors = stored(index.filter(F.pmod("vec_id", F.lit(every)) == 0), "anchors")
    total, asked = index.count(), anchors.count()
    best = stored(positives_of(index, anchors, total, asked, positives), "positives")
    lists = best.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("other", "score")).alias("positives"))
    found = negatives_of(index, anchors.join(lists, "row"), total, asked, negatives).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score", "place": "rank"})
    named = best.select("anchor", "other", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return found.join(named, ["anchor", "other"]).join(ids, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
