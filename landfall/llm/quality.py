"""A quality classifier: random Fourier features, ridge regression and isotonic calibration.

Figures of whole texts are scaled, and cosines of random projections of them approximate a Gaussian
kernel. Each partition adds up its part of the normal equations, these parts are summed by cell, and the
sums, whose number depends on the features alone, are solved on the driver. Scores of training rows
that the fit did not see are counted in bins and made to rise with the share of good labels.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored
from landfall.llm.stats import STATS, with_stats

FEATURES = 160
WIDTH = 2.5
PENALTY = 1.0
BINS = 512
GOOD = 0.7
SEED = 11


def figures(stats: np.ndarray) -> np.ndarray:
    """Ratios of the counts ``STATS``, a row for each text."""
    x = {name: stats[:, k].astype(np.float64) for k, name in enumerate(STATS)}
    words, chars, lines = np.maximum(x["n_words"], 1), np.maximum(x["word_chars"], 1), np.maximum(x["n_lines"], 1)
    return np.stack(
        [
            np.log1p(x["n_words"]),
            x["word_chars"] / words,
            np.sqrt(x["n_symbols"] / words),
            np.sqrt(x["n_dup_lines"] / lines),
            np.sqrt(x["n_repeat_words"] / words),
            np.sqrt(x["n_upper"] / chars),
            np.sqrt(x["n_digits"] / chars),
            np.sqrt(x["n_marks"] / words),
            x["n_distinct_words"] / words,
            np.sqrt(x["n_same_as_last"] / words),
            np.sqrt(x["n_stops"] / words),
            np.log1p(x["n_words"] / lines),
        ],
        axis=1,
    )


N_FIGURES = 12


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier((figures(stats) - self.mean) / self.scale) @ self.weights

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.levels), 0.0, 1.0)


def fourier(x: np.ndarray) -> np.ndarray:
    """The features and a constant, of scaled figures. Far values are drawn in, as all beyond them are alike."""
    random = np.random.default_rng(SEED)
    directions = random.normal(0.0, 1.0 / WIDTH, (N_FIGURES, FEATURES))
    shift = random.uniform(0.0, 2 * np.pi, FEATURES)
    cosines = np.cos(np.clip(x, -6.0, 6.0) @ directions + shift) * np.sqrt(2.0 / FEATURES)
    return np.concatenate((cosines, np.ones((len(x), 1))), axis=1)


def _counts(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(s)).to_numpy(zero_copy_only=False) for s in STATS], axis=1)


def _summed(rows: DataFrame, part, n_cells: int) -> np.ndarray:
    """The sum over all rows of what ``part`` makes of each batch, an array of ``n_cells`` numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_cells)
        for batch in batches:
            total += part(batch)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["cell", "value"])

    out = np.zeros(n_cells)
    for row in rows.mapInArrow(work, "cell bigint, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[row["cell"]] = row["value"]
    return out


def isotonic(position: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising function of position that is nearest to the shares of good rows (pooled neighbours)."""
    blocks: list[list[float]] = []
    for x, g, n in zip(position, good, count):
        blocks.append([x * n, g, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(rows: DataFrame) -> Model:
    """A model from rows of ``STATS``, a 0 or 1 ``label`` and whether the row is for ``calibration``.

    Without rows, or with rows of one label only, the score is the share of good labels, or a half.
    """
    training = rows.filter(~F.col("calibration"))

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        x = figures(_counts(batch))
        return np.concatenate(([len(x)], x.sum(axis=0), (x * x).sum(axis=0)))

    sums = _summed(training, moments, 1 + 2 * N_FIGURES)
    n = max(sums[0], 1.0)
    mean = sums[1 : 1 + N_FIGURES] / n
    scale = np.sqrt(np.maximum(sums[1 + N_FIGURES :] / n - mean * mean, 1e-6))
    width = FEATURES + 1
    upper = np.triu_indices(width)

    def equations(batch: pa.RecordBatch) -> np.ndarray:
        z = fourier((figures(_counts(batch)) - mean) / scale)
        y = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(np.float64)
        return np.concatenate(((z.T @ z)[upper], z.T @ y))

    cells = _summed(training, equations, len(upper[0]) + width)
    square = np.zeros((width, width))
    square[upper] = cells[: len(upper[0])]
    square = square + square.T - np.diag(np.diag(square))
    ridge = np.eye(width) * PENALTY
    ridge[-1, -1] = 1e-3
    weights = np.linalg.solve(square + ridge, cells[len(upper[0]) :])
    model = Model(mean, scale, weights, np.zeros(1), np.zeros(1))
    low, high = -0.5, 1.5

    def counted(batch: pa.RecordBatch) -> np.ndarray:
        raw = model.raw(_counts(batch))
        place = np.clip((raw - low) / (high - low) * BINS, 0, BINS - 1).astype(int)
        y = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False)
        return np.concatenate((np.bincount(place, minlength=BINS), np.bincount(place, weights=y, minlength=BINS)))

    seen = _summed(rows.filter("calibration"), counted, 2 * BINS)
    used = np.flatnonzero(seen[:BINS])
    if len(used):
        middle = low + (used + 0.5) * (high - low) / BINS
        model.knots, model.levels = isotonic(middle, seen[BINS:][used], seen[:BINS][used])
    else:
        model.knots, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def scored(docs: DataFrame, labels: DataFrame, learnable: Column) -> DataFrame:
    """Per document: ``doc_id``, ``learnable``, ``score`` and ``predicted``.

    ``labels`` has ``doc_id`` and ``quality``; labels other than 0 and 1 and rows whose ``learnable``, an
    expression of ``doc_id``, is not true are not learned from. Several labels of a document are as
    many examples. A null or empty text has figures of zero and gets the score these have. Where
    nothing can be learned all scores are a half. An empty table gives no rows; other columns are not
    looked at.
    """
    stats = stored(with_stats(docs.withColumn("learnable", F.coalesce(learnable, F.lit(False))).select("doc_id", "text", "learnable"), ("doc_id", "learnable")), "quality-stats")
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("double").alias("label"))
    examples = stats.filter("learnable").join(known, "doc_id").select(*STATS, "label", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("calibration"))
    examples = stored(examples, "quality-examples")
    model = fit(examples) if not examples.isEmpty() else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(_counts(batch)) if model else np.full(len(batch), 0.5)
            columns = [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= GOOD).astype(np.int32))]
            yield pa.record_batch(columns, names=["doc_id", "learnable", "score", "predicted"])

    kind = dict(docs.dtypes)["doc_id"]
    return stats.mapInArrow(work, f"doc_id {kind}, learnable boolean, score double, predicted int")
