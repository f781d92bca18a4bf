"""Boosted regression trees with logistic loss, on counted examples that are in memory or in a table of any size.

All that a level of a tree needs of the examples is a histogram of gradients per node, feature and bin, which is summed over all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEPTH = 3
BINS = 32
#: Gradients are multiples of one part in so many, so that their sums are exact and the same in any order.
STEP = float(1 << 20)


@dataclass
class Trees:
    """Trees of a fixed depth as arrays: the feature and bound of each inner node, the value of each leaf."""

    start: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    bounds: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def margins(self, x: np.ndarray, first: int = 0, before: np.ndarray | None = None) -> np.ndarray:
        """The margins of rows; ``before`` are those that the trees up to ``first`` give."""
        out = np.full(len(x), self.start) if before is None else before.copy()
        for feature, bound, leaf in zip(self.features[first:], self.bounds[first:], self.leaves[first:]):
            out += leaf[_place(x, feature, bound, DEPTH)]
        return out


def _place(x: np.ndarray, feature: np.ndarray, bound: np.ndarray, level: int) -> np.ndarray:
    """In which node of a level each row is, from the left."""
    rows, node = np.arange(len(x)), np.zeros(len(x), dtype=int)
    for _ in range(level):
        node = 2 * node + 1 + (x[rows, feature[node]] > bound[node])
    return node - (2**level - 1)


def _cuts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bounds of a feature's bins, which are its quantiles, from its counted values in order."""
    ends = np.cumsum(counts)
    places = np.floor((ends[-1] - 1) * np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.int64)
    return np.unique(values[np.searchsorted(ends, places, "right")])


def _histogram(x: np.ndarray, n: np.ndarray, good: np.ndarray, margin: np.ndarray, cuts: list[np.ndarray], feature: np.ndarray, bound: np.ndarray, level: int) -> np.ndarray:
    """Sums of gradients and curves by feature, node and bin; behind the features those of the whole node."""
    p = 1.0 / (1.0 + np.exp(-margin))
    gradient, curve = np.round((n * p - good) * STEP) / STEP, np.round(n * (p * (1.0 - p)) * STEP) / STEP
    local, width = _place(x, feature, bound, level) * (BINS + 1), 2**level
    out = np.zeros((2, len(cuts) + 1, width * (BINS + 1)))
    for f, cut in enumerate([*cuts, None]):
        if cut is None or len(cut):
            cell = local if cut is None else local + np.searchsorted(cut, x[:, f], "left")
            out[0, f], out[1, f] = np.bincount(cell, gradient, out.shape[2]), np.bincount(cell, curve, out.shape[2])
    return out


class Gathered:
    """Examples in memory: rows of features, how many examples each stands for, and how many of these are right."""

    def __init__(self, x: np.ndarray, n: np.ndarray, good: np.ndarray):
        self.x, self.n, self.good = x, n.astype(float), good.astype(float)
        self.margin, self.trees = None, 0

    def totals(self) -> tuple[float, float]:
        return float(self.n.sum()), float(self.good.sum())

    def cuts(self) -> list[np.ndarray]:
        out = []
        for column in self.x.T:
            values, place = np.unique(column, return_inverse=True)
            out.append(_cuts(values, np.bincount(place, self.n)))
        return out

    def histogram(self, trees: Trees, *at) -> np.ndarray:
        if self.margin is None or self.trees != len(trees.leaves):
            self.margin, self.trees = trees.margins(self.x, self.trees, self.margin), len(trees.leaves)
        return _histogram(self.x, self.n, self.good, self.margin, *at)


def unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``x``, ``n`` and ``good`` of a batch of examples."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
    return x, *[batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n", "good")]


class Spread:
    """The same in a stored table with ``x``, ``n`` and ``good``. Nothing comes to the driver but counted values of features and sums."""

    def __init__(self, rows: DataFrame, summed: Callable[[DataFrame, Callable[[pa.RecordBatch], np.ndarray], int], np.ndarray]):
        self.rows, self.summed = rows, summed

    def totals(self) -> tuple[float, float]:
        row = self.rows.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
        return float(row["n"]), float(row["good"])

    def cuts(self) -> list[np.ndarray]:
        counted = self.rows.select("n", F.posexplode("x").alias("f", "value")).groupBy("f", "value").agg(F.sum("n").alias("n")).collect()
        found: dict[int, list[tuple[float, int]]] = {}
        for row in counted:
            found.setdefault(row["f"], []).append((row["value"], row["n"]))
        return [_cuts(*np.array(sorted(found[f]), dtype=float).T) for f in sorted(found)]

    def histogram(self, trees: Trees, cuts: list[np.ndarray], feature: np.ndarray, bound: np.ndarray, level: int) -> np.ndarray:
        def part(batch: pa.RecordBatch) -> np.ndarray:
            x, n, good = unpacked(batch)
            return _histogram(x, n, good, trees.margins(x), cuts, feature, bound, level).ravel()

        shape = (2, len(cuts) + 1, 2**level * (BINS + 1))
        return self.summed(self.rows, part, int(np.prod(shape))).reshape(shape)


def grown(examples: Gathered | Spread, rounds: int = 60, rate: float = 0.2, penalty: float = 1.0) -> Trees:
    """Newton boosting; every split is the best of all bin bounds."""
    n, good = examples.totals()
    share = (good + 0.5) / (n + 1.0)
    trees, cuts = Trees(start=float(np.log(share / (1 - share)))), examples.cuts()
    for _ in range(rounds):
        feature, bound = np.zeros(2**DEPTH - 1, dtype=int), np.full(2**DEPTH - 1, np.inf)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            g, h = examples.histogram(trees, cuts, feature, bound, level).reshape(2, len(cuts) + 1, width, BINS + 1)
            g_all, h_all = g[-1].sum(1, keepdims=True), h[-1].sum(1, keepdims=True)
            best = np.zeros(width)
            # What is not split goes to the left.
            left, left_h = g_all[:, 0].copy(), h_all[:, 0].copy()
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                g_low, h_low = g[f].cumsum(1)[:, : len(cut)], h[f].cumsum(1)[:, : len(cut)]
                gain = g_low**2 / (h_low + penalty) + (g_all - g_low) ** 2 / (h_all - h_low + penalty) - g_all**2 / (h_all + penalty)
                at = gain.argmax(axis=1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best + 1e-9):
                    best[k], feature[first + k], bound[first + k] = top[k], f, cut[at[k]]
                    left[k], left_h[k] = g_low[k, at[k]], h_low[k, at[k]]
        sums = np.stack((left, g_all[:, 0] - left), axis=1).ravel(), np.stack((left_h, h_all[:, 0] - left_h), axis=1).ravel()
        trees.features.append(feature)
        trees.bounds.append(bound)
        trees.leaves.append(-rate * sums[0] / (sums[1] + penalty))
    return trees


def boosted(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2, penalty: float = 1.0) -> Trees:
    """Trees grown on ``x`` (rows by features) and 0 or 1 ``y``."""
    return grown(Gathered(x, np.ones(len(y)), y), rounds, rate, penalty)
