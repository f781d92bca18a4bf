import math
import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from landfall.llm import negatives
from landfall.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def vectors(n=600, dim=24, seed=1, labels=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        x = 0.6 * centres[label] + rng.normal(size=dim) * 0.5
        rows.append((i, [float(np.float32(v)) for v in x / np.sqrt(x @ x)], label))
    return rows


def brute(rows, every=50, positives=5, wanted=3):
    own = sorted({(i, label, tuple(math.floor(256 * v) for v in x)) for i, x, label in rows if i is not None and label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)})
    out = []
    for a in own:
        if a[0] % every:
            continue
        scored = [(-sum(p * q for p, q in zip(a[2], r[2])), r) for r in own if r is not a and len(r[2]) == len(a[2])]
        for s, p in sorted(((s, r) for s, r in scored if r[1] == a[1]), key=lambda x: (x[0], x[1][0]))[:positives]:
            fits = sorted((t, r[0]) for t, r in scored if r[1] != a[1] and 50 * -s <= 100 * -t <= 95 * -s)
            out += [(a[0], p[0], k, i, -s, -t) for k, (t, i) in enumerate(fits[:wanted], 1)]
    return sorted(out)


def got(frame, **options):
    return sorted(map(tuple, negatives.mined(frame, every=50, **options).collect()))


@pytest.mark.parametrize("rows_, anchors", [(8192, 1024), (100, 4)])
def test_equals_brute_force(spark, monkeypatch, rows_, anchors):
    monkeypatch.setattr(negatives, "ROWS", rows_)
    monkeypatch.setattr(negatives, "ANCHORS", anchors)
    rows = vectors()
    rows += [(1000 + i, rows[50][1], rows[50][2]) for i in range(0, 120)] + [(2000 + i, rows[100][1], (rows[100][2] + 1) % 10) for i in range(80)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "team", "block", "score", "Parts", "positives"):
        frame = frame.withColumn(name, F.lit("clash"))
    assert got(frame) == brute(rows)


def test_unusable_rows_few_rows_lengths_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.75, 0.25], 2), (3, [0.5, 0.5], 3), (3, [0.5, 0.5], 3), (3, [0.5, 0.25], 2), (50, [], 1), (51, [], 1), (52, [], 2), (100, [1.0], 4)]
    bad = [(4, None, 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 2), (7, [None, 1.0], 2), (8, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (9, [1.0, 2.0, 3.0], 2)]
    assert got(spark.createDataFrame(rows + bad, SCHEMA)) == brute(rows + bad)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(frame.limit(0)) == []
    assert got(frame.filter("vec_id = 0")) == []


def test_scores_are_exact_in_doubles_and_in_longs():
    rng = np.random.default_rng(2)
    for size in (1 << 8, 1 << 20, 1 << 27):
        parts = rng.integers(-size, size, (60, 32))
        own = negatives.Side(np.arange(60), np.arange(60), np.zeros(60, int), parts, negatives.summaries(parts), np.sqrt((parts.astype(float) ** 2).sum(axis=1)))
        bounds = negatives.Bounds(own, own)
        assert bounds.exact == (size < 1 << 24)
        for rows in (np.arange(60), np.arange(0, 60, 7)):
            bounds.start(3)
            bounds.refine(rows, len(negatives.LEVELS))
            assert bounds.score[rows].tolist() == (parts[rows] @ parts[3]).tolist()


def test_units_work_in_a_python_that_has_imported_nothing_else():
    """As in a fresh worker, which gets its rows as a stream: what the step needs it imports itself."""
    parts = np.arange(6, dtype="<i8").reshape(3, 2)
    packed = np.concatenate([x for pair in negatives.summaries(parts) for x in pair], axis=1)
    table = pa.table(
        {"row": [7, 8, 9], "vec_id": [2, 1, 3], "label": [1, 1, 2], "dim": pa.array([2, 2, 2], pa.int32()), "parts": [r.tobytes() for r in parts], "summary": [r.tobytes() for r in packed]}
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    code = """
import sys, pyarrow as pa
from landfall.llm import negatives
own = negatives.side(pa.ipc.open_stream(sys.stdin.buffer).read_all(), 2)
assert own.row.tolist() == [8, 7, 9] and own.parts.tolist() == [[2, 3], [0, 1], [4, 5]]
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], input=sink.getvalue().to_pybytes(), check=True, cwd=root, timeout=60)


def test_components_too_large_for_bounds_or_sums(spark):
    rows = [(0, [1e7, 1.0], 1), (1, [1e7, 2.0], 1), (2, [7e6, 1.0], 2), (3, [1e36, -1e36], 2), (50, [1e30, 1.0], 1)]
    found = [r for r in got(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")) if r[0] == 0]
    assert (0, 1, 1, 2) in [r[:4] for r in found]


def test_bounds_hold_and_settle_most_pairs():
    rng = np.random.default_rng(5)
    parts = rng.integers(-200, 200, (400, 30)) + rng.integers(-300, 300, (400, 3)).repeat(10, axis=1)
    levels = negatives.summaries(parts)
    norm = np.sqrt((parts.astype(float) ** 2).sum(axis=1))
    own = negatives.Side(np.arange(400), np.arange(400), np.zeros(400, int), parts, levels, norm)
    bounds = negatives.Bounds(own, own)
    exact = parts @ parts.T
    scored = 0
    for a in range(50):
        bounds.start(a)
        every = np.arange(400)
        widths = []
        for level in range(3):
            assert (bounds.low <= exact[a]).all() and (bounds.high >= exact[a]).all()
            widths.append((bounds.high - bounds.low).mean())
            if level < 1:
                bounds.refine(every, 1)
        assert widths[1] < widths[0]
        bounds.start(a)
        best = bounds.best(every, 5)
        assert best.tolist() == np.lexsort((every, -exact[a]))[:5].tolist()
        scored += (bounds.level == 2).sum()
    assert scored < 50 * 400 / 4


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_brute_force(spark, folder):
    import os

    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, x, (label + 1) % 10 if i % 7 == 0 else label) for i, x, label in rows]
    assert sorted(map(tuple, QUERIES["op13_hard_negatives"](spark, folder).collect())) == brute(moved)
