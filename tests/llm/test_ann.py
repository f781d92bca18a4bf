import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import ann


def vectors(n=700, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim)) * 2
    return [(i, [float(v) for v in np.float32(centres[i % 12] + rng.normal(size=dim))]) for i in range(n)]


def brute(rows, every, k):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None]
    out = {}
    for q, a in usable:
        if q % every == 0:
            near = sorted((-float(a @ b / np.sqrt((a @ a) * (b @ b))), i) for i, b in usable if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(frame, every, k=5):
    out = {}
    for r in sorted(ann.nearest(frame, every, k).collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET", 100)
    monkeypatch.setattr(ann, "SPLIT", 60)
    rows = vectors()
    got = found(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("code", F.lit("clash")), 20)
    want = brute(rows, 20, 5)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    whole = {i: np.array(v) for i, v in rows}
    for q, near in got.items():
        a = whole[q]
        for i, score in near:
            assert score == pytest.approx(float(a @ whole[i] / np.sqrt((a @ a) * (whole[i] @ whole[i]))), abs=1e-12)
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True)


def test_few_rows_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (5, [0.0, 1.0])]
    bad = [(4, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, []), (None, [1.0, 1.0]), (20, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows + bad + [rows[1]], "vec_id bigint, embedding array<float>")
    assert found(frame, 10) == {0: [(2, 1.0), (3, 1.0), (5, 0.0)]}
    assert found(frame.limit(0), 10) == {}
    assert found(frame.filter("vec_id = 4"), 10) == {}


def test_every_length_is_searched_by_itself(spark):
    """A few vectors of another length than most are no less found."""
    rows = vectors(200) + [(1000 + i, [1.0, float(i)]) for i in range(8)] + [(1100, [5.0] * 3)]
    got = found(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), 100)
    assert [i for i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005]
    assert 1100 not in got and {0, 100} <= got.keys() and all(i < 200 for i, _ in got[0])


def test_very_common_vector(spark):
    r = random.Random(2)
    rows = vectors(200) + [(1000 + i, vectors(1)[0][1]) for i in range(300)]
    r.shuffle(rows)
    got = found(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), 50)
    for q in [q for q in got if q >= 1000]:
        assert [i for i, _ in got[q]] == [i for i in (0, *range(1000, 1010)) if i != q][:5]


def test_codes_within_a_radius_share_a_part():
    r = random.Random(3)
    for _ in range(500):
        a, flips = r.getrandbits(64), r.sample(range(64), r.randint(0, 30))
        b = a
        for f in flips:
            b ^= 1 << f
        parts = [bin((a ^ b) >> (16 * j) & 0xFFFF).count("1") for j in range(4)]
        assert min(parts) <= len(flips) // 4
