import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import chat

FOLDER = os.environ.get("TRIAL_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def best_path(model, scores, begins):
    """All paths of a short conversation."""
    n, k = scores.shape
    paths = [((s,), model.first[s] + scores[0, s]) for s in range(k)]
    for i in range(1, n):
        paths = [((*p, s), v + model.change[begins[i]][p[-1], s] + scores[i, s]) for p, v in paths for s in range(k)]
    return max(v for _, v in paths), dict(paths)


def model():
    turns = [(c, t, ("user", "assistant")[t % 2], ("Why is it?" if t % 2 == 0 else "Because it is so.\n" * 4)) for c in range(50) for t in range(6)]
    return chat.fit(turns)


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(2)
    m = model()
    for _ in range(30):
        scores, begins = rng.normal(size=(6, 3)), rng.integers(0, 3, 6)
        best, paths = best_path(m, scores, begins)
        assert paths[tuple(chat.decode(m, scores, begins, None, None).tolist())] == pytest.approx(best)
        table = chat.passage(m, scores, begins)
        assert table[3].max() == pytest.approx(best)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("chunk", [2, 2048])
def test_roles_of_conversations_without_markers(spark, monkeypatch, chunk):
    talks = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    m = chat.learned(talks)
    whole = {tuple(r) for r in chat.parsed(talks, m).collect()}
    monkeypatch.setattr(chat, "CHUNK", chunk)
    assert {tuple(r) for r in chat.parsed(talks, m).collect()} == whole
    truth = {(r["conv_id"], r["turn"]): r for r in talks.collect()}
    assert len(whole) == len(truth)
    assert sum(truth[r[0], r[1]]["role"] == r[3] for r in whole) > 0.93 * len(whole)
    assert all(truth[r[0], r[1]]["text"] == r[4] for r in whole)


def test_markers_split_blocks_into_turns(spark):
    text = "User: what is it?\nAssistant: it is this\nand that\n**Human:** thanks"
    frame = spark.createDataFrame([(1, 0, None, text), (1, 1, None, "[system] be kind"), (2, 0, None, "<|user|>\nhello")], SCHEMA).withColumn("part", F.lit(9))
    got = sorted(tuple(r) for r in chat.parsed(frame, model()).drop("rendered").collect())
    assert [g[:5] for g in got[:3]] == [
        (1, 0, 0, "user", "what is it?"),
        (1, 0, 1, "assistant", "it is this\nand that"),
        (1, 0, 2, "user", "thanks"),
    ]
    # No sign follows the word in brackets, so it is no marker.
    assert got[3][:3] == (1, 1, 0) and got[3][4] == "[system] be kind"
    assert got[-1][3] == "user" and got[-1][4].strip() == "hello"


def test_awkward_conversations(spark):
    r = random.Random(1)
    rows = [(i, t, r.choice(["user", "assistant", None, "tool"]), r.choice(["hi?", "", None, "long " * 500, "a\n\nb"])) for i in range(10) for t in range(r.randint(1, 5))]
    rows += [(None, 0, "user", "x"), (None, None, None, None), (3, None, "user", "y"), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = chat.parsed(frame, chat.learned(frame)).collect()
    blocks = Counter((g["conv_id"], g["turn"]) for g in got if g["part"] == 0)
    assert blocks == Counter((x[0], x[1]) for x in rows)
    assert all(g["role"] in chat.ROLES and g["rendered"].startswith(f"<|{g['role']}|>") for g in got)
    empty = frame.limit(0)
    assert chat.parsed(empty, chat.learned(empty)).count() == 0


def test_rows_without_numbers_are_cut_into_bounded_chunks(spark, monkeypatch):
    r = random.Random(4)
    texts = [("Why is it?", "Because it is so.\n" * 4, "And then what?", "", None)[r.randrange(5)] for _ in range(150)]
    rows = [(None, None, None, t) for t in texts] + [(7, 3, None, f"{t} {i}") for i, t in enumerate(texts)] + [(8, 0, None, "same")] * 90 + [(9, 0, None, "hi?")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    m = model()
    whole = Counter(tuple(x) for x in chat.parsed(frame, m).collect())
    monkeypatch.setattr(chat, "CHUNK", 16)
    monkeypatch.setattr(chat, "SORTED", 2)
    of_long = chat.numbered(frame.filter("conv_id is null or conv_id < 9").select("conv_id", "turn", "text"), len(rows))
    sizes = {(x["conv_id"], x["chunk"]): x["count"] for x in of_long.groupBy("conv_id", "chunk").count().collect()}
    assert max(sizes.values()) == 16 and len(sizes) == 10 + 10 + 6
    assert of_long.selectExpr("count(distinct shiftright(place, 33))").first()[0] > 2
    got = Counter(tuple(x) for x in chat.parsed(frame, m).collect())
    assert got == whole and sum(whole.values()) >= len(rows)
