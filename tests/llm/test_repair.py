import hashlib
import random
import zlib

import pytest

from landfall.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        case = zlib.crc32(name.encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else "".join(c for c in text if c not in ".!?") if case == 2 else text
        role = "user" if case == 4 else role
        out += [(conv, turn, role, text)] * (2 if case == 3 else 1)
    return out


def plain(rows):
    """The least (cost, audit, repaired turns) by trying every edit; ``rows`` are (initial, role, text, must go, truncated)."""
    memo = {}

    def go(i, state, inserted):
        key = (i, state, inserted)
        if key not in memo:
            ways = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
            to, name = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}[state]
            if inserted < 3:
                ways += [(c + 5, "I" + a, ((name, ""), *t)) for c, a, t in [go(i, to, inserted + 1)] if c is not None]
            if i < len(rows):
                initial, role, text, gone, cut = rows[i]
                options = [("D", 2, state, None)]
                if not gone:
                    kept = {"s": 1 if state == 0 else None, "u": 2 if state != 2 else None, "a": 3 if state == 2 else None}.get(initial)
                    options += [("K", 5 * cut, kept, role), ("R", 1 + 5 * cut, to, name)]
                for letter, cost, after, given in options:
                    if after is not None:
                        c, a, t = go(i + 1, after, 0)
                        if c is not None:
                            ways.append((c + cost, letter + a, t if given is None else ((given, text), *t)))
            memo[key] = min(ways) if ways else (None, None, None)
        return memo[key]

    return go(0, 0, 0)


def expected(original, rows):
    out = {}
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in own:
            inner = text.strip(WHITE)
            fault = "blank" if not inner else "duplicate" if (role, text) in seen else "truncated" if inner[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role[:1], role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, turns = plain(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


def conversations(n=150, longest=14, seed=7):
    r = random.Random(seed)
    texts = ["Yes.", "No!", "What is it?", "and then", " \t\n", "", None, "É. ", "It is so", "a" * 20 + "."]
    rows = []
    for conv in [*range(n), None]:
        for turn in range(r.randint(1, longest)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            rows.append((conv, r.choice([turn, turn, turn, turn + 3 * 20]), role, r.choice(texts) if r.random() < 0.4 else f"{r.random()}" + r.choice([".", "!", "", " \n"])))
    rows = list({(a, b): (a, b, c, d) for a, b, c, d in rows}.values())
    return rows + [(5000, None, "user", "no turn."), (5001, None, None, None), (5002, 3, "system", "Only."), (5003, 0, "user", "x" * 300_000)]


def got(frame, rows=None):
    found = repair.told(frame, repair.damaged(frame) if rows is None else rows).collect()
    assert len({r["conv_id"] for r in found}) == len(found)
    return {r["conv_id"]: tuple(r)[1:] for r in found}


@pytest.mark.parametrize("chunk, fan", [(2048, 256), (3, 2)])
def test_digests_equal_all_ways_tried(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "FAN", fan)
    monkeypatch.setattr(repair, "GROUP", 50)
    rows = conversations()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in ("place", "fault", "edit", "chunk", "Part", "at"):
        frame = frame.selectExpr("*", f"'clash' as {name}")
    assert got(frame) == expected(rows, damaged(rows))


def test_every_short_sequence_of_kinds():
    """All sequences of four rows, divided and conquered, against all ways tried."""
    import itertools

    usual = [k for k, (initial, health) in enumerate(repair.KINDS) if (initial, health) in {("s", 0), ("u", 0), ("a", 0), ("u", 1), ("a", 1), ("", 0), ("u", 2)}]
    for kinds in itertools.product(usual, repeat=4):
        rows = [(repair.KINDS[k][0], "", "", repair.KINDS[k][1] == repair.GONE, repair.KINDS[k][1] == repair.CUT) for k in kinds]
        cost, audit, _ = plain(rows)
        own = repair.edits(kinds)
        assert "".join(e for _, _, e, _ in own) == audit
        assert sum(repair.COST[e] + (5 if e in "KR" and rows[i][4] else 0) for i, _, e, _ in own) == cost


def test_steps_combine_in_any_order():
    r = random.Random(3)
    for _ in range(200):
        steps = [r.choice(repair.STEPS) for _ in range(7)]
        cut = r.randint(1, 6)
        both = repair.combined([repair.combined(steps[:cut]), repair.combined(steps[cut:])])
        assert [sorted(x) for x in both] == [sorted(x) for x in repair.combined(steps)]


def test_ties_repeated_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(1, 0, "user", "Hello.")] * 3 + [(1, 1, "assistant", "Hi!")], SCHEMA)
    row = repair.told(frame, frame).first()
    assert (row["duplicate"], row["audit"], row["cost"]) == (2, "KDDK", 4)
    assert repair.told(frame.limit(0), frame.limit(0)).collect() == []
    gone = repair.told(frame, frame.limit(0)).first()
    assert tuple(gone) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_edits_carry_the_repaired_turns(spark):
    frame = spark.createDataFrame([(1, 0, "system", "Be kind."), (1, 2, "assistant", "I am well."), (1, 3, "tool", "And you?"), (1, 4, "assistant", " ")], SCHEMA)
    rows = repair.repaired(frame).orderBy("place", "number").collect()
    assert [(r["edit"], r["role"], r["text"], r["was"], r["fault"]) for r in rows] == [
        ("K", "system", "Be kind.", "system", ""),
        ("R", "user", "I am well.", "assistant", ""),
        ("R", "assistant", "And you?", "tool", ""),
        ("D", None, None, "assistant", "blank"),
    ]


def test_one_conversation_of_most_rows_is_spread(spark, monkeypatch):
    monkeypatch.setattr(repair, "CHUNK", 16)
    monkeypatch.setattr(repair, "SORTED", 4)
    monkeypatch.setattr(repair, "FAN", 4)
    r = random.Random(5)
    rows = [(1, i, r.choice(["user", "assistant", "user", "assistant", "tool"]), f"text {i}" + r.choice([".", "."," "])) for i in range(3000)] + [(2, 0, "user", "A."), (2, 1, "assistant", "B.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    marks = repair.numbered(frame)
    assert marks.filter("conv_id = 1").groupBy("part", "chunk").count().agg({"count": "max"}).first()[0] <= 16
    assert marks.filter("conv_id = 1").select("part").distinct().count() > 20
    import sys

    sys.setrecursionlimit(20000)
    assert got(frame, frame) == expected(rows, rows)
