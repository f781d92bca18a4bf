"""Roles of transcript lines by a hidden Markov model, and canonical turns.

A transcript is a sequence of blocks of lines. The hidden state of a line is the role that speaks.
What is seen of a line is the speaker marker it begins with, if any, and its place, length and marks.
A role can change where a block or a marked line begins, with chances learned for each of these, and almost
never elsewhere. The chances are counted on a bounded sample of conversations with known roles, the
most likely roles of a whole conversation are found by Viterbi, and successive lines of a role within
a block become one rendered turn.

A conversation is worked on in chunks of so many rows, whatever their turn numbers. Those with more than one chunk
are sorted and numbered by Spark, and each chunk first
gives the best score from every role before it to every role at its end. These small tables are combined
along the conversation, which fixes the roles at the borders, and then each chunk is decoded by itself. The
result is that of one long pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import attach, stored

ROLES = ("system", "user", "assistant")
#: Rows of a chunk (in the sample: turns), and conversations to count chances on, at most on average.
CHUNK = 2048
SAMPLE = 5000
#: Bytes of the texts of the sample, but for a longer single conversation.
SAMPLE_BYTES = 64 << 20
SEED = 17
#: Blocks that one task decodes together, on average, and chunks that one sorts.
GROUP = 4000
SORTED = 16
#: How seldom a role changes inside a block where no marker is.
SLIP = 1e-6

# Words before a colon that name a speaker, by role.
MARKERS = {
    "system": ("system", "sys", "instructions", "developer"),
    "user": ("user", "human", "customer", "q", "question", "prompt", "me", "you", "client"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "agent", "model", "gpt", "response", "support"),
}
_ROLE_OF = {word: k for k, role in enumerate(ROLES) for word in MARKERS[role]}
_MARK = re.compile(r"^\s*(?:#+\s*|\*\*|[<\[(]\|?)?([A-Za-z]{1,12})(?:\*\*|\|?[>\])])?\s*(?:[:>]|[-–—](?=\s))\s*(?:\*\*)?\s*")
_TAG = re.compile(r"^\s*<\|(?:im_start\|>)?\s*([A-Za-z]{1,12})(?:\|>)?\s*$")

#: The kinds of what is seen of a line, with the number of their values.
SEEN = (("marker", len(ROLES) + 1), ("words", 10), ("question", 2), ("code", 2), ("lines", 8), ("turn", 3))


SUMMARY = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("best", pa.list_(pa.float64()))])


def speaker(line: str) -> tuple[int, str]:
    """The role that a marker at the start of a line names (or the number of roles), and the line without it."""
    for pattern in (_TAG, _MARK):
        found = pattern.match(line)
        if found and found.group(1).lower() in _ROLE_OF:
            return _ROLE_OF[found.group(1).lower()], line[found.end() :]
    return len(ROLES), line


def _bucket(n: int, top: int) -> int:
    return min(top, int(np.log2(n + 1) * 1.5)) if n else 0


def lines_of(text: str | None, turn: int | None) -> list[tuple[tuple[int, ...], int, str]]:
    """Of each line of a block: what is seen, how it begins (0: inside, 1: marked, 2: the block), the line without marker."""
    lines = (text or "").split("\n")
    out = []
    for i, line in enumerate(lines):
        who, rest = speaker(line)
        seen = (
            who,
            _bucket(len(rest.split()), SEEN[1][1] - 1),
            int(rest.rstrip().endswith("?")),
            int(rest.lstrip().startswith(("```", "    ", "{", "<"))),
            _bucket(len(lines), SEEN[4][1] - 1) if i == 0 else 0,
            min(2, max(0, turn or 0)) if i == 0 else 2,
        )
        out.append((seen, 2 if i == 0 else 1 if who < len(ROLES) else 0, rest))
    return out


@dataclass
class Model:
    """Logarithms of the chances of the first role, of changes by how a line begins, and of what is seen by role."""

    first: np.ndarray
    change: np.ndarray  # 3, roles, roles
    seen: list[np.ndarray]  # roles, values; each

    def scores(self, seen: np.ndarray) -> np.ndarray:
        return sum(table.T[seen[:, k]] for k, table in enumerate(self.seen))


def decode(model: Model, scores: np.ndarray, begins: np.ndarray, entry: int | None, leave: int | None) -> np.ndarray:
    """The most likely roles of a chunk after the role ``entry`` (None: from the start) that end in ``leave`` (None: in any).

    Of equally likely roles the first in the list is taken.
    """
    n, k = scores.shape
    back = np.zeros((n, k), dtype=np.int8)
    best = (model.first if entry is None else model.change[begins[0]][entry]) + scores[0]
    for i in range(1, n):
        step = best[:, None] + model.change[begins[i]]
        back[i] = step.argmax(axis=0)
        best = step.max(axis=0) + scores[i]
    out = np.empty(n, dtype=np.int64)
    out[-1] = best.argmax() if leave is None else leave
    for i in range(n - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def passage(model: Model, scores: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The best score of a chunk from each role before it (the last row: from the start) to each role at its end."""
    best = np.concatenate((model.change[begins[0]], model.first[None])) + scores[0]
    for i in range(1, len(scores)):
        best = (best[:, :, None] + model.change[begins[i]][None]).max(axis=1) + scores[i]
    return best


def fit(turns: list[tuple]) -> Model:
    """Chances counted on rows of conversation, turn, role and text, in order; one is added to every count.

    A marker is taken at its word unless the sample says otherwise, as few samples have all of them.
    """
    k = len(ROLES)
    first, change = np.ones(k), np.ones((3, k, k))
    change[1] += 0.5
    seen = [np.ones((k, n)) for _, n in SEEN]
    seen[0][:, :k] = 1e-9 + 50.0 * np.eye(k)
    seen[0][:, k] = 10.0
    last, before = None, None
    for conversation, turn, role, text in turns:
        if role not in ROLES:
            last = None
            continue
        r = ROLES.index(role)
        for values, begins, _ in lines_of(text, turn):
            for table, value in zip(seen, values):
                table[r, value] += 1
            if begins == 2:
                if last is None or before != conversation:
                    first[r] += 1
                else:
                    change[2][last, r] += 1
        last, before = r, conversation
    change[0] = SLIP + (1 - k * SLIP) * np.eye(k)
    rows = [np.log(t / t.sum(axis=-1, keepdims=True)) for t in (first, change, *seen)]
    return Model(rows[0], rows[1], rows[2:])


def learned(conversations: DataFrame, limit: int = SAMPLE) -> Model:
    """A model from a bounded sample of conversations, chosen by a hash of their ids. Of each, a chunk is read.

    No more than ``limit`` conversations and ``SAMPLE_BYTES`` of their texts come here: those of the least hashes.
    """
    known = conversations.filter(F.col("role").isin(*ROLES) & F.col("conv_id").isNotNull())
    share = min(1.0, limit / max(1, known.agg(F.approx_count_distinct("conv_id")).first()[0]))
    chance = F.pmod(F.xxhash64(F.lit(SEED), "conv_id"), F.lit(1 << 32))
    rows = known.filter((chance < int(share * (1 << 32))) & F.coalesce(F.col("turn") < CHUNK, F.lit(False)))
    # Repeated rows teach nothing more, and turns that repeat a number are left to the first of them.
    once = rows.dropDuplicates(["conv_id", "turn"]).select("conv_id", "turn", "role", "text", chance.alias("chance"))
    drawn = stored(once, "chat-sample")
    sizes = drawn.groupBy("chance").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("size"))
    first = sizes.orderBy("chance").limit(limit).collect()
    taken = min(len(first), max(1, int(np.searchsorted(np.cumsum([r["size"] for r in first]), SAMPLE_BYTES, "right"))))
    kept = drawn.filter(F.col("chance") <= (first[taken - 1]["chance"] if first else -1))
    return fit([tuple(r) for r in kept.select("conv_id", "turn", "role", "text").orderBy("conv_id", "turn").collect()])


def rendered(role: str, text: str) -> str:
    return f"<|{role}|>\n{text.strip()}\n<|end|>"


def numbered(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` of long conversations with their ``place`` in the order of all and the ``chunk`` of their conversation.

    Spark sorts them by range over as many tasks as the ``total`` asks for, also where they repeat, so that no
    conversation has to fit in a task. Places follow each other within a sorted part; counts of the parts before
    give the number of a row in its conversation.
    """
    keys = ["conv_id", "turn", F.coalesce("text", F.lit("")), "tie"]
    parts = 1 + total // (SORTED * CHUNK)
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = stored(dealt.drop("tie").withColumn("place", F.monotonically_increasing_id()), "long-rows")
    part = F.shiftright("place", 33)
    counts = placed.groupBy("conv_id", part.alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("low"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("low")
    starts = stored(counts.select("conv_id", "part", before.alias("shift")), "long-starts")
    chunk = F.floor((F.col("place") + F.col("shift")) / CHUNK).alias("chunk")
    return attach(placed.withColumn("part", part), starts, ["conv_id", "part"], "place").select("conv_id", "turn", "text", chunk, "place")


def parsed(conversations: DataFrame, model: Model) -> DataFrame:
    """Per recovered turn: ``conv_id``, ``turn``, ``part``, ``role``, ``text`` and its canonical form ``rendered``.

    The roles that the table gives are not looked at. A block gives a turn for each run of lines of one
    role in it, numbered by ``part`` from 0. A null or empty text is one empty line and gives an empty turn.
    Blocks follow ``turn``, null first, then their text; repeated rows are blocks one after the other. Rows without
    a ``conv_id`` are one conversation. An empty table gives no rows; other columns are not looked at.
    """
    shared = conversations.sparkSession.sparkContext.broadcast(model)
    plain = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "text")
    sizes = plain.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > CHUNK)
    long = stored(sizes.select("conv_id", F.lit(True).alias("long")), "long-conversations")
    total = conversations.count()
    rows = attach(plain.withColumn("spot", F.monotonically_increasing_id()), long, ["conv_id"], "spot").drop("spot")
    of_long = numbered(rows.filter("long").drop("long"), total)

    def prepared(table: pa.Table):
        turns, texts = table.column("turn").to_pylist(), table.column("text").to_pylist()
        place = table.column("place").to_pylist()
        order = sorted(range(len(turns)), key=lambda i: (place[i] or 0, turns[i] is not None, turns[i] or 0, texts[i] or "", i))
        blocks = [(turns[i], lines_of(texts[i], turns[i])) for i in order]
        seen = np.array([s for _, lines in blocks for s, _, _ in lines])
        begins = np.array([b for _, lines in blocks for _, b, _ in lines])
        return blocks, shared.value.scores(seen), begins

    def summary(key: tuple, table: pa.Table) -> pa.Table:
        _, scores, begins = prepared(table)
        best = passage(shared.value, scores, begins)
        return pa.table({"conv_id": [key[0].as_py()], "chunk": [key[1].as_py()], "best": [best.ravel().tolist()]}, schema=SUMMARY)

    def borders(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("chunk")
        k = len(ROLES)
        tables = [np.array(b).reshape(k + 1, k) for b in table["best"]]
        best, back = tables[0][k], []
        for step in tables[1:]:
            total = best[:, None] + step[:k]
            back.append(total.argmax(axis=0))
            best = total.max(axis=0)
        leave = [int(best.argmax())]
        for came in reversed(back):
            leave.append(int(came[leave[-1]]))
        leave.reverse()
        entry = [-1, *leave[:-1]]
        return pd.DataFrame({"long_id": [key[0]] * len(leave), "long_chunk": table["chunk"].to_numpy(), "entry": entry, "leave": leave})

    tables = of_long.groupBy("conv_id", "chunk").applyInArrow(summary, "conv_id bigint, chunk bigint, best array<double>")
    known = tables.groupBy("conv_id").applyInPandas(borders, "long_id bigint, long_chunk bigint, entry int, leave int")
    known = stored(known.withColumnsRenamed({"long_id": "conv_id", "long_chunk": "chunk"}), "borders")
    joined = attach(of_long, known, ["conv_id", "chunk"], "place")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("place", "bigint"), ("entry", "int"), ("leave", "int"))]
    short = rows.filter("long is null").drop("long").select("*", F.lit(0).cast("bigint").alias("chunk"), *none)
    joined = joined.unionByName(short)

    def turns(table: pa.Table) -> pa.Table:
        out: list[tuple] = []
        keys = list(zip(table.column("conv_id").to_pylist(), table.column("chunk").to_pylist()))
        groups: dict[tuple, list[int]] = {}
        for i, key in enumerate(keys):
            groups.setdefault(key, []).append(i)
        for (conversation, _), members in groups.items():
            own = table.take(pa.array(members))
            blocks, scores, begins = prepared(own)
            entry, leave = own.column("entry")[0].as_py(), own.column("leave")[0].as_py()
            roles = decode(shared.value, scores, begins, None if entry in (None, -1) else entry, leave)
            at = 0
            for turn, lines in blocks:
                part, current, held = 0, roles[at], []
                for _, begin, rest in lines:
                    if held and (roles[at] != current or begin == 1):
                        out.append((conversation, turn, part, ROLES[current], "\n".join(held)))
                        part, held = part + 1, []
                    current = roles[at]
                    held.append(rest)
                    at += 1
                out.append((conversation, turn, part, ROLES[current], "\n".join(held)))
        columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()))]
        return pa.table([*columns, pa.array([rendered(r[3], r[4]) for r in out], pa.string())], names=["conv_id", "turn", "part", "role", "text", "rendered"])

    # Many chunks to a task, each whole in one of them.
    tasks = F.pmod(F.xxhash64("conv_id", "chunk"), F.lit(1 + total // GROUP)).alias("task")
    schema = "conv_id bigint, turn bigint, part int, role string, text string, rendered string"
    return joined.select("*", tasks).groupBy("task").applyInArrow(turns, schema)
