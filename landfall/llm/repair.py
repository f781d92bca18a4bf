"""Repair of conversations whose turns were damaged, by Hirschberg's divide and conquer.

A whole conversation has roles of the form ``(s?(ua)+)?``: perhaps one system turn, then user and assistant in
turn. That form is an automaton of four states. Rows are kept, given another role or deleted, and empty
turns are inserted, at the least cost; among the cheapest ways the one whose audit (the initials of its edits in
order) is least is taken.

From a state every edit leads to one other state only. So a stretch of rows is told by a small table: what it costs
to get from each state to each other one, and which of these ways have the smaller audit. Two such tables
make that of both stretches, a row has one as well as thousands of rows. Divide and conquer works on them: a forward vector
of four costs, with the order of their audits, meets a backward vector in the middle; of the states where their
sum is least that with the least audit is the crossing; then both halves are done in the same way. Only vectors are
kept, never a table of all rows by states.

Spark sorts and numbers the rows. A conversation is worked on in chunks of so many rows; the tables of its chunks are
combined ``FAN`` at a time up to one, which fixes the states at its ends, and then the crossings go down the same levels
until every chunk knows the states it begins and ends with. No conversation has to fit in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import WHITE, attach, stored

#: Rows of a chunk, tables that are combined together, chunks that one task sorts, and rows that one task repairs, on average.
CHUNK = 2048
FAN = 256
SORTED = 16
GROUP = 8192

# The costs of the edits, and of a truncated row that stays.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5

USER, ASSISTANT = "user", "assistant"
#: Nothing yet, after a system turn, after a user turn, after an assistant turn. The first and the last may end.
START, SYSTEM, ASKED, ANSWERED = range(4)
STATES = 4
#: The state after an inserted turn or a row with a new role, and the role that it gets.
NEXT = (ASKED, ASKED, ANSWERED, ASKED)
NEW_ROLE = (USER, USER, ASSISTANT, USER)
#: The turns that have to follow a state at the end.
LAST = ("", "II", "I", "")

SOUND, CUT, GONE = range(3)
FAULTS = ("", "blank", "duplicate", "truncated")

#: A table: for each state the states that can be reached, as (state, cost, place in the order of audits).
Step = tuple


def _row_words(initial: str, health: int) -> tuple[dict[int, tuple[int, str]], ...]:
    """For each state, the states after one row with the least cost and audit to get there."""
    out = []
    for state in range(STATES):
        best = {state: (COST["D"], "D")}
        if health != GONE:
            at, before = state, ""
            for _ in range(3):
                kept = {"s": SYSTEM if at == START else None, "u": ASKED if at != ASKED else None, "a": ANSWERED if at == ASKED else None}.get(initial)
                for edit, to in (("K", kept), ("R", NEXT[at])):
                    if to is not None:
                        cost = COST["I"] * len(before) + COST[edit] + (TRUNCATED if health == CUT else 0)
                        best[to] = min(best.get(to, (cost, before + edit)), (cost, before + edit))
                at, before = NEXT[at], before + "I"
        out.append(best)
    return tuple(out)


def _step(words: tuple[dict[int, tuple[int, str]], ...]) -> Step:
    """The table of a row, without the words."""
    out = []
    for best in words:
        order = {to: i for i, to in enumerate(sorted(best, key=lambda to: best[to][1]))}
        out.append(tuple((to, best[to][0], order[to]) for to in best))
    return tuple(out)


KINDS = [(initial, health) for initial in ("s", "u", "a", "") for health in (SOUND, CUT, GONE)]
WORDS = [_row_words(*kind) for kind in KINDS]
STEPS = [_step(words) for words in WORDS]

#: Costs and places in the order of audits of the states reached so far.
Reached = dict[int, tuple[int, int]]


def ahead(reached: Reached, step: Step) -> Reached:
    """The states reached after one more table."""
    best: dict[int, tuple[int, int, int]] = {}
    for state, (cost, place) in reached.items():
        for to, more, order in step[state]:
            way = (cost + more, place, order)
            if to not in best or way < best[to]:
                best[to] = way
    # Audits of equally many rows never begin one another, so places decide between any two.
    order = {way: i for i, way in enumerate(sorted({way[1:] for way in best.values()}))}
    return {to: (way[0], order[way[1:]]) for to, way in best.items()}


def behind(costs: dict[int, int], step: Step) -> dict[int, int]:
    """The costs from every state before a table to the end, given those after it."""
    out = {}
    for state in range(STATES):
        ways = [more + costs[to] for to, more, _ in step[state] if to in costs]
        if ways:
            out[state] = min(ways)
    return out


def combined(steps: Sequence[Step]) -> Step:
    """The table of several tables in order."""
    out = []
    for state in range(STATES):
        reached: Reached = {state: (0, 0)}
        for step in steps:
            reached = ahead(reached, step)
        out.append(tuple((to, cost, place) for to, (cost, place) in reached.items()))
    return tuple(out)


def exit_of(steps: Sequence[Step], entry: int) -> int:
    """The state in which the best way from ``entry`` to the end of a conversation ends."""
    reached: Reached = {entry: (0, 0)}
    for step in steps:
        reached = ahead(reached, step)
    return min(reached, key=lambda state: (reached[state][0] + COST["I"] * len(LAST[state]), reached[state][1]))


def crossings(steps: Sequence[Step], entry: int, leave: int) -> list[int]:
    """The states after each table on the best way from one state to another."""
    out = [leave] * len(steps)
    todo = [(0, len(steps), entry, leave)]
    while todo:
        low, high, first, last = todo.pop()
        if high - low < 2:
            continue
        middle = (low + high) // 2
        reached: Reached = {first: (0, 0)}
        for i in range(low, middle):
            reached = ahead(reached, steps[i])
        costs = {last: 0}
        for i in range(high - 1, middle - 1, -1):
            costs = behind(costs, steps[i])
        cross = min((s for s in reached if s in costs), key=lambda s: (reached[s][0] + costs[s], reached[s][1]))
        out[middle - 1] = cross
        todo += [(low, middle, first, cross), (middle, high, cross, last)]
    return out


def edits(kinds: Sequence[int], entry: int = START, leave: int | None = None) -> list[tuple[int, int, str, str | None]]:
    """``(row, number, edit, new role)`` of the best way through rows of some kinds (see ``KINDS``).

    Without ``leave`` the rows end their conversation, and turns that are missing after the last row are numbered on.
    """
    steps = [STEPS[kind] for kind in kinds]
    ends = leave is None
    if ends:
        leave = exit_of(steps, entry)
    out, state = [], entry
    for i, (kind, to) in enumerate(zip(kinds, crossings(steps, entry, leave))):
        word = WORDS[kind][state][to][1]
        if ends and i == len(kinds) - 1:
            word += LAST[to]
        for k, edit in enumerate(word):
            if edit in "IR":
                out.append((i, k, edit, NEW_ROLE[state]))
                state = NEXT[state]
            else:
                out.append((i, k, edit, None))
                if edit == "K":
                    state = {"s": SYSTEM, "u": ASKED, "a": ANSWERED}[KINDS[kind][0]]
    return out


def numbered(conversations: DataFrame) -> DataFrame:
    """The rows in order: ``conv_id``, ``turn``, ``role``, ``text``, ``place``, ``part`` and ``chunk``, and what is known of each row.

    ``place`` follows the order of all rows. Spark sorts them by range into parts, however often a key repeats; ``chunk``
    counts the rows of a conversation within its part, ``CHUNK`` at a time.
    """
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    inner = F.trim(text, F.lit(WHITE))
    health = F.when(inner == "", "blank").when(~F.right(inner, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise("")
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumns(
        {
            "fault": health,
            "same": F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))),
            "mark": F.xxhash64("text"),
            "tie": F.monotonically_increasing_id(),
        }
    )
    keys = ["conv_id", "turn", "role", "mark", "tie"]
    total = conversations.count()
    placed = rows.repartitionByRange(1 + total // (SORTED * CHUNK), *keys).sortWithinPartitions(*keys).drop("mark", "tie")
    kinds = ", ".join(f"{name} {kind}" for name, kind in placed.dtypes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, 0
        for batch in batches:
            ids = batch.column(0)
            new = np.append(True, _differs(ids)) if len(ids) else np.empty(0, bool)
            if len(ids) and last is not None and last[0] == ids[0].as_py():
                new[0] = False
            heads = np.flatnonzero(new)
            number = np.arange(len(ids)) - np.concatenate(([-held], heads))[np.cumsum(new)]
            if len(ids):
                last, held = (ids[-1].as_py(),), int(number[-1]) + 1
            yield pa.record_batch([*batch.columns, pa.array(number // CHUNK, pa.int64())], names=[*batch.schema.names, "chunk"])

    counted = placed.mapInArrow(count, f"{kinds}, chunk bigint").withColumn("place", F.monotonically_increasing_id())
    return stored(counted.withColumn("part", F.shiftright("place", 33)), "repair-rows")


def _differs(ids: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before; null equals null."""
    values = ids.to_pylist()
    return np.array([a != b for a, b in zip(values, values[1:])], dtype=bool)


def faulted(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``chunk``, ``place``, ``initial`` and ``fault`` of the rows, which tells duplicates now.

    The first of equal rows is found by partial minima, and told to the rows by their place, which no two share.
    """
    first = rows.filter("fault != 'blank'").groupBy("conv_id", "same").agg(F.min("place").alias("place"))
    found = rows.join(first.select("place", F.lit(True).alias("first")), "place", "left")
    fault = F.when(F.col("fault") == "blank", "blank").when(F.col("first").isNull(), "duplicate").otherwise(F.col("fault"))
    return found.select("conv_id", "part", "chunk", "place", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))


def _kind(initial: str, fault: str) -> int:
    health = CUT if fault == "truncated" else SOUND if fault == "" else GONE
    return KINDS.index((initial if initial in ("s", "u", "a") else "", health))


def _packed(step: Step) -> list[int]:
    """A table as numbers: 16 costs, -1 where there is no way, and 16 places."""
    cost, place = [-1] * 16, [0] * 16
    for state in range(STATES):
        for to, c, p in step[state]:
            cost[4 * state + to], place[4 * state + to] = c, p
    return cost + place


def _unpacked(numbers: Sequence[int]) -> Step:
    return tuple(
        tuple((to, numbers[4 * s + to], numbers[16 + 4 * s + to]) for to in range(STATES) if numbers[4 * s + to] >= 0) for s in range(STATES)
    )


def _groups(table: pa.Table, names: Sequence[str], by: str) -> Iterator[tuple[list, list[int]]]:
    """The row numbers of each combination of some columns, in the order of another one."""
    found: dict[tuple, list[int]] = {}
    columns = [table.column(name).to_pylist() for name in names]
    order = table.column(by).to_pylist()
    for i, key in enumerate(zip(*columns)):
        found.setdefault(key, []).append(i)
    for key, members in found.items():
        yield list(key), sorted(members, key=order.__getitem__)


def _table(rows: Sequence[tuple], kinds: Sequence[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)})


def _task(rows: int, *keys: str):
    return F.pmod(F.xxhash64(*keys), F.lit(1 + rows // GROUP)).alias("task")


def bordered(marks: DataFrame, long: DataFrame) -> DataFrame:
    """``conv_id``, ``at`` and the states ``entry`` and ``leave`` of every chunk of the conversations that have several.

    ``leave`` is -1 where a conversation ends. ``long`` has the chunks of these conversations and their number ``at`` in them.
    """
    id_type, total = dict(marks.dtypes)["conv_id"], long.count()
    told = f"conv_id {id_type}, at bigint, step array<bigint>"

    def of_rows(rows: pa.Table) -> pa.Table:
        kinds = [_kind(*pair) for pair in zip(rows.column("initial").to_pylist(), rows.column("fault").to_pylist())]
        out = [(*key, _packed(combined([STEPS[kinds[i]] for i in members]))) for key, members in _groups(rows, ("conv_id", "at"), "place")]
        return _table(out, [("conv_id", rows.schema.field("conv_id").type), ("at", pa.int64()), ("step", pa.list_(pa.int64()))])

    def of_steps(rows: pa.Table) -> pa.Table:
        steps = [_unpacked(step) for step in rows.column("step").to_pylist()]
        out = [(*key, _packed(combined([steps[i] for i in members]))) for key, members in _groups(rows, ("conv_id", "up"), "at")]
        return _table(out, [("conv_id", rows.schema.field("conv_id").type), ("at", pa.int64()), ("step", pa.list_(pa.int64()))])

    def of_borders(rows: pa.Table) -> pa.Table:
        steps, out = [_unpacked(step) for step in rows.column("step").to_pylist()], []
        at, entry, leave = (rows.column(c).to_pylist() for c in ("at", "entry", "leave"))
        for (conversation, _), members in _groups(rows, ("conv_id", "up"), "at"):
            own, first, last = [steps[i] for i in members], entry[members[0]], leave[members[0]]
            states = crossings(own, first, exit_of(own, first) if last < 0 else last)
            for n, (i, state) in enumerate(zip(members, states), 1):
                out.append((conversation, at[i], first, -1 if last < 0 and n == len(members) else state))
                first = state
        return _table(out, [("conv_id", rows.schema.field("conv_id").type), *[(c, pa.int64()) for c in ("at", "entry", "leave")]])

    rows = attach(marks, long, ["conv_id", "part", "chunk"], "place").filter("at is not null")
    rows = rows.select("conv_id", "at", "place", "initial", "fault", _task(total * CHUNK, "conv_id", "at"))
    levels = [stored(rows.groupBy("task").applyInArrow(of_rows, told), "repair-steps")]
    while (levels[-1].agg(F.max("at")).first()[0] or 0) >= FAN:
        above = levels[-1].withColumn("up", F.floor(F.col("at") / FAN))
        levels.append(stored(above.select("*", _task(total, "conv_id", "up")).groupBy("task").applyInArrow(of_steps, told), "repair-steps"))
    known = None
    for level in reversed(levels):
        nodes = level.withColumn("up", F.floor(F.col("at") / FAN))
        if known is None:
            nodes = nodes.withColumns({"entry": F.lit(START).cast("bigint"), "leave": F.lit(-1).cast("bigint")})
        else:
            nodes = attach(nodes, known.withColumnRenamed("at", "up"), ["conv_id", "up"], "at")
        borders = nodes.select("*", _task(total, "conv_id", "up")).groupBy("task").applyInArrow(
            of_borders, f"conv_id {id_type}, at bigint, entry bigint, leave bigint"
        )
        known = stored(borders, "repair-borders")
    return known


def repaired(conversations: DataFrame) -> DataFrame:
    """Every edit of every conversation: ``conv_id``, ``place``, ``number``, ``edit``, ``turn``, ``role``, ``text``, ``was`` and ``fault``.

    ``place`` and ``number`` give the order. ``edit`` is K (kept), R (another role), D (deleted) or I (inserted); ``role`` and
    ``text`` are those of the repaired turn, null where it is deleted, and ``was`` is the role before. An inserted turn has an empty text and
    neither ``turn`` nor ``was``; ``fault`` is blank, duplicate, truncated or empty.

    Rows follow ``turn``, null first; rows of one turn follow their role and then a hash of their text. A null role or text is
    one space. Rows without a ``conv_id`` are one conversation. Repeated rows are duplicates of the first of them. A text is blank
    without any character but white space, and truncated if the last other one is none of ``.!?``, however long it is. An
    empty table gives no rows. Other columns are not looked at.
    """
    rows = numbered(conversations.select("conv_id", "turn", "role", "text"))
    id_type = dict(rows.dtypes)["conv_id"]
    marks = stored(faulted(rows), "repair-marks")
    heads = marks.select("conv_id", "part", "chunk").distinct()
    order = Window.partitionBy("conv_id").orderBy("part", "chunk")
    every = heads.withColumn("at", (F.row_number().over(order) - 1).cast("bigint"))
    several = every.filter("at = 1").select(F.col("conv_id").alias("of"), F.lit(True).alias("several"))
    long = stored(every.join(several, F.col("conv_id").eqNullSafe(F.col("of")), "left_semi"), "repair-chunks")
    total = marks.count()
    found = attach(marks, long, ["conv_id", "part", "chunk"], "place")
    found = attach(found, bordered(marks, long), ["conv_id", "at"], "place")

    def mend(table: pa.Table) -> pa.Table:
        kinds = [_kind(*pair) for pair in zip(table.column("initial").to_pylist(), table.column("fault").to_pylist())]
        places, fault = table.column("place").to_pylist(), table.column("fault").to_pylist()
        entry, leave = table.column("entry").to_pylist(), table.column("leave").to_pylist()
        out = []
        for (_, _, _), members in _groups(table, ("conv_id", "part", "chunk"), "place"):
            first, last = entry[members[0]], leave[members[0]]
            own = edits([kinds[i] for i in members], START if first is None else first, None if last in (None, -1) else last)
            out += [(places[members[i]], number, edit, role, fault[members[i]]) for i, number, edit, role in own]
        return _table(out, [("place", pa.int64()), ("number", pa.int32()), ("edit", pa.string()), ("new", pa.string()), ("fault", pa.string())])

    told = found.select("conv_id", "part", "chunk", "place", "initial", "fault", "entry", "leave", _task(total, "conv_id", "part", "chunk"))
    done = told.groupBy("task").applyInArrow(mend, "place bigint, number int, edit string, new string, fault string")
    edit = F.col("edit")
    source = edit != "I"
    return done.join(rows.drop("fault", "same", "part", "chunk"), "place").select(
        F.col("conv_id").cast(id_type),
        "place",
        "number",
        "edit",
        F.when(source, F.col("turn")).alias("turn"),
        F.when(edit == "K", F.col("role")).otherwise(F.col("new")).alias("role"),
        F.when(edit == "I", "").when(edit != "D", F.col("text")).alias("text"),
        F.when(source, F.col("role")).alias("was"),
        F.when(source, F.col("fault")).otherwise("").alias("fault"),
    )


class _Digest:
    """What is told of one conversation, edit by edit."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.audit, self.cost, self.illegal = bytearray(), 0, 0
        self.counts = dict.fromkeys(FAULTS[1:], 0)
        self.turns: list = [None, None, 0]
        self.before: str | None = None
        self.hash, self.written = hashlib.sha256(), False

    def add(self, edit: str, turn: int | None, role: str | None, text: str | None, was: str | None, fault: str) -> None:
        self.audit += edit.encode()
        self.cost += COST[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if edit != "I":
            if fault:
                self.counts[fault] += 1
            if turn is not None and turn != self.turns[1]:
                self.turns = [turn if self.turns[0] is None else self.turns[0], turn, self.turns[2] + 1]
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
        if edit != "D":
            self.hash.update(("\n" * self.written + f"{role}:{text}").encode())
            self.written = True

    def row(self) -> tuple:
        low, high, distinct = self.turns
        gaps = 0 if low is None else high - low + 1 - distinct
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, self.cost, self.audit.decode(), self.hash.hexdigest())


def digests(edits_: DataFrame) -> DataFrame:
    """Per conversation with edits: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    A digest follows its text from start to end, so the edits of a conversation pass through one task, in order and
    one batch at a time; none is held.
    """
    id_type = dict(edits_.dtypes)["conv_id"]
    id_arrow = {}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for batch in batches:
            id_arrow["type"] = batch.schema.field("conv_id").type
            out = []
            for conv_id, *row in zip(*[column.to_pylist() for column in batch.columns]):
                if now is None or now.conv_id != conv_id:
                    out += [] if now is None else [now.row()]
                    now = _Digest(conv_id)
                now.add(*row)
            if out:
                yield from _digest_rows(out, id_arrow["type"])
        if now is not None:
            yield from _digest_rows([now.row()], id_arrow["type"])

    shape = ", ".join([f"conv_id {id_type}", *[f"{name} bigint" for name in ("gaps", *FAULTS[1:], "illegal", "cost")], "audit string, repaired_sha256 string"])
    ordered = edits_.repartition("conv_id").sortWithinPartitions("conv_id", "place", "number")
    return ordered.select("conv_id", "edit", "turn", "role", "text", "was", "fault").mapInArrow(read, shape)


def _digest_rows(rows: list[tuple], id_type: pa.DataType) -> list[pa.RecordBatch]:
    names = ["gaps", *FAULTS[1:], "illegal", "cost"]
    kinds = [("conv_id", id_type), *[(name, pa.int64()) for name in names], ("audit", pa.string()), ("repaired_sha256", pa.string())]
    return _table(rows, kinds).to_batches()


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by a hash of their id and turn, to be repaired.

    Of 20 equal parts one loses its rows, one its texts, one the marks that end sentences, one has every row twice and in one
    all turns are the user's. Nulls are one space, but ``conv_id`` and ``turn`` stay null.
    """
    space = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    case = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), space).alias("role"), text.alias("text"), case.alias("case")).filter("case != 0")
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    changed = rows.withColumns({"text": text, "role": F.when(F.col("case") == 4, USER).otherwise(F.col("role"))})
    twice = changed.withColumn("copy", F.explode(F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return twice.select("conv_id", "turn", "role", "text")


def told(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """The digests of ``rows`` for every ``conv_id`` of ``conversations``; those without rows have zeros, no audit and the hash of nothing."""
    found = digests(repaired(rows)).withColumnRenamed("conv_id", "of")
    ids = conversations.select("conv_id").distinct()
    joined = ids.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    none = {name: F.coalesce(name, F.lit(0).cast("bigint")) for name in ("gaps", *FAULTS[1:], "illegal", "cost")}
    return joined.withColumns({**none, "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))})
