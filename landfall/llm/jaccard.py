"""Documents whose sets of word shingles overlap: an exact Jaccard join by T-occurrence search.

1. Every text becomes its set of distinct hashed shingles. Equal sets are one node from here on.
2. A node with n shingles can be linked only if it shares T(n) = ceil(threshold * n) of them with
   one other node. Two filters drop the nodes that cannot: first by a prefix of their shingles in
   hash order, then, for the nodes left, by the whole sets. Both ask only which shingles occur in
   two nodes or more.
3. Linked nodes share one of their held - T + 1 rarest shingles. Nodes joined by such shingles, directly
   or over others, form a block, so no link leaves its block. Large blocks are divided into chunks of
   a bounded size, and each pair of chunks is a unit of work.
4. In a unit the shingles of one chunk are inverted lists, and each node of the other is a query for
   the DivideSkip search: its longest lists, at most T - 1, are set aside; the short ones are merged,
   and nodes found in at least T minus their number are candidates. These are looked up in the
   long lists by binary search until they can no longer reach T. The overlap found is exact.
   The lists are searched in ranges of numbers, of few nodes first, and what the links found in one range connect
   is taken out of the lists before the next. So a group of near copies gives as many links as it has members and
   not as many as it has pairs, and most of its members are compared with few others.
5. Links give components, and these the smallest document of each.

Shingles and sets are known by 64-bit hashes; all else is exact, with no limit on lists or partners.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import BROADCAST_ROWS, attach, quoted, stored
from landfall.llm.components import components
from landfall.llm.words import mix, slices, words_of

SHINGLE = 5
PERCENT = 80
#: Shingles of a bucket in which shared ones are looked for, on average.
BUCKET = 400_000
#: Shingles of a chunk of a block, and of the units that one task takes together.
CHUNK = 2_000_000
TOGETHER = 1_000_000
#: Numbers in the first range of lists that a query searches; each further range is so many times as long.
FIRST_RANGE, LONGER = 16, 8
#: The weight of a binary search against a step of the merge, as published with the method.
MU = 0.0085


def least_overlap(n, percent: int = PERCENT):
    """T(n): shingles that a set of n shares with any set it is linked with. For numbers, arrays and columns."""
    return (n * percent + 99) // 100 if not isinstance(n, Column) else F.floor((n * percent + 99) / 100)


def early_overlap(n):
    """How many of these lie within the prefixes of both sets; see ``prefix_length``."""
    return 1 + n // 10


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of a prefix.

    Of the T common shingles of two sets the first ``early_overlap`` lie within this many of each.
    """
    return n - least_overlap(n, percent) + early_overlap(n)


def sets_of(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for low, high in slices(texts):
        words = words_of(texts.slice(low, high - low), fold=True)
        hashes = words.hashes()
        values, begin = words.windows(hashes, size)
        at = np.searchsorted(begin, words.first)
        for i in range(high - low):
            found = np.unique(values[at[i] : at[i + 1]])
            n = int(words.first[i + 1] - words.first[i])
            if 0 < n < size:
                own = hashes[words.first[i] : words.first[i + 1]]
                steps = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(n * 2 + 1)) | np.uint64(1)
                found = mix((own * steps).sum(dtype=np.uint64, keepdims=True))
            yield found


def _node(found: np.ndarray) -> int:
    """One hash of a whole set."""
    total = mix(found ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + np.uint64(len(found))).view(np.int64)[0])


def _lists(values: list[np.ndarray], kind=None) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


PRINTS = "doc_id bigint, mark bigint, n bigint, node bigint, prefix array<bigint>"


def prints(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document a hash of its text, the number of its shingles, the hash of its set (null if empty) and the first shingles of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for low, high in slices(texts):
                found = list(sets_of(texts.slice(low, high - low), size))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        pa.array([len(x) for x in found], pa.int64()),
                        pa.array([_node(x) if len(x) else None for x in found], pa.int64()),
                        _lists([x[: prefix_length(len(x), percent)] for x in found]),
                    ],
                    names=["doc_id", "mark", "n", "node", "prefix"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("mark")).mapInArrow(work, PRINTS)


def shared(sets: DataFrame) -> DataFrame:
    """``token`` and ``node`` for all tokens that two nodes or more hold, of rows ``node``, ``tokens`` (a list).

    A task deals its tokens by hash into buckets as packed arrays. Tokens that several nodes of the
    same batch hold are known to be shared: their rows go to buckets by chance and one marker
    tells the token's own bucket. So a bucket gets at most one entry per token and batch, however
    many nodes hold it, and the same node in two batches counts once.
    """
    total = sets.agg(F.sum(F.size("tokens"))).first()[0] or 0
    buckets = 1 + total // BUCKET

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, at = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
            lists = batch.column(1).take(pa.array(at))
            tokens = lists.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(nodes, np.diff(lists.offsets.to_numpy()))
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            new = np.append(True, tokens[1:] != tokens[:-1]) if len(tokens) else np.empty(0, bool)
            run = np.cumsum(new) - 1
            many = np.bincount(run, minlength=1)[run] > 1 if len(tokens) else new
            mark = new & many
            kind = np.concatenate((np.where(many, 2, 0), np.ones(int(mark.sum()), int)))
            token, node = np.concatenate((tokens, tokens[mark])), np.concatenate((owner, owner[mark]))
            spot = np.where(kind == 2, mix(token ^ node.view(np.uint64)), mix(token)) % np.uint64(buckets)
            order = np.lexsort((kind, spot))
            token, node, key = token[order], node[order], spot[order].astype(np.int64) * 4 + kind[order]
            cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, int)
            ends = np.append(cuts[1:], len(key))
            yield pa.record_batch(
                [
                    pa.array(key[cuts] // 4, pa.int64()),
                    pa.array(key[cuts] % 4, pa.int64()),
                    pa.array([token[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
                    pa.array([b"" if k % 4 == 1 else node[a:b].tobytes() for k, a, b in zip(key[cuts], cuts, ends)], pa.binary()),
                ],
                names=["bucket", "kind", "tokens", "nodes"],
            )

    def gather(rows: pa.Table) -> pa.Table:
        kinds = rows.column("kind").to_pylist()
        parts = {k: [[], []] for k in (0, 1, 2)}
        for kind, t, n in zip(kinds, rows.column("tokens"), rows.column("nodes")):
            parts[kind][0].append(np.frombuffer(t.as_py(), np.uint64))
            parts[kind][1].append(np.frombuffer(n.as_py(), np.int64))
        parts = {k: [np.concatenate(x) if x else np.empty(0, t) for x, t in zip(v, (np.uint64, np.int64))] for k, v in parts.items()}
        token, node = parts[0]
        order = np.lexsort((node, token))
        token, node = token[order], node[order]
        fresh = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))[: len(token)]
        token, node = token[fresh], node[fresh]
        run = np.cumsum(np.append(True, token[1:] != token[:-1])[: len(token)]) - 1
        several = np.bincount(run, minlength=1)[run] > 1 if len(token) else fresh
        several = several | np.isin(token, parts[1][0])
        out_t, out_n = np.concatenate((token[several], parts[2][0])), np.concatenate((node[several], parts[2][1]))
        return pa.table({"token": pa.array(out_t.view(np.int64)), "node": pa.array(out_n)})

    packed = sets.select("node", "tokens").mapInArrow(deal, "bucket bigint, kind bigint, tokens binary, nodes binary")
    return packed.groupBy("bucket").applyInArrow(gather, "token bigint, node bigint").distinct()


def linkable(docs: DataFrame, nodes: DataFrame, printed: DataFrame, size: int, percent: int) -> DataFrame:
    """``node``, ``n`` and ``tokens`` (the whole set) of the nodes that may have a link."""
    early = shared(printed.filter("n > 0").select("node", F.col("prefix").alias("tokens"))).groupBy("node").agg(F.count(F.lit(1)).alias("held"))
    # A partner may be smaller by the threshold, and so may its own prefix.
    least = 1 + F.floor(least_overlap(F.col("n"), percent) / 10)
    wanted = stored(nodes.join(early, "node").filter(F.col("held") >= least).select("node", "n", F.col("rep").alias("doc_id"), "mark"), "early")
    counted = wanted.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id").isNull()).alias("unnamed")).first()
    few = counted["n"] <= BROADCAST_ROWS
    chosen = docs.select(F.col("doc_id").cast("bigint"), "text").join(F.broadcast(wanted) if few else wanted, "doc_id").select("text", "node")
    if counted["unnamed"]:
        # No row of these nodes has an id, so one text of each is found by its hash; copies are taken together first.
        marked = docs.filter(F.col("doc_id").isNull()).select(F.xxhash64("text").alias("mark"), "text")
        sought = wanted.filter(F.col("doc_id").isNull()).select("mark", "node")
        if few:
            marked = marked.join(F.broadcast(sought.select("mark")), "mark", "left_semi")
        once = marked.groupBy("mark").agg(F.first("text").alias("text"))
        chosen = chosen.unionByName(once.join(F.broadcast(sought) if few else sought, "mark").select("text", "node"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for low, high in slices(texts):
                rows = [
                    (node, x)
                    for node, x in zip(batch.column(1).slice(low, high - low).to_pylist(), sets_of(texts.slice(low, high - low), size))
                    if len(x) and _node(x) == node
                ]
                yield pa.record_batch(
                    [
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([len(r[1]) for r in rows], pa.int64()),
                        _lists([r[1] for r in rows]),
                    ],
                    names=["node", "n", "tokens"],
                )

    # Rows that repeat an id can bring a set twice.
    return chosen.mapInArrow(whole, "node bigint, n bigint, tokens array<bigint>").dropDuplicates(["node"])


def filtered(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sets that share enough with others, and their shared tokens: ``token``, ``node``, ``n``, ``held``.

    The filter is applied twice, as nodes that went may have held tokens of nodes that stayed.
    """
    for _ in range(2):
        both = stored(shared(sets), "shared")
        held = both.groupBy("node").agg(F.count(F.lit(1)).alias("held")).join(sets.select("node", "n"), "node")
        enough = held.filter(F.col("held") >= least_overlap(F.col("n"), percent))
        sets = stored(sets.join(enough.select("node"), "node", "left_semi"), "sets")
    return sets, both.join(enough, "node")


def blocks(tokens: DataFrame, percent: int) -> DataFrame:
    """``node`` and ``block`` of the nodes that share one of their rarest tokens with another node."""
    seen = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("nodes"))
    order = Window.partitionBy("node").orderBy("nodes", "token")
    ranked = tokens.join(seen, "token").withColumn("place", F.row_number().over(order))
    rare = stored(ranked.filter(F.col("place") <= F.col("held") - least_overlap(F.col("n"), percent) + 1).select("token", "node"), "rare")
    first = rare.groupBy("token").agg(F.min("node").alias("a"))
    edges = rare.join(first, "token").filter(F.col("a") != F.col("node")).select("a", F.col("node").alias("b"))
    return components(edges).withColumnRenamed("component", "block")


class Index:
    """Inverted lists of the tokens of some sets; set numbers follow the sizes of the sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(x) for x in sets])
        token = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(token, kind="stable")
        token, self.owner = token[order], owner[order]
        self.begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        self.token = token[self.begin]
        self.end = np.append(self.begin[1:], len(token))

    def lists(self, query: np.ndarray, low: int, high: int) -> list[np.ndarray]:
        """The lists of the tokens of a query, as far as they hold numbers from ``low`` to ``high``."""
        # A set is sorted as unsigned numbers, so where its signed numbers lie beyond the tokens can be anywhere in it.
        at = np.searchsorted(self.token, query)
        inside = at < len(self.token)
        at, query = at[inside], query[inside]
        at = at[self.token[at] == query]
        out = []
        for a, b in zip(self.begin[at].tolist(), self.end[at].tolist()):
            part = self.owner[a:b]
            if part[0] < low or part[-1] >= high:
                part = part[slice(*np.searchsorted(part, (low, high)))]
            if len(part):
                out.append(part)
        return out


def divide_skip(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur in at least ``least`` of some sorted lists, and in how many."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    if len(lists) < least:
        return none
    lists = sorted(lists, key=len)
    aside = min(least - 1, int(least / (MU * np.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    found, count = merged(short, least - aside)
    for left, entries in zip(range(len(long), 0, -1), long):
        reach = count + left >= least
        if not reach.all():
            found, count = found[reach], count[reach]
        if not len(found):
            return none
        at = np.minimum(entries.searchsorted(found), len(entries) - 1)
        count = count + (entries[at] == found)
    enough = count >= least
    return found[enough], count[enough]


def merged(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in at least ``least`` of some sorted lists, from a heap over the heads of the lists."""
    found, count = [], []
    heap = [(int(x[0]), k, 0) for k, x in enumerate(lists)]
    heapq.heapify(heap)
    while len(heap) >= least:
        value, run = heap[0][0], 0
        while heap and heap[0][0] == value:
            _, k, at = heap[0]
            run += 1
            if at + 1 < len(lists[k]):
                heapq.heapreplace(heap, (int(lists[k][at + 1]), k, at + 1))
            else:
                heapq.heappop(heap)
        if run >= least:
            found.append(value)
            count.append(run)
    return np.array(found, np.int64), np.array(count, np.int64)


def ranges(low: int, high: int) -> Iterator[tuple[int, int]]:
    """Ranges that make up ``low`` to ``high``, from the highest down, each ``LONGER`` times as long as the one before."""
    length = FIRST_RANGE
    while high > low:
        yield max(low, high - length), high
        high, length = high - length, LONGER * length


def between(lists: list[np.ndarray], low: int, high: int) -> list[np.ndarray]:
    """What sorted lists hold from ``low`` to below ``high``; lists with none are left out."""
    parts = (x[x.searchsorted(low) : x.searchsorted(high)] for x in lists)
    return [x for x in parts if len(x)]


def without(lists: list[np.ndarray], gone: np.ndarray) -> list[np.ndarray]:
    """Lists without the numbers that an array of flags marks; lists with no others are left out."""
    flat = np.concatenate(lists)
    stays = ~gone[flat]
    ends = np.cumsum(stays)[np.cumsum([len(x) for x in lists]) - 1]
    return [x for x in np.split(flat[stays], ends[:-1]) if len(x)]


def unit_links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int, spanning: bool) -> list[tuple[int, int]]:
    """Linked pairs of numbers within ``left``, or between ``left`` and ``right``; both are sorted by size.

    ``spanning`` leaves out links between nodes that other links connect.
    """
    index = Index(left)
    queries = left if right is None else right
    root = np.arange(len(left) + (0 if right is None else len(right)))
    out = []
    for q, query in enumerate(queries):
        n = len(query)
        least = least_overlap(n, percent)
        low = int(np.searchsorted(index.size, least))
        high = q if right is None else int(np.searchsorted(index.size, n * 100 // percent, "right"))
        if low >= high:
            continue
        own = q if right is None else len(left) + q
        lists = index.lists(query, low, high)
        dense = sum(map(len, lists)) > FIRST_RANGE * len(lists)
        for a, b in ranges(low, high) if spanning and dense else [(low, high)]:
            if len(lists) < least:
                break
            near, both = divide_skip(between(lists, a, b), least)
            good = near[both * 100 >= (n + index.size[near] - both) * percent].tolist()
            if not spanning:
                out.extend((other, q) for other in good)
                continue
            more = False
            for other in good:
                if root[other] != root[own]:
                    root[root == root[other]] = root[own]
                    out.append((other, q))
                    more = True
            if more:
                lists = without(lists, root == root[own])
    return out


def links(sets: DataFrame, block: DataFrame, percent: int = PERCENT, spanning: bool = True) -> DataFrame:
    """Linked pairs of nodes ``a``, ``b`` of rows ``node``, ``n``, ``tokens``, unit by unit."""
    placed = sets.join(block, "node")
    chunks = stored(placed.groupBy("block").agg(F.sum("n").alias("total")).withColumn("chunks", F.ceil(F.col("total") / CHUNK)), "blocks")
    total = chunks.agg(F.sum(F.col("total") * F.col("chunks"))).first()[0] or 0
    tasks = 1 + total // TOGETHER
    own = F.pmod(F.xxhash64("node"), F.col("chunks"))
    units = (
        placed.join(chunks.select("block", "chunks"), "block")
        .select("node", "tokens", "block", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("node", "tokens", "block", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), (F.col("own") > F.col("other")).alias("second"))
    )

    def search(rows: pa.Table) -> pa.Table:
        nodes = rows.column("node").to_numpy()
        lists = rows.column("tokens").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        keys = np.stack([rows.column(c).to_numpy() for c in ("block", "x", "y")])
        second = rows.column("second").to_numpy(zero_copy_only=False)
        order = np.lexsort((np.diff(at), *keys[::-1]))
        change = np.flatnonzero(np.append(True, (keys[:, order][:, 1:] != keys[:, order][:, :-1]).any(axis=0)))
        out = []
        for unit in np.split(order, change[1:]):
            x, y = int(keys[1, unit[0]]), int(keys[2, unit[0]])
            one, two = (unit, None) if x == y else (unit[~second[unit]], unit[second[unit]])
            if len(one) and (two is None or len(two)):
                pick = lambda part: [flat[at[i] : at[i + 1]] for i in part]
                found = unit_links(pick(one), None if two is None else pick(two), percent, spanning)
                out.extend((nodes[one[a]], nodes[(one if two is None else two)[b]]) for a, b in found)
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    task = F.pmod(F.xxhash64("block", "x", "y"), F.lit(tasks)).alias("task")
    return units.select(task, "node", "tokens", "block", "x", "y", "second").groupBy("task").applyInArrow(search, "a bigint, b bigint")


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``row`` (a number), ``doc_id``, ``mark``, ``n``, ``node``, ``component`` (a node that stands for it) and ``least``, its smallest id, of every row."""
    printed = stored(prints(docs, size, percent).withColumn("row", F.monotonically_increasing_id()), "prints")
    seen = printed.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.min("mark").alias("mark"))
    nodes = stored(seen, "nodes")
    sets = stored(linkable(docs, nodes, printed, size, percent), "sets")
    sets, tokens = filtered(sets, percent)
    found = components(links(sets, blocks(tokens, percent), percent))
    whole = found.join(nodes.select("node", "rep"), "node")
    least = whole.join(whole.groupBy("component").agg(F.min("rep").alias("least")), "component").select("node", "component", "least")
    named = nodes.join(least, "node", "left").select("node", F.coalesce("component", "node").alias("component"), F.coalesce("least", "rep").alias("least"))
    return attach(printed.drop("prefix"), stored(named, "named"), ["node"], "row")


def similar(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document ``doc_id``, ``n_shingles``, ``node`` (the hash of its set) and ``component_id``.

    Words are runs of characters that are not white space, with A to Z in lower case. A text with
    fewer words than a shingle has one, of all its words. A null or empty text has none, a null
    ``node`` and no links: its component is its own id. ``component_id`` is the smallest id that
    links reach. A row without an id takes part like any other and is never the smallest, unless
    no row of its component has an id; then that is null. Rows that repeat an id keep their number
    and their sets. An empty table gives no rows. Only ``doc_id`` and ``text`` are looked at.
    """
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    return _grouped(docs, size, percent).select("doc_id", F.col("n").alias("n_shingles"), "node", component)


def survivors(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each group of near duplicates, with all columns: that with the smallest id, then the smallest hash of its text.

    A row without an id stays only if no row of its group has one. Of rows that are alike in id and text the first in the order of the other
    columns stays. Rows that repeat an id with different texts are documents of their own. Null and empty texts, and those without a word, are like
    nothing and all stay.
    """
    rows = _grouped(docs.select("doc_id", "text"), size, percent).filter("node is not null")
    texts = stored(rows.groupBy("component", "doc_id", "mark").agg(F.count(F.lit(1)).alias("rows")), "texts")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("first")
    told = attach(texts, stored(texts.groupBy("component").agg(least), "firsts"), ["component"], "doc_id")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark"))
    # Most texts stay as they are, so the rows of the others are looked up and not theirs.
    others = told.withColumn("repeats", stays).filter(~stays | (F.col("rows") > 1))
    others = stored(others.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__own"), "repeats"), "others")
    columns = [F.col(quoted(c)) for c in docs.columns]
    named = docs.select(*columns, F.col("doc_id").cast("bigint").alias("__id"), F.xxhash64("text").alias("__own"), F.monotonically_increasing_id().alias("__spot"))
    marked = attach(named, others.withColumnRenamed("repeats", "__repeats"), ["__id", "__own"], "__spot")
    kept = marked.filter("__repeats is null").select(*columns)
    if others.filter("repeats").isEmpty():
        return kept
    rest = [quoted(c) for c in docs.columns if c not in ("doc_id", "text")]
    once = marked.filter("__repeats").groupBy("doc_id", "__own").agg(F.min(F.struct("text", *rest)).alias("__row"))
    return kept.unionByName(once.select("doc_id", "__row.*").select(*columns))
