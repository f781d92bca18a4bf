"""Benchmark passages in documents, by a distributed positional inverted index.

The index is a stored table. Each of its rows is the index of a block of documents: the distinct words of the block and,
for each of them, the list of places where it stands, with the places at which the documents of the block begin.

Every window of consecutive words of a benchmark item is a query. Windows are known by their words, so that one that
several items hold is asked once, for all of them. In a block the windows with a word that the block lacks are
out at once. For the others the lists of their words are taken from the shortest to the longest: the places of the rarest word,
less its offset in the window, are where the window can begin, and each further list, less its own offset, leaves those
that it holds as well. Those left by all lists are phrase matches. Where the lists need only agree up to a
few places, the matches are of proximity.

Windows are asked in groups of a bounded number, each of which is sent to all tasks; the index is read once per group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import stored
from landfall.llm.words import SPACE, slices, words_of

WINDOW = 10
#: Places by which the words of a proximity match may be off.
SLOP = 2
#: Windows with an item each that are sent to all tasks together, on average, and places that are looked at together.
TOGETHER = 100_000
STARTS = 1 << 20
#: Bytes of text of a block, but for a longer single text.
BLOCK_BYTES = 1 << 19

# The bytes that part words, once A to Z are in lower case.
PARTING = np.zeros_like(SPACE)
PARTING[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True

INDEX = "block bigint, ids array<bigint>, begins binary, terms binary, ends binary, places binary"
FOUND = "block bigint, number int, doc_id bigint, n_words bigint, n_hit bigint, n_near bigint, hit binary, items array<bigint>"


def indexed(docs: DataFrame) -> DataFrame:
    """The positional index of ``doc_id``, ``text``: a row per block, with all arrays packed.

    ``ids`` and ``begins`` are the documents of the block and the places of their first words, and one place more for the end;
    ``terms`` are the hashes of its distinct words in order, ``ends`` where the list of each ends in ``places``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high in slices(batch.column(1), BLOCK_BYTES):
                words = words_of(batch.column(1).slice(low, high - low), fold=True, parting=PARTING)
                hashes = words.hashes()
                order = np.argsort(hashes, kind="stable")
                terms, counts = np.unique(hashes, return_counts=True)
                arrays = (words.first.astype("<i8"), terms.astype("<u8"), np.cumsum(counts).astype("<i8"), order.astype("<u4"))
                ids = batch.column(0).slice(low, high - low)
                columns = [pa.array([block], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64()))]
                columns += [pa.array([a.tobytes()], pa.binary()) for a in arrays]
                yield pa.record_batch(columns, names=["block", "ids", "begins", "terms", "ends", "places"])
                block += 1

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, INDEX)


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``words`` (hashes) and ``item_id`` of all windows of ``item_id``, ``text``; an item of fewer words is one window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(1)):
                words = words_of(batch.column(1).slice(low, high - low), fold=True, parting=PARTING)
                hashes = words.hashes().view(np.int64)
                n = np.diff(words.first)
                length = np.minimum(n, size)
                full = np.where(n > 0, n - length + 1, 0)
                owner = np.repeat(np.arange(len(n)), full)
                begin = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full) + words.first[owner]
                count = length[owner]
                ends = np.cumsum(np.append(0, count))
                spot = np.arange(int(ends[-1])) - np.repeat(ends[:-1], count) + np.repeat(begin, count)
                lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(hashes[spot], pa.int64()))
                yield pa.record_batch([lists.cast(pa.list_(pa.int64())), batch.column(0).slice(low, high - low).take(pa.array(owner))], names=["words", "item_id"])

    return items.select(F.col("item_id").cast("bigint"), "text").mapInArrow(work, "words array<bigint>, item_id bigint").distinct()


@dataclass
class Queries:
    """Distinct windows: ``words`` has a row each, filled up with zeros after ``length``; ``items`` of window ``i`` end at ``ends[i]``.

    A window whose items are in several groups is asked in each of them, and the leading one counts its proximity matches.
    """

    words: np.ndarray
    length: np.ndarray
    items: np.ndarray
    ends: np.ndarray
    named: np.ndarray
    leads: np.ndarray


def queries(rows: list) -> Queries:
    """The windows of ``(words, item_id, leads)`` rows. A window of an item without an id is asked but names no item."""
    held: dict[tuple, list] = {}
    leading = set()
    for words, item, leads in rows:
        held.setdefault(tuple(words), []).append(item)
        if leads:
            leading.add(tuple(words))
    size = max(map(len, held), default=1)
    words = np.array([[*w, *[0] * (size - len(w))] for w in held], np.int64).reshape(-1, size)
    known = [sorted(i for i in items if i is not None) for items in held.values()]
    ends = np.cumsum([len(i) for i in known], dtype=np.int64)
    return Queries(words.view(np.uint64), np.array([len(w) for w in held], np.int64), np.array([i for x in known for i in x], np.int64), ends, np.array([len(i) for i in known], np.int64), np.array([w in leading for w in held], bool))


@dataclass
class Block:
    """The index of a block of documents."""

    begins: np.ndarray
    terms: np.ndarray
    ends: np.ndarray
    places: np.ndarray

    def __post_init__(self):
        self.heads = np.append(0, self.ends[:-1]).astype(np.int64)[: len(self.ends)]
        self.counts = self.ends - self.heads
        self.total = len(self.places)
        # Term after term and place after place, so that one search finds the next place of any term.
        self.keys = np.repeat(np.arange(len(self.terms), dtype=np.int64), self.counts) * (self.total + 1) + self.places

    def holds(self, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the list of each term holds a place from ``low`` to ``high``, both included."""
        base = term * (self.total + 1)
        at = np.searchsorted(self.keys, base + np.maximum(low, 0))
        inside = at < len(self.keys)
        out = np.zeros(len(term), bool)
        out[inside] = self.keys[at[inside]] <= (base + high)[inside]
        return out & (low <= high)

    def matches(self, asked: Queries, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """``window``, the place where it begins, the document, and whether it is a phrase, of all matches, in parts."""
        if not len(self.terms) or not len(asked.words):
            return
        at = np.searchsorted(self.terms, asked.words)
        at[at == len(self.terms)] = 0
        used = np.arange(asked.words.shape[1]) < asked.length[:, None]
        possible = np.flatnonzero(((self.terms[at] == asked.words) | ~used).all(axis=1))
        if not len(possible):
            return
        at, used = at[possible].astype(np.int64), used[possible]
        sizes = np.where(used, self.counts[at], np.iinfo(np.int64).max)
        order = np.argsort(sizes, axis=1, kind="stable")
        least = np.take_along_axis(sizes, order[:, :1], axis=1).ravel()
        total, low = np.cumsum(least * (2 * slop + 1)), 0
        while low < len(possible):
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + STARTS, "right")))
            yield from self._matched(asked, possible[low:high], at[low:high], order[low:high], least[low:high], slop)
            low = high

    def _matched(self, asked: Queries, window: np.ndarray, at: np.ndarray, order: np.ndarray, least: np.ndarray, slop: int):
        rows = np.repeat(np.arange(len(window)), least)
        rarest = at[np.arange(len(window)), order[:, 0]]
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(least) - least, least)
        place = self.places[self.heads[rarest][rows] + inside]
        doc = np.searchsorted(self.begins, place, "right") - 1
        shift = np.tile(np.arange(-slop, slop + 1), len(rows))
        rows, doc = np.repeat(rows, 2 * slop + 1), np.repeat(doc, 2 * slop + 1)
        start = np.repeat(place, 2 * slop + 1) + shift - order[rows, 0]
        first, last = self.begins[doc], self.begins[doc + 1] - 1
        length = asked.length[window]
        # A phrase is found from the place of its own rarest word.
        exact = (shift == 0) & (start >= first) & (start + length[rows] - 1 <= last)
        for k in range(1, order.shape[1]):
            more = length[rows] > k
            offset = order[rows, k]
            term = at[rows, offset]
            spot = start + offset
            near = exact.copy()
            checked = np.flatnonzero(more & exact)
            exact[checked] = near[checked] = self.holds(term[checked], spot[checked], spot[checked])
            if slop:
                checked = np.flatnonzero(~near)
                low, high = np.maximum(spot - slop, first)[checked], np.minimum(spot + slop, last)[checked]
                near[checked] = ~more[checked] | self.holds(term[checked], low, high)
            keep = np.flatnonzero(near)
            if len(keep) < len(rows):
                rows, start, doc, first, last, exact = (x[keep] for x in (rows, start, doc, first, last, exact))
            if not len(rows):
                return
        # Several places of the rarest word can tell of the same match.
        order_ = np.lexsort((~exact, start, doc, rows))
        rows, start, doc, exact = (x[order_] for x in (rows, start, doc, exact))
        new = np.append(True, (rows[1:] != rows[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]))
        new &= exact | bool(slop)
        yield window[rows[new]], start[new], doc[new], exact[new]


def searched(block: Block, asked: Queries, slop: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of a block: which words are hit, proximity matches that are no phrases by document, and the items found in each document."""
    n_docs = len(block.begins) - 1
    edge = np.zeros(block.total + 1, np.int64)
    near = np.zeros(n_docs, np.int64)
    pairs = []
    for window, start, doc, exact in block.matches(asked, slop):
        near += np.bincount(doc[~exact & asked.leads[window]], minlength=n_docs)
        window, start, doc = window[exact], start[exact], doc[exact]
        np.add.at(edge, start, 1)
        np.add.at(edge, start + asked.length[window], -1)
        once = np.unique(np.stack((doc, window), axis=1), axis=0)
        count = asked.named[once[:, 1]]
        spot = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(asked.ends[once[:, 1]] - count, count)
        pairs.append(np.unique(np.stack((np.repeat(once[:, 0], count), asked.items[spot]), axis=1), axis=0))
    items = np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)
    cuts = np.searchsorted(items[:, 0], np.arange(n_docs + 1))
    return np.cumsum(edge[:-1]) > 0, near, [items[a:b, 1] for a, b in zip(cuts, cuts[1:])]


def _found(index: DataFrame, rows: list, slop: int) -> DataFrame:
    """What one group of windows hits in every document of the index."""
    shared = index.sparkSession.sparkContext.broadcast(queries(rows))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                number, ids = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                kinds = ("<i8", "<u8", "<i8", "<u4")
                block = Block(*[np.frombuffer(batch.column(2 + i)[row].as_buffer(), kind).astype(kind if kind == "<u8" else np.int64) for i, kind in enumerate(kinds)])
                hit, near, items = searched(block, asked, slop)
                heads, ends = block.begins[:-1], block.begins[1:]
                total = np.append(0, np.cumsum(hit))
                n_hit = total[ends] - total[heads]
                columns = [
                    pa.array(np.full(len(ids), number), pa.int64()),
                    pa.array(np.arange(len(ids)), pa.int32()),
                    pa.array(ids, pa.int64()),
                    pa.array(ends - heads),
                    pa.array(n_hit),
                    pa.array(near),
                    pa.array([np.packbits(hit[a:b]).tobytes() if n else b"" for a, b, n in zip(heads, ends, n_hit)], pa.binary()),
                    pa.array([x.tolist() for x in items], pa.list_(pa.int64())),
                ]
                yield pa.record_batch(columns, names=[c.split()[0] for c in FOUND.split(", ")])

    return index.mapInArrow(work, FOUND)


def _merged(found: DataFrame) -> DataFrame:
    """What several groups of windows hit together, block by block."""

    def merge(rows: pa.Table) -> pa.Table:
        out: dict[int, list] = {}
        for row in rows.to_pylist():
            bits = np.unpackbits(np.frombuffer(row["hit"], np.uint8))[: row["n_words"]]
            held = out.setdefault(row["number"], [row, np.zeros(row["n_words"], np.uint8), 0, set()])
            if len(bits):
                held[1] |= bits
            held[2] += row["n_near"]
            held[3].update(row["items"])
        merged = [{**r, "n_hit": int(bits.sum()), "n_near": near, "hit": np.packbits(bits).tobytes(), "items": sorted(items)} for r, bits, near, items in out.values()]
        return pa.Table.from_pylist(merged, schema=rows.schema)

    return found.groupBy("block").applyInArrow(merge, FOUND)


def contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``n_hit``, ``n_near``, ``hit`` (a bit per word, empty if none) and ``items``, sorted.

    Words are runs of bytes that are neither ASCII punctuation, white space nor control characters, with A to Z in lower
    case. A word is hit inside any occurrence of a window of ``size`` words of an item. ``n_near`` counts windows and places to begin at from
    which each word of the window stands within ``slop`` places of where it belongs, but not all of them in place. A null or empty text has no words, and an
    item without words no window. Rows that repeat an id are documents of their own; items that repeat an id are one. A document without an id
    keeps a null; an item without one hits words but is not listed. An empty table of documents gives no rows, one of
    items no hits. Texts of any length are searched whole. Only ``doc_id``, ``item_id`` and ``text`` are looked at.
    """
    index = stored(indexed(docs), "positions")
    asked = windows(items, size)
    least = asked.groupBy(F.col("words").alias("of")).agg(F.min("item_id").alias("least"))
    leads = F.col("item_id").eqNullSafe(F.col("least")).alias("leads")
    asked = stored(asked.join(least, F.col("words") == F.col("of")).select("words", "item_id", leads), "windows")
    groups = 1 + asked.count() // TOGETHER
    dealt = asked.withColumn("group", F.pmod(F.xxhash64("words", "item_id"), F.lit(groups)))
    parts = []
    for group in range(groups):
        rows = [tuple(r) for r in dealt.filter(F.col("group") == group).select("words", "item_id", "leads").collect()]
        part = _found(index, rows, slop)
        parts.append(part if not group else part.filter("n_hit > 0 or n_near > 0"))
    if groups == 1:
        found = parts[0]
    else:
        every = stored(parts[0], "hits")
        for part in parts[1:]:
            every = every.unionByName(stored(part, "hits"))
        found = _merged(every)
    return found.select("doc_id", "n_words", "n_hit", "n_near", "hit", "items")
