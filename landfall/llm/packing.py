"""Packing token sequences into windows by best-fit decreasing.

Every task tokenizes its documents in blocks of a bounded size. Documents longer than a window are
cut into full windows first; the remainders are placed, longest first, into the open window with
the least room that holds them, which a segment tree over the room left finds. Windows that are
then neither full nor a power of two long are filled by cutting the pieces of the emptiest
of them, and the last of those is parted into powers of two, so nothing is padded.

A block never leaves its task, so there is no shuffle, and a lost task is run again by itself. A
sequence id is the number of the partition times 2^33 plus a count within it.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
END = 0
#: Tokens of a block. A document is never parted among blocks, so one that is longer is a block of its own.
BLOCK_TOKENS = 8 << 20
#: Texts that are read into Python at a time.
SLICE_BYTES = 4 << 20

SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
FIELDS = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")

# Fixed value: how byte-level BPE writes the bytes that are no printable characters.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
# Fixed value: the pre-tokenizer of byte-level BPE without its look-ahead, which matters for runs of white space only.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class TokenIds:
    """Ids of a tokenizer file, as uint32 arrays.

    Of a byte-level BPE the vocabulary is also given to a faster encoder, which takes the texts
    that have no two white-space characters in a row and no special token: on these its word
    pattern is the same. All other texts, and all of other tokenizers, go to the library itself.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.full = Tokenizer.from_file(path)
        self.fast = self._fast(spec)
        special = [regex.escape(x["content"]) for x in spec.get("added_tokens") or []]
        self.hard = regex.compile("|".join([r"\s\s", *special]))

    @staticmethod
    def _fast(spec: dict):
        shape = spec.get("pre_tokenizer") or {}
        plain = spec["model"]["type"] == "BPE" and shape.get("type") == "ByteLevel" and not spec.get("normalizer")
        if not plain or shape.get("add_prefix_space") or not shape.get("use_regex", True):
            return None
        import tiktoken

        others = [b for b in range(256) if b not in set(PRINTABLE)]
        byte_of = {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}
        added = {x["content"] for x in spec.get("added_tokens") or []}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        return tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or self.hard.search(text):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)


@functools.cache
def token_ids(path: str) -> TokenIds:
    """One encoder per Python worker."""
    return TokenIds(path)


class Rooms:
    """A segment tree over the room left in open windows: which is the tightest that holds a piece."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, which: int) -> None:
        self.open[room].append(which)
        node = self.leaves + room
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The room and number of the tightest window with at least ``need``, which leaves the tree."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


Piece = tuple[int, int, int]  # document, start, length


def best_fit(lengths: list[int], window: int = WINDOW) -> list[list[Piece]]:
    """The windows of a block of documents, each a list of pieces in their order."""
    done: list[list[Piece]] = []
    rest: list[Piece] = []
    for doc, n in enumerate(lengths):
        full = n // window
        done.extend([(doc, i * window, window)] for i in range(full))
        if n % window:
            rest.append((doc, full * window, n % window))
    rest.sort(key=lambda p: -p[2])
    rooms, windows = Rooms(window), []
    for piece in rest:
        found = rooms.take(piece[2])
        if found is None:
            windows.append([piece])
            found = window, len(windows) - 1
        else:
            windows[found[1]].append(piece)
        if found[0] > piece[2]:
            rooms.add(found[0] - piece[2], found[1])
    used = [sum(p[2] for p in w) for w in windows]
    closed = [n == window or n & (n - 1) == 0 for n in used]
    done.extend(w for w, c in zip(windows, closed) if c)
    return done + _closed([w for w, c in zip(windows, closed) if not c], window)


def _closed(gaps: list[list[Piece]], window: int) -> list[list[Piece]]:
    """Windows with gaps, filled from the emptiest of them; the last is parted into powers of two."""
    gaps = sorted(gaps, key=lambda w: sum(p[2] for p in w))
    spare: list[Piece] = []
    out = []
    while gaps:
        current = gaps.pop()
        room = window - sum(p[2] for p in current)
        while room and (spare or gaps):
            if not spare:
                spare = gaps.pop(0)
            doc, start, n = spare.pop()
            cut = min(n, room)
            current.append((doc, start, cut))
            room -= cut
            if cut < n:
                spare.append((doc, start + cut, n - cut))
        if room:
            spare = current
        else:
            out.append(current)
    left = sum(p[2] for p in spare)
    while left:
        size, part = 1 << (left.bit_length() - 1), []
        while size:
            doc, start, n = spare.pop()
            cut = min(n, size)
            part.append((doc, start, cut))
            size -= cut
            if cut < n:
                spare.append((doc, start + cut, n - cut))
        out.append(part)
        left = sum(p[2] for p in spare)
    return out


def _rows(docs: list, ids: list[np.ndarray], first: int, window: int) -> Iterator[pa.RecordBatch]:
    columns: list[list] = [[] for _ in FIELDS]
    held = 0
    for number, pieces in enumerate(best_fit([len(x) for x in ids], window), first):
        offset = 0
        for doc, start, n in pieces:
            data = ids[doc][start : start + n].astype("<u4", copy=False).tobytes()
            for column, value in zip(columns, (docs[doc], start, n, data, len(ids[doc]), number, offset)):
                column.append(value)
            offset += n
            held += len(data)
        if held > SLICE_BYTES:
            yield _batch(columns)
            columns, held = [[] for _ in FIELDS], 0
    if columns[0]:
        yield _batch(columns)


def _batch(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.binary() if f == "ids" else pa.int64() for f in FIELDS]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(FIELDS))


def packed(
    docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end: int = END, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """Pieces of documents and their places in sequences, ``ids`` as little-endian unsigned 32-bit integers.

    Every document ends with the id ``end``, so a null or empty text is that id alone. Ids of
    documents may be null or repeat: each row is packed by itself. An empty table gives no rows;
    other columns than ``doc_id`` and ``text`` are not looked at. ``tokenizer`` is the path of a
    tokenizers JSON file that every executor has.
    """
    path = tokenizer or default_tokenizer()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(path)
        count = TaskContext.get().partitionId() << 33
        keys: list = []
        block: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                block.append(np.append(encode(text.as_py() or ""), np.uint32(end)))
                held += len(block[-1])
                if held >= block_tokens:
                    for out in _rows(keys, block, count, window):
                        count = out.column(5)[-1].as_py() + 1
                        yield out
                    keys, block, held = [], [], 0
        yield from _rows(keys, block, count, window)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(pack, SCHEMA)
