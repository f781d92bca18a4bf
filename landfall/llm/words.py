"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Words are runs of characters that are not white space (``WHITE``), all of which are single bytes,
so bytes can be looked at without decoding.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a text is never cut.
SLICE_BYTES = 2 << 20
#: Bytes for which hashes are computed at once, and the longest word that is hashed that way.
HASH_BYTES = 1 << 20
LONG_WORD = 1 << 16

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_random.integers(0, 1 << 62)) * 4 + 3
_STEPS = _random.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers() -> np.ndarray:
    if not _POWERS:
        steps = np.full(LONG_WORD + 1, _BASE, dtype=np.uint64)
        steps[0] = 1
        _POWERS.append(np.cumprod(steps, dtype=np.uint64))
    return _POWERS[0]


@dataclass
class Words:
    """``first[i]`` to ``first[i + 1]`` are the words of text ``i``; ``bounds`` are its bytes."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """64 bits of each word."""
        out = np.empty(len(self.start), dtype=np.uint64)
        length = self.end - self.start
        for k in np.flatnonzero(length > LONG_WORD):
            word = self.data[self.start[k] : self.end[k]].tobytes()
            out[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        usual = np.flatnonzero(length <= LONG_WORD)
        total = np.cumsum(length[usual])
        at = 0
        while at < len(usual):
            done = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + HASH_BYTES, "right")))
            part = usual[at:to]
            n = length[part]
            heads = np.concatenate(([0], np.cumsum(n)[:-1]))
            place = np.arange(int(n.sum())) - np.repeat(heads, n)
            bytes_at = place + np.repeat(self.start[part], n)
            value = _BYTE[self.data[bytes_at]] * _powers()[place]
            out[part] = mix(np.add.reduceat(value, heads) + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            at = to
        return out

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``size`` words and the word each begins at; none crosses texts."""
        n = np.diff(self.first)
        full = np.maximum(n - size + 1, 0)
        heads = np.repeat(self.first[:-1], full)
        inside = np.arange(int(full.sum())) - np.repeat(np.concatenate(([0], np.cumsum(full)[:-1])), full)
        begin = heads + inside
        value = np.full(len(begin), size, dtype=np.uint64)
        for j in range(size):
            value += hashes[begin + j] * _STEPS[j]
        return mix(value), begin


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most so many bytes each, or of one text."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    at = 0
    while at < len(size):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + most, "right")))
        yield at, to
        at = to


def words_of(texts: pa.Array, fold: bool = False, parting: np.ndarray = SPACE) -> Words:
    """The words of an Arrow array of texts; null is empty. ``fold`` lower-cases A to Z; ``parting`` flags the bytes between words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
    bounds = offsets - offsets[0]
    if fold:
        data = _FOLD[data]
    inner = ~parting[data]
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    begins[edge] = inner[edge]
    ends = inner.copy()
    ends[:-1] &= ~inner[1:]
    edge = bounds[1:][bounds[1:] > 0] - 1
    ends[edge] = inner[edge]
    start = np.flatnonzero(begins)
    return Words(data, bounds, start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds))
