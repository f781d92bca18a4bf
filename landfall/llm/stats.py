"""Figures of whole texts, computed for many at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import quoted
from landfall.llm.words import SPACE as _SPACE
from landfall.llm.words import mix, slices, words_of

#: Words of the windows whose repetition is counted.
WINDOW = 8

STATS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_upper",
    "n_digits",
    "n_marks",
    "n_distinct_words",
    "n_same_as_last",
    "n_stops",
)


def _table(characters: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in characters]] = True
    return out


# The characters that are counted as symbols.
_SYMBOL = _table("#*$%&|<>")
_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _table("0123456789")
_MARK = _table("!?;:\"'()[]{}=+_/\\^~@`-")
_STOP = _table(".,")


def stats_of(texts: pa.Array) -> np.ndarray:
    """A row of ``STATS`` for each text; a null has zeros."""
    out = np.zeros((len(texts), len(STATS)), dtype=np.int64)
    for low, high in slices(texts):
        out[low:high] = _slice(texts.slice(low, high - low))
    return out


def _slice(texts: pa.Array) -> np.ndarray:
    words = words_of(texts)
    data, bounds, first = words.data, words.bounds, words.first
    n = np.diff(first)

    def per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[at])

    chars = per_text(~_SPACE[data] & ((data & 0xC0) != 0x80), bounds)

    hashes = words.hashes()
    text_of_word = np.repeat(np.arange(len(n), dtype=np.uint64), n) * np.uint64(0x9E3779B97F4A7C15)
    windows, begin = words.windows(hashes, WINDOW)
    repeated = _repeated(mix(windows ^ text_of_word[begin]))
    cover = np.zeros(len(hashes) + 1, dtype=np.int64)
    cover[begin[repeated]] += 1
    cover[begin[repeated] + WINDOW] -= 1
    key = mix(hashes ^ text_of_word)
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    which = np.repeat(np.arange(len(n)), n)[order[new]]
    distinct = np.bincount(which, minlength=len(n))
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][first[:-1] < len(same)]] = False

    lines = np.zeros((len(n), 2), dtype=np.int64)
    raw = data.tobytes()
    for i in range(len(n)):
        seen: set[bytes] = set()
        total = 0
        for line in raw[bounds[i] : bounds[i + 1]].split(b"\n"):
            if line.strip():
                total += 1
                seen.add(line)
        lines[i] = total, total - len(seen)

    return np.stack(
        [
            n,
            chars,
            per_text(_SYMBOL[data], bounds),
            lines[:, 0],
            lines[:, 1],
            per_text(np.cumsum(cover[:-1]) > 0, first),
            per_text(_UPPER[data], bounds),
            per_text(_DIGIT[data], bounds),
            per_text(_MARK[data], bounds),
            distinct,
            per_text(same, first),
            per_text(_STOP[data], bounds),
        ],
        axis=1,
    )


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Whether each key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order] = np.append(same, False) | np.append(False, same) if len(keys) else False
    return out


def with_stats(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns ``keep`` of the documents and the ``STATS`` of their texts."""
    kept = [f.simpleString().split(":", 1) for f in docs.select(*[quoted(c) for c in keep]).schema.fields]
    schema = ", ".join([f"`{name}` {kind}" for name, kind in kept] + [f"{s} bigint" for s in STATS])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = stats_of(batch.column(0))
            columns = [batch.column(i + 1) for i in range(len(keep))] + [pa.array(found[:, k]) for k in range(len(STATS))]
            yield pa.record_batch(columns, names=[*keep, *STATS])

    return docs.select(F.col("text"), *[F.col(quoted(c)) for c in keep]).mapInArrow(work, schema)
