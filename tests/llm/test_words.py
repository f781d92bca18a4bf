import random

import numpy as np
import pyarrow as pa
from cases import FOLD, documents, words
from collections import Counter

from landfall.llm import words as W
from landfall.llm.stats import STATS, stats_of


def test_words_and_hashes():
    texts = [row[1] for row in documents()]
    found = W.words_of(pa.array(texts, pa.string()), fold=True)
    hashes = found.hashes()
    known = {}
    for i, text in enumerate(texts):
        own = slice(found.first[i], found.first[i + 1])
        cut = [found.data[a:b].tobytes().decode() for a, b in zip(found.start[own], found.end[own])]
        assert cut == words((text or "").translate(FOLD))
        for word, h in zip(cut, hashes[own]):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


def test_windows_stay_within_texts():
    texts = pa.array(["a b c", "d e", None, "a b c d"])
    found = W.words_of(texts)
    values, begin = found.windows(found.hashes(), 3)
    assert begin.tolist() == [0, 5, 6] and values[0] == values[1] != values[2]


def test_slices_cover_all_texts_whole():
    texts = pa.array([None, "", "x" * W.SLICE_BYTES * 2, "y", None] * 3, pa.string())
    ranges = list(W.slices(texts))
    assert [i for a, b in ranges for i in range(a, b)] == list(range(15))
    assert list(W.slices(pa.array([], pa.string()))) == []


def test_stats_against_plain_counts():
    r = random.Random(1)
    texts = [row[1] for row in documents()] + ["a b c d e f g h " * 3, "x\n x\nx\n\n", "$ # a|b <c>"]
    texts += ["\n".join(" ".join(r.choice("ab") for _ in range(r.randint(0, 12))) for _ in range(4)) for _ in range(40)]
    got = stats_of(pa.array(texts, pa.string()))
    for text, row in zip(texts, got):
        own, text = words(text), text or ""
        lines = [line for line in text.split("\n") if words(line)]
        windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
        seen, covered = Counter(windows), set()
        for i, window in enumerate(windows):
            if seen[window] > 1:
                covered.update(range(i, i + 8))
        plain = dict(
            n_words=len(own),
            word_chars=sum(map(len, own)),
            n_symbols=sum(c in "#*$%&|<>" for c in text),
            n_lines=len(lines),
            n_dup_lines=len(lines) - len(set(lines)),
            n_repeat_words=len(covered),
            n_distinct_words=len(set(own)),
            n_same_as_last=sum(a == b for a, b in zip(own, own[1:])),
        )
        assert plain == {k: int(v) for k, v in zip(STATS, row) if k in plain}
    assert stats_of(pa.array([], pa.string())).shape == (0, len(STATS))


def test_mixing_of_bits_is_one_to_one():
    x = np.arange(10_000, dtype=np.uint64)
    assert len(np.unique(W.mix(x))) == len(x)
