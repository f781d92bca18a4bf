import random

import numpy as np
import pytest
from cases import documents, table

from landfall.llm import packing as P

public = pytest.importorskip("public_tokenizers")


def check(pieces, ids, window):
    """Pieces give back every document; sequences are gapless and padded nowhere."""
    whole, sequences = {}, {}
    for r in pieces:
        data = np.frombuffer(r["ids"], "<u4")
        assert len(data) == r["length"] > 0
        whole.setdefault(r["doc_id"], []).append((r["start"], data))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for key, parts in whole.items():
        parts.sort(key=lambda p: p[0])
        joined = np.concatenate([d for _, d in parts])
        assert [p[0] for p in parts] == np.cumsum([0, *[len(d) for _, d in parts[:-1]]]).tolist()
        assert joined.tolist() == ids[key]
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= window and (at == window or at & (at - 1) == 0)
    assert whole.keys() == ids.keys()


@pytest.mark.parametrize("block", [P.BLOCK_TOKENS, 3000])
def test_round_trip(spark, block):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = [(i, d[1], *d[2:]) for i, d in enumerate(documents())] + [(1000, "two  spaces\n\n and <|endoftext|> here", "en", "a", 1)]
    ids = {r[0]: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows}
    got = P.packed(table(spark, rows), block_tokens=block).collect()
    check(got, ids, P.WINDOW)
    assert {r["doc_tokens"] == len(ids[r["doc_id"]]) for r in got} == {True}


def test_repeated_and_missing_ids_are_packed(spark):
    got = P.packed(table(spark)).select("doc_id", "length", "doc_tokens", "start").collect()
    assert sum(r["length"] for r in got) == sum(r["doc_tokens"] for r in got if r["start"] == 0)
    assert sum(r["start"] == 0 for r in got) == len(documents())
    assert P.packed(table(spark, [])).count() == 0


def test_best_fit_takes_the_tightest_window():
    assert P.best_fit([6, 5, 3, 2], 8) == [[(0, 0, 6), (3, 0, 2)], [(1, 0, 5), (2, 0, 3)]]
    assert P.best_fit([20], 8) == [[(0, 0, 8)], [(0, 8, 8)], [(0, 16, 4)]]
    assert P.best_fit([], 8) == []


def test_tree_against_a_plain_search():
    r = random.Random(8)
    rooms, open_ = P.Rooms(100), []
    for which in range(3000):
        if r.random() < 0.5:
            room = r.randint(1, 100)
            rooms.add(room, which)
            open_.append(room)
        else:
            need = r.randint(1, 100)
            fit = min((x for x in open_ if x >= need), default=None)
            got = rooms.take(need)
            assert (got and got[0]) == fit
            if fit:
                open_.remove(fit)


def test_every_token_in_one_piece():
    r = random.Random(9)
    for _ in range(50):
        lengths = [r.randint(1, 700) for _ in range(r.randint(1, 60))]
        seen = sorted((d, s, n) for w in P.best_fit(lengths, 256) for d, s, n in w)
        at = {}
        for d, s, n in seen:
            assert at.get(d, 0) == s
            at[d] = s + n
        assert [at[d] for d in range(len(lengths))] == lengths
        used = [sum(p[2] for p in w) for w in P.best_fit(lengths, 256)]
        assert all(n == 256 or n & (n - 1) == 0 for n in used)
