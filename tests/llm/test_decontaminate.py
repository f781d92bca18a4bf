import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import decontaminate
from landfall.llm.queries import _items_digest

from cases import FOLD, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, size=10):
    asked = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            asked.setdefault(tuple(w[i : i + size]), set()).add(item)
    lengths = sorted({len(w) for w in asked})
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for i in range(len(w)):
            for n in lengths:
                window = tuple(w[i : i + n])
                if len(window) == n and window in asked:
                    hit.update(range(i, i + n))
                    found |= asked[window] - {None}
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)




def near(docs, windows, slop):
    """Pairs of a window and a place from which all its words are within ``slop`` of where they belong, but not all in place."""
    n = 0
    for w in docs:
        for window in windows:
            for s in range(-slop - 1, len(w) + slop):
                apart = [[d for d in range(-slop, slop + 1) if 0 <= s + j + d < len(w) and w[s + j + d] == x] for j, x in enumerate(window)]
                n += all(apart) and not all(0 in d for d in apart)
    return n


def cases():
    r = random.Random(8)
    items = [(i, prose(r, r.randint(12, 40))) for i in range(30)]
    items += [(100, "Only four words here"), (101, "one"), (102, ""), (103, None), (104, "..., !"), (None, prose(r, 15)), (3, prose(r, 20)), (105, items[5][1])]
    items += [(106, "ha " * 14), (107, "É" * 3 + " ü 漢字 " + prose(r, 12))]
    docs = []
    for i in range(120):
        parts = [prose(r, r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            text = words(r.choice(items)[1])
            a = r.randint(0, max(0, len(text) - 8))
            part = text[a : a + r.randint(5, 25)]
            if r.random() < 0.3 and part:
                part[r.randrange(len(part))] = "zzz"
            parts += [r.choice([" ", ", ", "\n-- "]).join(part).upper(), prose(r, r.randint(0, 5))]
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (202, " \n."), (203, "ha " * 5000), (204, prose(r, 20_000) + " " + items[2][1]), (None, items[1][1]), (5, docs[5][1]), docs[7], docs[7]]
    return docs, items


def got(spark, docs, items, **options):
    frame = spark.createDataFrame(docs, DOCS).repartition(3)
    for name in ("block", "items", "n_words", "hit", "Number"):
        frame = frame.withColumn(name, F.lit("clash"))
    found = decontaminate.contaminated(frame, spark.createDataFrame(items, ITEMS).withColumn("words", F.lit("clash")), **options)
    return found.collect()


@pytest.mark.parametrize("together, starts, block", [(100_000, 1 << 20, 2 << 20), (40, 50, 3000)])
def test_equals_brute_force(spark, monkeypatch, together, starts, block):
    for name, value in (("TOGETHER", together), ("STARTS", starts), ("BLOCK_BYTES", block)):
        monkeypatch.setattr(decontaminate, name, value)
    docs, items = cases()
    rows = got(spark, docs, items)
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in rows], key=str) == brute(docs, items)
    windows = {tuple(w[i : i + 10]) for w in (words(t) for _, t in items) if w for i in range(max(1, len(w) - 9))}
    few = [d for d in docs if len(words(d[1])) < 150][:40]
    assert sum(r["n_near"] for r in got(spark, few, items)) == near([words(t) for _, t in few], windows, decontaminate.SLOP)
    for r in rows:
        bits = np.unpackbits(np.frombuffer(bytes(r["hit"]), np.uint8))
        assert int(bits.sum()) == r["n_hit"]


def test_proximity():
    """A window with a word too many inside is near, one that is whole is a phrase."""
    text = "a b c d e f g h i j".split()
    ids = {w: k + 1 for k, w in enumerate(text)}
    doc = text[:4] + ["x"] + text[4:] + ["y"] * 5 + text + ["y"] * 5 + text[::-1]
    numbers = np.array([ids.get(w, 99 + ord(w[0])) for w in doc], np.uint64)
    terms, counts = np.unique(numbers, return_counts=True)
    block = decontaminate.Block(np.array([0, len(doc)]), terms, np.cumsum(counts), np.argsort(numbers, kind="stable").astype(np.int64))
    asked = decontaminate.queries([([ids[w] for w in text], 7, True)])
    hit, count, items = decontaminate.searched(block, asked, 1)
    assert np.flatnonzero(hit).tolist() == list(range(16, 26)) and items[0].tolist() == [7]
    assert count.tolist() == [near([doc], [text], 1)] and count[0] > 2
    assert decontaminate.searched(block, asked, 0)[1].tolist() == [0]
    apart = decontaminate.Block(np.array([0, 20, len(doc)]), terms, np.cumsum(counts), np.argsort(numbers, kind="stable").astype(np.int64))
    assert not decontaminate.searched(apart, asked, 1)[0].any()


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b")]) == []
    rows = got(spark, [(1, "a b"), (None, None)], [])
    assert sorted((r["n_words"], r["n_hit"], len(r["items"])) for r in rows) == [(0, 0, 0), (2, 0, 0)]


def test_digest_of_items(spark):
    import hashlib

    row = spark.sql("select array(10L, 9L, 100L) as items").select(_items_digest(F.col("items")).alias("d")).first()
    assert row["d"] == hashlib.sha256(b"10,100,9").hexdigest()
