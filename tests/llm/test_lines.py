from collections import Counter

import pytest
from cases import FOLD, documents, table

from landfall.llm import common
from landfall.llm import lines as L

WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    key = lambda line: line.strip(WHITE).translate(FOLD)
    holders = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(-1 if doc_id is None else doc_id)
    out = []
    for doc_id, text, *_ in rows:
        split = (text or "").split("\n")
        own = -1 if doc_id is None else doc_id
        kept = [x for x in split if len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == own]
        out.append((doc_id, "\n".join(kept), len(split), len(split) - len(kept)))
    return Counter(out)


@pytest.mark.parametrize("hot_keys", [common.HOT_KEYS, 15, 1])
def test_all_cases_against_plain_loops(spark, monkeypatch, hot_keys):
    """With all, some and no shared keys hot."""
    monkeypatch.setattr(common, "HOT_KEYS", hot_keys)
    got = L.without_shared_lines(table(spark, extra=False)).select("doc_id", "text", "n_lines", "n_dropped")
    expected = brute(documents())
    assert sum(e[3] for e in expected) > 10
    assert Counter(tuple(r) for r in got.collect()) == expected


def test_rows_without_an_id_lose_lines_by_their_own_text(spark):
    line = "a line of more than forty characters that many documents hold"
    rows = [(i, f"own {i}\n{line}", "en", "a", 1) for i in range(6)] + [(None, f"no id {i % 3}\n{line}\n{'x' * 50} {i % 3}", "en", "a", 1) for i in range(30)]
    docs = table(spark, rows, extra=False)
    drops = L.shared_keys(docs).filter("doc_id is null").collect()
    assert len(drops) == 3 and all(len(r["drops"]) == 1 for r in drops)
    got = L.without_shared_lines(docs).select("doc_id", "text", "n_lines", "n_dropped")
    assert Counter(tuple(r) for r in got.collect()) == brute(rows)


def test_other_columns_stay(spark):
    docs = table(spark)
    got = L.without_shared_lines(docs)
    assert got.columns == [*docs.columns, "n_lines_", "n_dropped"]
    assert got.filter("drops = 'clash' and n_lines = 'clash'").count() == docs.count()


def test_empty_table(spark):
    assert L.without_shared_lines(table(spark, [])).count() == 0
