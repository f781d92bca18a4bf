from collections import Counter

import pytest
from cases import documents, table, words
from pyspark.sql import functions as F

from landfall.llm import common, mixing


def plain_targets(sizes):
    """Round after round: share by weight, hold at the bound, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, target, total = set(order), {}, sum(sizes.values())
    while True:
        rest = total - sum(target.values())
        whole = sum(weight[s] for s in left)
        share = {s: rest * weight[s] / whole for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            return {**target, **share}
        target.update({s: 3 * sizes[s] for s in over})
        left -= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 40}, {"x": 7}, {"a": 0, "b": 3, "é": 100, "z": 1, "zz": 90}, {"a": 0}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_every_document_and_source(spark):
    rows = documents()
    got = mixing.copies(table(spark)).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((d[0], d[3], len(words(d[1]))) for d in rows)
    sizes = Counter()
    for d in rows:
        sizes[d[3]] += len(words(d[1]))
    goals = plain_targets(sizes)
    for r in got:
        assert r["target"] == pytest.approx(goals[r["source"]]) and r["source_size"] == sizes[r["source"]]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert int(rate) <= r["copies"] <= int(rate) + 1 and r["copies"] <= 3


def test_sources_come_near_their_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 13 + 1).cast("int")).alias("text"), F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).cast("string")).alias("source")
    )
    mix = mixing.copies(docs)
    for r in mix.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.08)


@pytest.mark.parametrize("salted", [False, True])
def test_sources_come_near_their_targets_where_ids_are_null_or_repeat(spark, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    number = F.col("id")
    docs = spark.range(6000, numPartitions=5).select(
        F.when(number % 3 == 0, number).when(number % 3 == 1, 7).alias("doc_id"),
        F.when(number % 2 == 0, F.repeat(F.lit("w "), (number % 13 + 1).cast("int"))).otherwise("the same text of seven words again").alias("text"),
        F.concat(F.lit("s"), (number % 4).cast("string")).alias("source"),
    )
    for r in mixing.copies(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")).collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.08)
    key = ["doc_id", "source", "text"]
    first = Counter(map(tuple, mixing.mixed(docs).select(*key).collect()))
    assert first == Counter(map(tuple, mixing.mixed(docs.repartition(11)).select(*key).collect()))
    sizes = Counter()
    for (_, source, text), n in first.items():
        sizes[source] += n * len(words(text))
    taken = {r["source"]: r["n"] for r in mixing.copies(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("n")).collect()}
    assert sizes == Counter(taken)


def test_alike_rows_are_numbered_from_one(spark):
    rows = spark.createDataFrame([(None, "a")] * 300 + [(1, "a")] * 2 + [(2, None), (3, "b")], "i int, t string").repartition(4)
    got = mixing.numbered(rows, ["i", "t"], "number").collect()
    found = {}
    for r in got:
        found.setdefault((r["i"], r["t"]), []).append(r["number"])
    assert {k: sorted(v) for k, v in found.items()} == {(None, "a"): list(range(1, 301)), (1, "a"): [1, 2], (2, None): [1], (3, "b"): [1]}


def test_repeated_documents_follow_the_copies(spark, monkeypatch):
    docs = table(spark)
    want = {}
    for r in mixing.copies(docs).collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"]
    first = mixing.mixed(docs)
    assert first.columns == docs.columns
    got = Counter(r["doc_id"] for r in first.collect())
    assert got == Counter({k: n for k, n in want.items() if n})
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert Counter(r["doc_id"] for r in mixing.mixed(docs).collect()) == got


def test_empty_table(spark):
    assert mixing.copies(table(spark, [])).count() == 0 and mixing.mixed(table(spark, [])).count() == 0
