"""Nearest neighbours by multi-index hashing.

Vectors become binary codes: principal axes of a bounded sample, a learned rotation of them, and the signs.
A code is cut into substrings, each with an index of its own. Codes within a Hamming radius of a query
agree with it in some substring up to the radius divided by their number, so looking up all
substring values that near finds every one of them. Found codes are checked over all bits, and the
vectors of those within the radius are ranked by cosine. The radius is learned: a bounded number
of queries is compared with all vectors, and nearly all of their neighbours must lie within it.
A query that finds too few is searched again with a larger radius, in the end over all vectors.

Equal vectors are one entry with their smallest ids, so a vector that is very common costs no more
than another one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.common import attach, stored

BITS = 64
PARTS = 4
PART_BITS = BITS // PARTS
#: Vectors to learn the codes from, and queries to learn the radius from, at most on average.
SAMPLE = 5000
PROBES = 64
#: The share of true neighbours that the radius must hold.
WITHIN = 0.98
#: Entries of a bucket of an index, on average and at most on average after splitting.
BUCKET = 20_000
SPLIT = 40_000
SEED = 3


@dataclass
class Codes:
    mean: np.ndarray
    axes: np.ndarray

    def __call__(self, unit: np.ndarray) -> np.ndarray:
        """64 bits for each row of unit vectors."""
        signs = ((unit - self.mean) @ self.axes) > 0
        return np.packbits(signs, axis=1, bitorder="little").view("<u8").ravel()


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def learned(sample: np.ndarray, rounds: int = 30) -> Codes:
    """Codes from unit vectors: principal axes, turned until the signs lose least (iterative quantization).

    Where there are fewer dimensions than bits, random directions fill up.
    """
    random = np.random.default_rng(SEED)
    dim = sample.shape[1]
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred.T @ centred + 1e-12 * np.eye(dim))
    axes = axes[:BITS].T
    if axes.shape[1] < BITS:
        axes = np.concatenate((axes, random.normal(size=(dim, BITS - axes.shape[1])) / np.sqrt(dim)), axis=1)
    low = centred @ axes
    turn = np.linalg.qr(random.normal(size=(BITS, BITS)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
        turn = (left @ right).T
    return Codes(mean, axes @ turn)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray) -> np.ndarray:
    """In double precision, each by itself, so that a pair has one value wherever it is computed."""
    return (vectors * query).sum(axis=1) / (norms * np.sqrt((query * query).sum()))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` of the rows that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & fine & F.exists("embedding", lambda x: x != 0)).select(
        F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>")
    )


def entries(rows: DataFrame, keep: int) -> DataFrame:
    """``entry``, ``embedding`` and ``ids``, the ``keep`` smallest, of every distinct vector."""
    order = Window.partitionBy("entry", "embedding").orderBy("vec_id")
    # Spark keeps the first rows of each vector within a task before it shuffles.
    least = rows.withColumn("entry", F.xxhash64("embedding")).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)
    return least.groupBy("entry", "embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))


def _top(score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((first, -score))[:k]


def neighbours_of(probes: list, table: DataFrame, codes: Codes, k: int) -> list[int]:
    """Hamming distances of the true ``k`` nearest entries of some vectors, by comparison with all."""
    queries = np.array(probes)
    shared = table.sparkSession.sparkContext.broadcast((queries, codes))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, codes = shared.value
        own = codes(units(queries))
        for batch in batches:
            vectors, first = _matrix(batch.column(1)), batch.column(0).to_numpy()
            norms, code = np.sqrt((vectors * vectors).sum(axis=1)), codes(units(vectors))
            out = []
            for q, query in enumerate(queries):
                score = cosines(vectors, norms, query)
                top = _top(score, first, k + 1)
                out += [(q, float(score[i]), int(np.bitwise_count(code[i] ^ own[q]))) for i in top]
            columns = [[r[c] for r in out] for c in range(3)]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.float64(), pa.int64()))], names=["q", "score", "bits"])

    order = Window.partitionBy("q").orderBy(F.desc("score"))
    near = table.select("entry", "embedding").mapInArrow(work, "q bigint, score double, bits bigint")
    best = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    return [r["bits"] for r in best.select("bits").collect()]


def _values_near() -> np.ndarray:
    """All masks of a substring, by their number of bits."""
    masks = np.arange(1 << PART_BITS, dtype=np.uint32)
    return masks[np.argsort(np.bitwise_count(masks), kind="stable")]


def _bucket(value: np.ndarray, buckets: int) -> np.ndarray:
    return (value.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)


def searched(coded: DataFrame, queries: DataFrame, radius: int, buckets: int, k: int) -> DataFrame:
    """``query``, ``entry``, ``ids`` and ``score`` of the ``k`` nearest entries whose codes lie within the radius.

    ``coded`` has ``entry``, ``embedding``, ``ids`` and ``code``; ``queries`` is a part of it.
    """
    reach = radius // PARTS
    near = [1]
    for i in range(1, reach + 1):
        near.append(near[-1] * (PART_BITS - i + 1) // i)
    n_values = sum(near)

    def substrings(batches: Iterator[pa.RecordBatch], probing: bool) -> Iterator[pa.RecordBatch]:
        masks = _values_near()[:n_values]
        for batch in batches:
            code = batch.column(batch.schema.get_field_index("code")).to_numpy().view(np.uint64)
            part, bucket, row = [], [], []
            for j in range(PARTS):
                value = ((code >> np.uint64(PART_BITS * j)) & np.uint64((1 << PART_BITS) - 1)).astype(np.uint32)
                for i, v in enumerate(value):
                    found = np.unique(_bucket(masks ^ v, buckets)) if probing else _bucket(value[i : i + 1], buckets)
                    part += [j] * len(found)
                    bucket += found.tolist()
                    row += [i] * len(found)
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.record_batch([pa.array(part, pa.int32()), pa.array(bucket, pa.int64()), *taken.columns], names=["part", "bucket", *batch.schema.names])

    def dealt(rows: DataFrame, probing: bool) -> DataFrame:
        kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
        return rows.mapInArrow(lambda b: substrings(b, probing), f"part int, bucket bigint, {kinds}")

    index, probes = dealt(coded, False), dealt(queries.select(F.col("entry").alias("query"), "embedding", "code"), True)
    # Buckets of substrings that very many codes share are split, and their probes repeated.
    counts = index.groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("n"))
    slots = stored(counts.select("part", "bucket", F.ceil(F.col("n") / SPLIT).cast("int").alias("slots")), "buckets")
    index = attach(index, slots, ["part", "bucket"], "entry").withColumn("slot", F.pmod(F.xxhash64("entry"), F.col("slots")).cast("int")).drop("slots")
    probes = attach(probes, slots.withColumnRenamed("slots", "copies"), ["part", "bucket"], "query").filter("copies > 0")
    probes = probes.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")

    def look(key: tuple, own: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(own) and len(asked):
            part = key[0].as_py()
            own, asked = own.combine_chunks(), asked.combine_chunks()
            shift, mask = np.uint64(PART_BITS * part), np.uint64((1 << PART_BITS) - 1)
            code = own.column("code").to_numpy().view(np.uint64)
            order = np.argsort((code >> shift) & mask, kind="stable")
            code, own = code[order], own.take(pa.array(order))
            value, held = np.unique((code >> shift) & mask, return_counts=True)
            entry = own.column("entry").to_numpy()
            ids = own.column("ids").to_pylist()
            first = np.array([x[0] for x in ids])
            vectors = _matrix(own.column("embedding").combine_chunks())
            norms = np.sqrt((vectors * vectors).sum(axis=1))
            looking = _matrix(asked.column("embedding").combine_chunks())
            for who, bits, query in zip(asked.column("query").to_pylist(), asked.column("code").to_numpy().view(np.uint64), looking):
                hit = np.bitwise_count(value ^ ((bits >> shift) & mask)) <= reach
                rows = np.flatnonzero(np.repeat(hit, held))
                rows = rows[np.bitwise_count(code[rows] ^ bits) <= radius]
                # A code that an earlier part finds too is left to that one.
                for earlier in range(part):
                    apart = ((code[rows] ^ bits) >> np.uint64(PART_BITS * earlier)) & mask
                    rows = rows[np.bitwise_count(apart) > reach]
                if not len(rows):
                    continue
                score = cosines(vectors[rows], norms[rows], query)
                out += [(who, int(entry[rows[i]]), ids[rows[i]], float(score[i])) for i in _top(score, first[rows], k)]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64())
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(("query", "entry", "ids", "score"), kinds))})

    keys = ["part", "bucket", "slot"]
    found = index.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(look, "query bigint, entry bigint, ids array<bigint>, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")


def nearest(vectors: DataFrame, every: int, k: int = 5, within: float = WITHIN) -> DataFrame:
    """The ``k`` nearest other rows of each row whose id is divisible by ``every``.

    Returns ``query_id``, ``rank``, ``vec_id`` and ``score``. Rows without an id and vectors that are null,
    empty or zero or hold a null or non-finite component take no part. Vectors of different lengths have no cosine, so
    each length is searched by itself. A row that repeats id and vector counts once. Ties go to the smaller id. Where there are fewer
    other rows than ``k``, all are returned; an empty table gives no rows. Only ``vec_id`` and ``embedding`` are looked at.
    """
    rows = stored(usable(vectors).distinct(), "vectors")
    lengths = sorted(r["n"] for r in rows.select(F.size("embedding").alias("n")).distinct().collect())
    found = [_nearest(rows.filter(F.size("embedding") == n) if len(lengths) > 1 else rows, every, k, within) for n in lengths]
    if not found:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    return reduce(lambda a, b: a.unionByName(b), found)


def _nearest(rows: DataFrame, every: int, k: int, within: float) -> DataFrame:
    """The nearest rows of stored vectors of one length."""
    total = rows.count()
    keep = k + 1
    table = stored(entries(rows, keep), "entries")
    n = table.count()
    asking = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", F.xxhash64("embedding").alias("query"))
    asked = table.join(asking.select(F.col("query").alias("entry")).distinct(), "entry", "left_semi")
    chance = F.pmod(F.xxhash64(F.lit(SEED), "entry"), F.lit(1 << 32))
    drawn = table.filter(chance < int(min(1.0, SAMPLE / max(1, n)) * (1 << 32))).orderBy("entry").select("embedding").collect()
    if not drawn:
        drawn = table.select("embedding").limit(1).collect()
    codes = learned(units(np.array([r["embedding"] for r in drawn])))
    shared = table.sparkSession.sparkContext.broadcast(codes)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = shared.value(units(_matrix(batch.column(1))))
            yield pa.record_batch([*batch.columns, pa.array(code.view(np.int64))], names=[*batch.schema.names, "code"])

    coded = stored(table.select("entry", "embedding", "ids").mapInArrow(encode, "entry bigint, embedding array<double>, ids array<bigint>, code bigint"), "codes")
    waiting = stored(coded.join(asked.select("entry"), "entry", "left_semi"), "queries")
    n_asked = waiting.count()
    probing = waiting.filter(chance < int(min(1.0, PROBES / max(1, n_asked)) * (1 << 32))).select("embedding").collect()
    bits = sorted(neighbours_of([r["embedding"] for r in probing], coded, codes, k)) if probing else []
    radius = bits[min(len(bits) - 1, int(within * len(bits)))] if bits else BITS
    buckets = 1 + n // BUCKET
    parts = []
    while True:
        found = stored(searched(coded, waiting, radius, buckets, keep), "found")
        held = found.groupBy("query").agg(F.sum(F.size("ids")).alias("held"))
        enough = held.filter(F.col("held") >= min(keep, total)).select(F.col("query").alias("entry"))
        parts.append(found if radius >= BITS else found.join(enough.withColumnRenamed("entry", "query"), "query", "left_semi"))
        if radius >= BITS:
            break
        waiting = stored(waiting.join(enough, "entry", "left_anti"), "queries")
        if waiting.isEmpty():
            break
        radius = min(BITS, 2 * radius + PARTS)
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    listed = everything.select("query", "score", F.explode("ids").alias("vec_id"))
    pairs = asking.withColumnRenamed("vec_id", "query_id").join(listed, "query").filter(F.col("query_id") != F.col("vec_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
