"""Language identification by sparse multinomial logistic regression on character n-grams.

Texts are lower-cased, everything but letters becomes one mark between words, and bigrams and
trigrams are hashed. A feature is the share of an n-gram in its text times its inverse document
frequency, which is counted over all documents that may be learned from. The weights are fitted by
follow-the-regularised-leader with elastic-net penalties, one text at a time, on a bounded
sample of labelled texts; a temperature that makes the probabilities of texts set aside most likely
calibrates them. A text is scored whole.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import fresh, quoted, stored
from landfall.llm.words import slices

BITS = 16
SIZE = 1 << BITS
#: Labelled texts to fit on, at most on average, in equal parts for each language.
SAMPLE = 4000
#: Bytes of the hashes and shares of these texts, but for a longer single one.
SAMPLE_BYTES = 64 << 20
EPOCHS = 2
RATE, SMOOTH, L1, L2 = 0.5, 1.0, 0.02, 0.01
TIMES = 100.0
#: Bytes of texts whose n-grams are in memory at once; a text is never cut.
SLICE_BYTES = 1 << 19
UNKNOWN = "und"
SEED = 5


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes below ``SIZE`` of all n-grams of some texts, and where those of each text begin (and the last end)."""
    low = [(t or "").lower() for t in texts.to_pylist()]
    codes = np.frombuffer("".join(f" {t} " for t in low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    bounds = np.concatenate(([0], np.cumsum([len(t) + 2 for t in low])))
    letter = _letters()[codes]
    marked = np.where(letter, codes, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:] & ~letter[:-1]
    # Between two words the mark after the first and the one before the second may both be there.
    twice = np.zeros(len(keep), dtype=bool)
    place = np.flatnonzero(keep)
    spaces = ~letter[place]
    twice[place[1:]] = spaces[1:] & spaces[:-1]
    first = np.isin(place, bounds) if len(place) else place.astype(bool)
    keep &= ~twice | np.bincount(place[first], minlength=len(keep)).astype(bool)
    marked, at = marked[keep], np.concatenate(([0], np.cumsum(keep)))[bounds]
    text = np.repeat(np.arange(len(low)), np.diff(at))
    two = marked * np.uint32(0x9E3779B1)
    two[:-1] += marked[1:] * np.uint32(0x85EBCA77)
    three = two * np.uint32(5)
    three[:-2] += marked[2:] * np.uint32(0xC2B2AE3D)
    parts = []
    for value, n in ((two, 2), (three, 3)):
        value = value ^ (value >> np.uint32(15))
        value = (value * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)
        inside = np.zeros(len(text), dtype=bool)
        if len(text) >= n:
            inside[: len(text) - n + 1] = text[: len(text) - n + 1] == text[n - 1 :]
        parts.append((value[inside], text[inside]))
    counts = sum(np.bincount(t, minlength=len(low)) for _, t in parts)
    ends = np.concatenate(([0], np.cumsum(counts)))
    out = np.empty(ends[-1], dtype=np.uint32)
    n_two = np.bincount(parts[0][1], minlength=len(low))
    for (value, owner), before in zip(parts, (np.zeros(len(low), int), n_two)):
        heads = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(low)))))[:-1]
        out[ends[owner] + before[owner] + np.arange(len(owner)) - heads[owner]] = value
    return out, ends


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each hash occurs, and the number of texts. Each task sends at most a number per hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(SIZE, np.int64), 0
        last = np.full(SIZE, -1)
        for batch in batches:
            texts = batch.column(0)
            for low, high in slices(texts, SLICE_BYTES):
                found, ends = grams(texts.slice(low, high - low))
                for i in range(high - low):
                    last[found[ends[i] : ends[i + 1]]] = n
                    total += last == n
                    n += 1
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(used, SIZE)), pa.array(np.append(total[used], n))], names=["hash", "n"])

    out = np.zeros(SIZE + 1, np.int64)
    for row in docs.select("text").mapInArrow(work, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n")).collect():
        out[row["hash"]] = row["n"]
    return out[:SIZE], int(out[SIZE])


def sample(docs: DataFrame, limit: int = SAMPLE) -> list[tuple[str, bool, np.ndarray, np.ndarray]]:
    """Labelled texts as language, whether to calibrate on it, hashes and shares, in a fixed order.

    Each language gives its part of ``limit``, chosen by a hash of the id and the text, so that texts that share an id or have none are chosen each by
    itself. No more than ``limit`` texts come here and no more than ``SAMPLE_BYTES`` of what is learned of them: those of the least hashes.
    """
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return []
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, min(1.0, limit / len(counts) / n)).otherwise(share)
    chance = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "lang", F.xxhash64("text")), F.lit(1 << 32))
    chosen = docs.withColumn("chance", chance).filter(F.col("chance") < share * float(1 << 32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for low, high in slices(texts, SLICE_BYTES):
                found, ends = grams(texts.slice(low, high - low))
                rows = [np.unique(found[a:b], return_counts=True) for a, b in zip(ends[:-1], ends[1:])]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        pa.array([h.astype("<u2").tobytes() for h, _ in rows], pa.binary()),
                        pa.array([(c / max(1, c.sum())).astype("<f4").tobytes() for _, c in rows], pa.binary()),
                    ],
                    names=["lang", "chance", "hashes", "shares"],
                )

    drawn = stored(chosen.select("lang", "text", "chance").mapInArrow(work, "lang string, chance bigint, hashes binary, shares binary"), "language-sample")
    # Within its language a text's turn is its place among those that may come, so that a cut takes from all languages alike.
    turn = (F.col("chance") / (share * float(1 << 32))).alias("turn")
    size = F.octet_length("hashes") + F.octet_length("shares")
    first = drawn.select(turn, size.alias("size")).orderBy("turn", "size").limit(limit).collect()
    if not first:
        return []
    taken = min(len(first), max(1, int(np.searchsorted(np.cumsum([r["size"] for r in first]), SAMPLE_BYTES, "right"))))
    rows = drawn.select("*", turn).filter(F.col("turn") <= first[taken - 1]["turn"]).orderBy("turn", size, "lang", "hashes").limit(taken).collect()
    rows.sort(key=lambda r: (r["chance"] * 0x9E3779B1 % (1 << 32), r["lang"], r["hashes"]))
    return [(r["lang"], r["chance"] % 5 == 0, np.frombuffer(r["hashes"], "<u2").astype(np.int64), np.frombuffer(r["shares"], "<f4").astype(np.float64)) for r in rows]


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # of shares, by hash and language: the fitted ones times the inverse document frequencies
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, found: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = np.diff(ends)
        out = np.tile(self.bias, (len(n), 1))
        used = np.flatnonzero(n)
        if len(used):
            out[used] += np.add.reduceat(self.weights[found], ends[:-1][used], axis=0, dtype=np.float64) / n[used, None]
        return out

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return softmax(logits / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list, frequencies: np.ndarray, n_texts: int) -> Model:
    """The model of a sample. All texts of one language, or none, give a model that knows no other."""
    langs = sorted({r[0] for r in rows})
    inverse = (np.log((1.0 + n_texts) / (1.0 + frequencies)) + 1.0) * TIMES
    z = np.zeros((SIZE + 1, len(langs)))
    n = np.zeros_like(z)

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((SMOOTH + np.sqrt(n)) / RATE + L2))

    training = [r for r in rows if not r[1]] or rows
    for _ in range(EPOCHS):
        for lang, _, hashes, shares in training:
            at = np.append(hashes, SIZE)
            x = np.append(shares * inverse[hashes], 1.0)[:, None]
            z_at, n_at = z[at], n[at]
            w = weights(z_at, n_at)
            p = softmax((x * w).sum(axis=0))
            p[langs.index(lang)] -= 1.0
            g = x * p
            more = n_at + g * g
            z[at] = z_at + g - (np.sqrt(more) - np.sqrt(n_at)) / RATE * w
            n[at] = more
    w = weights(z, n)
    model = Model(langs, (w[:SIZE] * inverse[:, None]).astype(np.float32), w[SIZE])
    checks = [r for r in rows if r[1]] or rows
    logits = np.array([(r[3][:, None] * model.weights[r[2]]).sum(axis=0) + model.bias for r in checks])
    truth = np.array([langs.index(r[0]) for r in checks])
    best = np.inf
    for temperature in np.geomspace(0.05, 20.0, 121):
        p = softmax(logits / temperature)[np.arange(len(truth)), truth]
        # A text that is labelled wrongly must not decide alone.
        loss = -np.log(np.maximum(p, 1e-6)).mean()
        if loss < best - 1e-9:
            best, model.temperature = loss, float(temperature)
    return model


def learned(docs: DataFrame, learnable: Column, limit: int = SAMPLE) -> Model | None:
    """A model of the rows of ``docs`` whose ``learnable`` is true and whose ``lang`` is not null; None if there are none."""
    rows = docs.filter(learnable & F.col("lang").isNotNull()).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    drawn = sample(rows, limit)
    return fit(drawn, *document_frequencies(rows)) if drawn else None


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with all their columns, ``lang_pred`` and ``score``, the calibrated probability of that language.

    A text that is null or has no letter gets ``und`` and 0, and so does every text where there is no model.
    Nothing but the text is looked at. New columns whose names ``docs`` has already get an underscore.
    """
    names = fresh(docs, "lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("text", *[quoted(c) for c in docs.columns if c != "text"]).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(0)
            langs, scores = [], []
            for low, high in slices(texts, SLICE_BYTES):
                found, ends = grams(texts.slice(low, high - low))
                known = np.diff(ends) > 0
                if model is None:
                    langs.extend([UNKNOWN] * len(known))
                    scores.extend([0.0] * len(known))
                    continue
                p = model.probabilities(model.logits(found, ends))
                best = p.argmax(axis=1)
                langs.extend(model.langs[b] if k else UNKNOWN for b, k in zip(best, known))
                scores.extend(np.where(known, p[np.arange(len(best)), best], 0.0).tolist())
            yield pa.record_batch(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, *names]
            )

    schema = schema.add(names[0], "string").add(names[1], "double")
    out = docs.select("text", *[quoted(c) for c in docs.columns if c != "text"]).mapInArrow(work, schema)
    return out.select(*[quoted(c) for c in [*docs.columns, *names]])
