"""Personal data by candidate spans and boosted trees.

Generators with high recall propose spans of four kinds, which may overlap. The strict ones among
them, with the checks of their kind, are the base and always stay. The loose ones propose looser forms:
addresses without a domain's dot or with the sign spelled out, numbers with other separators. Boosted trees judge
these by their format and context. They learn on the candidates of all documents, counted by their features, from weak labels. Right are
candidates inside a base span of their kind and base spans rewritten into the looser forms. Wrong are candidates that
fail the check of their kind, lie inside a base span of another kind, follow a word for a version or an id or belong
to a longer list of numbers, and rewritten base spans that were made to fail. All other candidates have no label
and teach nothing. A calibrated threshold of each kind, chosen on examples that were set aside, decides which
loose spans are added.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.boosting import Gathered, Spread, Trees, grown, unpacked
from landfall.llm.common import quoted, stored
from landfall.llm.quality import _summed, isotonic

KINDS = ("email", "ip", "card", "phone")
#: Counted rows of examples up to which trees are grown on the driver; beyond, the same sums are taken by Spark.
GATHERED_ROWS = 50_000
#: Examples of a batch.
BATCH_SPANS = 4096
#: Margins are told apart in so many steps, so that few have to be counted.
MARGIN_STEPS = 1024
#: The least calibrated chance, and share of right ones among those set aside, of added spans.
LEAST_CHANCE = 0.5
LEAST_PRECISION = 0.99
#: Texts before a span whose cues are kept, of at most as many characters as the context has.
CUES_KEPT = 1024
#: Characters to both sides of a span that count as its context.
CONTEXT = 24
SEED = 13

# The strict patterns. They match what the plain forms match, but never look at a run of
# characters twice, so that long runs take linear time: an address begins at the start of a run of its characters or
# after an earlier match, and a number at the start of a run of digits.
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
EMAIL_AFTER = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGITS, NOT_DIGITS, HEX = re.compile(r"[0-9]+"), re.compile(r"[^0-9]+"), re.compile(r"[0-9][a-f]|[a-f][0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The loose patterns. All numbers of a text lie in runs of digits and separators, none of them shorter than the least one,
# so only these runs are searched for numbers, each by itself.
RUN = re.compile(r"[0-9(+][0-9\x20().,/+-]{6,}+")
LOOSE_NUMBERS = (
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,5}(?:\x20?[.,]\x20?[0-9]{1,5}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[\x20./-]{0,2}[0-9]){11,22}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])\(?[0-9]{2,4}\)?(?:[\x20./-]{1,2}[0-9]{2,5}){2,4}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])(?:\+|00)\x20?[0-9](?:[\x20()./-]{0,2}[0-9]){7,15}(?![0-9])")),
)
# An address is what stands on both sides of its sign: before it, a whole run of such characters.
NAME = re.compile(r"(?<![^\s@<>()\[\]\"',;:])[^\s@<>()\[\]\"',;:]{1,64}+\Z")
HOST = re.compile(r"[^\s@<>()\[\]\"',;:]{1,255}")
SIGN = re.compile(r"[(\[{]at[)\]}]")
SPELLED_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}+\x20?[(\[{]at[)\]}]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[A-Za-z0-9-]{1,63}){1,8}")
WORTH = r"[0-9@]|[(\[{]at[)\]}]"
CUES = re.compile(r"(?i)(mail|e-mail|contact)|(\bip\b|addr|host|server)|(card|visa|credit|konto|carte|tarjeta)|(phone|tel|call|mobil|fax)|(version|token|key|id\b|no\.|isbn|hash)")


def luhn(digits: str) -> bool:
    double = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(double) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _part(text: str) -> bool:
    text = text.lstrip("0")
    return len(text) <= 3 and int(text or "0") <= 255


def _digits(text: str) -> str:
    return NOT_DIGITS.sub("", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    found = EMAIL.search(text) if "@" in text else None
    while found:
        yield found.span()
        at = found.end()
        # Right after a match an address may begin inside a run, which the plain pattern sees too.
        found = EMAIL_AFTER.match(text, at) or EMAIL.search(text, at)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base spans by kind and start."""
    out = [("email", a, b) for a, b in _emails(text)]
    ips, cards, phones = [], [], []
    for start, end in _runs(text):
        for found in IP.finditer(text, start, end):
            if all(map(_part, found.group().split("."))):
                ips.append(("ip", *found.span()))
        for found in CARD.finditer(text, start, end):
            digits = _digits(found.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(("card", *found.span()))
        for found in PHONE.finditer(text, start, end):
            if 9 <= len(_digits(found.group())) <= 15:
                phones.append(("phone", *found.span()))
    return out + ips + cards + phones


def _runs(text: str) -> Iterator[tuple[int, int]]:
    return (run.span() for run in RUN.finditer(text))


def _loose_emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses by their sign, so that no other part of a text is looked at."""
    end, at = 0, text.find("@")
    while at >= 0:
        # A run of 65 such characters is too long.
        first = max(0, at - 65)
        name, host = NAME.search(text[first:at]), HOST.match(text, at + 1)
        if name and host and first + name.start() >= end:
            end = host.end()
            yield first + name.start(), end
        at = text.find("@", at + 1)


def candidates(text: str) -> list[tuple[str, int, int]]:
    """What the loose generators propose."""
    found = {("email", *span) for span in _loose_emails(text)}
    if SIGN.search(text):
        found.update(("email", *m.span()) for m in SPELLED_EMAIL.finditer(text))
    for start, end in _runs(text):
        found.update((kind, *m.span()) for kind, pattern in LOOSE_NUMBERS for m in pattern.finditer(text, start, end))
    return sorted(found)


def _worthy(texts: pa.Array) -> Iterator[tuple[int, str]]:
    """The place and the text of each that may hold a candidate. Arrow finds them, so that no other one becomes a text of Python."""
    for i in pc.indices_nonzero(pc.match_substring_regex(texts, WORTH)).to_pylist():
        yield i, texts[i].as_py()


@lru_cache(CUES_KEPT)
def _cue(before: str) -> int:
    """The number of the last cue before a span, 0 for none and 5 for a word for a version or an id.

    All forms of a base span stand behind the same few texts, so the last ones are kept.
    """
    last = 0
    for found in CUES.finditer(before):
        last = found.lastindex
    return last


FORMAT = ("length", "digits", "share", "separators", "groups", "longest", "shortest", "plus", "at", "dot_after_at", "luhn", "parts", "hex", "brackets")


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span, as numbers."""
    span = text[start:end]
    digits = _digits(span)
    groups = DIGITS.findall(span)
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    last, following = before[-1:] or " ", after[:1] or " "
    return [
        *[float(kind == k) for k in KINDS],
        len(span),
        len(digits),
        len(digits) / len(span),
        sum(map(span.count, " .-/()")),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        float(span.startswith("+")),
        float("@" in span),
        float("." in span.partition("@")[2]),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(len(groups) == 4 and all(map(_part, groups))),
        float(bool(HEX.search(before[-4:] + span + after[:4]))),
        float("(" in span),
        float(last.isalnum()),
        float(following.isalnum()),
        float(last in "\"'=#_/\\"),
        float(last == "\n" or start == 0),
        float(following in ".,;"),
        len(_digits(before)),
        len(_digits(after)),
        float(_cue(before)),
    ]


N_FEATURES = len(KINDS) + len(FORMAT) + 8


@dataclass
class Model:
    """Trees, the calibration of their margins, and the least chance of an added span of each kind."""

    trees: Trees
    knots: np.ndarray
    levels: np.ndarray
    least: dict[str, float]

    def chances(self, x: np.ndarray) -> np.ndarray:
        return np.interp(_steps(self.trees, x) / MARGIN_STEPS, self.knots, self.levels) if len(x) else np.empty(0)


def _steps(trees: Trees, x: np.ndarray) -> np.ndarray:
    return np.round(trees.margins(x) * MARGIN_STEPS).astype(np.int64)


class Taken:
    """Spans of a text of which none overlaps another one of its kind, so that the one that could touch a span is found by bisection."""

    def __init__(self, spans: Iterable[tuple[str, int, int]] = ()):
        self.starts: dict[str, list[int]] = {kind: [] for kind in KINDS}
        self.ends: dict[str, list[int]] = {kind: [] for kind in KINDS}
        for kind, start, end in sorted(spans):
            self.starts[kind].append(start)
            self.ends[kind].append(end)

    def covers(self, span: tuple[str, int, int]) -> bool:
        """Whether a span overlaps one of its kind."""
        kind, start, end = span
        at = bisect_right(self.ends[kind], start)
        return at < len(self.ends[kind]) and self.starts[kind][at] < end

    def holds(self, kind: str, start: int, end: int) -> bool:
        """Whether a span lies inside one of a kind."""
        at = bisect_right(self.starts[kind], start) - 1
        return at >= 0 and end <= self.ends[kind][at]

    def add(self, span: tuple[str, int, int]) -> None:
        """Add a span that overlaps none of its kind."""
        kind, start, end = span
        at = bisect_right(self.starts[kind], start)
        self.starts[kind].insert(at, start)
        self.ends[kind].insert(at, end)


# The words that spell out a sign, the separators of loose numbers, and a number on either side of a list.
SPELLED = re.compile(r"\x20?[(\[{](at|dot)[)\]}]\x20?")
EMAIL_FORMS = ((" (at) ", " (dot) "), ("[at]", "[dot]"), (" {at} ", "."))
IP_FORMS = (", ", ",", " . ", ". ")
CARD_FORMS = (".", "/", " - ", "--")
LIST_BEFORE, LIST_AFTER = re.compile(r"[0-9]\x20?[.,/-]\x20?$"), re.compile(r"\x20?[.,/-]\x20?[0-9]")


def _passes(kind: str, span: str) -> bool:
    """The check of a kind, for a span of any form."""
    if kind == "email":
        plain = SPELLED.sub(lambda m: "@" if m[1] == "at" else ".", span)
        name, _, host = plain.partition("@")
        return any(c.isalnum() for c in name) and any(c.isalpha() for c in host)
    digits = _digits(span)
    if kind == "ip":
        groups = DIGITS.findall(span)
        return len(groups) == 4 and all(map(_part, groups)) and not any(len(g) > 1 and g[0] == "0" for g in groups)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def label(text: str, span: tuple[str, int, int], base: Taken) -> bool | None:
    """The weak label of a candidate; None where nothing tells."""
    kind, start, end = span
    if base.holds(kind, start, end):
        return True
    if base.covers(span):
        return None
    if not _passes(kind, text[start:end]) or any(base.holds(other, start, end) for other in KINDS if other != kind):
        return False
    before = text[max(0, start - CONTEXT) : start]
    if kind != "email" and (_cue(before) == 5 or LIST_BEFORE.search(before) or LIST_AFTER.match(text, end)):
        return False
    return None


def loose_forms(kind: str, span: str) -> list[tuple[str, bool]]:
    """A base span in the forms that only the loose generators propose, and such forms made to fail."""
    if kind == "email":
        name, _, host = span.partition("@")
        return [(name + at + host.replace(".", dot), True) for at, dot in EMAIL_FORMS] + [(f"{name}@{host.partition('.')[0]}", True)]
    digits = _digits(span)
    if kind == "ip":
        # Other numbers too, as the same few addresses stand in many texts.
        r = random.Random(span)
        groups, others = span.split("."), [str(r.randrange(256)) for _ in range(4)]
        spoilt = list(others)
        spoilt[r.randrange(4)] = str(r.randrange(256, 1000))
        return [(sep.join(g), g is not spoilt) for sep in IP_FORMS for g in (groups, others, spoilt)]
    if kind == "card":
        spoilt = digits[:-1] + str((int(digits[-1]) + 5) % 10)
        return [(sep.join(d[i : i + 4] for i in range(0, len(d), 4)), d is digits) for sep in CARD_FORMS for d in (digits, spoilt)]
    # Without the sign, the country's number goes too, which is what comes before the last ten digits.
    own = digits[-10:]
    parts = own[:-7], own[-7:-4], own[-4:]
    national = [sep.join(parts) for sep in ("-", ".", " ", "/")] + [f"({parts[0]}) {parts[1]}-{parts[2]}"]
    return [(form, True) for form in (*national, "00" + span[1:], "00" + re.sub(r"[^0-9]+", " ", span[1:]), "+" + "/".join((digits[:-7] or "1", *parts[1:])))]


def rewritten(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[list[float], bool, int, str]]:
    """Examples from base spans in looser forms: features, label, start of the base span and its kind.

    Each stands where the base span does, and numbers also after a word for a version or an id, which makes them wrong.
    What lies inside such a form and is of another kind is wrong too.
    """
    for kind, start, end in base:
        before, after = text[max(0, start - 4 * CONTEXT) : start], text[end : end + 4 * CONTEXT]
        for form, right in loose_forms(kind, text[start:end]):
            if right and not _passes(kind, form):
                continue
            for cue in ("",) if kind == "email" or not right else ("", "version ", "id "):
                if not cue and right and kind != "email" and _cue(before[-CONTEXT:]) == 5:
                    continue
                near = before + cue + form + after
                span = (kind, len(before) + len(cue), len(before) + len(cue) + len(form))
                for own in candidates(near):
                    if own == span or own[0] != kind and span[1] <= own[1] and own[2] <= span[2]:
                        yield features(near, *own), own == span and right and not cue, start, own[0]


def calibrated(trees: Trees, counted: Iterable[tuple[int, int, int, int]]) -> Model:
    """A model from counts of the examples set aside: kind, step of the margin, how many and how many right ones."""
    kind, step, n, good = np.array(sorted(counted), dtype=np.int64).T
    steps, place = np.unique(step, return_inverse=True)
    model = Model(trees, *isotonic(steps / MARGIN_STEPS, np.bincount(place, good), np.bincount(place, n)), {})
    chance = np.interp(step / MARGIN_STEPS, model.knots, model.levels)
    for k, name in enumerate(KINDS):
        levels, at = np.unique(chance[kind == k], return_inverse=True)
        many, right = (np.bincount(at, c[kind == k], len(levels)) for c in (n, good))
        precision = right[::-1].cumsum() / many[::-1].cumsum()
        least = 2.0
        for level, share in zip(levels[::-1], precision):
            if level < LEAST_CHANCE or share < LEAST_PRECISION:
                break
            least = float(level)
        # Where all of the least chance and more are right enough, those between it and the lowest seen are too.
        likely = levels[levels >= LEAST_CHANCE]
        model.least[name] = LEAST_CHANCE if len(likely) and least == likely.min() else least
    return model


def _told(text: str) -> Iterator[tuple[list[float], bool, int, str]]:
    """The examples of a text: features, label, start and kind."""
    base = base_spans(text)
    taken = Taken(base)
    for span in candidates(text):
        y = label(text, span, taken)
        if y is not None:
            yield features(text, *span), y, span[1], span[0]
    yield from rewritten(text, base)


def examples(docs: DataFrame) -> DataFrame:
    """The examples of all documents, counted: features ``x``, whether they are set ``aside``, ``n`` and how many of these are right, ``good``."""

    def packed(order: list[int], rows: list[list[float]], labels: list[bool]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.bool_()]
        return pa.record_batch([pa.array(v, t) for v, t in zip((order, rows, labels), kinds)], names=["key", "x", "y"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, rows, labels = [], [], []
        for batch in batches:
            for i, text in _worthy(batch.column(0)):
                key = batch.column(1)[i].as_py()
                for x, y, start, kind in _told(text):
                    rows.append(x)
                    labels.append(y)
                    order.append((key * 31 + start * 1_000_003 + KINDS.index(kind)) & 0x7FFFFFFFFFFFFFFF)
                    if len(rows) == BATCH_SPANS:
                        yield packed(order, rows, labels)
                        order, rows, labels = [], [], []
        yield packed(order, rows, labels)

    told = docs.select("text", F.xxhash64("doc_id").alias("key")).mapInArrow(work, "key bigint, x array<double>, y boolean")
    aside = F.pmod(F.xxhash64(F.lit(SEED), "key"), F.lit(4)) == 0
    return told.groupBy("x", aside.alias("aside")).agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("good"))


def learned(docs: DataFrame) -> Model | None:
    """A model from the candidates of all of ``docs``; None where no right one can be learned or none is set aside.

    Examples with the same features are one row with its counts. Few such rows are gathered, of many the sums that a level of
    a tree needs are taken by Spark; both ways give the same trees.
    """
    rows = stored(examples(docs.select("doc_id", "text")), "personal-examples")
    held = {r["aside"]: r for r in rows.groupBy("aside").agg(F.count(F.lit(1)).alias("rows"), F.sum("good").alias("good")).collect()}
    if True not in held or False not in held or not held[False]["good"]:
        return None
    training = rows.filter(~F.col("aside")).select("x", "n", "good")
    if held[False]["rows"] <= GATHERED_ROWS:
        trees = grown(Gathered(*unpacked(training.toArrow().combine_chunks().to_batches()[0])))
    else:
        trees = grown(Spread(training, _summed))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch)[0]
            kind = x[:, : len(KINDS)].argmax(axis=1)
            yield pa.record_batch([pa.array(kind), pa.array(_steps(trees, x)), batch.column("n"), batch.column("good")], names=["kind", "step", "n", "good"])

    steps = rows.filter("aside").select("x", "n", "good").mapInArrow(work, "kind bigint, step bigint, n bigint, good bigint")
    return calibrated(trees, map(tuple, steps.groupBy("kind", "step").agg(F.sum("n"), F.sum("good")).collect()))


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean, chance: double>>"


def found(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id`` and the ``spans`` of every document: kind, start and end in code points, base or not, chance.

    Spans follow the order of ``KINDS``, then start and end. Base spans have the chance 1. A loose span that
    overlaps a base span of its kind adds nothing; of loose ones that overlap each other the likelier
    stays, then the longer. Without a model only the base is found. A null or empty text has no spans; a very long one
    is searched whole, in a time that grows with its length and spans. Rows that repeat are judged each by itself. An empty table gives no rows; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("chance", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            spans: list[list[dict]] = [[] for _ in range(len(batch))]
            taken: dict[int, Taken] = {}
            loose: list[tuple[int, tuple[str, int, int]]] = []
            x: list[list[float]] = []
            for i, text in _worthy(batch.column(0)):
                base = base_spans(text)
                taken[i] = Taken(base)
                spans[i] = [dict(kind=k, start=a, end=b, base=True, chance=1.0) for k, a, b in base]
                if model is not None:
                    for span in candidates(text):
                        if model.least[span[0]] <= 1.0 and not taken[i].covers(span):
                            loose.append((i, span))
                            x.append(features(text, *span))
            if loose:
                chance = model.chances(np.array(x, dtype=float))
                ranked = sorted(range(len(loose)), key=lambda j: (-chance[j], loose[j][1][1] - loose[j][1][2], loose[j]))
                for j in ranked:
                    i, span = loose[j]
                    if chance[j] >= model.least[span[0]] and not taken[i].covers(span):
                        taken[i].add(span)
                        spans[i].append(dict(kind=span[0], start=span[1], end=span[2], base=False, chance=float(chance[j])))
            for own in filter(None, spans):
                own.sort(key=lambda s: (KINDS.index(s["kind"]), s["start"], s["end"]))
            yield pa.record_batch([batch.column(1), pa.array(spans, pa.list_(kind))], names=["doc_id", "spans"])

    return docs.select("text", "doc_id").mapInArrow(work, f"doc_id {dict(docs.dtypes)['doc_id']}, spans {SPANS}")


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with all columns, every span of a text replaced by its kind in brackets; overlapping ones by that of the first."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["text", *[c for c in docs.columns if c != "text"]]

    def clean(text: str, model: Model | None) -> str:
        base = base_spans(text)
        spans, taken = list(base), Taken(base)
        more = [s for s in candidates(text) if model and model.least[s[0]] <= 1.0 and not taken.covers(s)]
        chance = model.chances(np.array([features(text, *s) for s in more], dtype=float)) if more else []
        spans += [s for s, c in zip(more, chance) if c >= model.least[s[0]]]
        out, at = [], 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= at:
                out += [text[at:a], f"[{kind}]"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i, text in _worthy(batch.column(0)):
                texts[i] = clean(text, shared.value)
            yield pa.record_batch([pa.array(texts, pa.string()), *batch.columns[1:]], names=names)

    rows = docs.select(*[quoted(c) for c in names])
    return rows.mapInArrow(work, rows.schema).select(*[quoted(c) for c in docs.columns])
