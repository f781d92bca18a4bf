"""Removal of lines that many documents share.

Lines are exploded and normalised, their keys hashed, and the distinct documents of each hash
counted. Documents that hold a key over the threshold lose its lines, all but the largest of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import UPPER, fresh, join_counted, quoted, stored, trimmed

LEAST_CHARS = 40
LEAST_DOCS = 5


def line_key(line: Column) -> Column:
    return F.translate(trimmed(line), UPPER, UPPER.lower())


def key_hash(key: Column) -> Column:
    """128 bits, so that keys of a very large corpus do not meet by chance."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(1), key).alias("b"))


def _mark() -> Column:
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def shared_keys(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``doc_id``, ``mark`` and the hashes (``drops``) of the keys whose lines that document loses.

    ``mark`` is null but for rows without an id, which it tells apart by a hash of their text, so that their keys are not gathered in one
    place. Only hashes and ids are shuffled. A key that very many documents hold is combined in each
    task before the count, and its rows are not shuffled by key for the join that follows.
    """
    line = docs.select("doc_id", _mark().alias("mark"), F.explode(F.array_distinct(F.transform(_lines(F.col("text")), line_key))).alias("key"))
    held = stored(
        line.filter(F.char_length("key") >= least_chars).select("doc_id", "mark", key_hash(F.col("key")).alias("h")).select("doc_id", "mark", "h.*"),
        "line-keys",
    )
    # A null id counts as one document, below all others.
    counted = held.groupBy("a", "b").agg(
        F.count_distinct("doc_id").alias("n"),
        F.count(F.lit(1)).alias("rows"),
        F.max(F.col("doc_id").isNull().cast("int")).alias("none"),
        F.max("doc_id").alias("last"),
    )
    over = stored(counted.filter(F.col("n") + F.col("none") >= least_docs).select("a", "b", "rows", "last"), "shared-keys")
    losing = join_counted(held, over, ["a", "b"], "rows", held.count()).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    return losing.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("a", "b")).alias("drops"))


def without_shared_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` with all columns, the text of each without its shared lines, and ``n_lines`` and ``n_dropped``.

    A null or empty text is one empty line and comes back empty. Rows that repeat an id are one
    document with several texts: a key counts once for the id, and the rule holds for each row.
    Names of the two counts that ``docs`` has already get an underscore.
    """
    n_lines, n_dropped = fresh(docs, "n_lines", "n_dropped")
    owner, mark, drops, kept = fresh(docs, "line_owner", "line_mark", "drops", "kept_lines")
    found = shared_keys(docs, least_chars, least_docs).select(F.col("doc_id").alias(owner), F.col("mark").alias(mark), F.col("drops").alias(drops))
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col(owner)) & _mark().eqNullSafe(F.col(mark)), "left")
    lines = _lines(F.col("text"))
    stays = F.filter(lines, lambda line: ~F.array_contains(F.col(drops), key_hash(line_key(line))))
    cleaned = joined.withColumn(kept, F.when(F.col(drops).isNull(), lines).otherwise(stays))
    return cleaned.select(
        *[F.array_join(kept, "\n").alias("text") if c == "text" else F.col(quoted(c)) for c in docs.columns],
        F.size(lines).cast("bigint").alias(n_lines),
        (F.size(lines) - F.size(kept)).cast("bigint").alias(n_dropped),
    )
