"""Documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept, which is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import jaccard, langid, lines, mixing, packing
from landfall.llm.common import prepared, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents whose most likely language is less likely than this are rejected.
LEAST_SCORE = 0.4

#: Tokens cannot be expressed in SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the language found in their text; those without letters or with no likely language go.

    The model learns from all documents that have a language.
    """
    prepared(spark)
    found = langid.identified(docs.select(*COLUMNS), langid.learned(docs, F.lit(True)))
    likely = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return likely.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share. One that has no line left stays, empty."""
    prepared(spark)
    kept = lines.without_shared_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id (``jaccard.survivors``)."""
    prepared(spark)
    return jaccard.survivors(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as the mix of sources takes it."""
    prepared(spark)
    return mixing.mixed(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences, with their token ids."""
    prepared(spark)
    return packing.packed(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_shared_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
