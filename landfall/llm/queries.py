"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import ann, chat, decontaminate, jaccard, langid, lines, mixing, negatives, packing, pii, quality, repair, rules
from landfall.llm.common import prepared, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepared(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return build


def _remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo a number; a row without an id has none."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.learned(docs, _remainder(3) != 1)
    found = langid.identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op2_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), every=50, k=5)


@query
def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixing.copies(table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op4_pack_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.packed(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def _held(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@query
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    spans = pii.found(docs, pii.learned(docs))
    base = F.filter("spans", lambda s: s["base"])
    return spans.select(
        "doc_id",
        *[_held(base, kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.judged(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    found = quality.scored(table(spark, folder, "documents").select("doc_id", "text"), labels, _remainder(4) != 2)
    held_out = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "score", "predicted")


@query
def op8_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.without_shared_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op10_chat_roles(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return chat.parsed(conversations, chat.learned(conversations))


@query
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations")
    return repair.told(conversations, repair.damaged(conversations))


def _items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ","), 256)


@query
def op12_benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), slop=0)
    n_items = F.size("items").cast("bigint").alias("n_items")
    return found.select("doc_id", "n_words", "n_hit", n_items, _items_digest(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined(negatives.relabelled(table(spark, folder, "embeddings")), every=50, positives=5, negatives=3)
