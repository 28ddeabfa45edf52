"""The operators bound to the driver's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation, decontaminate, entropy_lm, language_id, line_dedup, manifest, mixing, near_dedup, outliers, quality, sharding, toxicity, url_filter
from .oracle import ORACLE_SQL  # noqa: F401
from .shared import id_remainder, table


def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaks of ``benchmark`` into ``documents``: a row per document and item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))


def op2_perfect_hash_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_mcd_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return outliers.reject_outliers(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")


def op4_bounded_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


def op5_hypergeometric_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.plan_mix(docs).withColumn("__row", F.expr("explode(sequence(1, rows))"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "shard_1", "order_1", "shard_2", "order_2")


def op6_circulant_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, words_each=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op7_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.score_toxicity(docs, labels, id_remainder(F.col("doc_id"), 5) == 0)


def op9_ngram_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


def op10_hashed_entropy_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    return entropy_lm.score_texts(docs, ~held_out).withColumn("held_out", held_out)


def op11_slot_pivot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return manifest.manifest(docs, tampered, F.translate("text", "\n", ""))


def op12_byte_convolution_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    return language_id.identify(docs, ~held_out).withColumn("held_out", held_out)


def op13_rank_convergence_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.audit(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_pigeonhole_decontamination, op2_perfect_hash_line_dedup, op3_mcd_quality_rules, op4_bounded_ring_sharding,
    op5_hypergeometric_mixing, op6_circulant_minhash_dedup, op7_weak_label_quality, op8_counterfactual_toxicity,
    op9_ngram_url_filter, op10_hashed_entropy_lm, op11_slot_pivot_manifest,
    op12_byte_convolution_language, op13_rank_convergence_repair)}
