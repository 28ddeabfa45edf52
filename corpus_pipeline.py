"""The corpus pipeline: quality, near duplicates, benchmark leaks, mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet to the shared folder and read again as the next stage's ``docs``. All but
the last return the columns of ``documents``; the last returns the placement of every
row that the mix takes: doc_id, size, text_crc32, home, shard, slot.

Nulls, empty tables, repeated rows and extra columns: as the operators say. Extra
columns of ``docs`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelmerge.llm import decontaminate, mixing, near_dedup, quality, sharding
from panelmerge.llm.shared import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality classifier keeps."""
    return quality.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard 0.8)."""
    return near_dedup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def shard_placement(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row."""
    return sharding.assign_shards(docs, shards=8)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("source mix", source_mix),
    ("sharding", shard_placement),
]

#: Fitted models and similarity searches: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
