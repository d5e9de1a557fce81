"""The corpus pipeline: documents to packed training sequences, stage by stage.

Null and empty texts fail the quality rules, so later stages get none from it; on their own they treat them like their operators do.
Rows that repeat, ties, null ids, very long texts and empty tables: see each stage's operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brindle.llm import exact_dedup, quality, queries, simhash
from brindle.llm.work import discard, materialize, scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie outside their perplexity bands go."""
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest id stays."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link, directly or over others, the one with the smallest id stays."""
    return simhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in the training sequences."""
    return queries.packed_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("best-fit packing", packing_stage),
]

#: Quality rules, near-dedup and packing go beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again. What a stage wrote besides is deleted when its result
    is there, and that result when the next one is; the last stage's tables stay, since its result is read from them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        before = docs
        with scratch(spark) as kept:
            docs = materialize(stage(spark, before, sf_dir), name.replace(" ", "-"))
            kept.append(docs)
        discard(before)
    return last(spark, docs, sf_dir)
