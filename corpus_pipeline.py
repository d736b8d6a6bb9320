"""The training-data pipeline: each stage works on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers

from feedweave.llm import mixing, packing, quality, simhash, substrings
from feedweave.session import scratch_dir
from pyspark.sql import DataFrame, SparkSession


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose host is not rejected."""
    return quality.filtered(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of smallest id."""
    return simhash.representatives(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that also start earlier. A text may end up empty."""
    return substrings.remaining(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no XXH64, suffix sort or tokenizer; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    path = scratch_dir(spark, f"stage-{STAGES[-1][0]}")
    STAGES[-1][1](spark, docs, sf_dir).write.parquet(path)
    return spark.read.parquet(path)
