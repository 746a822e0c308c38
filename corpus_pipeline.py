"""A corpus pipeline of five operators, each stage written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmeter.llm import decontamination, language_id, mixing, sharding, simhash
from lexmeter.sources.scratch import new_folder, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter, or unlike every language learned from the others."""
    return language_id.keep_identified(docs, language_id.learn(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the smallest id.

    Texts are near-duplicates if SimHash fingerprints of their four-word shingles connect them
    by four differing bits or fewer.
    """
    return simhash.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.remove_contaminated(docs, benchmark)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and leave out documents so that sources meet their targets, in training order."""
    return mixing.curriculum(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add shard and slot, so that each shard holds the mixture."""
    return sharding.interleave(docs)


STAGES = [
    ("language ID", known_language),
    ("near-dedup", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: Trained models and XXH64 fingerprints decide which rows stay; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each is written as Parquet and read again."""
    folder = new_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return docs
