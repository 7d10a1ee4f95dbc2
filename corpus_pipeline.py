"""The corpus pipeline: documents to training shards, every stage written as Parquet and read again.

A stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns rows with the columns of
documents; the last adds slot and shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crownledger.llm import decontam, mixing, quality, sharding, simhash
from crownledger.llm.text import read
from crownledger.session import small_batches
from crownledger.sources.scratch import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    small_batches(spark)
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    small_batches(spark)
    return simhash.dedup(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    small_batches(spark)
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the slot and shard that they belong to."""
    small_batches(spark)
    return sharding.placed(docs)


STAGES = [
    ("quality rules", good_quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixed),
    ("sharding", sharded),
]

#: SQL cannot express the stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
