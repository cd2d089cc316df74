"""A corpus pipeline of the training-data operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textorbit.llm.bands import compression_bands
from textorbit.llm.common import BATCH_BYTES, table
from textorbit.llm.decontaminate import find_benchmark
from textorbit.llm.mixing import mix_sources, take
from textorbit.llm.omh import keep_one
from textorbit.llm.sharding import shard_documents
from textorbit.session import BATCH_SETTING, stage


def small_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python in batches of bounded bytes; workers and executors keep what a larger one took."""
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the word rules and the compression bands keep."""
    small_batches(spark)
    return compression_bands(docs).filter("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least id."""
    small_batches(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    small_batches(spark)
    return find_benchmark(docs, table(spark, sf_dir, "benchmark")).filter("NOT contaminated").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the sources' targets ask for: documents of small sources repeat, large ones are cut."""
    small_batches(spark)
    return take(mix_sources(docs)).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it."""
    small_batches(spark)
    return shard_documents(docs).select(*docs.columns, "shard", "slot")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Compression and sketches have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
