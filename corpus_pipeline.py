"""Corpus pipeline: the stages that take `documents` to numbered records of shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laurel.llm import decontamination, language, minhash, mixing, sharding
from laurel.session import stored_copy


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without text, or without a letter in it, go."""
    return language.keep_known_languages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every record with its shard and its slot there."""
    return sharding.numbered_records(docs)


STAGES = [
    ("language_id", known_languages),
    ("minhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

# Language ID and the near-duplicate candidates are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written to the shared folder and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored_copy(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
