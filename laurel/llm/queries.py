"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from laurel.llm import (
    bpe, conversations, decontamination, embeddings, language, minhash, mixing, sharding, spelling, substrings, tokens, toxicity, warc,
)
from laurel.llm.oracles import ORACLES
from laurel.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(substrings.substring_dedup(table(spark, sf_dir, "documents"), size=13))


@query
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


@query
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85, bands=21, rows=6)


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = mixing.mixed_copies(table(spark, sf_dir, "documents"))
    return copies.select("doc_id", "size", "source_size", "target", "copies", "taken")


@query
def op5_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark)
    tokens.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return tokens.id_checksums(tokens.read_tokens(spark, path))


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(warc.with_record_types(table(spark, sf_dir, "pages")), scratch_path(spark))
    return warc.page_records(warc.read_archives(archives, counted=True))


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.language_of_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.leaks(documents, benchmark)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sharding.shard_records(table(spark, sf_dir, "documents"), shards=40)
    return records.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(spelling.variant_words(table(spark, sf_dir, "documents")))


@query
def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(rows, conversations.damaged(rows))


@query
def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
