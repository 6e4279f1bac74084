"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (
    alignment,
    bpe,
    decontam,
    divergence,
    langid,
    mixing,
    parsing,
    sharding,
    simhash,
    suffixes,
    tokencount,
    topk,
    windows,
)

SHARDS = 24

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def _query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


@_query("op1_slot_sharding")
def slot_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, folder), SHARDS)


@_query("op2_simhash")
def simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, folder))


@_query("op3_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(_documents(spark, folder), ["doc_id"])


@_query("op4_parsed_fingerprints")
def parsed_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return parsing.fingerprint_documents(_documents(spark, folder))


@_query("op5_temperature_mixing")
def temperature_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(_documents(spark, folder), repeats=2.0)
    return mixed.select("row.doc_id", "row.source", "n_tokens", "epoch", "block", "place")


@_query("op6_exact_top_k")
def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))


ORACLES["op6_exact_top_k"] = topk.oracle_sql()


@_query("op7_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(suffixes.remove_repeated_passages(_documents(spark, folder)))


@_query("op8_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.predict(_documents(spark, folder))


@_query("op9_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.count_tokens(_documents(spark, folder))


@_query("op10_super_kmer_dedup")
def super_kmer_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(windows.remove_repeats(_documents(spark, folder))).drop("removed")


@_query("op11_decontamination")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet")
    return decontam.report(_documents(spark, folder), benchmark)


ORACLES["op11_decontamination"] = decontam.oracle_sql()


@_query("op12_source_divergence")
def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_documents(spark, folder))


ORACLES["op12_source_divergence"] = divergence.oracle_sql()


@_query("op13_token_alignment")
def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokenizers(_documents(spark, folder))


def _digests(kept: DataFrame) -> DataFrame:
    """What is left, as digests; ``removed`` stays as the word ranges."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    digest = F.sha2(F.col("kept").cast("binary"), 256)
    return kept.select("doc_id", "n_words", gone.alias("n_removed"), digest.alias("kept_sha256"), "removed")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
