"""The corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup, mixing by weights, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.functions.lineage import scratch_path
from tidemill.llm import bpe, langid, mixing, simhash, suffixes


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the letters of learned languages, one or several, each with the language identified for it."""
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of close fingerprints."""
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; documents of which nothing is left go."""
    return suffixes.clean(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of rare sources up to twice, written in the order of blocks and places."""
    return mixing.in_order(mixing.mix_sources(docs, repeats=2.0))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    return bpe.encode(docs, ["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("source_mixing", mixed),
    ("byte_bpe", tokens),
]

#: Language models, fingerprints and tokenizers are not SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read by the next one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
