"""Token counts by way of a cache: digests of content and tokenizer name a stored count, only what misses is encoded."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.llm.common import Splitter, rows, stored

TOKENIZER = "byte_bpe_50k.json"
_CACHE = "content binary, tokenizer string, n_tokens long"
#: Characters (of one text or of several together) that are encoded in one call.
_CALL = 1 << 18


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the file and of the library's name and version: another version counts anew."""
    library = _library(path)
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + file.read()).hexdigest()


def _library(path: str):
    if path.endswith(".json"):
        import tokenizers as library
    elif path.endswith(".model"):
        import sentencepiece as library
    else:
        raise ValueError(f"no tokenizer library reads {path}")
    return library


@lru_cache(maxsize=2)
def _counter(path: str):
    """``count(texts) -> counts`` and a way to cut long texts without changing the counts (or None); one for a worker."""
    library = _library(path)
    if path.endswith(".model"):
        model = library.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)], None
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = library.Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()

    def count(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    first = spec.get("pre_tokenizer") or {}
    plain = ("id", "content", "special")
    simple = all(not v for t in spec.get("added_tokens") or [] for k, v in t.items() if k not in plain)
    if spec.get("normalizer") or first.get("type") != "ByteLevel" or not first.get("use_regex", True) or not simple:
        return count, None
    return count, ([t["content"] for t in spec["added_tokens"]], Splitter(public_tokenizers.PATTERN))


def _long(text: str, count, cut) -> int:
    """A long text in parts that end where the tokenizer itself cuts before its merges."""
    special, splitter = cut
    for token in special:
        if token in text:
            first, rest = text.split(token, 1)
            return _long(first, count, cut) + count([token])[0] + sum(
                _long(part, count, cut) + (i > 0) * count([token])[0] for i, part in enumerate(rest.split(token))
            )
    if len(text) <= _CALL:
        return count([text])[0]
    return sum(count([part])[0] for part in splitter.parts(text, _CALL // 8))


def _counts(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count, cut = _counter(path)
    for batch in batches:
        keys, counts, waiting, size = [], [], [], 0
        for key, text in rows(iter([batch]), "content", "text", step=64):
            keys.append(key)
            if cut is not None and len(text) > _CALL:
                counts.append(_long(text, count, cut))
                continue
            counts.append(None)
            waiting.append((len(counts) - 1, text))
            size += len(text)
            if size > _CALL:
                for (at, _), n in zip(waiting, count([t for _, t in waiting]), strict=True):
                    counts[at] = n
                waiting, size = [], 0
        for (at, _), n in zip(waiting, count([t for _, t in waiting]), strict=True):
            counts[at] = n
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], ["content", "n_tokens"])


def _cached(spark: SparkSession, cache: str, tokenizer: str) -> DataFrame | None:
    """The counts of this tokenizer version, or None before the first append."""
    try:
        table = spark.read.schema(_CACHE).parquet(cache)
        table.schema  # noqa: B018
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    # Two jobs that missed the same content at the same time have both appended it.
    found = table.where(F.col("tokenizer") == tokenizer)
    return found.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    cache: str | None = None,
    limit: int = 1024,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, as the library for the tokenizer file counts.

    No begin, end or added special tokens, truncation or padding; special strings inside a text are what the library
    makes of them. Normalised content is the whole text's UTF-8 with null taken as empty (anything more would change
    counts). ``cache`` is a folder that grows by the distinct content that missed; None takes a new one in the scratch
    folder. Empty and null texts have no tokens; repeated rows are encoded once and give repeated rows; no rows give
    none; other columns are not looked at. Texts of a quarter million characters and more are encoded in parts where
    the tokenizer allows it.

    Copies are merged within each task before the shuffle by digest, so a text held by a third of all rows travels
    once for each task.
    """
    spark = df.sparkSession
    path = path or public_tokenizers.path(TOKENIZER)
    cache = cache or scratch_path(spark, "token-counts")
    tokenizer = tokenizer_digest(path)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    content = F.unhex(F.sha2(text.cast("binary"), 256))
    known = _cached(spark, cache, tokenizer)
    texts = df.select(content.alias("content"), text.alias("text"))
    if known is not None:
        texts = texts.join(known.select("content"), "content", "left_anti")
    missing = texts.groupBy("content").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counts(path, batches)

    counted = missing.mapInArrow(run, "content binary, n_tokens long")
    counted.select("content", F.lit(tokenizer).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    counts = stored(_cached(spark, cache, tokenizer), "counts")
    keys = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        content.alias("content"),
        F.octet_length(text.cast("binary")).cast("long").alias("n_bytes"),
    )
    return stored(keys, "contents").join(counts, "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
