"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path

# A word is a run of bytes that are not ASCII white space: bytes.split() without arguments cuts at just these.
WORD = "[^\\x20\\x09-\\x0D]+"

# Characters for which the classes of ``re`` and ``regex`` agree: up to U+024F without the separators of ASCII, the
# next-line control and the numeric signs that are not digits.
_PLAIN_ONLY = re.compile("[^\t-\r -\x84\x86-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: lineage is cut, lost executors lose nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slim(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of the text alone: other columns, whatever their names, stay out of the work."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows(batches: Iterator[pa.RecordBatch], *names: str, step: int = 512) -> Iterator[tuple]:
    """Rows of the named columns; only a few become Python objects at a time."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for start in range(0, batch.num_rows, step):
            yield from zip(*[c.slice(start, step).to_pylist() for c in columns], strict=True)


def is_plain(text: str) -> bool:
    """Whether all characters are of those that libraries of regular expressions class alike."""
    return _PLAIN_ONLY.search(text) is None


def give_back() -> None:
    """Free memory goes back to the system, as a worker waits idle for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Splitter:
    """Cuts texts into the matches of a tokenizer's pattern.

    The pattern is run by ``regex``. Texts of plain characters only go through the same pattern written for ``re``,
    which is faster and has the same classes there; the tests compare both over all code points.
    """

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern)
        plain = pattern.replace("[^\\s\\p{L}\\p{N}]", "(?:[^\\s\\w]|_)")
        plain = plain.replace("\\p{L}", "[^\\W\\d_]").replace("\\p{N}", "\\d")
        self.plain = re.compile(plain) if "\\p" not in plain else None

    def lists(self, text: str, step: int = 1 << 18) -> Iterator[list[str]]:
        """The matches; those of a long text come in several lists, so that they are never all in memory."""
        pattern = self.plain if self.plain is not None and is_plain(text) else self.full
        if len(text) <= step:
            yield pattern.findall(text)
            return
        part: list[str] = []
        for m in pattern.finditer(text):
            part.append(m.group())
            if len(part) >= step:
                yield part
                part = []
        yield part

    def parts(self, text: str, step: int) -> Iterator[str]:
        """The text in parts of about ``step`` matches, each of which has the same matches by itself.

        A part ends with a match that is not white space: of spaces at its end the pattern would make one match.
        """
        part: list[str] = []
        for some in self.lists(text, step):
            for match in some:
                part.append(match)
                if len(part) >= step and not match.isspace():
                    yield "".join(part)
                    part = []
        if part:
            yield "".join(part)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit of the input moves every bit of the output."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Odd base of the hash of a run of words.
BASE = 0x2545F4914F6CDD1D


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out *= np.uint64(BASE)
            out += hashes[j : j + n]
    return mix(out)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value (the first of equal ones) in each run of ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at, size = np.arange(len(values)), 1
    while size < width:
        shift = min(size, width - size)
        left, right = at[: len(at) - shift], at[shift:]
        at = np.where(values[right] < values[left], right, left)
        size += shift
    return at[:n]


def spans(flags: np.ndarray) -> np.ndarray:
    """Start and end of each run of true flags, as rows of two numbers."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges.reshape(-1, 2)
