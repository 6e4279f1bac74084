"""Document fingerprints by locally consistent parsing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import mix, partitions, rows

#: Levels whose phrase names are kept, and how many names of each.
LEVELS = (2, 3)
KEPT = 32
#: Bytes of text that are parsed together.
BATCH = 1 << 20

_ONE = np.uint64(1)
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
#: Position of the lowest set bit of a byte.
_LOWEST = np.array([(x & -x).bit_length() - 1 if x else 0 for x in range(256)], np.uint8)


def _colours(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6, different for neighbours, that depend on few symbols to the left only.

    Deterministic coin tossing: a symbol's label becomes the lowest bit in which it differs from its left neighbour,
    with its position. Three more rounds bring 64 bits to less than 6 labels. The first symbol of a document tosses
    by its lowest bit.
    """
    before = np.concatenate((names[:1], names[:-1]))
    differ = names ^ before
    differ[first] = _ONE
    at = np.bitwise_count(~differ & (differ - _ONE)).astype(np.uint8)
    label = (at << np.uint8(1)) | ((names >> at.astype(np.uint64)) & _ONE).astype(np.uint8)
    for _ in range(3):
        before = np.concatenate((label[:1], label[:-1]))
        differ = label ^ before
        differ[first] = 1
        at = _LOWEST[differ]
        label = (at << np.uint8(1)) | ((label >> at) & np.uint8(1))
    return label


def _level(names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases that the symbols are cut into, and which of them begin a document."""
    with np.errstate(over="ignore"):
        # A run of one symbol is one symbol, so that neighbours differ.
        new = first.copy()
        new[1:] |= names[1:] != names[:-1]
        starts = np.flatnonzero(new)
        lengths = np.diff(np.append(starts, len(names))).astype(np.uint64)
        first, names = first[starts], names[starts]
        many = lengths > 1
        names[many] = mix(names[many] + lengths[many] * np.uint64(0x8CB92BA72F3D8DD7))
        label = _colours(names, first)
        # Phrases begin where the label is larger than both neighbours', and with the document.
        starts = first.copy()
        starts[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
        at = np.flatnonzero(starts)
        lengths = np.diff(np.append(at, len(names)))
        place = (np.arange(len(names)) - np.repeat(at, lengths)).astype(np.uint64)
        summed = np.add.reduceat(mix(names + place * np.uint64(0xE7037ED1A0B428DB)), at)
        phrase = mix(summed + lengths.astype(np.uint64))
        alone = lengths == 1
        phrase[alone] = names[at[alone]]
    return phrase, first[at]


def _smallest(names: np.ndarray, document: np.ndarray, count: int) -> list[np.ndarray]:
    """The KEPT smallest values of the phrases of each document, as 32-bit numbers.

    A phrase that occurs again has another value each time, so that likeness goes by how often phrases occur.
    """
    order = np.lexsort((names, document))
    names, document = names[order], document[order]
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (document[1:] != document[:-1])
    starts = np.flatnonzero(new)
    again = np.arange(len(names)) - starts[np.cumsum(new) - 1]
    with np.errstate(over="ignore"):
        values = mix(names + again.astype(np.uint64) * np.uint64(0x589965CC75374CC3)) >> np.uint64(32)
    packed = np.sort((document.astype(np.uint64) << np.uint64(32)) | values)
    edges = np.searchsorted(packed >> np.uint64(32), np.arange(count + 1).astype(np.uint64))
    return [packed[a : min(b, a + KEPT)].astype(np.uint32) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def fingerprints(texts: list[bytes]) -> list[str]:
    """Fingerprint of each text: the name of the whole, and the smallest names of its phrases at some levels.

    Bytes are symbols of level 0. At each level the sequence is cut where the colours of few neighbouring symbols say
    so, and each phrase gets a hash of its symbols as its name and becomes a symbol of the next level. So a substring
    that two texts share has the same phrases in both, but for a few at its ends, whatever its position. Levels go on
    until one symbol is left, whose name stands for the whole text; an empty text has 0. Memory goes with the bytes
    of the texts (or of the longest one).
    """
    count = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    document = np.repeat(np.arange(count), sizes)
    names = _LETTERS[np.frombuffer(b"".join(texts), np.uint8)]
    first = np.zeros(len(names), bool)
    first[np.cumsum(sizes)[sizes > 0] - sizes[sizes > 0]] = True
    sketches: list[list[np.ndarray]] = []
    level = 0
    while True:
        if level in LEVELS:
            sketches.append(_smallest(names, document, count))
        if level >= max(LEVELS) and first.all():
            break
        if len(names):
            here = document[np.flatnonzero(first)]
            names, first = _level(names, first)
            document = here[np.cumsum(first) - 1]
        level += 1
    roots = np.zeros(count, np.uint64)
    roots[document] = names
    return [
        ".".join([f"{int(roots[i]):016x}", *(s[i].astype(">u4").tobytes().hex() for s in sketches)]) for i in range(count)
    ]


def likeness(a: str, b: str) -> float:
    """Mean over the levels of the share of common phrases, estimated from the smallest names of the union; 0 to 1."""
    if a == b:
        return 1.0
    shares = []
    for x, y in zip(a.split(".")[1:], b.split(".")[1:], strict=True):
        mine = {x[i : i + 8] for i in range(0, len(x), 8)}
        theirs = {y[i : i + 8] for i in range(0, len(y), 8)}
        union = sorted(mine | theirs)[:KEPT]
        shares.append(sum(n in mine and n in theirs for n in union) / len(union) if union else 1.0)
    return sum(shares) / len(shares)


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by the beginning of another, as many code points or all there are."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_NAMES = [f.split()[0] for f in _SCHEMA.split(", ")]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range of ids in descending order; the last ones, marked, begin the next range."""
    waiting: list[tuple] = []
    size = 0
    for row in rows(batches, "guest", "doc_id", "text", step=64):
        waiting.append((row[0], row[1], row[2] or ""))
        size += len(waiting[-1][2])
        if size > BATCH and len(waiting) > 1:
            yield from _batch(waiting)
            waiting = waiting[-1:]
            size = len(waiting[0][2])
    yield from _batch(waiting)


def _batch(some: list[tuple]) -> Iterator[pa.RecordBatch]:
    pairs = [(a, b) for a, b in zip(some[:-1], some[1:], strict=True) if not a[0]]
    if not pairs:
        return
    changed = [edited(a[2], b[2]).encode() for a, b in pairs]
    own = fingerprints([a[2].encode() for a, _ in pairs] + [pairs[-1][1][2].encode()])
    theirs = fingerprints(changed)
    columns = [
        [a[1] for a, _ in pairs],
        [len(a[2]) for a, _ in pairs],
        [hashlib.sha256(c).hexdigest() for c in changed],
        own[:-1],
        theirs,
        [likeness(a, b) for a, b in zip(own[:-1], theirs, strict=True)],
        [likeness(a, b) for a, b in zip(own[:-1], own[1:], strict=True)],
    ]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], _NAMES)


def fingerprint_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they and the next document's are.

    The next document is the one with the next smaller id; after the last comes the first. Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. A null text is empty; two empty texts
    are alike. Of rows that repeat an id, the smaller text comes first; null ids come last. One row alone is its own
    next; no rows give none. Other columns are not looked at.

    The ids alone are dealt into ranges first; only the ends of each range reach the driver. Then the texts move once,
    and the first text of each range also goes to the one before it, so that each task has all the neighbours it needs.
    """
    spark = df.sparkSession
    ids = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"))
    ranges = (
        ids.where("doc_id IS NOT NULL")
        .repartitionByRange(partitions(spark), F.desc("doc_id"))
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.max("doc_id").alias("high"), F.min("doc_id").alias("low"))
        .collect()
    )
    if not ranges and not ids.take(1):
        return spark.createDataFrame([], _SCHEMA)
    ranges = sorted(((r.high, r.low) for r in ranges), reverse=True) or [(None, None)]
    count = len(ranges)
    shared = spark.sparkContext.broadcast(
        (np.array([-low for _, low in ranges if low is not None], np.int64), {high: i for i, (high, _) in enumerate(ranges)})
    )

    @F.pandas_udf("own int, before int")
    def place(ids: pd.Series) -> pd.DataFrame:
        lows, highs = shared.value
        known = ids.notna().to_numpy()
        values = ids.fillna(0).to_numpy(np.int64)
        own = np.where(known, np.searchsorted(lows, -values), count - 1)
        first = [highs.get(v if ok else None, -1) for v, ok in zip(values.tolist(), known, strict=True)]
        return pd.DataFrame({"own": own.astype(np.int32), "before": [(i - 1) % count if i >= 0 else -1 for i in first]})

    dealt = (
        df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
        .withColumn("at", place("doc_id"))
        .select(
            "doc_id",
            "text",
            F.inline(
                F.filter(
                    F.array(
                        F.struct(F.col("at.own").alias("range"), F.lit(False).alias("guest")),
                        F.struct(F.col("at.before").alias("range"), F.lit(True).alias("guest")),
                    ),
                    lambda x: x["range"] >= 0,
                )
            ),
        )
    )
    ordered = dealt.repartitionById(count, "range").sortWithinPartitions(
        "range", "guest", F.desc_nulls_last("doc_id"), F.asc("text")
    )
    return ordered.select("guest", "doc_id", "text").mapInArrow(_compared, _SCHEMA)
