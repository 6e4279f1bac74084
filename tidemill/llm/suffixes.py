"""Suffix dedup by a sparse suffix array: only suffixes at content-selected positions are kept, sorted and extended."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import give_back, gram_hashes, partitions, rows, spans, stored, window_minima, word_hashes
from tidemill.llm.windows import (
    HOT_ROWS,
    NO_ID,
    cut_out,
    digest_halves,
    hot_batch,
    hot_ranges,
    hot_values,
    isin,
    keyed,
    merge,
    without_ranges,
)

#: Words a passage must have, words that neighbouring suffixes must share, words of the runs among which minimisers are.
PASSAGE, SHARED, GRAM = 50, 25, 5
#: Windows that are sorted together.
SORTED = 1 << 20


class Suffixes:
    """The kept suffixes of one document.

    Every passage of PASSAGE words has the minimiser of its first half as its position: the same one wherever it
    occurs, with SHARED words of the passage after it. ``at`` are these positions, ``name`` the hash of the SHARED
    words that the suffix begins with, ``first`` and ``count`` the passages (by their first word) that it stands for.
    """

    def __init__(self, text: bytes):
        hashes = word_hashes(text.split())
        passages = len(hashes) - PASSAGE + 1
        self.passages = gram_hashes(hashes, PASSAGE)
        if passages <= 0:
            self.at = self.first = self.count = np.empty(0, np.int64)
            self.name = np.empty(0, np.uint64)
            return
        at = window_minima(gram_hashes(hashes, GRAM), PASSAGE - SHARED + 1)[:passages]
        self.first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        self.count = np.diff(np.append(self.first, passages))
        self.at = at[self.first]
        self.name = gram_hashes(hashes, SHARED)[self.at]


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, keys, names, at = [], [], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for doc, key, text in rows(iter([batch]), "doc_id", "text_key", "text", step=64):
            own = Suffixes(text)
            names.append(own.name)
            at.append(own.at)
            docs += [doc] * len(own.at)
            keys += [key] * len(own.at)
        arrays = [pa.array(np.concatenate(names).view(np.int64)), pa.array(docs, pa.int64()), pa.array(keys, pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(np.concatenate(at).astype(np.int32))], ["suffix", "doc_id", "text_key", "at"]
        )


_EXTENDED = "suffix long, doc_id long, text_key long, first int, offset int, extended binary"


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each wanted suffix one signature of every passage it stands for: the match extended left and right to it."""
    for batch in batches:
        out = []
        for doc, key, text, wanted in rows(iter([batch]), "doc_id", "text_key", "text", "wanted", step=64):
            own = Suffixes(text)
            for i in np.flatnonzero(np.isin(own.at, wanted)).tolist():
                first, count = int(own.first[i]), int(own.count[i])
                signatures = own.passages[first : first + count].tobytes()
                out.append((int(own.name[i].view(np.int64)), doc, key, first, int(own.at[i]) - first, signatures))
        columns = list(zip(*out, strict=True)) or [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            ["suffix", "doc_id", "text_key", "first", "offset", "extended"],
        )


_RANGES = "doc_id long, text_key long, begin int, end int"


def _whole_runs(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], int]) -> Iterator[pa.Table]:
    """Rows that come sorted by their first column, some together, but never a part of the rows of one value."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if held > SORTED:
            # What belongs to the last value so far may go on in this batch.
            last = waiting[-1].column(0)[-1].as_py()
            end = int(np.searchsorted(batch.column(0).to_numpy(), last, "right"))
            waiting.append(batch.slice(0, end))
            batch = batch.slice(end)
            if not batch.num_rows:
                continue
            yield pa.Table.from_batches(waiting)
            waiting, held = [], 0
        waiting.append(batch)
        held += size(batch)
    if waiting:
        yield pa.Table.from_batches(waiting)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffixes, sorted by name and document, that have a neighbour of another document with the same name."""
    for table in _whole_runs(batches, lambda b: b.num_rows):
        suffix, doc = (table.column(n).to_numpy() for n in ("suffix", "doc_id"))
        starts = np.flatnonzero(np.concatenate(([True], suffix[1:] != suffix[:-1])))
        ends = np.append(starts[1:], len(suffix))
        matched = np.repeat(doc[starts] != doc[ends - 1], ends - starts)
        yield from table.filter(pa.array(matched)).select(["doc_id", "text_key", "at"]).to_batches()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Extended matches, sorted by suffix, compared for whole suffixes."""
    for table in _whole_runs(batches, lambda b: int(b.column(5).nbytes) // 8):
        yield _repeated(table)


def _repeated(table: pa.Table) -> pa.RecordBatch:
    suffix, doc, key, first, offset = (table.column(i).to_numpy() for i in range(5))
    signatures = [np.frombuffer(x, np.uint64) for x in table.column(5).to_pylist()]
    counts = np.array([len(s) for s in signatures])
    row = np.repeat(np.arange(len(counts)), counts)
    starts = np.cumsum(counts) - counts
    place = np.arange(len(row)) - starts[row]
    signature = np.concatenate(signatures)
    ahead = offset[row] - place  # words from the passage's beginning to the suffix
    order = np.lexsort((doc[row], signature, ahead, suffix[row]))
    sorted_ = [x[order] for x in (suffix[row], ahead, signature)]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_])
    lowest = doc[row][order][np.flatnonzero(new)][np.cumsum(new) - 1]
    repeated = np.zeros(len(order), bool)
    repeated[order] = doc[row][order] > lowest
    # Runs of repeated passages; one flag more keeps the runs of two rows apart.
    flags = np.zeros(len(order) + len(counts), bool)
    flags[np.arange(len(row)) + row] = repeated
    runs = spans(flags)
    of = row[runs[:, 0] - np.searchsorted(starts + np.arange(len(counts)), runs[:, 0], "right") + 1] if len(runs) else np.empty(0, int)
    begin = first[of] + runs[:, 0] - (starts[of] + of)
    end = begin + runs[:, 1] - runs[:, 0] + PASSAGE - 1
    arrays = [doc[of], key[of], begin.astype(np.int32), end.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["doc_id", "text_key", "begin", "end"])


def _hot_suffixes(hot, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hot suffixes with the signatures of their passages, as rows of HOT_ROWS."""
    for batch in batches:
        out = []
        for doc, key, text in rows(iter([batch]), "doc_id", "text_key", "text", step=64):
            own = Suffixes(text)
            for i in np.flatnonzero(isin(own.name, hot.value)).tolist():
                first, count = int(own.first[i]), int(own.count[i])
                head = struct.pack("<Qi", int(own.name[i]), int(own.at[i]) - first)
                payload = head + own.passages[first : first + count].tobytes()
                out.append((*digest_halves(payload), doc, key, first, payload))
        yield hot_batch(out)


def _single_passages(payload: bytes) -> list[tuple[int, int]]:
    """Suffix, words ahead of it and signature name a passage."""
    name, offset = struct.unpack_from("<Qi", payload)
    signatures = np.frombuffer(payload, "<u8", offset=12).tolist()
    return [digest_halves(struct.pack("<QiQ", name, offset - j, s)) for j, s in enumerate(signatures)]


def repeated_passages(docs: DataFrame, dealt: DataFrame) -> DataFrame:
    """Word ranges in which every passage is also in a document with a smaller id.

    ``docs`` are rows of ``keyed``, and ``dealt`` the same ones (with other columns perhaps) dealt out by their keys:
    what the caller joins the ranges with, so that the texts are shuffled once.
    """
    spark = docs.sparkSession
    names = stored(docs.mapInArrow(_names, "suffix long, doc_id long, text_key long, at int"), "suffixes")
    hot = hot_values(names.select("suffix", F.lit(1).cast("long").alias("n")), "suffix", names.count)
    shared = spark.sparkContext.broadcast(hot)
    if len(hot):
        few = spark.createDataFrame([(x,) for x in hot.view(np.int64).tolist()], "suffix long")
        names = names.join(F.broadcast(few), "suffix", "left_anti")
    wanted = (
        names.repartition(partitions(spark), "suffix")
        .sortWithinPartitions("suffix", "doc_id")
        .mapInArrow(_neighbours, "doc_id long, text_key long, at int")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("at").alias("wanted"))
    )
    ranges = (
        dealt.join(wanted, ["doc_id", "text_key"])
        .mapInArrow(_extend, _EXTENDED)
        .repartition(partitions(spark), "suffix")
        .sortWithinPartitions("suffix")
        .mapInArrow(_compare, _RANGES)
    )
    if len(hot):

        def hot_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _hot_suffixes(shared, batches)

        ranges = ranges.union(hot_ranges(docs.mapInArrow(hot_ones, HOT_ROWS), _single_passages, PASSAGE))
    return ranges


def remove_repeated_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the passages of PASSAGE words and more that a document with a smaller id has too.

    Returns ``doc_id, n_words, removed`` (word ranges) and ``kept`` (the text without them, otherwise as it was). Words
    are compared, not the white space between them. Null and empty texts stay empty, shorter texts as they are. Rows
    that repeat an id don't take passages from each other; a null id counts as larger than any other. No rows give
    none; other columns are not looked at.

    A suffix is kept where the hash of a few words is the smallest for half a passage around, so about one word in
    thirteen, and chosen by content alone. Suffixes are ordered by the hash of their first SHARED words; where
    neighbours of different documents agree, the match is extended to both sides: a passage of PASSAGE words is a
    repeat if the words to the left of the suffix and those to the right agree as well (64-bit hashes of the passage,
    within one suffix and one offset). Only matched suffixes go on. Suffixes that very many rows share, of which there are
    a bounded number, are met by digests of their passages instead (see ``windows.hot_ranges``).
    """
    docs = keyed(df, id_col, text_col)
    dealt = docs.repartition(partitions(df.sparkSession), "doc_id", "text_key")
    return without_ranges(dealt, repeated_passages(docs, dealt), joined=False)


def clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The columns of ``df`` with repeated passages cut out of the text; documents of which nothing is left go.

    ``size_col``, if there is one of that name, becomes the new number of characters of a changed text. Rows without a
    repeat stay as they are, also empty ones.
    """
    docs = keyed(df, id_col, text_col)
    text = F.col(f"`{text_col}`")
    rest = F.struct(F.lit(True), text.isNull().alias("no_text"), *[F.col(f"`{c}`").alias(f"_{c}") for c in df.columns if c != text_col])
    dealt = df.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.coalesce(text.cast("binary"), F.lit("").cast("binary")).alias("text"),
        rest.alias("rest"),
    ).repartition(partitions(df.sparkSession), "doc_id", "text_key")
    by_row = repeated_passages(docs, dealt).groupBy("doc_id", "text_key")
    joined = dealt.join(by_row.agg(F.collect_list(F.struct("begin", "end")).alias("ranges")), ["doc_id", "text_key"], "left")
    names = [f.name for f in df.schema.fields if f.name != text_col]
    run = partial(_cleaned, df.columns.index(text_col), names.index(size_col) if size_col in names else None)
    return joined.select("text", "rest", "ranges").mapInArrow(run, df.schema)


def _cleaned(place: int, size_at: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``clean``, a few at a time: the text goes to its ``place``, the other columns stay as they are."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            texts, ranges = (part.column(i).to_pylist() for i in (0, 2))
            _, empty, *others = part.column(1).flatten()
            changed = [r is not None for r in ranges]
            for i in np.flatnonzero(changed).tolist():
                words = texts[i].split()
                texts[i] = cut_out(texts[i], words, merge(len(words), ranges[i]))
            kept = pa.array([not c or bool(t.split()) for c, t in zip(changed, texts, strict=True)], pa.bool_())
            text = pa.array([None if e else t for e, t in zip(empty.to_pylist(), texts, strict=True)], pa.binary()).cast(pa.string())
            if size_at is not None and any(changed):
                sizes = pc.utf8_length(text).cast(others[size_at].type)
                others[size_at] = pc.if_else(pa.array(changed), sizes, others[size_at])
            columns = [*others[:place], text, *others[place:]]
            yield pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))]).filter(kept)
    give_back()
