"""Substring dedup by super-k-mers: windows that share a minimiser travel together, and are sorted where they meet."""

from __future__ import annotations

import re
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import gram_hashes, partitions, rows, spans, stored, window_minima, word_hashes

#: Words of a window, and of the runs among which its minimiser is chosen.
WINDOW, GRAM = 50, 5
#: Bytes that a task packs together; super-k-mers for each bucket; windows that are sorted at once.
PACK, BUCKET, SORTED = 1 << 26, 1 << 17, 1 << 18
#: A minimiser is hot if its super-k-mers would be more than a quarter of a bucket (and more than a millionth of all).
HOT, HOT_MOST = BUCKET // 4, 1 << 20
#: Stands for a null id: larger than any other.
NO_ID = 2**63 - 1


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` (NO_ID for null), a hash of the text that tells rows with the same id apart, and the text's bytes."""
    text = F.col(f"`{text_col}`")
    return df.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        F.coalesce(text.cast("binary"), F.lit("").cast("binary")).alias("text"),
    )


def super_kmers(words: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each maximal run of windows with one minimiser position."""
    count = len(words) - window + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    grams = gram_hashes(word_hashes(words), gram)
    at = window_minima(grams, window - gram + 1)
    starts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    return starts, np.diff(np.append(starts, count)), grams[at[starts]]


def _count(total, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [super_kmers(text.split())[2] for (text,) in rows(iter([batch]), "text", step=64)]
        values, counts = np.unique(np.concatenate([*found, np.empty(0, np.uint64)]), return_counts=True)
        total.add(int(counts.sum()))
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["minimiser", "n"])


def hot_values(counted: DataFrame, value: str, total: Callable[[], int]) -> np.ndarray:
    """Values of more than HOT rows and more than a HOT_MOST-th of all, so that there are fewer than HOT_MOST of them.

    ``total`` is asked after the rows have been counted.
    """
    heavy = counted.groupBy(value).agg(F.sum("n").alias("n")).where(F.col("n") > HOT)
    heavy = stored(heavy, "heavy")
    hot = heavy.where(F.col("n") > total() // HOT_MOST).select(value).collect()
    return np.sort(np.array([r[0] for r in hot], np.int64)).view(np.uint64)


def isin(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    few = np.sort(few)
    if not len(few):
        return np.zeros(len(values), bool)
    return few[np.minimum(np.searchsorted(few, values), len(few) - 1)] == values


_HEAD = [("minimiser", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("start", "<u4"), ("windows", "<u4"), ("size", "<u4")]


def _packs(buckets: int, hot, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket one compressed pack of the super-k-mers that this task has for it, now and then."""
    heads: list[np.ndarray] = []
    texts: list[bytes] = []
    size = 0

    def flush() -> pa.RecordBatch:
        head = np.concatenate(heads)
        bucket = (head["minimiser"] % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        packer = zstandard.ZstdCompressor(level=1)
        names, packs = [], []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            some = order[a:b]
            packs.append(packer.compress(b"".join([np.uint32(b - a).tobytes(), head[some].tobytes(), *[texts[i] for i in some]])))
            names.append(bucket[some[0]])
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(packs, pa.binary())], ["bucket", "pack"])

    for doc, key, text in rows(batches, "doc_id", "text_key", "text", step=64):
        words = text.split()
        starts, counts, minimisers = super_kmers(words)
        keep = ~isin(minimisers, hot.value)
        starts, counts, minimisers = starts[keep], counts[keep], minimisers[keep]
        if not len(starts):
            continue
        own = [b" ".join(words[s : s + n + WINDOW - 1]) for s, n in zip(starts.tolist(), counts.tolist(), strict=True)]
        head = np.empty(len(starts), _HEAD)
        head["minimiser"], head["doc"], head["key"] = minimisers, doc, key
        head["start"], head["windows"], head["size"] = starts, counts, [len(t) for t in own]
        heads.append(head)
        texts += own
        size += int(head["size"].sum()) + head.nbytes
        if size > PACK:
            yield flush()
            heads, texts, size = [], [], 0
    if heads:
        yield flush()


_RANGES = "doc_id long, text_key long, begin int, end int"


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that repeat, as word ranges. The packs of a bucket come one after the other."""
    last, packs = None, []
    for bucket, pack in rows(batches, "bucket", "pack", step=16):
        if bucket != last and packs:
            yield _ranges(packs)
            packs = []
        last = bucket
        packs.append(pack)
    if packs:
        yield _ranges(packs)


def _ranges(packs: list[bytes]) -> pa.RecordBatch:
    heads, texts = [], []
    for pack in packs:
        data = zstandard.ZstdDecompressor().decompress(pack)
        count = int(np.frombuffer(data, "<u4", 1)[0])
        head = np.frombuffer(data, _HEAD, count, 4)
        heads.append(head)
        at = 4 + head.nbytes
        for size in head["size"].tolist():
            texts.append(data[at : at + size])
            at += size
    head = np.concatenate(heads)
    order = np.argsort(head["minimiser"], kind="stable")
    edges = np.flatnonzero(np.diff(head["minimiser"][order], prepend=~head["minimiser"][order[:1]], append=~head["minimiser"][order[-1:]]))
    docs = head["doc"][order]
    shared = np.minimum.reduceat(docs, edges[:-1]) < np.maximum.reduceat(docs, edges[:-1])
    out: list[tuple] = []
    for a, b in zip(edges[:-1][shared].tolist(), edges[1:][shared].tolist(), strict=True):
        some = order[a:b]
        for row, repeated in _group([texts[i] for i in some], head["doc"][some], int(head["windows"][some].sum())):
            one = head[some[row]]
            for begin, end in spans(repeated).tolist():
                start = int(one["start"]) + begin
                out.append((int(one["doc"]), int(one["key"]), start, start + end - begin + WINDOW - 1))
    columns = list(zip(*out, strict=True)) or [[], [], [], []]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "text_key", "begin", "end"]
    )


def _group(texts: list[bytes], docs: np.ndarray, windows: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of the super-k-mers of one minimiser, those with windows that an earlier document has, and which windows.

    Equal super-k-mers are looked at once. The windows of the others are sorted, so that equal ones are neighbours,
    the one of the smallest document first; if there are very many, in several rounds by a hash of the window.
    """
    rows_of: dict[bytes, list[int]] = defaultdict(list)
    for row, text in enumerate(texts):
        rows_of[text].append(row)
    kinds = list(rows_of)
    lowest = [int(docs[rows_of[t]].min()) for t in kinds]
    first = []
    for text in kinds:
        letters = np.frombuffer(text, np.uint8)
        first.append(np.zeros(int((letters == 32).sum()) + 2 - WINDOW, np.int64))
    rounds = -(-windows // SORTED)
    for turn in range(rounds):
        entries = []
        for kind, text in enumerate(kinds):
            gaps = np.flatnonzero(np.frombuffer(text, np.uint8) == 32).tolist()
            begins, ends = [0, *[g + 1 for g in gaps]], [*gaps, len(text)]
            cut = [text[a:b] for a, b in zip(begins, ends[WINDOW - 1 :], strict=False)]
            entries += [
                (w, lowest[kind], kind, j)
                for j, w in enumerate(cut)
                if rounds == 1 or xxhash.xxh32_intdigest(w) % rounds == turn
            ]
        entries.sort()
        window, low = None, 0
        for w, doc, kind, j in entries:
            if w != window:
                window, low = w, doc
            first[kind][j] = low
    for kind, text in enumerate(kinds):
        for row in rows_of[text]:
            repeated = first[kind] < docs[row]
            if repeated.any():
                yield row, repeated


def digest_halves(data: bytes) -> tuple[int, int]:
    return struct.unpack("<qq", xxhash.xxh3_128_digest(data))


def _hot_super_kmers(hot, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of hot minimisers, each with a digest of its words."""
    for batch in batches:
        out = []
        for doc, key, text in rows(iter([batch]), "doc_id", "text_key", "text", step=64):
            words = text.split()
            starts, counts, minimisers = super_kmers(words)
            for at in np.flatnonzero(isin(minimisers, hot.value)).tolist():
                start = int(starts[at])
                own = b" ".join(words[start : start + int(counts[at]) + WINDOW - 1])
                out.append((*digest_halves(own), doc, key, start, own))
        yield hot_batch(out)


def _single_windows(text: bytes) -> list[tuple[int, int]]:
    words = text.split()
    return [digest_halves(b" ".join(words[j : j + WINDOW])) for j in range(len(words) - WINDOW + 1)]


HOT_ROWS = "high long, low long, doc_id long, text_key long, start int, payload binary"


def hot_batch(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [[]] * 6
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["high", "low", "doc_id", "text_key", "start", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _expand(expand: Callable[[bytes], list[tuple[int, int]]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["window_high", "window_low", "high", "low", "place", "most", "least"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        out = [
            (*window, high, low, place, most, least)
            for high, low, most, least, payload in rows(iter([batch]), "high", "low", "most", "least", "payload", step=64)
            for place, window in enumerate(expand(payload))
        ]
        columns = list(zip(*out, strict=True)) or [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _runs(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, key, start, repeated in rows(iter([batch]), "doc_id", "text_key", "start", "repeated", step=64):
            flags = np.zeros(max(r["place"] for r in repeated) + 1, bool)
            flags[[r["place"] for r in repeated if r["first"] < doc]] = True
            out += [(doc, key, start + begin, start + end + window - 1) for begin, end in spans(flags).tolist()]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "text_key", "begin", "end"]
        )


def hot_ranges(found: DataFrame, expand: Callable[[bytes], list[tuple[int, int]]], window: int) -> DataFrame:
    """Word ranges that repeat, of rows of HOT_ROWS: runs of windows whose content a 128-bit digest names.

    Equal runs are looked at once, whatever the number of documents that have them; ``expand`` gives the digests of
    the windows of one. The first document of every window comes from an aggregate that combines before the shuffle,
    and goes back to the runs and then to the rows that have them. All sides are written before they are joined, so
    that a join can split what very many rows share.
    """
    found = stored(found, "hot")
    kinds = found.groupBy("high", "low").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.first("payload").alias("payload")
    )
    schema = "window_high long, window_low long, high long, low long, place int, most long, least long"
    each = stored(kinds.mapInArrow(partial(_expand, expand), schema), "hot-windows")
    names = ["window_high", "window_low"]
    first = stored(each.groupBy(*names).agg(F.min("least").alias("first")), "hot-first")
    repeated = (
        each.join(first, names)
        .where("first < most")
        .groupBy("high", "low")
        .agg(F.collect_list(F.struct("place", "first")).alias("repeated"))
    )
    back = found.drop("payload").join(stored(repeated, "hot-repeated"), ["high", "low"])
    return back.select("doc_id", "text_key", "start", "repeated").mapInArrow(partial(_runs, window), _RANGES)


_SPACE = re.compile(rb"[\x20\x09-\x0D]*")


def _kept(joined: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "removed", "kept"]
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    types = [pa.int64(), pa.int64(), kind, pa.binary()]
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            out = []
            for doc, text, ranges in rows(iter([batch.slice(start, 64)]), "doc_id", "text", "ranges"):
                words = text.split()
                merged = merge(len(words), ranges or [])
                if joined:
                    edges = [0, *[x for pair in merged for x in pair], len(words)]
                    kept = b" ".join([w for i in range(0, len(edges), 2) for w in words[edges[i] : edges[i + 1]]])
                else:
                    kept = cut_out(text, words, merged)
                removed = [{"begin": b, "end": e} for b, e in merged]
                out.append((None if doc == NO_ID else doc, len(words), removed, kept))
            columns = zip(zip(*out, strict=True), types, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names)


def merge(words: int, ranges: list[dict]) -> list[list[int]]:
    """Word ranges that may overlap, as ranges that don't."""
    flags = np.zeros(words + 1, np.int64)
    for r in ranges:
        flags[r["begin"]] += 1
        flags[r["end"]] -= 1
    return spans(np.cumsum(flags[:-1]) > 0).tolist()


def cut_out(text: bytes, words: list[bytes], ranges: list[list[int]]) -> bytes:
    """The text without the words of the ranges and the white space after each of them."""
    out, copied, word, at = [], 0, 0, 0
    for begin, end in ranges:
        for w in words[word:begin]:
            at = text.index(w, at) + len(w)
        first = _SPACE.match(text, at).end()
        for w in words[begin:end]:
            at = text.index(w, at) + len(w)
        out.append(text[copied:first])
        copied, word = _SPACE.match(text, at).end(), end
    return b"".join([*out, text[copied:]])


def without_ranges(docs: DataFrame, ranges: DataFrame, joined: bool) -> DataFrame:
    """``doc_id, n_words, removed`` and ``kept`` of the rows of ``keyed``, from rows of ``_RANGES``.

    ``kept``: the words that are left, joined by one space; or the text without the removed words, as it was.
    """
    by_row = ranges.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    return (
        docs.join(by_row, ["doc_id", "text_key"], "left")
        .select("doc_id", "text", "ranges")
        .mapInArrow(
            partial(_kept, joined), "doc_id long, n_words long, removed array<struct<begin:int,end:int>>, kept binary"
        )
        .withColumn("kept", F.col("kept").cast("string"))
    )


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document without the words of windows that a document with a smaller id has too.

    A window is WINDOW consecutive words of one document. Returns ``doc_id, n_words, removed`` (word ranges) and
    ``kept`` (the other words, joined by one space). Null and empty texts have no words, shorter texts no windows. Rows that repeat an id don't take words from each other; a null id counts as
    larger than any other. No rows give none; other columns are not looked at.

    Consecutive windows with one minimiser position are one string, which goes to the minimiser's bucket; there the
    windows of a minimiser that several documents have are sorted and compared as they are. The number of buckets goes
    with the data. Super-k-mers of hot minimisers, of which there are a bounded number, are met by digests
    instead (see ``hot_ranges``).
    """
    spark = df.sparkSession
    docs = keyed(df, id_col, text_col)
    # Tasks that are run again count twice; the sum only decides on the number of buckets and what is hot.
    total = spark.sparkContext.accumulator(0)
    counted = docs.select("text").mapInArrow(partial(_count, total), "minimiser long, n long")
    hot = hot_values(counted, "minimiser", lambda: total.value)
    shared = spark.sparkContext.broadcast(hot)
    buckets = max(4 * partitions(spark), total.value // BUCKET)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packs(buckets, shared, batches)

    ranges = (
        docs.mapInArrow(pack, "bucket int, pack binary")
        .repartition(max(partitions(spark), buckets // 16), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(_meet, _RANGES)
    )
    if len(hot):

        def hot_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _hot_super_kmers(shared, batches)

        ranges = ranges.union(hot_ranges(docs.mapInArrow(hot_ones, HOT_ROWS), _single_windows, WINDOW))
    return without_ranges(docs, ranges, joined=True)
