"""Benchmark decontamination: a prefix-filtered join of benchmark windows with all texts, verified word by word."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import gram_hashes, rows, spans, stored, word_hashes

#: Words of a window, and of the shingles a window is looked up by.
WINDOW, SHINGLE = 10, 3
#: Bytes of windows and item names that are sent to the executors at once; there are as many blocks as it takes.
BLOCK = 16 << 20
#: Bits of the table that most shingles of the texts are told from those looked for.
_FLAG_BITS = 20
# Letters in lower case, digits and all that is not ASCII stay; every other byte becomes a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text after A-Z are in lower case."""
    return text.translate(_FOLD).split() if text else []


def windows_of(words: list[bytes], window: int = WINDOW) -> Iterator[list[bytes]]:
    """Each run of ``window`` words; all of them if there are fewer, and nothing if there are none."""
    for start in range(max(1, len(words) - window + 1) if words else 0):
        yield words[start : start + window]


def needed(size: int, shingle: int, containment: float) -> tuple[int, int]:
    """Shingles of a window of ``size`` words that must be in place, and how many of its rarest ones cannot all be missing."""
    count = size - min(shingle, size) + 1
    least = max(1, math.ceil(containment * count - 1e-9))
    return least, count - least + 1


def _cut(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, found, size = [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(names, pa.string())], ["window", "item"])

    for item, text in rows(batches, "item", "text", step=64):
        for part in windows_of(words_of(text), window):
            found.append(b" ".join(part))
            names.append(item)
            size += len(found[-1])
            if size > 1 << 22:
                yield batch()
                names, found, size = [], [], 0
    yield batch()


def _shingles(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every shingle of every window, with its place there and its number of words."""
    for batch in batches:
        out: list[tuple] = []
        for (window,) in rows(iter([batch]), "window"):
            words = window.split()
            size = min(shingle, len(words))
            grams = gram_hashes(word_hashes(words), size).view(np.int64).tolist()
            out += [(window, len(words), size, at, g) for at, g in enumerate(grams)]
        types = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        columns = zip(*out, strict=True) if out else [[]] * 5
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["window", "words", "size", "at", "shingle"])


class Lookup:
    """Shingles by their number of words, found among those of a text without a search for most."""

    def __init__(self, sizes: np.ndarray, shingles: np.ndarray):
        self.sorted = {int(k): np.unique(shingles[sizes == k].view(np.uint64)) for k in np.unique(sizes)}

    def occurrences(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each size the places in a text, given the hashes of its words, and the shingles there."""
        for size, few in self.sorted.items():
            grams = gram_hashes(hashes, size)
            at = np.flatnonzero(self.flags(size)[grams >> np.uint64(64 - _FLAG_BITS)])
            where = np.searchsorted(few, grams[at])
            at = at[few[np.minimum(where, len(few) - 1)] == grams[at]]
            yield size, at, grams[at]

    def flags(self, size: int) -> np.ndarray:
        known = self.__dict__.setdefault("_flags", {})
        if size not in known:
            known[size] = np.zeros(1 << _FLAG_BITS, bool)
            known[size][self.sorted[size] >> np.uint64(64 - _FLAG_BITS)] = True
        return known[size]


def _count(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the shingles occur in the texts of a batch."""
    for batch in batches:
        found: dict[int, list[np.ndarray]] = {}
        for (text,) in rows(iter([batch]), "text", step=64):
            for size, _, grams in shared.value.occurrences(word_hashes(words_of(text))):
                if len(grams):
                    found.setdefault(size, []).append(grams)
        for size, parts in found.items():
            values, counts = np.unique(np.concatenate(parts), return_counts=True)
            sizes = np.full(len(values), size, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes), pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["size", "shingle", "n"]
            )


class Index(Lookup):
    """The windows of a block by the prefix shingles that one of them must have in a text."""

    def __init__(self, entries: list, items: list, shingle: int, containment: float):
        names = sorted({e.window for e in entries})
        place = {w: i for i, w in enumerate(names)}
        super().__init__(np.array([e.size for e in entries], np.int32), np.array([e.shingle for e in entries], np.int64))
        self.entries = [(e.size, e.shingle & (2**64 - 1), e["at"], place[e.window]) for e in entries]
        self.windows, self.shingle, self.containment = names, shingle, containment
        self.items: list[list[str]] = [[] for _ in names]
        for row in items:
            if row.window in place:
                self.items[place[row.window]].append(row.item)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        words: dict[bytes, bytes] = {}
        self._words = [[words.setdefault(w, w) for w in window.split()] for window in self.windows]
        self._least = [needed(len(w), self.shingle, self.containment)[0] for w in self._words]
        self._by: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for size, shingle, at, window in self.entries:
            self._by.setdefault((size, shingle), []).append((at, window))

    def agrees(self, words: list[bytes], start: int, window: int) -> bool:
        """Whether enough of the window's shingles are in place in as many words of the text from ``start`` on."""
        want = self._words[window]
        have = words[start : start + len(want)]
        if have == want:
            return True
        if self.containment >= 1:
            return False
        size = min(self.shingle, len(want))
        return sum(have[i : i + size] == want[i : i + size] for i in range(len(want) - size + 1)) >= self._least[window]

    def find(self, words: list[bytes]) -> tuple[np.ndarray, list[str]]:
        """Spans of the words that are in some window, and the items of all windows that occur."""
        inside, found = np.zeros(len(words), bool), set()
        for size, at, grams in self.occurrences(word_hashes(words)):
            for place, gram in zip(at.tolist(), grams.tolist(), strict=True):
                for offset, window in self._by[size, gram]:
                    start, length = place - offset, len(self._words[window])
                    # The shingle's place in the window says where the window begins; it must be whole in the text.
                    if start >= 0 and start + length <= len(words) and self.agrees(words, start, window):
                        inside[start : start + length] = True
                        found.add(window)
        return spans(inside), sorted({i for w in found for i in self.items[w]}, key=str.encode)


_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def _find(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = shared.value
    for batch in batches:
        counts, hits, items = [], [], []
        for (text,) in rows(iter([batch]), "text", step=64):
            words = words_of(text)
            inside, found = index.find(words)
            counts.append(len(words))
            hits.append([{"begin": a, "end": b} for a, b in inside.tolist()])
            items.append(found)
        columns = [pa.array(counts, pa.int64()), pa.array(hits, _SPANS), pa.array(items, pa.list_(pa.string()))]
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept, *columns], ["doc_id", "text_key", "n_words", "hits", "items"])


def _prefixes(docs: DataFrame, windows: DataFrame, shingle: int, containment: float) -> DataFrame:
    """Of each window the shingles that are rarest in all texts, as many as cannot all be missing; none that never occurs.

    A window whose rarest shingle is nowhere is nowhere itself (at containment 1).
    """
    spark = docs.sparkSession
    parts = windows.mapInArrow(
        lambda batches: _shingles(shingle, batches), "window binary, words int, size int, at int, shingle long"
    )
    parts = stored(parts, "window-shingles")
    wanted = parts.select("size", "shingle").distinct().toArrow()
    lookup = spark.sparkContext.broadcast(Lookup(wanted.column(0).to_numpy(), wanted.column(1).to_numpy()))
    counted = docs.select("text").mapInArrow(lambda batches: _count(lookup, batches), "size int, shingle long, n long")
    counts = stored(counted.groupBy("size", "shingle").agg(F.sum("n").alias("n")), "shingle-counts")
    rarest = Window.partitionBy("window").orderBy("n", "shingle", "at")
    ranked = (
        parts.join(counts, ["size", "shingle"], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("rank", F.row_number().over(rarest))
    )
    count = F.col("words") - F.col("size") + 1
    least = F.greatest(F.lit(1), F.ceil(F.lit(containment) * count - 1e-9))
    return ranked.where((F.col("rank") <= count - least + 1) & (F.col("n") > 0)).select("window", "size", "at", "shingle")


def contaminated_words(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    containment: float = 1.0,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, n_words, hits, items`` of every document: word spans inside an occurring window, and whose windows occur.

    A window is ``window`` consecutive words of an item, or all words of an item that has fewer. It occurs where as
    many words of a text have at least ``containment`` of its shingles of ``shingle`` words in the same places; at 1
    these words are those of the window. The shingles of all windows are counted in all texts; each window is looked
    up by its rarest ones only, as many as cannot all be missing. The place of a shingle says where its window begins;
    it must be whole in the text, and is compared word by word.

    Null, empty and wordless texts have no words and no hits; an item without words has no window; an item without an
    id marks words under the name ''. Rows of one item are one item; repeated documents give repeated rows; no
    benchmark gives documents without hits, no documents give no rows. Other columns, whatever their names, are not
    looked at. A very long text is one list of words in its task.

    Texts are not shuffled: the windows of a block (``block`` bytes, in as many blocks as it takes) are sent to them, and
    documents with hits in one of several blocks are put together by id and a hash of the text.
    """
    spark = documents.sparkSession
    text = F.col(f"`{text_col}`")
    docs = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("text")
    )
    source = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"),
        F.col(f"`{item_text_col}`").cast("binary").alias("text"),
    )
    pairs = stored(source.mapInArrow(lambda b: _cut(window, b), "window binary, item string").distinct(), "windows")
    size = pairs.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / block))
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    schema = "doc_id long, text_key long, n_words long, hits array<struct<begin: int, end: int>>, items array<string>"
    found = []
    for number in range(blocks):
        some = pairs.where(F.col("block") == number)
        entries = _prefixes(docs, some.select("window").distinct(), shingle, containment).collect()
        index = Index(entries, some.select("window", "item").collect(), shingle, containment)
        shared = spark.sparkContext.broadcast(index)
        found.append(docs.mapInArrow(lambda b, shared=shared: _find(shared, b), schema))
    if blocks == 1:
        return found[0].drop("text_key")
    found = [stored(f, "block-hits") for f in found]
    return _together(found)


def _together(blocks: list[DataFrame]) -> DataFrame:
    """One row for each document from one for each document and block."""
    keys = ["doc_id", "text_key"]
    hit = blocks[0]
    for other in blocks[1:]:
        hit = hit.unionAll(other)
    hit = hit.where(F.size("items") + F.size("hits") > 0)
    items = hit.select(*keys, F.explode("items").alias("item")).distinct()
    items = items.groupBy(*keys).agg(F.sort_array(F.collect_list("item")).alias("items"))
    hits = hit.select(*keys, F.explode("hits").alias("hit")).distinct()
    hits = hits.groupBy(*keys).agg(F.sort_array(F.collect_list("hit")).alias("hits"))
    merged = F.expr(
        "aggregate(hits, cast(array() as array<struct<begin: int, end: int>>), (a, h) -> if(size(a) > 0 and "
        "element_at(a, -1).end >= h.begin, concat(slice(a, 1, size(a) - 1), array(struct(element_at(a, -1).begin as begin, "
        "greatest(element_at(a, -1).end, h.end) as end))), concat(a, array(h))))"
    )
    hits = hits.select(*keys, merged.alias("hits"))
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"x.{k}")) for k in keys]
    out = blocks[0].select(*keys, "n_words").alias("d").join(hits.alias("x"), same, "left").select("d.*", "hits")
    out = out.alias("d").join(items.alias("x"), same, "left").select("d.*", "items")
    none = F.array().cast("array<struct<begin: int, end: int>>")
    return out.select(
        "doc_id", "n_words", F.coalesce("hits", none).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def report(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document (see ``contaminated_words``)."""
    found = contaminated_words(documents, benchmark, **options)
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["begin"])
    names = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        names.alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def oracle_sql() -> str:
    """DuckDB SQL for ``report`` over ``documents`` and ``benchmark``."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    folded = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = f"regexp_extract_all({folded.format('text')}, '{word}')"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {split} AS w FROM documents),
b AS MATERIALIZED (SELECT coalesce(item_id::VARCHAR, '') AS item, {split} AS w FROM benchmark),
want AS MATERIALIZED (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS size, array_to_string(w[s : s + least(len(w), {WINDOW}) - 1], ' ') AS t
  FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - {WINDOW - 1}))) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM want),
have AS (
  SELECT r, size, s, array_to_string(w[s : s + size - 1], ' ') AS t
  FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS s FROM d, sizes WHERE len(w) >= size)),
hit AS MATERIALIZED (SELECT r, h.size, s, item FROM have h JOIN want USING (size, t)),
words AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, unnest(generate_series(s, s + size - 1)) FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""
