"""Source divergence audit: sparse term vectors per language, summed by source, and compared source by source."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.accumulators import AccumulatorParam
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.llm.common import mix, partitions, rows, stored

#: Documents of a language that must have a term; ranks that are reported of the terms of a group.
MIN_DOCUMENTS, RANKS = 3, 200
#: Distinct terms of one vocabulary, of which there are as many as a language needs: one is held by the driver at a time.
TERMS = 1 << 21
#: Hashes from which the number of different terms is estimated, to 3 %.
SKETCH = 1024
#: Sources of a language whose pairs a task adds up in one array; pairs of more are sorted and merged.
DENSE = 1024
#: Pairs of sources that are laid out at once; sums that a task holds before it hands them on.
_LAID, _HELD = 1 << 19, 1 << 21
UNIT = 1_000_000_000
#: Is in no text: a vocabulary always has it, so that it is never empty.
_BLANK = " "
# Letters in lower case and all that is not ASCII stay; every other byte becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The matches of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z in lower case."""
    return text.translate(_FOLD).split() if text else []


class Smallest(AccumulatorParam):
    """For each language the SKETCH smallest hashes of its terms, which tell how many different ones there are.

    Adding the same ones again changes nothing, so a task may run twice.
    """

    def zero(self, value: dict) -> dict:
        return {}

    def addInPlace(self, value1: dict, value2: dict) -> dict:  # noqa: N802
        for lang, hashes in value2.items():
            value1[lang] = np.unique(np.concatenate([value1.get(lang, hashes[:0]), hashes]))[:SKETCH]
        return value1


def different(hashes: np.ndarray) -> int:
    """About how many different values there are, by the smallest hashes of them."""
    return len(hashes) if len(hashes) < SKETCH else int((SKETCH - 1) * 2.0**64 / float(hashes[-1]))


def _sketched(sketch, seen: dict[int, set[bytes]]) -> None:
    for lang, terms in seen.items():
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))
        sketch.add({lang: np.unique(hashes)[:SKETCH]})
    seen.clear()


def _folded(sketch, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a term: what comes with the text, and its terms joined by spaces."""
    seen: dict[int, set[bytes]] = {}
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            texts = []
            for lang, text in rows(iter([part]), "lang", "text", step=64):
                terms = terms_of(text)
                texts.append(b" ".join(terms))
                if lang not in seen:
                    seen[lang] = set()
                seen[lang].update(terms)
                if len(seen[lang]) > 1 << 17:
                    _sketched(sketch, seen)
            kept = [part.column(i) for i in range(part.num_columns - 1)]
            found = pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.binary()).cast(pa.string())], ["lang", "number", "terms"])
            yield found.filter(pa.array([bool(t) for t in texts], pa.bool_()))
    _sketched(sketch, seen)


def probability(count: Column, total: Column, size: Column) -> Column:
    """``1 + floor(10^9 (count + 1) / (total + size))``, exact; null if there are no terms."""
    below = F.when(size > 0, total + size)
    whole = F.call_function("div", F.lit(UNIT) * (count + 1), below)
    # Counts whose product is no long any more.
    large = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.when(count < 9 * UNIT, whole).otherwise(F.call_function("div", large, below.cast("decimal(20,0)"))) + 1


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _vocabulary(docs: DataFrame, shard: int, shards: int, min_documents: int) -> DataFrame:
    """``index, term``: the terms of one shard that a CountVectorizer keeps of the documents of a language."""
    spark, words = docs.sparkSession, F.split("terms", " ", -1)
    own = words if shards == 1 else F.filter(words, lambda w: F.pmod(F.xxhash64(w), F.lit(shards)) == shard)
    blank = spark.range(min_documents).select(F.array(F.lit(_BLANK)).alias("words"))
    counter = CountVectorizer(inputCol="words", outputCol="vector", minDF=float(min_documents), vocabSize=2**31 - 1)
    path = scratch_path(spark, "vocabulary")
    counter.fit(docs.select(own.alias("words")).unionAll(blank)).write().save(path)
    terms = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("index", "term"))
    return terms.where(F.col("term") != _BLANK)


class Indices(dict):
    """Index of each term of a vocabulary; -1 of any other."""

    def __missing__(self, term: bytes) -> int:
        return -1


def vectors_of(texts: list[bytes], vocabulary: Indices) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sparse vectors of documents, laid end to end: number of the document, index, and count."""
    words = [text.split(b" ") for text in texts]
    sizes = np.array([len(w) for w in words])
    index = np.fromiter(map(vocabulary.__getitem__, chain.from_iterable(words)), np.int64, sizes.sum())
    entry = np.repeat(np.arange(len(texts)), sizes) << 32 | index
    entry = np.sort(entry[index >= 0])
    edges = np.flatnonzero(np.diff(entry, prepend=-1))
    return entry[edges] >> 32, entry[edges] & 0xFFFFFFFF, np.diff(np.append(edges, len(entry)))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their counts."""
    key, count = np.concatenate([*keys, np.empty(0, np.int64)]), np.concatenate([*counts, np.empty(0, np.int64)])
    order = np.argsort(key)
    key, count = key[order], count[order]
    edges = np.flatnonzero(np.diff(key, prepend=-1))
    return key[edges], np.add.reduceat(count, edges) if len(edges) else count


def _summed(parts: int, vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each source, so far as a task has room for them: one pack for each bucket of terms."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []

    def out() -> Iterator[pa.RecordBatch]:
        key, count = _merged(keys, counts)
        bucket = (mix((key >> 32).view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
        packs = [order[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        columns = [pa.array([x[some].tobytes() for some in packs], pa.binary()) for x in (key, count)]
        yield pa.RecordBatch.from_arrays([pa.array(bucket[[some[0] for some in packs]]), *columns], ["bucket", "keys", "counts"])

    for batch in batches:
        numbers = batch.column(0).to_numpy().astype(np.int64)
        for start in range(0, batch.num_rows, 256):
            texts = batch.column(1).slice(start, 256).cast(pa.binary()).to_pylist()
            doc, index, count = vectors_of(texts, vocabulary.value)
            keys.append(index << 32 | numbers[start + doc])
            counts.append(count)
            if sum(map(len, keys)) > _HELD:
                keys[:], counts[:] = ([x] for x in _merged(keys, counts))
                if len(keys[0]) > _HELD // 2:
                    yield from out()
                    keys.clear()
                    counts.clear()
    if sum(map(len, keys)):
        yield from out()


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each term of a bucket: the sources that have it, ascending, and how often."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for key, count in rows(batches, "keys", "counts", step=16):
        keys.append(np.frombuffer(key, np.int64))
        counts.append(np.frombuffer(count, np.int64))
        if sum(map(len, keys[1:])) > max(_HELD, len(keys[0])):
            keys, counts = ([x] for x in _merged(keys, counts))
    if not keys:
        return
    key, count = _merged(keys, counts)
    index, number = key >> 32, (key & 0xFFFFFFFF).astype(np.int32)
    starts = np.flatnonzero(np.diff(index, prepend=-1))
    edges = np.append(starts, len(key))
    for a in range(0, len(starts), 1 << 13):
        cut = edges[a : a + (1 << 13) + 1]
        some = slice(cut[0], cut[-1])
        lists = [pa.ListArray.from_arrays(pa.array(cut - cut[0], pa.int32()), pa.array(x[some])) for x in (number, count)]
        yield pa.RecordBatch.from_arrays([pa.array(index[cut[:-1]].astype(np.int32)), *lists], ["index", "numbers", "counts"])


def _flat(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    """Columns of the rows of terms, and their lists laid end to end."""
    found = {c: batch.column(batch.schema.get_field_index(c)) for c in ("lang", "shard", "index", "numbers", "counts")}
    out = {c: found[c].to_numpy().astype(np.int64) for c in ("lang", "shard", "index")}
    out["many"] = np.diff(found["numbers"].offsets.to_numpy())
    return out | {c: found[c].flatten().to_numpy().astype(np.int64) for c in ("numbers", "counts")}


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences in each group, by task."""
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for batch in batches:
        x = _flat(batch)
        keys, counts = ([y] for y in _merged([*keys, np.repeat(x["lang"], x["many"]) << 32 | x["numbers"]], [*counts, x["counts"]]))
    if keys:
        lang, number = (keys[0] >> 32).astype(np.int32), (keys[0] & 0xFFFFFFFF).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(number), pa.array(counts[0])], ["lang", "number", "total"])


def group_sums(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS, terms: int = TERMS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All groups, the kept terms of each language, and how often each kept term occurs in each group.

    ``groups``: ``lang, number, name, source``, language and source by number and by name. ``kept``: ``lang, shard, index,
    term``. ``sums``: ``lang, shard, index, numbers, counts``, one row for each term. A language's terms are counted by one CountVectorizer, or by
    several, of about ``terms`` terms at most each.
    """
    spark = df.sparkSession
    lang, source = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_col, source_col))
    docs = df.select(lang.alias("name"), source.alias("source"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    pairs = stored(docs.select("name", "source").distinct(), "pairs")
    names = [r.name for r in pairs.select("name").distinct().orderBy("name").collect()]
    langs = spark.createDataFrame(list(enumerate(names)), "lang int, name string")
    number = F.row_number().over(Window.partitionBy("name").orderBy("source")) - 1
    groups = stored(pairs.withColumn("number", number).join(F.broadcast(langs), "name"), "groups")
    folder = scratch_path(spark, "terms")
    numbered = docs.join(groups, ["name", "source"]).select("lang", "number", "text")
    sketch = spark.sparkContext.accumulator({}, Smallest())
    folded = numbered.mapInArrow(lambda batches: _folded(sketch, batches), "lang int, number int, terms string")
    folded.write.partitionBy("lang").parquet(folder)
    kept, sums = scratch_path(spark, "kept-terms"), scratch_path(spark, "term-sums")
    kept_schema, sums_schema = "lang int, shard int, index int, term string", "lang int, shard int, index int, numbers array<int>, counts array<long>"
    spark.createDataFrame([], kept_schema).write.parquet(kept)
    spark.createDataFrame([], sums_schema).write.parquet(sums)
    texts = spark.read.schema("number int, terms string, lang int").parquet(folder)
    parts = partitions(spark)
    for lang, hashes in sorted(sketch.value.items()):
        shards, docs = math.ceil(different(hashes) / terms), texts.where(F.col("lang") == lang).select("number", "terms")
        for shard in range(shards):
            own = [F.lit(lang).alias("lang"), F.lit(shard).alias("shard")]
            found = _vocabulary(docs, shard, shards, min_documents)
            found.select(*own, "index", "term").write.mode("append").parquet(kept)
            table = found.toArrow()
            named = zip(table.column("term").cast(pa.binary()).to_pylist(), table.column("index").to_pylist(), strict=True)
            shared = spark.sparkContext.broadcast(Indices(named))
            # What tasks have summed is met in the buckets of its terms.
            packs = docs.mapInArrow(partial(_summed, parts, shared), "bucket int, keys binary, counts binary")
            summed = packs.repartitionById(parts, "bucket").mapInArrow(_met, "index int, numbers array<int>, counts array<long>")
            summed.select(*own, "index", "numbers", "counts").write.mode("append").parquet(sums)
            shared.unpersist()
    return groups, spark.read.schema(kept_schema).parquet(kept), spark.read.schema(sums_schema).parquet(sums)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _probability(count: np.ndarray, total: np.ndarray | int, size: int) -> np.ndarray:
    if count.max(initial=0) < 9 * UNIT:
        return UNIT * (count + 1) // (total + size) + 1
    return (UNIT * (count.astype(object) + 1) // (total + size) + 1).astype(np.int64)


class _Sums:
    """Sums by pairs of whole numbers, in one array while the numbers are small, else sorted and merged."""

    def __init__(self, dense: int):
        self.dense, self.table, self.keys, self.sums = dense, np.zeros((0, 0), np.int64), [], []

    def add(self, one: np.ndarray, two: np.ndarray, value: np.ndarray) -> None:
        size = 1 + max(one.max(initial=-1), two.max(initial=-1))
        if size <= self.dense:
            if size > len(self.table):
                wide = np.zeros((min(self.dense, 2 * size),) * 2, np.int64)
                wide[: len(self.table), : len(self.table)] = self.table
                self.table = wide
            np.add.at(self.table, (one, two), value)
            return
        key, total = _merged([one << 32 | two], [value])
        self.keys.append(key)
        self.sums.append(total)
        if sum(map(len, self.keys)) > _HELD:
            self.keys, self.sums = ([x] for x in _merged(self.keys, self.sums))

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        one, two = np.nonzero(self.table)
        yield one, two, self.table[one, two]
        key, total = _merged(self.keys, self.sums)
        yield key >> 32, key & 0xFFFFFFFF, total
        self.__init__(self.dense)


_TERM = ("lang", "shard", "index")
_PAIR, _ALONE, _OVER = 0, 1, 2
_FOUND = pa.schema([("kind", pa.int32()), ("lang", pa.int32()), *[(c, pa.int64()) for c in ("a", "b", "x", "y")]])


@dataclass(frozen=True)
class _Groups:
    """By language the first of its groups; by group its total, probability of an absent term, and its language's size and total."""

    first: dict[int, int]
    total: np.ndarray
    p0: np.ndarray
    size: np.ndarray
    all: np.ndarray


def _compared(groups, dense: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the terms of a task say, from their counts by source.

    Kind 0: what two sources ``a, b`` add by the terms that both have beyond each of them alone, ``x``. Kind 1: how many
    terms, ``y``, source ``a`` has with the probability ``x``. Kind 2: a term of shard ``b`` and index ``y`` that source
    ``a`` has more than the language, and its divergence ``x``.
    """
    groups = groups.value
    both, alone, of = _Sums(dense), _Sums(0), None

    def rows_of(kind: int, lang: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(columns[0]), 1 << 16):
            part = [pa.array(c[a : a + (1 << 16)].astype(np.int64)) for c in columns]
            ends = [pa.array(np.full(len(part[0]), v, np.int32)) for v in (kind, lang)]
            yield pa.RecordBatch.from_arrays([*ends, *part], schema=_FOUND)

    def out() -> Iterator[pa.RecordBatch]:
        for one, two, value in both.take():
            yield from rows_of(_PAIR, of, one, two, value, np.zeros(len(one)))
        for number, p, many in alone.take():
            yield from rows_of(_ALONE, of, number, np.zeros(len(number)), p, many)

    def met(number: np.ndarray, p: np.ndarray, p0: np.ndarray, starts: np.ndarray) -> None:
        """All ordered pairs of sources of each term, a bounded number at a time."""
        many = np.diff(np.append(starts, len(p)))
        cuts = np.flatnonzero(np.diff(np.cumsum(many * many) // _LAID, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(starts)], strict=True):
            size = many[a:b]
            each = np.repeat(size, size)
            left = np.repeat(np.arange(starts[a], starts[a] + size.sum()), each)
            right = np.arange(len(left)) + np.repeat(np.repeat(starts[a:b], size) - np.cumsum(each) + each, each)
            other = left != right
            left, right = left[other], right[other]
            value = _f(p[left], p[right]) - _f(p[left], p0[right]) - _f(p0[left], p[right]) + _f(p0[left], p0[right])
            both.add(number[left], number[right], value)

    def take(shard: np.ndarray, index: np.ndarray, many: np.ndarray, number: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Terms of one language."""
        starts = np.cumsum(many) - many
        group = groups.first[of] + number
        size, total = groups.size[group[0]], groups.all[group[0]]
        p = _probability(n, groups.total[group], size)
        q = np.repeat(_probability(np.add.reduceat(n, starts), total, size), many)
        over = np.flatnonzero(p > q)
        yield from rows_of(_OVER, of, number[over], np.repeat(shard, many)[over], _f(p[over], q[over]), np.repeat(index, many)[over])
        alone.add(number, p, np.ones(len(p), np.int64))
        met(number, p, groups.p0[group], starts)

    for batch in batches:
        x = _flat(batch)
        ends = np.cumsum(x["many"])
        edges = np.flatnonzero(np.diff(x["lang"], prepend=-1))
        for a, b in zip(edges, [*edges[1:], batch.num_rows], strict=False):
            if x["lang"][a] != of:
                if of is not None:
                    yield from out()
                of = int(x["lang"][a])
            inside = slice(ends[a] - x["many"][a], ends[b - 1])
            yield from take(x["shard"][a:b], x["index"][a:b], x["many"][a:b], x["numbers"][inside], x["counts"][inside])
    if of is not None:
        yield from out()


def audit(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    min_documents: int = MIN_DOCUMENTS, ranks: int = RANKS, terms: int = TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from the others of its language, and in which terms.

    Null text, language and source are ''. A language keeps the terms that at least ``min_documents`` of its documents
    have; a group is a language and source. Every kept term has a probability in units of 1e-9 in each group and in the
    language, smoothed by one occurrence, and the divergence of p from q is ``floor((p - q)^2 / q)``. Part ``pair``:
    ``item`` is another source of the language, ``value`` the divergence from it summed over all kept terms. Part
    ``term``: ``item`` is a term that occurs in the group more than in the language, ``value`` its divergence, down to
    rank ``ranks``. Ranks go by value, then by the item's bytes. All arithmetic is on whole numbers.

    Groups without terms are compared like others; a language without kept terms has value 0 for each pair. Repeated
    rows count as often as they occur; one source alone has no pairs; no rows give none; other columns are not looked
    at. A very long text is one list of words in its task.

    Terms are counted by Spark ML's CountVectorizer for each language, with minDF and the largest vocabSize, in
    vocabularies of about ``terms`` terms each at most, whose bound is also that of what the driver holds and sends at a time
    (besides the names of languages). Documents become sparse vectors by that vocabulary in Arrow batches, and are
    summed by group in whole numbers (Summarizer works with means). Pairs of sources are evaluated over the
    terms that occur in one of them; all others have the same value, which is multiplied.
    """
    groups, kept, sums = group_sums(df, text_col, lang_col, source_col, min_documents, terms)
    sizes = kept.groupBy("lang").agg(F.count("*").alias("size"))
    totals = sums.mapInArrow(_totals, "lang int, number int, total long").groupBy("lang", "number").agg(F.sum("total").alias("total"))
    groups = groups.join(sizes, "lang", "left").join(totals, ["lang", "number"], "left")
    size, total = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("size", "total"))
    groups = groups.select("lang", "name", "source", F.col("number").cast("long").alias("number"), size, total)
    p0 = probability(F.lit(0).cast("long"), F.col("total"), F.col("size"))
    groups = stored(groups.withColumn("p0", p0).withColumn("all", F.sum("total").over(Window.partitionBy("lang"))), "group-totals")
    # A few numbers for each group, of which the result has a row for each pair.
    table = groups.select("lang", "number", "total", F.coalesce("p0", F.lit(0)).alias("p0"), "size", "all").orderBy("lang", "number").toArrow()
    lang, *numbers = (table.column(c).to_numpy() for c in ("lang", "total", "p0", "size", "all"))
    first = {int(v): int(i) for v, i in zip(*np.unique(lang, return_index=True), strict=True)}
    shared = df.sparkSession.sparkContext.broadcast(_Groups(first, *numbers))
    found = sums.mapInArrow(lambda batches: _compared(shared, DENSE, batches), "kind int, lang int, a long, b long, x long, y long")
    found = stored(found, "compared")
    over = found.where(F.col("kind") == _OVER)
    # The best by value first, so that only these need their terms.
    level = Window.partitionBy("lang", "a").orderBy(F.desc("x"))
    over = over.withColumn("level", F.rank().over(level)).where(F.col("level") <= ranks)
    over = over.select("lang", F.col("a").alias("number"), F.col("b").cast("int").alias("shard"), F.col("y").cast("int").alias("index"), "x")
    over = over.join(kept, list(_TERM)).join(groups.select("lang", "number", "name", "source"), ["lang", "number"])
    over = over.select(F.col("name").alias("lang"), "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.col("x").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    over = over.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    return _pairs(groups, found).withColumn("rank", F.row_number().over(best)).unionByName(over)


def _pairs(groups: DataFrame, found: DataFrame) -> DataFrame:
    """Divergence of each source from each other one of its language.

    The sum over all kept terms is that of terms in neither (as if all were), a correction for those in one of the two,
    by how many terms have which probability, and a second one for those in both.
    """
    me, other = groups.alias("me"), groups.alias("other")
    absent = F.coalesce(F.col("me.size") * divergence(F.col("me.p0"), F.col("other.p0")), F.lit(0).cast("long"))
    both = (F.col("me.lang") == F.col("other.lang")) & (F.col("me.source") != F.col("other.source"))
    neither = me.join(other, both).select("me.lang", F.col("me.number").alias("left"), F.col("other.number").alias("right"), absent.alias("value"))
    alike = found.where(F.col("kind") == _ALONE).groupBy("lang", "a", "x").agg(F.sum("y").alias("many"))
    own = groups.select("lang", F.col("number").alias("a"), "p0")
    alike = alike.join(own, ["lang", "a"]).select(F.col("lang").alias("_lang"), "a", F.col("x").alias("p"), "p0", "many")
    others = groups.select("lang", F.col("number").alias("b"), F.col("p0").alias("p1"))
    one = alike.join(others, (F.col("_lang") == F.col("lang")) & (F.col("a") != F.col("b")))
    p, p0, p1, many = (F.col(c) for c in ("p", "p0", "p1", "many"))
    to = F.struct(F.col("a").alias("left"), F.col("b").alias("right"), (many * (divergence(p, p1) - divergence(p0, p1))).alias("value"))
    back = F.struct(F.col("b").alias("left"), F.col("a").alias("right"), (many * (divergence(p1, p) - divergence(p1, p0))).alias("value"))
    either = one.select("lang", F.inline(F.array(to, back)))
    met = found.where(F.col("kind") == _PAIR).select("lang", F.col("a").alias("left"), F.col("b").alias("right"), F.col("x").alias("value"))
    total = neither.unionAll(either).unionAll(met).groupBy("lang", "left", "right").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "name", F.col("number").alias("left"), "source")
    return (
        total.join(names, ["lang", "left"])
        .join(groups.select("lang", F.col("number").alias("right"), F.col("source").alias("item")), ["lang", "right"])
        .select(F.col("name").alias("lang"), "source", F.lit("pair").alias("part"), "item", "value")
    )


def oracle_sql() -> str:
    """DuckDB SQL for ``audit`` over ``documents``."""
    word = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
    folded = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({folded}, '{word}') AS w FROM documents),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs
  FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY lang, source, term),
kept AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term HAVING sum(docs) >= {MIN_DOCUMENTS}),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
totals AS (SELECT lang, source, sum(c.n) AS n FROM c JOIN kept USING (lang, term) GROUP BY lang, source),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + ({UNIT}::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(t.n, 0) + s.v) AS p,
    1 + ({UNIT}::HUGEINT * (k.n + 1)) // (s.n + s.v) AS q
  FROM g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= {RANKS}"""
