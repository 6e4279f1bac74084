"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which of them overlap."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.bpe import decode
from tidemill.llm.common import Splitter, is_plain, rows, stored

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Id pairs whose counts are sent to the executors; those of the others are joined.
SENT = 1 << 20
#: Characters of the texts that are aligned together; a text of more is alone, and encoded in parts.
LONG = 1 << 18
#: Tokens whose links are laid out at once; distinct pairs a task counts before it hands them on.
STEP, PAIRS = 1 << 19, 1 << 20


@dataclass(frozen=True)
class Tokens:
    """Bytes of each id, and the ids of texts: each with a space in front, which the tokenizer adds or ``encode`` does."""

    bytes: list[bytes]
    size: np.ndarray
    encode: Callable[[list[str]], list[np.ndarray]]
    spelled: pa.Array


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else one above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _byte_level(path: str) -> Tokens:
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    model = tokenizers.Tokenizer.from_file(path)
    model.encode_special_tokens = True
    model.no_truncation()
    model.no_padding()
    letters, entries = _byte_letters(), model.get_vocab(with_added_tokens=True)
    found = [b""] * (max(entries.values()) + 1)
    for entry, i in entries.items():
        found[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
    split, ranked = Splitter(public_tokenizers.PATTERN), _ranked(path, found)

    def ids(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(texts: list[str]) -> list[np.ndarray]:
        spaced = [f" {t}" for t in texts]
        plain = [ranked is not None and is_plain(t) for t in spaced]
        rest = [t for t, p in zip(spaced, plain, strict=True) if not p]
        if len(rest) == 1 and len(rest[0]) > LONG:
            # A part ends where the tokenizer itself cuts before its merges.
            others = [np.concatenate([i for part in split.parts(rest[0], LONG // 8) for i in ids([part])])]
        else:
            others = ids(rest) if rest else []
        left = iter(others)
        quick = lambda t: ranked.encode_to_numpy(t, disallowed_special=()).astype(np.int64)
        return [quick(t) if p else next(left) for t, p in zip(spaced, plain, strict=True)]

    return Tokens(found, np.array([len(b) for b in found]), encode, pa.array(found, pa.binary()))


def _ranked(path: str, found: list[bytes]):
    """A faster encoder with the same result on plain text, or None.

    It merges the neighbours whose joined bytes have the lowest id. If the ids of what the file's merges make ascend,
    these are the file's next merge: what is left of a token's bytes when all lower merges are done are the two parts
    it is made of.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    first, vocabulary = spec.get("pre_tokenizer") or {}, spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    made = [vocabulary["".join(p)] for p in pairs]
    added = {t["content"] for t in spec.get("added_tokens") or []}
    entries = {found[i]: i for e, i in vocabulary.items() if e not in added}
    known = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
    singles = all(bytes([b]) in entries for b in range(256))
    if not known or not singles or made != sorted(set(made)) or len(made) + 256 != len(entries) or spec.get("normalizer"):
        return None
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=entries, special_tokens={})


def _pieces(path: str) -> Tokens:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(count)]
    found = [
        bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
    ]
    # If no piece has a space after something else, no token crosses the place before such a space.
    cuts = not any(re.search("[^▁]▁", p) for p in pieces) and model.encode("a  b c") == model.encode("a") + model.encode(" b") + model.encode("c")

    def encode(texts: list[str]) -> list[np.ndarray]:
        if len(texts) > 1 or len(texts[0]) <= LONG or not cuts:
            return [np.array(i, np.int64) for i in model.encode(texts, num_threads=1)]
        text, start, ids = texts[0], 0, []
        for place in re.finditer("(?<=[^ ▁]) (?=.)", text, re.DOTALL):
            if place.start() - start >= LONG:
                ids += model.encode(text[start : place.start()], num_threads=1)
                start = place.end()
        return [np.array(ids + model.encode(text[start:], num_threads=1), np.int64)]

    return Tokens(found, np.array([len(b) for b in found]), encode, pa.array(found, pa.binary()))


@lru_cache(maxsize=4)
def load(path: str) -> Tokens:
    """The tokenizer of a file; read once by each worker."""
    if path.endswith(".json"):
        return _byte_level(path)
    if path.endswith(".model"):
        return _pieces(path)
    raise ValueError(f"no tokenizer library reads {path}")


def gallop(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """For each of ``few`` the place of the first of ``many`` that is not less; both ascend.

    Every second value first, and so on recursively: the next one starts from its left neighbour's place, takes steps of
    1, 2, 4, ... until it has passed the value, and searches the last step by halves. All of a level go side by side.
    """
    places = np.zeros(len(few), np.int64)
    stride = 1 << max(0, len(few) - 1).bit_length()
    while stride:
        at = np.arange(stride if stride < len(few) else 0, len(few), 2 * stride)
        low = np.where(at >= stride, places[np.maximum(at - stride, 0)], 0)
        want, step = few[at], np.zeros(len(at), np.int64)
        # Invariant: what is before ``low`` is less. After this loop the place is in low .. low + step.
        going = np.arange(len(at))
        width = 1
        while len(going):
            probe = low[going] + width - 1
            less = probe < len(many)
            less[less] = many[probe[less]] < want[going][less]
            stopped = going[~less]
            step[stopped] = width - 1
            going = going[less]
            low[going] += width
            width *= 2
        high = np.minimum(low + step, len(many))
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) >> 1
            less = many[middle] < want[going]
            low[going[less]] = middle[less] + 1
            high[going[~less]] = middle[~less]
            going = going[low[going] < high[going]]
        places[at] = low
        stride //= 2
    return places


@dataclass(frozen=True)
class Alignment:
    """Of several texts laid end to end: ids, and for each token of the side with fewer tokens what it overlaps.

    ``ends_a`` and ``ends_b`` tell the tokens with which a group ends; ``first`` and ``last`` are the range of the
    overlapping tokens of the longer side. ``text_a`` and ``text_b``: the text that each token is of.
    """

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    first: np.ndarray
    last: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray

    def links(self, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair (id of a times ``base`` plus id of b) and number of links, for each text its pairs in order."""
        swapped = len(self.a) > len(self.b)
        few, many, text = (self.b, self.a, self.text_b) if swapped else (self.a, self.b, self.text_a)
        room = base * (int(self.a.max(initial=0)) + 1)
        keys, counts = [], []
        for start in range(0, len(few), STEP):
            some = slice(start, start + STEP)
            each = self.last[some] - self.first[some] + 1
            ends = np.cumsum(each)
            other = many[np.arange(ends[-1]) + np.repeat(self.first[some] - ends + each, each)].astype(np.int64)
            own = np.repeat(few[some].astype(np.int64), each)
            pair = other * base + own if swapped else own * base + other
            pair += np.repeat(text[some] * room, each)
            pair.sort()
            edges = np.flatnonzero(np.diff(pair, prepend=-1))
            keys.append(pair[edges])
            counts.append(np.diff(np.append(edges, len(pair))))
        key, count = summed(keys, counts)
        return key // room, key % room, count


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    if len(keys) == 1:
        return keys[0], counts[0]
    key = np.concatenate([*keys, np.empty(0, np.int64)])
    order = np.argsort(key, kind="stable")
    key, count = key[order], np.concatenate([*counts, np.empty(0, np.int64)])[order]
    edges = np.flatnonzero(np.diff(key, prepend=-1))
    return key[edges], np.add.reduceat(count, edges) if len(edges) else count


def align(a: list[np.ndarray], b: list[np.ndarray], size_a: np.ndarray, size_b: np.ndarray) -> Alignment:
    """Aligns the ids of texts, text by text the same bytes on both sides."""
    text_a, text_b = (np.repeat(np.arange(len(x)), [len(i) for i in x]) for x in (a, b))
    ids_a, ids_b = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (a, b))
    ends = [np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b])]
    swapped = len(ids_a) > len(ids_b)
    few, many = reversed(ends) if swapped else ends
    last = gallop(few, many)
    common = many[last] == few
    first = np.concatenate(([0], (last + common)[:-1])) if len(last) else last
    there = np.zeros(len(many), bool)
    there[last[common]] = True
    return Alignment(ids_a, ids_b, *((there, common) if swapped else (common, there)), first, last, text_a, text_b)


@lru_cache(maxsize=4)
def _cells(count: int, inside: bytes, end: bytes) -> np.ndarray:
    """Each id in decimal with what follows it, twice: within a group and at its end. Shorter ones end in NUL."""
    cells = [b"%d%s" % (i, mark) for mark in (inside, end) for i in range(count)]
    return np.array(cells)


def groups_of(found: Alignment, texts: int, count_a: int, count_b: int) -> list[bytes]:
    """Of each text its groups, as ``a1,a2|b1;a3|b2,b3``."""
    of_a, of_b = np.cumsum(found.ends_a) - found.ends_a, np.cumsum(found.ends_b) - found.ends_b
    before_b = np.concatenate(([0], np.flatnonzero(found.ends_b) + 1))
    upto_a = np.flatnonzero(found.ends_a) + 1
    names_a, names_b = _cells(count_a, b",", b"|"), _cells(count_b, b",", b";")
    cells = np.zeros(len(of_a) + len(of_b), f"S{max(names_a.itemsize, names_b.itemsize)}")
    cells[np.arange(len(of_a)) + before_b[of_a]] = names_a[found.a + count_a * found.ends_a]
    cells[np.arange(len(of_b)) + upto_a[of_b]] = names_b[found.b + count_b * found.ends_b]
    size = np.bincount(found.text_a, minlength=texts) + np.bincount(found.text_b, minlength=texts)
    edges = np.concatenate(([0], np.cumsum(size)))
    return [cells[p:q].tobytes().translate(None, b"\0")[:-1] for p, q in zip(edges[:-1], edges[1:], strict=True)]


def _encoded(a: Tokens, b: Tokens, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids of both sides; none where they do not spell the text."""
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    out = []
    for text, ids_a, ids_b in zip(texts, a.encode(texts), b.encode(texts), strict=True):
        whole = b" " + text.encode()
        same = decode(a.spelled, ids_a) == whole and decode(b.spelled, ids_b) == whole
        out.append((ids_a, ids_b) if same else none)
    return out


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows whose texts have LONG characters together, or one row with a longer text."""
    group, size = [], 0
    for row in rows(batches, "row", "doc_id", "text", step=64):
        length = len(row[2] or "")
        if group and size + length > LONG:
            yield group
            group, size = [], 0
        group.append(row)
        size += length
    if group:
        yield group


_PAIR = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
_ALIGNED = pa.schema(
    [(n, pa.int64()) for n in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("ids_a", pa.binary()), ("ids_b", pa.binary()), ("pairs", _PAIR)]
)


def _pairs(keys: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One list with all pairs and their counts."""
    flat = pa.StructArray.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "n"])
    return pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), flat)


def _handed(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows without a document, with the counts of pairs."""
    for start in range(0, len(keys), 1 << 16):
        part = _pairs(keys[start : start + (1 << 16)], counts[start : start + (1 << 16)])
        columns = [pa.nulls(1, f.type) if f.name != "pairs" else part.cast(_PAIR) for f in _ALIGNED]
        yield pa.RecordBatch.from_arrays(columns, schema=_ALIGNED)


def _narrow(count: int) -> str:
    return "<u2" if count <= 1 << 16 else "<u4"


def _aligned(path_a: str, path_b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = load(path_a), load(path_b)
    kinds = _narrow(len(a.bytes)), _narrow(len(b.bytes))
    keys: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    for group in _grouped(batches):
        texts = [text for _, _, text in group if text]
        encoded = iter(_encoded(a, b, texts) if texts else [])
        none = (np.empty(0, np.int64), np.empty(0, np.int64))
        both = [next(encoded) if text else none for _, _, text in group]
        found = align([x for x, _ in both], [y for _, y in both], a.size, b.size)
        text, pair, links = found.links(len(b.bytes))
        names = groups_of(found, len(group), len(a.bytes), len(b.bytes))
        many = [np.bincount(x, minlength=len(group)) for x in (found.text_a, found.text_b, found.text_a[found.ends_a])]
        total = np.zeros(len(group), np.int64)
        np.add.at(total, text, links)
        columns = [
            [r for r, _, _ in group],
            [d for _, d, _ in group],
            *many,
            total,
            [hashlib.sha256(n).hexdigest() if n else "" for n in names],
            [x.astype(kinds[0]).tobytes() for x, _ in both],
            [y.astype(kinds[1]).tobytes() for _, y in both],
        ]
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _ALIGNED, strict=False)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(group), _PAIR)], schema=_ALIGNED)
        pair.sort()
        edges = np.flatnonzero(np.diff(pair, prepend=-1))
        keys.append(pair[edges])
        counts.append(np.diff(np.append(edges, len(pair))))
        if sum(map(len, keys)) > 2 * PAIRS:
            key, count = summed(keys, counts)
            keys, counts = [key], [count]
            if len(key) > PAIRS:
                yield from _handed(key, count)
                keys, counts = [], []
    if keys:
        yield from _handed(*summed(keys, counts))


_SUMS = [("n_best", pa.int64()), ("count_sum", pa.int64()), ("rest", _PAIR)]


def _kept(with_ids: bool) -> list[pa.Field]:
    """Columns of an aligned document that its result keeps."""
    return [f for f in _ALIGNED if f.name != "pairs" and (with_ids or not f.name.startswith("ids_"))]


def _looked_up(path_a: str, path_b: str, with_ids: bool, shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the links of each document; pairs whose count was not sent are the ``rest``, with their links."""
    a, b = load(path_a), load(path_b)
    kinds, base = (_narrow(len(a.bytes)), _narrow(len(b.bytes))), len(b.bytes)
    known, times, best = shared.value
    kept = _kept(with_ids)
    schema = pa.schema([*kept, *_SUMS])
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = [batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("n_a", "n_b")]
        edges = np.flatnonzero(np.diff((sizes[0].cumsum() + sizes[1].cumsum()) // STEP, prepend=-1))
        for start, end in zip(edges, [*edges[1:], batch.num_rows], strict=True):
            part = batch.slice(start, end - start)
            ids = [
                [np.frombuffer(x, kind) for x in part.column(part.schema.get_field_index(n)).to_pylist()]
                for n, kind in zip(("ids_a", "ids_b"), kinds, strict=True)
            ]
            text, pair, links = align(*ids, a.size, b.size).links(base)
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            sent = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            n = np.where(sent, times[at] if len(known) else 0, 0)
            sums = np.zeros((2, part.num_rows), np.int64)
            np.add.at(sums[0], text, links * (sent & (n == best[pair // base])))
            np.add.at(sums[1], text, links * n)
            rest = np.flatnonzero(~sent)
            flat = pa.StructArray.from_arrays([pa.array(pair[rest]), pa.array(links[rest])], ["pair", "n"])
            bounds = np.searchsorted(text[rest], np.arange(part.num_rows + 1)).astype(np.int32)
            columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
            lists = pa.ListArray.from_arrays(pa.array(bounds), flat).cast(_PAIR)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums[0]), pa.array(sums[1]), lists], schema=schema)


def _ddl(schema: Iterable[pa.Field]) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary", _PAIR: "array<struct<pair: long, n: long>>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _most_counted(spark: SparkSession, counts: DataFrame, most: int) -> DataFrame:
    """The pairs of the largest counts, at most ``most``, and all of any count or none."""
    level = F.floor(F.log2("n") * 16)
    rest, least = most, None
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if row["count"] > rest:
            break
        rest, least = rest - row["count"], row.level
    return counts.where(level >= least) if least is not None else counts.limit(0)


def align_tokenizers(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_a: str | None = None,
    path_b: str | None = None,
    sent: int = SENT,
    with_ids: bool = False,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    Both tokenizers encode a space and the whole text, without special tokens. Byte offsets where tokens of both end
    cut them into groups; an A token is linked with every B token whose bytes overlap its own. ``n_best`` are the links
    whose id pair is in as many documents of the table as the most frequent pair of that A id, ``count_sum`` adds up
    these numbers of documents over the links. ``groups_sha256`` is the digest of the groups as ``a1,a2|b1;a3|b2,b3``.
    With ``with_ids`` also ``ids_a`` and ``ids_b``: little-endian unsigned integers, of 16 bits if the vocabulary
    allows it, else of 32.

    A null or empty text, and one that the bytes of either side's tokens do not spell, has no tokens: zeros and ''.
    Repeated rows are documents of their own; no rows give none; other columns are not looked at. A very long text is
    encoded in parts, at places no token can cross; its ids are in one task.

    Texts are encoded once and only ids are stored; nothing is shuffled by document. Every task adds up its pairs before
    they are counted. The counts of the ``sent`` most frequent pairs and the largest of each A id (as many as the
    vocabulary has) are sent to the executors; the other pairs of a document, rare ones, are joined with their counts.
    """
    path_a, path_b = path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)
    spark = df.sparkSession
    docs = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    aligned = stored(docs.mapInArrow(partial(_aligned, path_a, path_b), _ddl(_ALIGNED)), "aligned")
    each = aligned.where("pairs is not null").select(F.inline("pairs"))
    counts = stored(each.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    base, size = len(load(path_b).bytes), len(load(path_a).bytes)
    best = np.zeros(size, np.int64)
    for row in counts.groupBy(F.expr(f"pair div {base}").alias("a")).agg(F.max("n").alias("n")).collect():
        best[row.a] = row.n
    known = _most_counted(spark, counts, sent).toArrow().sort_by("pair")
    tables = [known.column(c).to_numpy() for c in ("pair", "n")]
    shared = spark.sparkContext.broadcast((*tables, best))
    rows_ = aligned.where("pairs is null").drop("pairs")
    schema = _ddl([*_kept(with_ids), *pa.schema(_SUMS)])
    found = stored(rows_.mapInArrow(partial(_looked_up, path_a, path_b, with_ids, shared), schema), "looked-up")
    largest = spark.createDataFrame([(i, n) for i, n in enumerate(best.tolist()) if n], "a long, best long")
    rest = (
        found.select("row", F.inline("rest"))
        .withColumnRenamed("n", "links")
        .join(counts, "pair")
        .withColumn("a", F.expr(f"pair div {base}"))
        .join(F.broadcast(largest), "a")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") == F.col("best"), F.col("links")).otherwise(0)).alias("more_best"),
            F.sum(F.col("links") * F.col("n")).alias("more_sum"),
        )
    )
    out = found.drop("rest").join(rest, "row", "left")
    return out.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
        *["ids_a", "ids_b"] * with_ids,
    )
