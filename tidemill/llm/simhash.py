"""SimHash fingerprints, linked where few bits differ, by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import rows, slim, stored
from tidemill.llm.components import components

SEED = 42
#: Fingerprints in one bucket of an index up to which its matches are looked up there.
BUCKET = 256
_STEP = 1 << 16


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """64 bits: bit i is set if it is set in the hashes of more than half of all shingles, repeats included.

    A-Z become lower case; a text of fewer words than a shingle is one shingle, one without words has fingerprint 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingles = max(1, len(words) - size + 1)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, shingles, _STEP):
        part = words[start : min(start + _STEP, shingles) + size - 1]
        runs = zip(*[part[j:] for j in range(size)], strict=False) if len(words) >= size else [part]
        hashes = np.array([digest(b" ".join(run), SEED) for run in runs], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > shingles, bitorder="little").view("<u8")[0])


def _fingerprints(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t, size) for (t,) in rows(iter([batch]), "text")]
        signed = np.array(values, np.uint64).view(np.int64)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(signed)], [*names, "fp"])


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, key: bool = False
) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed long ``fp``; a null text is a text without words.

    ``key`` adds ``text_key``, a hash that tells the texts of an id apart.
    """
    texts, schema = slim(df, id_col, text_col), "doc_id long, fp long"
    if key:
        texts, schema = texts.withColumn("text_key", _text_key("text")), "doc_id long, text_key long, fp long"
    return texts.mapInArrow(partial(_fingerprints, size), schema)


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.col(f"`{text_col}`").cast("binary"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def index_plan(distance: int, segments: int) -> list[tuple[int, list[int]]]:
    """Mask of each segment, and the flips that make up the Hamming ball to look up in it.

    Of two fingerprints within ``distance``, one of the first ``distance % segments + 1`` segments differs in at most
    ``distance // segments`` bits, or one of the others in fewer.
    """
    radius, wide = divmod(distance, segments)
    edges = [64 * s // segments for s in range(segments + 1)]
    plan = []
    for s in range(segments):
        bits = range(edges[s], edges[s + 1])
        ball = radius if s <= wide else radius - 1
        flips = [sum(1 << b for b in some) for k in range(ball + 1) for some in combinations(bits, k)]
        if flips:
            plan.append((sum(1 << b for b in bits), flips))
    return plan


def _around(plan: list[tuple[int, list[int]]], ball: bool):
    """One entry for each segment (its value), or for each value in the ball around it."""
    fp = F.col("fp")
    entries = [
        F.struct(F.lit(s).alias("segment"), fp.bitwiseAND(_signed(mask)).bitwiseXOR(F.lit(_signed(flip))).alias("value"))
        for s, (mask, flips) in enumerate(plan)
        for flip in (flips if ball else [0])
    ]
    return F.inline(F.array(*entries))


def links(nodes: DataFrame, distance: int = 2, segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links ``a, b`` that connect all of ``nodes`` (``fp``, unique, and ``node``) whose fingerprints are that close.

    Every fingerprint looks up the ball around each of its segments in the table of segment values, and what it meets
    is kept if the whole distance holds. A value shared by more than ``bucket`` fingerprints is not met pair by pair:
    two fingerprints within an even distance 2h have a point within h of both, so those that look up such a value
    each name all points within h, and all that name a point are linked with one of them. For an odd distance 2h + 1 one
    of two is within h of the point and the other one bit on. A link by a point is checked by its distance too.
    """
    plan = index_plan(distance, segments)
    table = nodes.select("fp", "node", _around(plan, False))
    probes = nodes.select("fp", "node", _around(plan, True))
    crowded = stored(table.groupBy("segment", "value").count().where(F.col("count") > bucket), "crowded")
    crowded = crowded.select("segment", "value")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("other_fp"))) <= distance
    keys = ["segment", "value"]
    met = (
        probes.join(
            table.join(crowded, keys, "left_anti").select(
                *keys, F.col("fp").alias("other_fp"), F.col("node").alias("other")
            ),
            keys,
        )
        .where((F.col("fp") < F.col("other_fp")) & apart)
        .select(F.col("node").alias("a"), F.col("other").alias("b"))
    )
    if not crowded.take(1):
        return met
    many = probes.join(crowded, keys, "left_semi").select("fp", "node").distinct()
    return met.union(_by_points(stored(many, "crowded-fingerprints"), distance))


def _by_points(nodes: DataFrame, distance: int) -> DataFrame:
    """Links with the smallest node within half the distance of a common point."""
    half, odd = divmod(distance, 2)
    ball = [_signed(sum(1 << b for b in some)) for k in range(half + 1) for some in combinations(range(64), k)]
    rim = [_signed(sum(1 << b for b in some)) for some in combinations(range(64), half + 1)] if odd else []
    named = nodes.select("fp", "node", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in ball])).alias("point"))
    if odd:
        far = nodes.select("fp", "node", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m)) for m in rim])).alias("point"))
        first = stored(named.groupBy("point").agg(F.min("node").alias("low"), F.min_by("fp", "node").alias("low_fp")), "points")
        named = stored(named.union(far), "named")
    else:
        named = stored(named, "named")
        first = named.groupBy("point").agg(
            F.min("node").alias("low"), F.min_by("fp", "node").alias("low_fp"), F.count("*").alias("n")
        )
        first = stored(first.where("n > 1").drop("n"), "points")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("low_fp"))) <= distance
    return (
        named.join(first, "point")
        .where((F.col("node") != F.col("low")) & near)
        .select(F.col("node").alias("a"), F.col("low").alias("b"))
    )


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, distance: int = 2
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the smallest id reachable over links of close fingerprints.

    Equal fingerprints are one node, so copies are never paired with each other. Texts that are null, empty or white
    space have fingerprint 0 and are linked like any other. Repeated rows give repeated rows; a null id takes part
    through its fingerprint, but is never the smallest one unless it is the only one. No rows give no rows.
    """
    marked = _grouped(stored(fingerprints(df, id_col, text_col, size), "fingerprints"), distance)
    return marked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(marked: DataFrame, distance: int) -> DataFrame:
    """With ``component``, its smallest fingerprint, and ``component_id``, its smallest id.

    The nodes are fingerprints, so that those without an id link others as well, and an id with several texts links none.
    """
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    whole = components(links(nodes.select("fp", F.col("fp").alias("node")), distance))
    members = nodes.join(whole.withColumnRenamed("node", "fp"), "fp", "left")
    members = stored(members.select("fp", "low", F.coalesce("component", "fp").alias("component")), "members")
    smallest = stored(members.groupBy("component").agg(F.min("low").alias("component_id")), "smallest")
    named = members.join(smallest, "component").select("fp", "component", "component_id")
    return marked.join(stored(named, "components"), "fp")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``df`` that are the first of their component, by id and then by a hash of the text; all columns stay.

    Of rows that repeat an id and its text, one stays. Different texts of one id are documents of their own. A row
    without an id stays, as nothing can name it.
    """
    marked = _grouped(stored(fingerprints(df, id_col, text_col, size, key=True), "fingerprints"), distance)
    marked = stored(marked.where("doc_id IS NOT NULL").select("doc_id", "text_key", "component", "component_id"), "grouped")
    heads = marked.where("doc_id = component_id")
    first = heads.groupBy("component").agg(F.min("text_key").alias("first"), F.max("text_key").alias("last")).where("first <> last")
    others = heads.join(stored(first, "firsts"), "component").where("text_key <> first")
    gone = marked.where("doc_id <> component_id").select("doc_id", "text_key").union(others.select("doc_id", "text_key"))
    gone = stored(gone.distinct().toDF("_later_id", "_later_key"), "later")
    own = (F.col(f"`{id_col}`").cast("long") == F.col("_later_id")) & (_text_key(text_col) == F.col("_later_key"))
    kept = df.join(gone, own, "left_anti")
    repeated = df.groupBy(id_col).count().where(f"`{id_col}` IS NOT NULL AND count > 1")
    if not repeated.take(1):
        return kept
    missing = kept.where(F.col(f"`{id_col}`").isNull())
    once = kept.where(F.col(f"`{id_col}`").isNotNull()).withColumn("_text_key", _text_key(text_col))
    return once.dropDuplicates([id_col, "_text_key"]).drop("_text_key").union(missing)
