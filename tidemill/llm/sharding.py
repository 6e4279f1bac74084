"""Shards by fixed virtual slots: a record's hash names its slot for ever, a small versioned map names the slot's shard."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.llm.common import stored

SLOTS = 8192


@dataclass(frozen=True)
class SlotMap:
    """Version ``version`` of the map; ``shard[s]`` is the shard of virtual slot ``s``."""

    version: int
    shards: int
    shard: np.ndarray

    def save(self, spark: SparkSession, folder: str) -> None:
        """Each version is a table of its own; an older one is never changed."""
        rows = list(enumerate(self.shard.tolist()))
        spark.createDataFrame(rows, "virtual_slot int, shard int").coalesce(1).write.parquet(
            f"{folder}/version={self.version}/shards={self.shards}"
        )


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    return SlotMap(1, shards, np.arange(slots) * shards // slots)


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> SlotMap:
    """The given version of a saved map, else the latest."""
    table = spark.read.parquet(folder)
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    rows = table.where(F.col("version") == version).orderBy("virtual_slot").collect()
    return SlotMap(version, rows[0].shards, np.array([r.shard for r in rows]))


def _best_move(loads: np.ndarray, mine: np.ndarray, theirs: np.ndarray, gap: int) -> tuple[int, int | None] | None:
    """The slot to give (and the one to take for it, if any) that brings two shards closest, ``gap`` apart by now."""
    best, move = 0, None
    fits = mine[(loads[mine] > 0) & (loads[mine] < gap)]
    if len(fits):
        at = fits[np.abs(2 * loads[fits] - gap).argmin()]
        best, move = min(loads[at], gap - loads[at]), (at, None)
    if len(theirs) and len(mine):
        partners = theirs[np.argsort(loads[theirs], kind="stable")]
        near = np.searchsorted(loads[partners], loads[mine] - gap // 2)
        for shift in (-1, 0):
            pick = partners[np.clip(near + shift, 0, len(partners) - 1)]
            moved = loads[mine] - loads[pick]
            gain = np.minimum(moved, gap - moved)
            at = int(gain.argmax())
            if gain[at] > best:
                best, move = gain[at], (mine[at], pick[at])
    return move


def rebalance(current: SlotMap, loads: np.ndarray, shards: int) -> SlotMap:
    """The next version: slots move, or two change places, from a fuller to an emptier shard as long as that helps.

    ``loads`` are the bytes of each slot. The fullest and the emptiest shard go first; if nothing helps these two, the
    fullest with any other, and any other with the emptiest. Slots that need not move stay; a map that is balanced
    already keeps all. A larger number of shards than before starts the new ones empty, a smaller one first spreads
    the slots of those that go.
    """
    shard = np.where(current.shard < shards, current.shard, current.shard % shards)
    total = np.bincount(shard, loads, shards).astype(np.int64)
    for _ in range(8 * len(shard)):
        order = np.argsort(total, kind="stable")
        pairs = [(order[-1], low) for low in order[:-1]] + [(high, order[0]) for high in order[-2:0:-1]]
        for high, low in pairs:
            gap = int(total[high] - total[low])
            move = gap > 1 and _best_move(loads, np.flatnonzero(shard == high), np.flatnonzero(shard == low), gap)
            if move:
                break
        else:
            break
        shard[move[0]] = low
        if move[1] is not None:
            shard[move[1]] = high
        total = np.bincount(shard, loads, shards).astype(np.int64)
    return SlotMap(current.version + 1, shards, shard)


def with_slots(df: DataFrame, id_col: str, text_col: str, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot`` of each row.

    Size: UTF-8 bytes of the text (none if it is null) plus 8. The slot is the hash of the id; rows without an id are
    spread by the checksum of their text.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit("").cast("binary"))
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    key = F.coalesce("doc_id", "text_crc32")
    return rows.withColumn("virtual_slot", F.pmod(F.xxhash64(key), F.lit(slots)).cast("int"))


def shard_documents(
    df: DataFrame,
    shards: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    slots: int = SLOTS,
    folder: str | None = None,
) -> DataFrame:
    """Every row with its shard; shards are near equal in bytes.

    The rows' hashes name virtual slots, the bytes of each slot are summed, and the latest map under ``folder`` (the
    even one if there is none) is edited into a new saved version for these bytes. Returns ``doc_id, size, text_crc32,
    law, shard, slot, grown_shard, virtual_slot, map_version``: ``slot`` counts the rows of a shard from 0 without gaps.

    Null or empty texts have size 8 and checksum 0; null ids are placed by their text; repeated rows share a slot, so
    a repeated id weighs on one shard. An empty table gives no rows (and a map). Other columns are not looked at.

    Only the sums of the slots, whose number is fixed, reach the driver. Positions come from the counts of each shard
    and input partition, so neither a hot shard nor a hot id is numbered by one task.
    """
    spark = df.sparkSession
    fresh = folder is None
    folder = folder or scratch_path(spark, "slot-map")
    placed = with_slots(df, id_col, text_col, slots).withColumn("part", F.spark_partition_id())
    placed = stored(placed, "slotted")
    loads = np.zeros(slots, np.int64)
    for row in placed.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect():
        loads[row.virtual_slot] = row.bytes
    current = first_map(shards, slots)
    if fresh:
        current.save(spark, folder)
    else:
        current = load_map(spark, folder)
    chosen = rebalance(current, loads, shards)
    chosen.save(spark, folder)
    table = spark.createDataFrame(list(enumerate(chosen.shard.tolist())), "virtual_slot int, shard int")
    placed = placed.join(F.broadcast(table), "virtual_slot")
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "part")
        .agg(F.count("*").alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32")
    return (
        placed.withColumn("place", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "part"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("offset") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
            F.lit(chosen.version).alias("map_version"),
        )
    )
