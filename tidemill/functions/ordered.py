"""Previous value and running sum along time, for keys that may hold a large share of all rows.

A plain window sorts one key in one task. These helpers cut every key into chunks of time, work inside a chunk,
and carry the end of each chunk to the next one through a table with one row per key and chunk. The chunk is a
column of the table that must not fall along the order; calls that share it share one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], chunk: str
) -> DataFrame:
    """Add ``prev_<column>``: the value on the previous row of the key."""
    keys = list(keys)
    inside = W.partitionBy(*keys, chunk).orderBy(*order)
    own = df.withColumns({f"_in_{c}": F.lag(c).over(inside) for c in columns}).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    row = F.struct(*[F.col(c) for c in columns])
    last = (
        df.groupBy(*keys, chunk)
        .agg(F.max_by(row, F.struct(*order)).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(W.partitionBy(*keys).orderBy(chunk)))
        .select(*keys, chunk, "_carry")
    )
    joined = own.join(last, keys + [chunk], "left")
    previous = {
        f"prev_{c}": F.when(F.col("_first"), F.col(f"_carry.{c}")).otherwise(F.col(f"_in_{c}")) for c in columns
    }
    return joined.withColumns(previous).drop("_carry", "_first", *[f"_in_{c}" for c in columns])


def with_running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column], chunk: str
) -> DataFrame:
    """Add for each name the sum of its value over the key's rows up to and including this one."""
    keys = list(keys)
    valued = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    inside = W.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*keys).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        valued.groupBy(*keys, chunk)
        .agg(*[F.sum(f"_v_{n}").alias(f"_total_{n}") for n in values])
        .withColumns({f"_before_{n}": F.coalesce(F.sum(f"_total_{n}").over(before), F.lit(0)) for n in values})
        .select(*keys, chunk, *[f"_before_{n}" for n in values])
    )
    own = valued.withColumns({f"_own_{n}": F.sum(f"_v_{n}").over(inside) for n in values})
    return (
        own.join(carried, keys + [chunk])
        .withColumns({n: F.col(f"_own_{n}") + F.col(f"_before_{n}") for n in values})
        .drop(*[f"{p}{n}" for p in ("_v_", "_own_", "_before_") for n in values])
    )


def with_running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, chunk: str
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the key's rows up to and including this one."""
    return with_running_sums(df, keys, order, {name: value}, chunk)
