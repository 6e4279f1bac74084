"""Categories by the million: a dictionary table numbered in parallel, and sparse features joined from it.

``operators.features`` makes a column for each category and needs them all on the driver; here a category is a row of a
table, and a row of features is a list of places in one long sparse vector.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.columns import quoted, require_columns, value_of
from tidemill.functions.lineage import scratch_path
from tidemill.operators.features import EMPTY_TEXT, fit_numeric, scaled
from tidemill.operators.profile import most_frequent, value_frequencies


@dataclass(frozen=True)
class Dictionary:
    """``path``: a table ``(column, value, n, index)``, values of a column numbered from 0 in their order.

    ``numeric``: mean and deviation by column. ``start``, ``size`` and ``mode`` of each categorical column: its first
    place in the sparse vector, its number of categories, and what stands for a missing value.
    """

    path: str
    numeric: dict[str, dict[str, float]]
    start: dict[str, int]
    size: dict[str, int]
    mode: dict[str, str]

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.size.values())

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def fit_dictionary(df: DataFrame, categorical: list[str], path: str | None = None, numeric: list[str] | None = None) -> Dictionary:
    """Number the categories of all columns, by ranges of values that are numbered side by side.

    Values are counted, range-partitioned by column and value, and sorted within each range; a range's first number is
    the number of values in the ranges before it. What reaches the driver is one row for each column.
    """
    require_columns(df, [*categorical, *(numeric or [])])
    spark = df.sparkSession
    path = path or scratch_path(spark, "dictionary")
    frequencies = value_frequencies(df, categorical)
    # written once, so that a value keeps its range and its place there
    ranged = scratch_path(spark, "ranges")
    ordered = frequencies.repartitionByRange("column", "value").sortWithinPartitions("column", "value")
    ordered.withColumn("_id", F.monotonically_increasing_id()).write.parquet(ranged)
    values = spark.read.parquet(ranged).withColumn("_range", F.shiftright("_id", 33))
    place = F.col("_id").bitwiseAND((1 << 33) - 1)
    # a row for each range and column in it
    parts = values.groupBy("column", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"))
    before = W.partitionBy("column").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    numbered = values.join(parts.select("column", "_range", "_first", "_before"), ["column", "_range"])
    numbered.select("column", "value", "n", (place - F.col("_first") + F.col("_before")).alias("index")).write.parquet(path)
    found = {r["column"]: r for r in most_frequent(spark.read.parquet(path).select("column", "value", "n")).collect()}
    numbers = fit_numeric(df, numeric) if numeric else {}
    size = {c: found[c]["unique_values"] if c in found else 0 for c in categorical}
    start, at = {}, len(numbers)
    for c in categorical:
        start[c], at = at, at + size[c]
    mode = {c: found[c]["most_common"] if c in found else EMPTY_TEXT for c in categorical}
    return Dictionary(path, numbers, start, size, mode)


def sparse_features(df: DataFrame, fitted: Dictionary, keep: list[str], drop_first: bool = False) -> DataFrame:
    """The columns ``keep``, and ``size``, ``indices`` and ``values`` of a sparse vector.

    Scaled numbers come first, then a 1 at the place of each column's category; a missing value counts as the most frequent
    one, an unknown category has no place. With ``drop_first`` the first category of a column has none either. Each
    column is one join with its part of the dictionary; hot categories are split by adaptive execution.
    """
    table = fitted.table(df.sparkSession)
    out = df.select(
        F.struct(*[F.col(quoted(c)) for c in keep]).alias("_keep"),
        *[scaled(value_of(df, c), p["mean"], p["sd"]).alias(f"_x{i}") for i, (c, p) in enumerate(fitted.numeric.items())],
        *[F.coalesce(value_of(df, c).cast("string"), F.lit(fitted.mode[c])).alias(f"_c{i}") for i, c in enumerate(fitted.start)],
    )
    for i, (c, start) in enumerate(fitted.start.items()):
        part = table.where(F.col("column") == c)
        if drop_first:
            part = part.where("index > 0")
        part = part.select(F.col("value").alias(f"_c{i}"), (F.col("index") + start).alias(f"_i{i}"))
        out = out.join(part, f"_c{i}", "left").drop(f"_c{i}")
    places = [F.lit(i).cast("bigint") for i in range(len(fitted.numeric))] + [F.col(f"_i{i}") for i in range(len(fitted.start))]
    entries = F.array(*places)
    known = F.array_compact(entries)
    numbers = [F.col(f"_x{i}") for i in range(len(fitted.numeric))]
    ones = F.transform(F.slice(known, len(numbers) + 1, max(len(fitted.start), 1)), lambda i: F.lit(1.0))
    values = F.concat(F.array(*numbers), ones) if numbers else ones
    return out.select("_keep.*", F.lit(fitted.width).cast("bigint").alias("size"), known.alias("indices"), values.alias("values"))
