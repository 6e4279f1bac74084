"""Drift between stored periods: quantile sketches and value counts by day, from which any two periods are compared.

A day is written once, when its rows are there; a comparison merges what is stored and reads no raw row. The distance
of two numeric distributions is off by at most ``error_bound()`` (with 99 % confidence); chi-square statistics of
categories are exact. ``operators.drift`` remains the exact form.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows, long_rows, value_of
from tidemill.operators.drift import ALPHA, chi_square_p_value, ks_p_value
from tidemill.sources.tables import read_if_exists

# Accuracy of a sketch (some 3 K numbers each), and points at which two of them are compared.
K, POINTS = 2000, 1000
# Rank error of these sketches at 99 % confidence is this over K to that power.
_ERROR, _POWER = 2.296, 0.9021

NUMBERS = "day date, column string, n bigint, sketch binary, batch string"
COUNTS = "day date, column string, value string, n bigint, batch string"


def error_bound(k: int = K, points: int = POINTS) -> float:
    """How far the distance of two merged sketches may be from the exact one."""
    return 2 * (_ERROR / k**_POWER + 1 / points)


def day_sketches(df: DataFrame, ts: str, columns: list[str], k: int = K) -> DataFrame:
    """``(day, column, n, sketch)`` of numeric columns: one pass, sketches are merged before the shuffle."""
    rows = {c: {"value": value_of(df, c).cast("double")} for c in columns}
    long = df.select(F.to_date(ts).alias("day"), long_rows(rows)).where(F.col("value").isNotNull())
    return long.groupBy("day", "column").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("value", F.lit(k)).alias("sketch"))


def day_counts(df: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """``(day, column, value, n)`` of categorical columns."""
    rows = {c: {"value": value_of(df, c).cast("string")} for c in columns}
    long = df.select(F.to_date(ts).alias("day"), long_rows(rows)).where(F.col("value").isNotNull())
    return long.groupBy("day", "column", "value").agg(F.count(F.lit(1)).alias("n"))


class DriftStore:
    """Sketches and counts by day under one folder; what a batch wrote is written anew if it comes again."""

    def __init__(self, spark: SparkSession, root: str, k: int = K):
        self.spark, self.root, self.k = spark, root.rstrip("/"), k

    def append(self, df: DataFrame, ts: str, numeric: list[str], categorical: list[str], batch: str) -> None:
        """Store the days of a batch of rows. A day may come in several batches."""
        if numeric:
            self._write(day_sketches(df, ts, numeric, self.k), "numbers", batch)
        if categorical:
            self._write(day_counts(df, ts, categorical), "counts", batch)

    def _write(self, table: DataFrame, kind: str, batch: str) -> None:
        # a folder for a batch; days are found by the ranges that the files keep of them
        table.sortWithinPartitions("day").write.mode("overwrite").parquet(f"{self.root}/{kind}/batch={batch}")

    def _read(self, kind: str, schema: str, period: tuple[str, str]) -> DataFrame:
        path = f"{self.root}/{kind}"
        found = read_if_exists(partial(_parquet, self.spark, schema), path)
        table = local_rows(self.spark, [], schema) if found is None else found
        first, last = (F.lit(d).cast("date") for d in period)
        return table.where((F.col("day") >= first) & (F.col("day") < last))

    def distribution(self, period: tuple[str, str]) -> DataFrame:
        """``(column, n, sketch)`` of a period, its end not included."""
        days = self._read("numbers", NUMBERS, period)
        return days.groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(self.k)).alias("sketch"))

    def numeric_drift(self, reference: tuple[str, str], current: tuple[str, str], alpha: float = ALPHA) -> DataFrame:
        """``(column, n_reference, n_current, statistic, p_value, drift_detected)`` of two periods."""
        ours = self.distribution(reference).select("column", F.col("n").alias("n_reference"), F.col("sketch").alias("_r"))
        theirs = self.distribution(current).select("column", F.col("n").alias("n_current"), F.col("sketch").alias("_c"))
        both = ours.join(theirs, "column")
        shares = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
        # each quantile stands for as many rows as the next; both sides are summed up along the values
        points = [_weighted(F.kll_sketch_get_quantile_double(s, shares), a) for s, a in (("_r", 1.0), ("_c", -1.0))]
        sizes = both.select("column", "n_reference", "n_current")
        steps = both.select("column", F.inline(F.concat(*points)))
        upto = W.partitionBy("column").orderBy("x").rangeBetween(W.unboundedPreceding, W.currentRow)
        apart = steps.select("column", (F.abs(F.sum("share").over(upto)) / POINTS).alias("apart"))
        distance = apart.groupBy("column").agg(F.max("apart").alias("statistic"))
        p = ks_p_value(F.col("statistic"), F.col("n_reference").cast("double"), F.col("n_current").cast("double"))
        found = sizes.join(distance, "column").withColumn("p_value", p)
        return found.withColumn("drift_detected", F.col("p_value") < alpha)

    def categorical_drift(self, reference: tuple[str, str], current: tuple[str, str], alpha: float = ALPHA) -> DataFrame:
        """``(column, statistic, dof, p_value, drift_detected)`` of two periods, as the exact form gives it."""
        ours, theirs = (self._read("counts", COUNTS, p).groupBy("column", "value").agg(F.sum("n").alias(a)) for p, a in ((reference, "r"), (current, "c")))
        counts = ours.join(theirs, ["column", "value"], "full_outer").fillna(0, ["r", "c"])
        totals = counts.groupBy("column").agg(F.sum("r").alias("a"), F.sum("c").alias("b"))
        r, c, a, b = (F.col(x).cast("double") for x in ("r", "c", "a", "b"))
        cells = counts.join(F.broadcast(totals), "column").where("a > 0 AND b > 0")
        tested = cells.groupBy("column").agg(
            F.sum((r * b - c * a) * (r * b - c * a) / (a * b * (r + c))).alias("statistic"), (F.count(F.lit(1)) - 1).alias("dof")
        )
        return tested.withColumn("p_value", chi_square_p_value("statistic", "dof")).withColumn("drift_detected", F.col("p_value") < alpha)

    def column_drift(self, reference: tuple[str, str], current: tuple[str, str], alpha: float = ALPHA) -> DataFrame:
        """``(column, kind, statistic, p_value, drift_detected)`` of everything that is stored."""
        parts = [("numeric", self.numeric_drift(reference, current, alpha)), ("categorical", self.categorical_drift(reference, current, alpha))]
        tables = [t.select("column", F.lit(kind).alias("kind"), "statistic", "p_value", "drift_detected") for kind, t in parts]
        return tables[0].unionByName(tables[1])


def _parquet(spark: SparkSession, schema: str, path: str) -> DataFrame:
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def _weighted(values: Column, weight: float) -> Column:
    return F.transform(values, lambda x: F.struct(x.alias("x"), F.lit(weight).alias("share")))
