"""Seeded train/test splits of exact size that do not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows
from tidemill.functions.ranking import smallest_by_hash
from tidemill.operators.profile import sketched_distinct

# Allowed share of test rows and its default.
MIN_TEST, MAX_TEST, DEFAULT_TEST = 0.1, 0.9, 0.2
STRATIFY_CLASSES = 10


def random_split(
    df: DataFrame, key: str, test_size: float = DEFAULT_TEST, seed: int = 42, stratify: str | None = None
) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(test_size * rows)`` rows, chosen by the hash of a unique ``key``.

    With ``stratify`` every class gives its share, and the rows left over by rounding down go to the classes with
    the largest remainders (ties to the smaller label). Rows without a label are never test rows.
    """
    check_test_size(test_size)
    if stratify is None:
        rows = df.count()
        quota = local_rows(df.sparkSession, [(split_size(rows, test_size),)], "quota bigint")
        flagged = smallest_by_hash(df, key, seed, quota)
    else:
        # one row per class, and a class column is one with few values
        labelled, unlabelled = df.where(F.col(stratify).isNotNull()), df.where(F.col(stratify).isNull())
        flagged = smallest_by_hash(labelled, key, seed, class_quota(labelled, stratify, test_size), [stratify])
        flagged = flagged.unionByName(unlabelled.withColumn("selected", F.lit(False)))
    return flagged.withColumnRenamed("selected", "is_test")


def class_quota(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """``(label, quota)``: test rows per class by largest remainder."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = W.partitionBy(F.lit(1))
    rows = F.sum("n").over(everything)
    shared = counts.withColumns({"test_rows": F.ceil(F.lit(test_size) * rows - 1e-9), "share": F.col("n") / rows})
    shared = shared.withColumn("exact", F.col("test_rows") * F.col("share")).withColumn("base", F.floor(F.col("exact") + 1e-9))
    by_remainder = W.partitionBy(F.lit(1)).orderBy(F.round(F.col("exact") - F.col("base"), 9).desc(), F.col(label))
    left = F.col("test_rows") - F.sum("base").over(everything)
    extra = F.when(F.row_number().over(by_remainder) <= left, 1).otherwise(0)
    return shared.select(label, (F.col("base") + extra).alias("quota"))


def split_size(rows: int, test_size: float) -> int:
    return math.ceil(test_size * rows - 1e-9)


def check_test_size(test_size: float) -> None:
    if not MIN_TEST <= test_size <= MAX_TEST:
        raise ValueError(f"test_size {test_size} is not between {MIN_TEST} and {MAX_TEST}")


def should_stratify(df: DataFrame, label: str) -> bool:
    """A label with few classes is split class by class."""
    return sketched_distinct(df, [label], [STRATIFY_CLASSES])[label] < STRATIFY_CLASSES
