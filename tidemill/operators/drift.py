"""Distribution drift between a reference table and a current one."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import (
    bucket_of,
    long_rows,
    numeric_columns,
    string_columns,
    total,
    value_sql,
)
from tidemill.functions.ranking import exact_quantiles, ks_statistic
from tidemill.operators.profile import describe, missing_rate, value_frequencies

ALPHA = 0.05
DATASET_SHARE = 0.5
PSI_BINS = 10
PSI_FLOOR = 1e-6

# Score bands.
SCORE_BANDS = {"yellow": 0.1, "red": 0.2}
FEATURE_BANDS = {"yellow": 0.3, "red": 0.5}
TARGET = "target"

KS_TERMS = 100


def ks_p_value(statistic: Column, n: Column, m: Column) -> Column:
    """Asymptotic Kolmogorov distribution of the two-sample distance."""
    squared = statistic * statistic * (n * m / (n + m))
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        lambda j: F.exp(F.lit(-2.0) * j * j * squared) * F.when(j % 2 == 1, 1.0).otherwise(-1.0),
    )
    tail = F.aggregate(terms, F.lit(0.0), lambda total_, term: total_ + term)
    # the alternating series does not converge near 0, where the p-value is 1
    return F.when(squared < 0.04, F.lit(1.0)).otherwise(F.least(F.greatest(F.lit(2.0) * tail, F.lit(0.0)), F.lit(1.0)))


def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str], alpha: float = ALPHA) -> DataFrame:
    """``(column, n_reference, n_current, statistic, p_value, drift_detected)`` by the Kolmogorov-Smirnov test."""
    distance = ks_statistic(reference, current, columns)
    p = ks_p_value(F.col("statistic"), F.col("n_reference").cast("double"), F.col("n_current").cast("double"))
    return distance.withColumn("p_value", p).withColumn("drift_detected", F.col("p_value") < alpha)


def category_counts(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, r, c)``: counts on both sides, 0 where a value is absent."""
    ours = value_frequencies(reference, columns).withColumnRenamed("n", "r")
    theirs = value_frequencies(current, columns).withColumnRenamed("n", "c")
    return ours.join(theirs, ["column", "value"], "full_outer").fillna(0, ["r", "c"])


def categorical_drift(reference: DataFrame, current: DataFrame, columns: list[str], alpha: float = ALPHA) -> DataFrame:
    """``(column, statistic, dof, p_value, total_variation, drift_detected)`` by the two-sample chi-square test.

    Per value with counts r of n and c of m the statistic gains ``(r m - c n)^2 / (n m (r + c))``, so one grouped
    sum after the totals is enough.
    """
    counts = category_counts(reference, current, columns)
    # one row per column
    totals = counts.groupBy("column").agg(F.sum("r").alias("n"), F.sum("c").alias("m"))
    cells = counts.join(F.broadcast(totals), "column").where((F.col("n") > 0) & (F.col("m") > 0))
    r, c = F.col("r").cast("double"), F.col("c").cast("double")
    n, m = F.col("n").cast("double"), F.col("m").cast("double")
    tested = cells.groupBy("column").agg(
        F.sum((r * m - c * n) * (r * m - c * n) / (n * m * (r + c))).alias("statistic"),
        (F.count(F.lit(1)) - 1).alias("dof"),
        (F.sum(F.abs(r / n - c / m)) / 2).alias("total_variation"),
    )
    p = chi_square_p_value("statistic", "dof")
    return tested.withColumn("p_value", p).withColumn("drift_detected", F.col("p_value") < alpha)


def chi_square_p_value(statistic: str, dof: str) -> Column:
    """Upper tail of the chi-square distribution; called on one row per column."""

    @F.pandas_udf("double")
    def upper_tail(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, k in parts:
            yield pd.Series([_chi_square_tail(float(a), int(b)) for a, b in zip(x, k)])

    return upper_tail(F.col(statistic), F.col(dof))


def _chi_square_tail(x: float, dof: int) -> float:
    if dof <= 0 or x <= 0:
        return 1.0
    a, half = dof / 2.0, x / 2.0
    scale = math.exp(-half + a * math.log(half) - math.lgamma(a))
    if half < a + 1:
        # lower series
        term = total_ = 1.0 / a
        k = a
        while abs(term) > abs(total_) * 1e-16:
            k += 1
            term *= half / k
            total_ += term
        return max(0.0, 1.0 - total_ * scale)
    # continued fraction (Lentz)
    b = half + 1 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 100_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / (an * d + b)
        c = b + an / c
        step = c * d
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return min(1.0, scale * h)


def column_drift(
    reference: DataFrame, current: DataFrame, columns: list[str] | None = None, alpha: float = ALPHA
) -> DataFrame:
    """``(column, kind, statistic, p_value, drift_detected)`` over numeric and string columns."""
    columns = columns or [c for c in reference.columns if c in current.columns and c != TARGET]
    numbers = [c for c in numeric_columns(reference) if c in columns]
    strings = [c for c in string_columns(reference) if c in columns]
    parts = []
    if numbers:
        parts.append(("numeric", numeric_drift(reference, current, numbers, alpha)))
    if strings:
        parts.append(("categorical", categorical_drift(reference, current, strings, alpha)))
    if not parts:
        raise ValueError("no columns to compare")
    tables = [
        df.select("column", F.lit(kind).alias("kind"), "statistic", "p_value", "drift_detected") for kind, df in parts
    ]
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def target_drift(
    reference: DataFrame, current: DataFrame, target: str = TARGET, alpha: float = ALPHA
) -> DataFrame | None:
    """Drift of the target; None when a side lacks it."""
    if target not in reference.columns or target not in current.columns:
        return None
    return column_drift(reference, current, [target], alpha)


def drift_summary(drift: DataFrame, share: float = DATASET_SHARE) -> DataFrame:
    """One row ``(number_of_columns, number_of_drifted_columns, drift_share, dataset_drift)``."""
    drifted = total(F.col("drift_detected").cast("int"))
    return drift.agg(F.count(F.lit(1)).alias("number_of_columns"), drifted.alias("number_of_drifted_columns")).select(
        "number_of_columns",
        "number_of_drifted_columns",
        F.try_divide("number_of_drifted_columns", "number_of_columns").alias("drift_share"),
        (F.try_divide("number_of_drifted_columns", "number_of_columns") >= share).alias("dataset_drift"),
    )


def _psi_term(actual: Column, expected: Column) -> Column:
    a, e = F.greatest(actual, F.lit(PSI_FLOOR)), F.greatest(expected, F.lit(PSI_FLOOR))
    return (a - e) * F.log(a / e)


def psi_numeric(reference: DataFrame, current: DataFrame, columns: list[str], bins: int = PSI_BINS) -> DataFrame:
    """``(column, psi)`` over the reference's exact quantile bins."""
    probs = [i / bins for i in range(1, bins)]
    edges = {r["column"]: sorted(set(r["q"])) for r in exact_quantiles(reference, columns, probs).collect()}

    def shares(df: DataFrame, name: str) -> DataFrame:
        values = {c: f"CAST({value_sql(df, c)} AS DOUBLE)" for c in edges}
        rows = {c: {"x": F.expr(x), "bin": bucket_of(x, edges[c])} for c, x in values.items()}
        binned = df.select(long_rows(rows)).where(F.col("x").isNotNull())
        return binned.groupBy("column", "bin").agg(F.count(F.lit(1)).alias(name))

    return _psi(shares(reference, "r").join(shares(current, "c"), ["column", "bin"], "full_outer").fillna(0, ["r", "c"]))


def psi_categorical(reference: DataFrame, current: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, psi)`` over the distinct values of both sides."""
    return _psi(category_counts(reference, current, columns))


def _psi(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("column").agg(F.sum("r").alias("n"), F.sum("c").alias("m"))
    cells = counts.join(F.broadcast(totals), "column").where((F.col("n") > 0) & (F.col("m") > 0))
    return cells.groupBy("column").agg(
        F.sum(_psi_term(F.col("c") / F.col("m"), F.col("r") / F.col("n"))).alias("psi")
    )


def quality_compare(reference: DataFrame, current: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sd, min, median, max and missing rate of both tables side by side."""
    columns = columns or [c for c in numeric_columns(reference) if c in numeric_columns(current)]

    def side(df: DataFrame, name: str) -> DataFrame:
        own = df.select(*columns)
        profile = describe(own, columns).join(F.broadcast(missing_rate(own)), "column")
        return profile.select(
            "column",
            *[F.col(c).alias(f"{name}_{c}") for c in ["count", "mean", "std", "min", "q50", "max", "missing_rate"]],
        )

    # one row per column on both sides
    return side(reference, "reference").join(F.broadcast(side(current, "current")), "column", "full_outer")


def severity(score: Column, bands: dict[str, float]) -> Column:
    """green, yellow or red; a band starts at its threshold."""
    return F.when(score >= bands["red"], "red").when(score >= bands["yellow"], "yellow").otherwise("green")


def drift_severity(scores: DataFrame, score: str = "score", bands: dict[str, float] = SCORE_BANDS) -> DataFrame:
    return scores.withColumn("severity", severity(F.col(score), bands))


def time_since_drift(detections: DataFrame, ts: str, now: Column) -> DataFrame:
    """One row ``(last_detection, seconds_since)``."""
    gap = (now.cast("timestamp_ntz") - F.col("last_detection").cast("timestamp_ntz")).cast("interval second")
    return detections.agg(F.max(ts).alias("last_detection")).select(
        "last_detection", gap.cast("decimal(20,6)").cast("double").alias("seconds_since")
    )

