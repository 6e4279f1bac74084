"""Dataset profiling and inference: what a table holds, and what a model could learn from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.columns import (
    local_rows,
    long_rows,
    numeric_columns,
    one_row,
    require_columns,
    string_columns,
    value_of,
)
from tidemill.functions.ranking import exact_quantiles

# Well-known names of a target column, in order of preference.
TARGET_NAMES = ["target", "label", "class", "y", "output", "result", "outcome"]

# The messages of the dataset check.
VALID_MESSAGE = "Dataset validation successful"
EMPTY_MESSAGE = "Dataset is empty"
FEW_ROWS_MESSAGE = "Dataset has fewer than 10 samples"
FEW_COLUMNS_MESSAGE = "Dataset needs at least 2 columns (features and target)"
MISSING_WARNING = "Columns with >50% missing values: "
NO_NUMERIC_WARNING = "Dataset has no numeric columns, which might limit model choices"

PREVIEW_ROWS = 5
# Relative standard error of a distinct-count sketch.
SKETCH_ERROR = 0.02
# Estimated distinct values from which on a column has certainly more than ten.
MANY_VALUES = 100


def missing_share(df: DataFrame, name: str) -> Column:
    return F.avg(value_of(df, name).isNull().cast("int"))


def distinct_count(df: DataFrame, name: str, approximate: bool = False) -> Column:
    value = value_of(df, name)
    return F.approx_count_distinct(value) if approximate else F.countDistinct(value)


def dataset_info(df: DataFrame) -> DataFrame:
    """One row: size, column names and classes, and whether any value is missing."""
    any_missing = F.lit(False)
    for c in df.columns:
        any_missing = any_missing | value_of(df, c).isNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.bool_or(any_missing).alias("has_missing")).select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        _names(df.columns).alias("column_names"),
        _names([f.dataType.simpleString() for f in df.schema.fields]).alias("column_types"),
        F.coalesce("has_missing", F.lit(False)).alias("has_missing_values"),
        _names(numeric_columns(df)).alias("numeric_columns"),
        _names(string_columns(df)).alias("categorical_columns"),
    )


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    return df.limit(rows)


def validate_dataset(df: DataFrame) -> DataFrame:
    """One row ``(valid, message, warnings)``: is the table fit for training?"""
    shares = {f"m{i}": missing_share(df, c) for i, c in enumerate(df.columns)}
    counted = df.agg(F.count(F.lit(1)).alias("n"), *[e.alias(a) for a, e in shares.items()])
    message = (
        F.when(F.col("n") == 0, EMPTY_MESSAGE)
        .when(F.col("n") < 10, FEW_ROWS_MESSAGE)
        .when(F.lit(len(df.columns) < 2), FEW_COLUMNS_MESSAGE)
        .otherwise(VALID_MESSAGE)
    )
    sparse = F.array_compact(
        F.array(*[F.when(F.col(f"m{i}") > 0.5, F.lit(c)) for i, c in enumerate(df.columns)])
    )
    sparse_warning = F.when(F.size(sparse) > 0, F.concat(F.lit(MISSING_WARNING), F.concat_ws(", ", sparse)))
    numeric_warning = F.when(F.lit(not numeric_columns(df)), F.lit(NO_NUMERIC_WARNING))
    valid = message == VALID_MESSAGE
    return counted.select(
        valid.alias("valid"),
        message.alias("message"),
        F.when(valid, F.array_compact(F.array(sparse_warning, numeric_warning)))
        .otherwise(F.array().cast("array<string>"))
        .alias("warnings"),
    )


def missing_rate(df: DataFrame) -> DataFrame:
    """``(column, missing_rate)``, one pass over the table."""
    wide = df.agg(*[missing_share(df, c).alias(f"m{i}") for i, c in enumerate(df.columns)])
    return wide.select(long_rows({c: {"missing_rate": F.col(f"m{i}")} for i, c in enumerate(df.columns)}))


def infer_target(df: DataFrame) -> DataFrame:
    """One row ``(target_column)``; null when no column looks like a target."""
    known = next((name for name in TARGET_NAMES if name in df.columns), None)
    if known is not None or len(df.columns) < 2:
        return df.sparkSession.range(1).select(F.lit(known).cast("string").alias("target_column"))
    # A sketch that estimates more than MANY_VALUES has that many registers in use, so the column has at least ten
    # values for certain: only the others are counted, and their few values leave little to shuffle.
    estimates = df.agg(*[distinct_count(df, c, True).alias(f"d{i}") for i, c in enumerate(df.columns)]).first()
    few_valued = [(i, c) for i, c in enumerate(df.columns) if estimates[i] <= MANY_VALUES]
    if not few_valued:
        return df.sparkSession.range(1).select(F.lit(None).cast("string").alias("target_column"))
    counted = df.agg(
        F.count(F.lit(1)).alias("n"), *[distinct_count(df, c).alias(f"d{i}") for i, c in few_valued]
    )
    # position before name: the first of equal counts wins
    fewest = F.array_min(
        F.array(
            *[
                F.struct(F.col(f"d{i}").alias("d"), F.lit(i).alias("position"), F.lit(c).alias("name"))
                for i, c in few_valued
            ]
        )
    )
    few = (fewest["d"] < 10) & (F.try_divide(fewest["d"], F.col("n")) < 0.05)
    return counted.select(F.when(few, fewest["name"]).alias("target_column"))


def sketched_distinct(df: DataFrame, columns: list[str], limits: list[float]) -> dict[str, float]:
    """Distinct values of each column, exact where an estimate could fall on the wrong side of one of ``limits``.

    One pass sketches all columns; no row is copied for it. Only a column whose estimate is within five standard errors
    of a limit is counted, in an aggregate of its own.
    """
    if not columns:
        return {}
    found = one_row(df, {c: F.approx_count_distinct(value_of(df, c), SKETCH_ERROR) for c in columns})
    for c, estimate in found.items():
        if any(abs(estimate - limit) <= 5 * SKETCH_ERROR * max(estimate, limit) for limit in limits):
            found[c] = df.agg(F.countDistinct(value_of(df, c))).first()[0]
    return found


def suggest_features(df: DataFrame, target: str, approximate: bool = False) -> DataFrame:
    """``(position, feature)``: columns that are filled enough and not nearly unique.

    With ``approximate`` the sketches alone decide.
    """
    require_columns(df, [target])
    features = [c for c in df.columns if c != target]
    stats = one_row(df, {None: F.count(F.lit(1))} | {c: missing_share(df, c) for c in features})
    rows = stats[None]
    filled = [c for c in features if rows and stats[c] < 0.5]
    distinct = sketched_distinct(df, filled, [] if approximate else [0.95 * rows])
    kept = [(df.columns.index(c), c) for c in filled if distinct[c] / rows < 0.95]
    return local_rows(df.sparkSession, kept, "position int, feature string")


def detect_task(df: DataFrame, target: str, approximate: bool = False) -> DataFrame:
    """One row ``(task)``: classification or regression, judged by the target values."""
    require_columns(df, [target])
    kind = df.schema[target].dataType
    if not isinstance(kind, T.NumericType):
        return df.sparkSession.range(1).select(F.lit("classification").alias("task"))
    value = value_of(df, target)
    rounded = F.lit(True) if isinstance(kind, T.IntegralType) else F.max(F.abs(value - F.round(value))) <= 1e-5
    found = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(rounded, F.lit(True)).alias("integer_like")).first()
    # only which side of these limits the number of values is on: a column of many values is sketched, not shuffled
    limits = [10, 20, 0.05 * found["n"]]
    values = sketched_distinct(df, [target], [] if approximate else limits)[target]
    classes = values < 10 or found["n"] and values / found["n"] < 0.05 or found["integer_like"] and values < 20
    return local_rows(df.sparkSession, [("classification" if classes else "regression",)], "task string")


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column, count, mean, std, min, q25, q50, q75, max)`` per numeric column, quartiles exact."""
    columns = columns or numeric_columns(df)
    stats = df.agg(
        *[
            e.alias(f"{a}{i}")
            for i, c in enumerate(columns)
            for a, e in {
                "n": F.count(value_of(df, c)),
                "avg": F.avg(value_of(df, c)),
                "sd": F.stddev_samp(value_of(df, c)),
                "lo": F.min(value_of(df, c).cast("double")),
                "hi": F.max(value_of(df, c).cast("double")),
            }.items()
        ]
    )
    rows = {
        c: {
            "count": F.col(f"n{i}"),
            "mean": F.col(f"avg{i}"),
            "std": F.col(f"sd{i}"),
            "min": F.col(f"lo{i}"),
            "max": F.col(f"hi{i}"),
        }
        for i, c in enumerate(columns)
    }
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    q = F.col("q")
    # one row per column on both sides
    return (
        stats.select(long_rows(rows))
        .join(F.broadcast(quartiles.select("column", q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"))), "column", "left")
        .select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
    )


def value_frequencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value string, n)`` over non-null values; a hot value is combined before the shuffle."""
    rows = {c: {"value": value_of(df, c).cast("string")} for c in columns}
    return (
        df.select(long_rows(rows))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(frequencies: DataFrame) -> DataFrame:
    """``(column, unique_values, most_common)``; among equally frequent values the smallest."""
    return frequencies.groupBy("column").agg(
        F.count(F.lit(1)).alias("unique_values"),
        F.min(F.struct((-F.col("n")).alias("rank"), "value"))["value"].alias("most_common"),
    )


def feature_statistics(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """``(column, mean, min, max, std, unique_values, most_common)``; the part of the other class is null."""
    require_columns(df, [*numeric, *categorical])
    parts = []
    if numeric:
        wide = df.agg(
            *[
                e.alias(f"{a}{i}")
                for i, c in enumerate(numeric)
                for a, e in {
                    "avg": F.avg(value_of(df, c)),
                    "lo": F.min(value_of(df, c).cast("double")),
                    "hi": F.max(value_of(df, c).cast("double")),
                    "sd": F.stddev_samp(value_of(df, c)),
                }.items()
            ]
        )
        rows = {
            c: {"mean": F.col(f"avg{i}"), "min": F.col(f"lo{i}"), "max": F.col(f"hi{i}"), "std": F.col(f"sd{i}")}
            for i, c in enumerate(numeric)
        }
        parts.append(wide.select(long_rows(rows)))
    if categorical:
        parts.append(most_frequent(value_frequencies(df, categorical)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def unique_values(df: DataFrame, column: str) -> DataFrame:
    """``(value)``: the distinct non-null values."""
    return df.select(value_of(df, column).alias("value")).where(F.col("value").isNotNull()).distinct()


def _names(names: list[str]) -> Column:
    return F.array(*[F.lit(n) for n in names]).cast("array<string>")
