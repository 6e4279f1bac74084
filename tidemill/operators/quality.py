"""Expectation suites: derived from one table, checked on another in one pass, and row rules."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.columns import (
    AGG_WIDTH,
    local_rows,
    number,
    numeric_columns,
    one_row,
    quoted,
    string_columns,
    text,
    total,
    value_of,
    value_sql,
    when_true,
)
from tidemill.operators.profile import sketched_distinct

# The expectation types of a suite file.
ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMN_COUNT = "expect_table_column_count_to_equal"
COLUMN_LIST = "expect_table_columns_to_match_ordered_list"
IN_SET = "expect_column_values_to_be_in_set"
NOT_NULL = "expect_column_values_to_not_be_null"
VALUES_BETWEEN = "expect_column_values_to_be_between"
MEAN_BETWEEN = "expect_column_mean_to_be_between"
KNOWN_TYPES = {ROW_COUNT, COLUMN_COUNT, COLUMN_LIST, IN_SET, NOT_NULL, VALUES_BETWEEN, MEAN_BETWEEN}

# Tolerances of derived expectations.
ROW_GROWTH = 2
SET_SHARE = 0.1
SET_MOSTLY = 0.95
RANGE_SDS = 3
RANGE_MOSTLY = 0.99
NULL_SLACK = 0.05

# Inclusive ranges per column of the predefined row schemas; no value may be missing.
IRIS_RANGES = {
    "sepal_length": (4.0, 8.0),
    "sepal_width": (2.0, 4.5),
    "petal_length": (1.0, 7.0),
    "petal_width": (0.1, 2.5),
}
HOUSING_RANGES = {
    "median_income": (0.0, 15.0),
    "housing_median_age": (1.0, 52.0),
    "total_rooms": (6.0, 37937.0),
    "total_bedrooms": (1.0, 6445.0),
    "population": (3.0, 35682.0),
    "households": (1.0, 6082.0),
    "latitude": (32.5, 42.0),
    "longitude": (-124.3, -114.0),
}
ROW_SCHEMAS = {"iris": IRIS_RANGES, "california_housing": HOUSING_RANGES}
MODEL_SCHEMAS = {"iris-classifier": "iris", "california-housing-model": "california_housing"}
IRIS_ALIASES = {
    "sepal length (cm)": "sepal_length",
    "sepal width (cm)": "sepal_width",
    "petal length (cm)": "petal_length",
    "petal width (cm)": "petal_width",
}

# Default size up to which a value set lives in the suite itself.
INLINE_SET = 10_000

SUITE_ROW = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("expectation_type", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("min_value", T.DoubleType()),
        T.StructField("max_value", T.DoubleType()),
        T.StructField("mostly", T.DoubleType()),
        T.StructField("expected_columns", T.ArrayType(T.StringType())),
        T.StructField("value_set", T.ArrayType(T.StringType())),
    ]
)


@dataclass
class Suite:
    """Expectations as ``{expectation_type, kwargs}``; ``large_sets`` maps a column to a one-column table ``value``."""

    dataset_name: str
    version: str
    expectations: list[dict]
    created_at: str = field(default_factory=lambda: datetime.now(timezone.utc).isoformat())
    large_sets: dict[str, DataFrame] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(
            {
                "dataset_name": self.dataset_name,
                "version": self.version,
                "created_at": self.created_at,
                "expectations": self.expectations,
            }
        )

    @classmethod
    def from_json(cls, text: str) -> Suite:
        doc = json.loads(text)
        return cls(doc["dataset_name"], doc["version"], doc["expectations"], doc["created_at"])

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per expectation; sizes and column counts appear as equal bounds."""
        rows = []
        for i, e in enumerate(self.expectations):
            k = e["kwargs"]
            rows.append(
                (
                    i,
                    e["expectation_type"],
                    k.get("column"),
                    _double(k.get("min_value", k.get("value"))),
                    _double(k.get("max_value", k.get("value"))),
                    _double(k.get("mostly")),
                    k.get("column_list"),
                    k.get("value_set"),
                )
            )
        return local_rows(spark, rows, SUITE_ROW)


def generate_suite(
    df: DataFrame,
    dataset_name: str,
    version: str = "v1",
    existing: Suite | None = None,
    overwrite: bool = False,
    inline_set: int | None = None,
) -> Suite:
    """Derive the expectations of a table; an existing suite is kept unless ``overwrite``.

    Value sets of up to ``inline_set`` values are part of the suite's text; larger ones are tables beside it, which a
    suite store keeps with it.
    """
    if existing is not None and not overwrite:
        return existing
    strings, numbers = string_columns(df), numeric_columns(df)
    wanted: dict = {("rows", ""): F.count(F.lit(1))}
    for c in [*strings, *numbers]:
        wanted[("count", c)] = F.count(value_of(df, c))
    for c in numbers:
        v = value_of(df, c)
        wanted |= {
            ("min", c): F.min(v.cast("double")),
            ("max", c): F.max(v.cast("double")),
            ("mean", c): F.avg(v),
            ("sd", c): F.stddev_samp(v),
        }
    stats = one_row(df, wanted)
    rows = stats[("rows", "")]
    inline_set = INLINE_SET if inline_set is None else inline_set
    distinct = sketched_distinct(df, strings, [SET_SHARE * rows, inline_set])
    sets = [c for c in strings if rows and distinct[c] / rows < SET_SHARE]
    inline = [c for c in sets if distinct[c] <= inline_set]
    values = one_row(df, {c: F.sort_array(F.collect_set(quoted(c))) for c in inline}) if inline else {}

    def filled(c: str) -> dict:
        null_share = 1 - stats[("count", c)] / rows if rows else 0.0
        return _expect(NOT_NULL, column=c, mostly=max(1.0 - (null_share + NULL_SLACK), 0.0))

    expectations = [
        _expect(ROW_COUNT, min_value=1, max_value=rows * ROW_GROWTH),
        _expect(COLUMN_COUNT, value=len(df.columns)),
        _expect(COLUMN_LIST, column_list=df.columns),
    ]
    for c in df.columns:
        if c in strings:
            if c in inline:
                expectations.append(_expect(IN_SET, column=c, value_set=list(values[c]), mostly=SET_MOSTLY))
            elif c in sets:
                expectations.append(_expect(IN_SET, column=c, value_table=True, mostly=SET_MOSTLY))
            expectations.append(filled(c))
        elif c in numbers:
            low, high, mean = (stats[(s, c)] for s in ("min", "max", "mean"))
            sd = stats[("sd", c)]
            known = None not in (low, high, mean, sd)
            expectations += [
                _expect(
                    VALUES_BETWEEN,
                    column=c,
                    min_value=low - RANGE_SDS * sd if known else None,
                    max_value=high + RANGE_SDS * sd if known else None,
                    mostly=RANGE_MOSTLY,
                ),
                _expect(
                    MEAN_BETWEEN,
                    column=c,
                    min_value=float(mean) - sd if known else None,
                    max_value=float(mean) + sd if known else None,
                ),
                filled(c),
            ]
    large = {c: df.select(F.col(quoted(c)).alias("value")).dropna().distinct() for c in sets if c not in inline}
    return Suite(dataset_name, version, expectations, large_sets=large)


def validate(df: DataFrame, suite: Suite) -> DataFrame:
    """``(position, expectation_type, column, success, observed, error)``, one row per known expectation.

    All expectations share one aggregate over the table. ``mostly`` is a share of the non-null values, and a
    column without values passes. Large value sets are compared by value counts.
    """
    checks = [(i, e) for i, e in enumerate(suite.expectations) if e["expectation_type"] in KNOWN_TYPES]
    by_table = [(i, e) for i, e in checks if e["expectation_type"] == IN_SET and e["kwargs"].get("value_table")]
    in_one_pass = [pair for pair in checks if pair not in by_table]
    parts = []
    for start in range(0, len(in_one_pass), AGG_WIDTH):
        group = in_one_pass[start : start + AGG_WIDTH]
        observed = df.agg(*[_observed(df, e).alias(f"o{i}") for i, e in group])
        verdicts = ", ".join(_verdict(df, i, e, f"o{i}") for i, e in group)
        parts.append(observed.selectExpr(f"inline(array({verdicts}))"))
    for i, e in by_table:
        column = e["kwargs"]["column"]
        if column not in df.columns:
            parts.append(df.sparkSession.range(1).selectExpr(f"inline(array({_verdict(df, i, e, 'null')}))"))
            continue
        allowed = suite.large_sets[column].select("value", F.lit(1).alias("known"))
        share = (
            df.groupBy(F.col(quoted(column)).cast("string").alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .dropna()
            .join(allowed, "value", "left")
            .agg(F.try_divide(total(F.col("n") * F.coalesce("known", F.lit(0))), total(F.col("n"))).alias("o"))
        )
        parts.append(share.selectExpr(f"inline(array({_verdict(df, i, e, 'o')}))"))
    return reduce(DataFrame.unionByName, parts)


def summarize(results: DataFrame) -> DataFrame:
    """One row ``(passed, total_expectations, passing_expectations, failing_expectations, success_percent)``."""
    counted = results.agg(
        F.count(F.lit(1)).alias("total_expectations"), total(when_true(F.col("success"))).alias("passing_expectations")
    )
    failing = F.col("total_expectations") - F.col("passing_expectations")
    return counted.select(
        (failing == 0).alias("passed"),
        "total_expectations",
        "passing_expectations",
        failing.alias("failing_expectations"),
        F.when(F.col("total_expectations") > 0, F.col("passing_expectations") / F.col("total_expectations") * 100)
        .otherwise(0.0)
        .alias("success_percent"),
    )


def row_errors(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Add ``errors array<string>`` and ``is_valid``: every ranged column present, filled and within bounds."""
    checks = [F.lit(None).cast("string")]
    for name, (low, high) in ranges.items():
        if name not in df.columns:
            checks.append(F.lit(f"{name}: field required"))
            continue
        value = value_of(df, name)
        checks.append(
            F.when(value.isNull(), f"{name}: missing value")
            .when(value < low, f"{name}: below {low}")
            .when(value > high, f"{name}: above {high}")
        )
    return df.withColumn("errors", F.array_compact(F.array(*checks))).withColumn("is_valid", F.size("errors") == 0)


def schema_ranges(schema_type: str) -> dict[str, tuple[float, float]]:
    if schema_type not in ROW_SCHEMAS:
        raise ValueError(f"no row schema is named {schema_type}")
    return ROW_SCHEMAS[schema_type]


def model_ranges(model_name: str) -> dict[str, tuple[float, float]]:
    """The ranges of a model's requests; a model without a schema accepts everything."""
    schema = MODEL_SCHEMAS.get(model_name)
    return schema_ranges(schema) if schema else {}


def schema_verdict(checked: DataFrame) -> DataFrame:
    """One row ``(is_valid, invalid_rows)`` over the output of :func:`row_errors`; no rows are valid."""
    return checked.agg(
        F.coalesce(F.bool_and("is_valid"), F.lit(True)).alias("is_valid"),
        total(when_true(~F.col("is_valid"))).alias("invalid_rows"),
    )


def quarantine_split(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the check columns, and rejected rows with their errors."""
    checked = row_errors(df, ranges)
    return checked.where("is_valid").drop("errors", "is_valid"), checked.where("not is_valid").drop("is_valid")


def validation_failures(rejected: DataFrame, by: list[str]) -> DataFrame:
    return rejected.groupBy(*by).agg(F.count(F.lit(1)).alias("validation_failures"))


def rename_aliases(df: DataFrame, aliases: Mapping[str, str] = IRIS_ALIASES) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in aliases.items() if old in df.columns})


def _expect(kind: str, **kwargs) -> dict:
    return {"expectation_type": kind, "kwargs": kwargs}


def _double(value) -> float | None:
    return None if value is None else float(value)


def _problem(df: DataFrame, expectation: dict) -> str | None:
    column = expectation["kwargs"].get("column")
    if column is None:
        return None
    if column not in df.columns:
        return f"column {column} not found"
    numeric = expectation["expectation_type"] in (VALUES_BETWEEN, MEAN_BETWEEN)
    if numeric and column not in numeric_columns(df):
        return f"column {column} is not numeric"
    return None


def _observed(df: DataFrame, expectation: dict) -> Column:
    """The aggregate an expectation is judged by."""
    kind, kwargs = expectation["expectation_type"], expectation["kwargs"]
    if _problem(df, expectation):
        return F.expr("cast(null as double)")
    if kind == ROW_COUNT:
        return F.expr("cast(count(1) as double)")
    if kind in (COLUMN_COUNT, COLUMN_LIST):
        return F.expr(f"max({number(len(df.columns))})")
    value = value_sql(df, kwargs["column"])
    if kind == NOT_NULL:
        return F.expr(f"avg(if(({value}) IS NOT NULL, 1D, 0D))")
    if kind == MEAN_BETWEEN:
        return F.expr(f"avg(cast({value} AS double))")
    if kind == VALUES_BETWEEN:
        inside = _within(f"({value})", kwargs.get("min_value"), kwargs.get("max_value"))
        return F.expr(f"avg(if(({value}) IS NULL, null, if({inside}, 1D, 0D)))")
    listed = F.expr(value).cast("string").isin(kwargs["value_set"])
    return F.avg(listed.cast("double"))


def _verdict(df: DataFrame, position: int, expectation: dict, observed: str) -> str:
    """SQL of the result row of an expectation, given the SQL of its aggregate."""
    kind, kwargs = expectation["expectation_type"], expectation["kwargs"]
    problem = _problem(df, expectation)
    if problem:
        success = "false"
    elif kind == COLUMN_COUNT:
        success, observed = str(len(df.columns) == kwargs["value"]).lower(), number(len(df.columns))
    elif kind == COLUMN_LIST:
        success, observed = str(df.columns == list(kwargs["column_list"])).lower(), number(len(df.columns))
    elif kind in (ROW_COUNT, MEAN_BETWEEN):
        success = f"coalesce({_within(observed, kwargs['min_value'], kwargs['max_value'])}, true)"
    else:
        success = f"coalesce({observed} >= {number(kwargs.get('mostly', 1.0))}, true)"
    return (
        f"named_struct('position', {position}, 'expectation_type', {text(kind)}, 'column', {text(kwargs.get('column'))}, "
        f"'success', {success}, 'observed', cast({observed} AS double), 'error', {text(problem)})"
    )


def _within(value: str, low: float | None, high: float | None) -> str:
    bounds = []
    if low is not None:
        bounds.append(f"{value} >= {number(low)}")
    if high is not None:
        bounds.append(f"{value} <= {number(high)}")
    return "(" + " AND ".join(bounds or ["true"]) + ")"
