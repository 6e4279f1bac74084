"""Column classes, null handling and long-form helpers."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Aggregates evaluated per job: wider ones outgrow the generated method.
AGG_WIDTH = 60


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))]


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def value_sql(df: DataFrame, name: str) -> str:
    """The column with NaN read as NULL, so both kinds of missing value count the same."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return f"if(isnan({quoted(name)}), null, {quoted(name)})"
    return quoted(name)


def value_of(df: DataFrame, name: str) -> Column:
    return F.expr(value_sql(df, name))


def number(value: float | None) -> str:
    """A double as an SQL literal."""
    if value is None:
        return "cast(null as double)"
    if math.isinf(value) or math.isnan(value):
        return f"double('{value}')"
    return f"{float(value)!r}D"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: value_of(df, c) for c in floats}) if floats else df


def total(count: Column) -> Column:
    """Sum that stays a bigint and is 0 over no rows."""
    return F.coalesce(F.sum(count), F.lit(0)).cast("bigint")


def when_true(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def long_rows(rows: Mapping[str, Mapping[str, Column]], key: str = "column") -> Column:
    """One output row per entry: the key as literal plus the entry's expressions.

    Used after a wide one-pass aggregate to turn its single row into a long table.
    """
    structs = [
        F.struct(F.lit(name).alias(key), *[e.alias(alias) for alias, e in exprs.items()])
        for name, exprs in rows.items()
    ]
    return F.inline(F.array(*structs))


def unpivot_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns as rows ``(keep..., column, x double)`` without missing values."""
    rows = {c: {"x": value_of(df, c).cast("double")} for c in columns}
    return df.select(*keep, long_rows(rows)).where(F.col("x").isNotNull())


def one_row(df: DataFrame, aggregates: Mapping[str, Column]) -> dict:
    """Evaluate many global aggregates, a bounded number per job, and return their values by name."""
    names = list(aggregates)
    out: dict = {}
    for start in range(0, len(names), AGG_WIDTH):
        part = names[start : start + AGG_WIDTH]
        out.update(zip(part, df.agg(*[aggregates[n] for n in part]).first()))
    return out


def small_or_none(df: DataFrame, max_rows: int) -> list[Row] | None:
    """The rows when there are at most ``max_rows``; None says the table is too large to hold or broadcast."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def local_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """A small table held by the driver: a local relation, whose size the planner knows."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = kind.fieldNames()
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=to_arrow_schema(kind))
    return spark.createDataFrame(table, kind)


def spread(df: DataFrame) -> DataFrame:
    """Before work that costs far more than a shuffle: use all cores when the input has fewer partitions."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast a side whose size was checked; leave the join to the planner otherwise."""
    return F.broadcast(df) if small else df


def text(value: str | None) -> str:
    """A string as an SQL literal."""
    if value is None:
        return "cast(null as string)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def bucket_of(x: str, edges: Sequence[float]) -> Column:
    """Number of ``edges`` (ascending) below the SQL expression ``x``, found by halving."""

    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"if({x} <= {number(edges[mid])}, {search(low, mid)}, {search(mid + 1, high)})"

    return F.expr(search(0, len(edges)))


def md5_key(*parts: Column) -> Column:
    """Uniform 60-bit key of the joined parts: equal on every engine that has md5."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 as decimal(20,6); for timestamps without zone, free of the session zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (ts.cast("timestamp_ntz") - origin).cast("interval second").cast("decimal(20,6)")
