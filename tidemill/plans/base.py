"""Registration of queries and access to the fixture tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``tables.lineitem`` reads ``<folder>/lineitem.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL if there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show; -0.0 becomes 0.0."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


LINEITEM_NUMBERS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]
LINEITEM_STRINGS = ["l_returnflag", "l_linestatus"]
LINEITEM_COLUMNS = [*LINEITEM_NUMBERS, *LINEITEM_STRINGS, "l_shipdate"]

# Drift compares the shipments before this day with those from it on.
SPLIT_DAY = "1998-06-01"


def before(df: DataFrame) -> DataFrame:
    return df.where(F.col("l_shipdate") < F.lit(SPLIT_DAY).cast("timestamp_ntz"))


def since(df: DataFrame) -> DataFrame:
    return df.where(F.col("l_shipdate") >= F.lit(SPLIT_DAY).cast("timestamp_ntz"))


BEFORE_SQL = f"SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{SPLIT_DAY}'"
SINCE_SQL = f"SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{SPLIT_DAY}'"


def md5_sql(*parts: str) -> str:
    joined = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({joined}), 1, 15) AS BIGINT)"
