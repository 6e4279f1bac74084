"""Compare a registered query with its SQL on the same parquet files."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

# Spark types and the SQL types that hold the same values.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def _multiset(rows, order) -> Counter:
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(con: duckdb.DuckDBPyConnection, sql: str, df: DataFrame) -> str | None:
    """None if both give the same columns, types and rows; else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for f in df.schema.fields:
        ours = SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString())
        if ours != types[f.name]:
            return f"type of {f.name}: {ours} != {types[f.name]}"
    rows = df.collect()
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    ordered = sorted(names)
    mine = _multiset(rows, [df.columns.index(c) for c in ordered])
    theirs = _multiset(expected, [names.index(c) for c in ordered])
    if mine != theirs:
        return f"rows {ordered}: {list((mine - theirs).items())[:3]} != {list((theirs - mine).items())[:3]}"
    return None
