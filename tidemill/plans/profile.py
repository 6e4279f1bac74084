"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import profile
from tidemill.plans.base import LINEITEM_COLUMNS, LINEITEM_NUMBERS, LINEITEM_STRINGS, query, rounded, union_sql

_SPARSE_SQL = """SELECT l_orderkey, CASE WHEN l_quantity > 20 THEN NULL ELSE l_quantity END AS l_quantity,
  CASE WHEN l_discount > 0.05 THEN NULL ELSE l_discount END AS l_discount, l_tax,
  nullif(l_returnflag, 'R') AS l_returnflag FROM lineitem"""


def sparse(t):
    """Lineitem columns with missing values: by rule, so that SQL can repeat them. The discount misses as NaN."""
    return t.lineitem.select(
        "l_orderkey",
        F.when(F.col("l_quantity") <= 20, F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_discount") > 0.05, float("nan")).otherwise(F.col("l_discount")).alias("l_discount"),
        "l_tax",
        F.nullif("l_returnflag", F.lit("R")).alias("l_returnflag"),
    )


_NAMES = ",".join(LINEITEM_COLUMNS)


@query(
    "p1_dataset_info",
    f"""SELECT count(*) AS rows, CAST(11 AS INTEGER) AS columns, '{_NAMES}' AS column_names,
  false AS has_missing_values, '{",".join(LINEITEM_NUMBERS)}' AS numeric_columns,
  '{",".join(LINEITEM_STRINGS)}' AS categorical_columns FROM lineitem""",
)
def dataset_info(t):
    info = profile.dataset_info(t.lineitem)
    lists = ["column_names", "numeric_columns", "categorical_columns"]
    return info.drop("column_types").withColumns({c: F.array_join(c, ",") for c in lists})


@query(
    "p1_dataset_info_missing",
    f"""SELECT count(*) AS rows, CAST(5 AS INTEGER) AS columns,
  bool_or(l_quantity IS NULL OR l_discount IS NULL OR l_returnflag IS NULL) AS has_missing_values FROM ({_SPARSE_SQL})""",
)
def dataset_info_missing(t):
    return profile.dataset_info(sparse(t)).select("rows", "columns", "has_missing_values")


@query(
    "p1_preview",
    "SELECT n_nationkey, n_name, n_regionkey FROM nation ORDER BY n_nationkey LIMIT 5",
)
def preview(t):
    return profile.preview(t.nation.orderBy("n_nationkey"))


@query(
    "p2_validate_dataset",
    f"""WITH m AS (SELECT count(*) AS n, avg(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END) AS q,
  avg(CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END) AS d, avg(CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END) AS r
  FROM ({_SPARSE_SQL}))
SELECT n >= 10 AS valid, CASE WHEN n = 0 THEN 'Dataset is empty' WHEN n < 10 THEN 'Dataset has fewer than 10 samples'
  ELSE 'Dataset validation successful' END AS message,
  'Columns with >50% missing values: ' || concat_ws(', ', CASE WHEN q > 0.5 THEN 'l_quantity' END,
  CASE WHEN d > 0.5 THEN 'l_discount' END, CASE WHEN r > 0.5 THEN 'l_returnflag' END) AS warnings FROM m""",
)
def validate_dataset(t):
    return profile.validate_dataset(sparse(t)).withColumn("warnings", F.array_join("warnings", "; "))


@query(
    "p3_missing_rate",
    union_sql(
        [
            f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_rate "
            f"FROM ({_SPARSE_SQL})"
            for c in ["l_orderkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
        ]
    ),
)
def missing_rate(t):
    return rounded(profile.missing_rate(sparse(t)))


_COUNTS_SQL = "\n UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS name, count(DISTINCT {c}) AS d FROM lineitem"
    for i, c in enumerate(LINEITEM_COLUMNS)
)


@query(
    "p4_infer_target",
    f"""WITH c AS ({_COUNTS_SQL}), f AS (SELECT * FROM c ORDER BY d, position LIMIT 1)
SELECT CASE WHEN d < 10 AND d / (SELECT count(*) FROM lineitem) < 0.05 THEN name END AS target_column FROM f""",
)
def infer_target(t):
    return profile.infer_target(t.lineitem)


@query(
    "p5_suggest_features",
    """WITH c AS (
  SELECT 0 AS position, 'o_orderkey' AS feature, count(DISTINCT o_orderkey) AS d, count(o_orderkey) AS f FROM orders
  UNION ALL SELECT 1, 'o_custkey', count(DISTINCT o_custkey), count(o_custkey) FROM orders
  UNION ALL SELECT 3, 'o_totalprice', count(DISTINCT o_totalprice), count(o_totalprice) FROM orders
  UNION ALL SELECT 4, 'o_orderdate', count(DISTINCT o_orderdate), count(o_orderdate) FROM orders
  UNION ALL SELECT 5, 'o_orderpriority', count(DISTINCT o_orderpriority), count(o_orderpriority) FROM orders),
n AS (SELECT count(*) AS n FROM orders)
SELECT feature FROM c, n WHERE d / n < 0.95 AND 1 - f / n < 0.5""",
)
def suggest_features(t):
    return profile.suggest_features(t.orders, "o_orderstatus").select("feature")


def _task_sql(table: str, column: str, integer_like: str) -> str:
    return f"""SELECT '{column}' AS target, CASE WHEN count(DISTINCT {column}) < 10
  OR count(DISTINCT {column}) / count(*) < 0.05 OR ({integer_like} AND count(DISTINCT {column}) < 20)
  THEN 'classification' ELSE 'regression' END AS task FROM {table}"""


@query(
    "p6_detect_task",
    union_sql(
        [
            _task_sql("lineitem", "l_quantity", "max(abs(l_quantity - round(l_quantity))) <= 0.00001"),
            _task_sql("orders", "o_totalprice", "max(abs(o_totalprice - round(o_totalprice))) <= 0.00001"),
            _task_sql("orders", "o_orderkey", "true"),
            "SELECT 'o_orderstatus' AS target, 'classification' AS task FROM (SELECT count(*) FROM orders)",
        ]
    ),
)
def detect_task(t):
    out = None
    for table, target in [
        (t.lineitem, "l_quantity"),
        (t.orders, "o_totalprice"),
        (t.orders, "o_orderkey"),
        (t.orders, "o_orderstatus"),
    ]:
        part = profile.detect_task(table, target).select(F.lit(target).alias("target"), "task")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "p7_describe",
    union_sql(
        [
            f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
  round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
  CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
            for c in LINEITEM_NUMBERS
        ]
    ),
)
def describe(t):
    return rounded(profile.describe(t.lineitem))


def _mode_sql(c: str, table: str) -> str:
    return f"(SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "p8_feature_statistics",
    union_sql(
        [
            f"""SELECT '{c}' AS "column", round(avg({c}), 6) AS mean, min({c}) AS min, max({c}) AS max,
  round(stddev_samp({c}), 6) AS std, CAST(NULL AS BIGINT) AS unique_values, CAST(NULL AS VARCHAR) AS most_common
  FROM lineitem"""
            for c in ["l_quantity", "l_extendedprice", "l_discount"]
        ]
        + [
            f"""SELECT '{c}', NULL, NULL, NULL, NULL, count(DISTINCT {c}), {_mode_sql(c, "lineitem")} FROM lineitem"""
            for c in LINEITEM_STRINGS
        ]
    ),
)
def feature_statistics(t):
    return rounded(
        profile.feature_statistics(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"], LINEITEM_STRINGS)
    )


@query("p9_unique_values", "SELECT DISTINCT o_orderpriority AS value FROM orders WHERE o_orderpriority IS NOT NULL")
def unique_values(t):
    return profile.unique_values(t.orders, "o_orderpriority")
