"""Drift queries: shipments before a day against those since."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.operators import drift, drift_store
from tidemill.plans.base import BEFORE_SQL, SINCE_SQL, SPLIT_DAY, before, query, rounded, since, union_sql

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]
_SIDES = f"r AS ({BEFORE_SQL}), c AS ({SINCE_SQL})"


def ks_sql(columns: list[str]) -> str:
    """The textbook form: both cumulative distributions over every distinct value."""
    parts = [
        f"""SELECT '{x}' AS "column", max(n) AS n, max(m) AS m, max(abs(fr - fc)) AS d FROM (
  SELECT n, m, sum(a) OVER (ORDER BY x) / n AS fr, sum(b) OVER (ORDER BY x) / m AS fc FROM (
    SELECT x, sum(a) AS a, sum(b) AS b FROM (SELECT {x} AS x, 1 AS a, 0 AS b FROM r UNION ALL SELECT {x}, 0, 1 FROM c)
    GROUP BY x), (SELECT count({x})::DOUBLE AS n FROM r), (SELECT count({x})::DOUBLE AS m FROM c))"""
        for x in columns
    ]
    return f"""WITH {_SIDES}, ks AS ({union_sql(parts)}),
tested AS (SELECT "column", n, m, d, d * d * (n * m / (n + m)) AS s FROM ks)
SELECT "column", 'numeric' AS kind, CAST(n AS BIGINT) AS n_reference, CAST(m AS BIGINT) AS n_current, d AS statistic,
  CASE WHEN s < 0.04 THEN 1.0 ELSE least(greatest(2 * (SELECT sum((CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * s))
  FROM range(1, 101) g(j)), 0.0), 1.0) END AS p_value FROM tested"""


@query(
    "d1_column_drift_numeric",
    f"""SELECT "column", n_reference, n_current, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
  p_value < 0.05 AS drift_detected FROM ({ks_sql(NUMBERS)})""",
)
def column_drift_numeric(t):
    return rounded(drift.numeric_drift(before(t.lineitem), since(t.lineitem), NUMBERS))


@query(
    "d1_drift_from_sketches",
    f"""SELECT "column", n_reference, n_current, p_value < 0.05 AS drift_detected, true AS within_bound FROM ({ks_sql(["l_quantity", "l_extendedprice"])})""",
)
def drift_from_sketches(t):
    """Two periods compared by the sketches of their days; the distance is as near to the exact one as is promised."""
    store = drift_store.DriftStore(t.spark, scratch_path(t.spark, "drift-store"))
    columns = ["l_quantity", "l_extendedprice"]
    store.append(t.lineitem, "l_shipdate", columns, [], "all")
    periods = ("1900-01-01", SPLIT_DAY), (SPLIT_DAY, "2100-01-01")
    exact = drift.numeric_drift(before(t.lineitem), since(t.lineitem), columns).select("column", F.col("statistic").alias("exact"))
    near = F.abs(F.col("statistic") - F.col("exact")) <= drift_store.error_bound()
    found = store.numeric_drift(*periods).join(exact, "column")
    return found.select("column", "n_reference", "n_current", "drift_detected", near.alias("within_bound"))


_ORDER_SIDES = f"""r AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT_DAY}'),
c AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{SPLIT_DAY}')"""


def _order_sides(t):
    day = F.lit(SPLIT_DAY).cast("timestamp_ntz")
    return t.orders.where(F.col("o_orderdate") < day), t.orders.where(F.col("o_orderdate") >= day)


def _cells_sql(x: str) -> str:
    return f"""SELECT '{x}' AS "column", coalesce(a.v, b.v) AS v, coalesce(a.n, 0)::DOUBLE AS r, coalesce(b.n, 0)::DOUBLE AS c,
  (SELECT count({x}) FROM r)::DOUBLE AS n, (SELECT count({x}) FROM c)::DOUBLE AS m
  FROM (SELECT {x} AS v, count(*) AS n FROM r GROUP BY 1) a FULL JOIN (SELECT {x} AS v, count(*) AS n FROM c GROUP BY 1) b ON a.v = b.v"""


@query(
    "d2_column_drift_categorical",
    f"""WITH {_ORDER_SIDES}, cells AS ({union_sql([_cells_sql("o_orderpriority"), _cells_sql("o_orderstatus")])}),
tested AS (SELECT "column", n + m AS total, sum((r * m - c * n) * (r * m - c * n) / (n * m * (r + c))) AS s, count(*) - 1 AS dof,
  sum(abs(r / n - c / m)) / 2 AS tv FROM cells GROUP BY ALL)
SELECT "column", round(s, 6) AS statistic, dof, round(tv, 6) AS total_variation,
  round(CASE WHEN dof = 2 THEN exp(-s / 2) ELSE exp(-s / 2) * (1 + s / 2) END, 6) AS p_value,
  CASE WHEN dof = 2 THEN exp(-s / 2) ELSE exp(-s / 2) * (1 + s / 2) END < 0.05 AS drift_detected FROM tested""",
)
def column_drift_categorical(t):
    """Five priorities and three statuses: for even degrees of freedom the tail has a closed form."""
    reference, current = _order_sides(t)
    return rounded(drift.categorical_drift(reference, current, ["o_orderpriority", "o_orderstatus"]))


def _bin_sql(x: str) -> str:
    edges = f"(SELECT list_distinct(quantile_cont({x}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM r)"

    def side(name: str) -> str:
        return f"""SELECT len(list_filter(e, lambda q: q < {x})) AS v, count(*)::DOUBLE AS n FROM {name}, {edges} GROUP BY 1"""

    return f"""SELECT '{x}' AS "column", coalesce(a.n, 0) AS r, coalesce(b.n, 0) AS c,
  (SELECT count({x}) FROM r)::DOUBLE AS n, (SELECT count({x}) FROM c)::DOUBLE AS m
  FROM ({side("r")}) a FULL JOIN ({side("c")}) b ON a.v = b.v"""


_PSI = "sum((greatest(c / m, 1e-6) - greatest(r / n, 1e-6)) * ln(greatest(c / m, 1e-6) / greatest(r / n, 1e-6)))"
PSI_COLUMNS = ["l_quantity", "l_extendedprice", "l_orderkey"]
_PSI_NUMERIC_SQL = f"""SELECT "column", {_PSI} AS psi FROM ({union_sql([_bin_sql(x) for x in PSI_COLUMNS])}) GROUP BY 1"""


@query("d3_psi_numeric", f'WITH {_SIDES} SELECT "column", round(psi, 6) AS psi FROM ({_PSI_NUMERIC_SQL})')
def psi_numeric(t):
    return rounded(drift.psi_numeric(before(t.lineitem), since(t.lineitem), PSI_COLUMNS))


@query(
    "d3_psi_categorical",
    f"""WITH {_ORDER_SIDES}, cells AS ({union_sql([_cells_sql("o_orderpriority"), _cells_sql("o_orderstatus")])})
SELECT "column", round({_PSI}, 6) AS psi FROM cells GROUP BY 1""",
)
def psi_categorical(t):
    reference, current = _order_sides(t)
    return rounded(drift.psi_categorical(reference, current, ["o_orderpriority", "o_orderstatus"]))


@query(
    "d4_target_drift",
    f"""SELECT 'target' AS "column", kind, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
  p_value < 0.05 AS drift_detected FROM ({ks_sql(["l_extendedprice"])})""",
)
def target_drift(t):
    table = t.lineitem.withColumnRenamed("l_extendedprice", "target")
    return rounded(drift.target_drift(before(table), since(table)))


@query(
    "d5_drift_summary",
    f"""SELECT count(*) AS number_of_columns, count(*) FILTER (WHERE p_value < 0.05) AS number_of_drifted_columns,
  round(count(*) FILTER (WHERE p_value < 0.05) / count(*), 6) AS drift_share,
  count(*) FILTER (WHERE p_value < 0.05) / count(*) >= 0.5 AS dataset_drift FROM ({ks_sql(NUMBERS)})""",
)
def drift_summary(t):
    found = drift.column_drift(before(t.lineitem), since(t.lineitem), NUMBERS)
    return rounded(drift.drift_summary(found))


def _quality_sql(x: str) -> str:
    def side(name: str) -> str:
        values = {
            "count": f"count({x})",
            "mean": f"round(avg({x}), 6)",
            "std": f"round(stddev_samp({x}), 6)",
            "min": f"min({x})::DOUBLE",
            "q50": f"round(quantile_cont({x}, 0.5), 6)",
            "max": f"max({x})::DOUBLE",
            "missing_rate": f"round(avg(CASE WHEN {x} IS NULL THEN 1.0 ELSE 0.0 END), 6)",
        }
        label = {"r": "reference", "c": "current"}[name]
        return ", ".join(f"(SELECT {e} FROM {name}) AS {label}_{k}" for k, e in values.items())

    return f"""SELECT '{x}' AS "column", {side("r")}, {side("c")}"""


@query("d6_data_quality_compare", f"WITH {_SIDES}\n" + union_sql([_quality_sql(x) for x in ["l_quantity", "l_discount"]]))
def data_quality_compare(t):
    return rounded(drift.quality_compare(before(t.lineitem), since(t.lineitem), ["l_quantity", "l_discount"]))


@query(
    "d7_drift_severity",
    f"""WITH {_SIDES}, p AS ({_PSI_NUMERIC_SQL})
SELECT "column", round(psi, 6) AS score, CASE WHEN psi >= 0.2 THEN 'red' WHEN psi >= 0.1 THEN 'yellow' ELSE 'green' END AS severity,
  CASE WHEN psi >= 0.5 THEN 'red' WHEN psi >= 0.3 THEN 'yellow' ELSE 'green' END AS feature_severity FROM p""",
)
def drift_severity(t):
    scores = drift.psi_numeric(before(t.lineitem), since(t.lineitem), PSI_COLUMNS).withColumnRenamed("psi", "score")
    by_score = drift.drift_severity(scores)
    return rounded(by_score.withColumn("feature_severity", drift.severity(F.col("score"), drift.FEATURE_BANDS)))


@query(
    "d8_time_since_drift",
    """SELECT max(ts) AS last_detection, round(epoch(TIMESTAMP '2024-02-01' - max(ts)), 6) AS seconds_since
FROM events WHERE event_type = 'error' AND value > 100""",
)
def time_since_drift(t):
    detections = t.events.where("event_type = 'error' and value > 100")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return rounded(drift.time_since_drift(detections, "ts", now))
