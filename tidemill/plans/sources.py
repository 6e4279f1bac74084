"""Reader and sink queries: tables are written in a format and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.operators import drift
from tidemill.plans.base import before, query, rounded, since
from tidemill.plans.drift import ks_sql
from tidemill.sources.runs import model_versions, run_metrics, run_params, runs, write_run
from tidemill.sources.tables import append_drift_summary, drop_empty_rows, read_table

_ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string"
)


@query("s1_scan_csv", "SELECT * FROM orders")
def scan_csv(t):
    path = scratch_path(t.spark, "orders") + ".csv"
    t.orders.write.csv(path, header=True)
    return read_table(t.spark, path, _ORDERS)


@query(
    "s1_scan_tsv",
    "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def scan_tsv(t):
    """Types inferred from the text."""
    path = scratch_path(t.spark, "customer") + ".tsv"
    t.customer.write.csv(path, header=True, sep="\t")
    found = read_table(t.spark, path)
    return found.select(F.col("c_custkey").cast("bigint"), "c_name", "c_acctbal", "c_mktsegment")


@query("s1_scan_json", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def scan_json(t):
    path = scratch_path(t.spark, "part") + ".json"
    t.part.write.json(path)
    schema = "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double"
    return read_table(t.spark, path, schema, multiline_json=False)


@query("s1_scan_parquet", "SELECT * FROM lineitem")
def scan_parquet(t):
    return read_table(t.spark, t.path("lineitem"))


@query("s2_drop_all_null_rows", "SELECT * FROM customer WHERE c_acctbal >= 0")
def drop_all_null_rows(t):
    """Every value of an overdrawn customer is blanked, one of them as NaN."""
    kept = F.col("c_acctbal") >= 0
    blanked = [F.when(kept, F.col(c)).otherwise(F.lit(float("nan")) if c == "c_acctbal" else None).alias(c) for c in t.customer.columns]
    return drop_empty_rows(t.customer.select(*blanked))


@query(
    "s5_run_tracking_scan",
    """SELECT 'orders' AS experiment_id, 'run-' || substr(o_orderpriority, 1, 1) AS run_id, m.key AS key,
  CAST(1700000000000 AS BIGINT) AS ts_ms, round(CASE WHEN m.key = 'mean_price' THEN avg(o_totalprice) ELSE max(o_totalprice) END, 4) AS value,
  CAST(0 AS INTEGER) AS step FROM orders, (VALUES ('mean_price'), ('max_price')) m(key) GROUP BY o_orderpriority, m.key""",
)
def run_tracking_scan(t):
    """One run per order priority, written as metric files of the tracking layout."""
    root = scratch_path(t.spark, "runs")
    per_run = t.orders.groupBy("o_orderpriority").agg(
        F.avg("o_totalprice").alias("mean_price"), F.max("o_totalprice").alias("max_price")
    )
    for row in per_run.collect():
        for key in ("mean_price", "max_price"):
            line = f"1700000000000 {row[key]!r} 0"
            path = f"{root}/orders/run-{row['o_orderpriority'][0]}/metrics/{key}"
            t.spark.range(1).select(F.lit(line).alias("value")).write.text(path)
    return rounded(run_metrics(t.spark, root), 4)


def _tree(t, name: str, text) -> str:
    """A run tree with one file for each order priority, as a tracker leaves them; ``name`` may hold the run."""
    root = scratch_path(t.spark, "runs")
    moment = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    per_run = t.orders.groupBy(F.substring("o_orderpriority", 1, 1).alias("run"), "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.min(moment).alias("first"), F.max(moment).alias("last")
    )
    for row in per_run.select("run", text.alias("text")).collect():
        t.spark.range(1).select(F.lit(row["text"]).alias("value")).write.text(f"{root}/{name.format(run=row['run'])}")
    return root


_RUNS_SQL = """SELECT substr(o_orderpriority, 1, 1) AS run, o_orderpriority, count(*) AS orders,
  epoch_ms(min(o_orderdate)) AS first, epoch_ms(max(o_orderdate)) AS last FROM orders GROUP BY ALL"""


@query(
    "s5_run_params",
    f"""SELECT 'orders' AS experiment_id, 'run-' || run AS run_id, 'count' AS key, CAST(orders AS VARCHAR) AS value FROM ({_RUNS_SQL})
UNION ALL SELECT 'late', 'run-x', 'alpha', '0.5' FROM (SELECT count(*) FROM orders)""",
)
def run_parameters(t):
    """Parameters from the files of a tree and from a run that was appended later."""
    root = _tree(t, "orders/run-{run}/params/count", F.col("orders").cast("string"))
    write_run(t.spark, root, "late", "run-x", {"rmse": 1.5}, {"alpha": "0.5"}, 1_700_000_000_000)
    return run_params(t.spark, root)


@query(
    "s5_runs",
    f"""SELECT 'orders' AS experiment_id, 'run-' || run AS run_id, o_orderpriority AS run_name, CAST(3 AS INTEGER) AS status,
  first AS start_ms, last AS end_ms, round((last - first) / 1000, 6) AS seconds FROM ({_RUNS_SQL})""",
)
def run_documents(t):
    """Name, state and times of every run from its document."""
    lines = F.concat_ws(
        "\n",
        F.lit("experiment_id: 'orders'"),
        F.concat(F.lit("run_id: run-"), "run"),
        F.concat(F.lit("run_name: "), "o_orderpriority"),
        F.lit("status: 3"),
        F.concat(F.lit("start_time: "), "first"),
        F.concat(F.lit("end_time: "), "last"),
    )
    return rounded(runs(t.spark, _tree(t, "orders/run-{run}/meta.yaml", lines)))


@query(
    "s5_model_versions",
    f"""SELECT 'priority' AS model, CAST(run AS INTEGER) AS version, CASE WHEN orders % 2 = 0 THEN 'Production' ELSE 'Staging' END AS stage,
  'run-' || run AS run_id, 'READY' AS status, first AS created_ms FROM ({_RUNS_SQL})""",
)
def registered_versions(t):
    lines = F.concat_ws(
        "\n",
        F.lit("name: priority"),
        F.concat(F.lit("version: '"), "run", F.lit("'")),
        F.concat(F.lit("current_stage: "), F.when(F.col("orders") % 2 == 0, "Production").otherwise("Staging")),
        F.concat(F.lit("run_id: run-"), "run"),
        F.lit("status: READY"),
        F.concat(F.lit("creation_timestamp: "), "first"),
    )
    return model_versions(t.spark, _tree(t, "models/priority/version-{run}/meta.yaml", lines))


@query(
    "s6_drift_summary_sink",
    f"""WITH k AS (SELECT "column", statistic, p_value < 0.05 AS drifted FROM ({ks_sql(["l_quantity", "l_discount"])})),
s AS (SELECT count(*) AS number_of_columns, count(*) FILTER (WHERE drifted) AS number_of_drifted_columns FROM k)
SELECT number_of_columns, number_of_drifted_columns, round(number_of_drifted_columns / number_of_columns, 6) AS drift_share,
  "column", round(statistic, 6) AS statistic, drifted AS drift_detected FROM s, k""",
)
def drift_summary_sink(t):
    path = scratch_path(t.spark, "drift")
    found = drift.column_drift(before(t.lineitem), since(t.lineitem), ["l_quantity", "l_discount"])
    append_drift_summary(drift.drift_summary(found), found, path)
    written = t.spark.read.json(path)
    counts = ["number_of_columns", "number_of_drifted_columns", "drift_share"]
    return rounded(written.select(*counts, F.inline("drift_by_feature")).select(*counts, "column", "statistic", "drift_detected"))
