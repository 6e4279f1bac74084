"""Requests scored as a stream: order lines ask for their price, and the log is what test results and metrics read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.operators import abtest, models, monitor
from tidemill.operators.abtest import LATENCY_BUCKETS
from tidemill.plans.abtest import bucket_rows_sql, results_sql
from tidemill.plans.base import md5_sql, query, rounded
from tidemill.streaming import monitor as streams
from tidemill.streaming import scoring

TEST = abtest.ABTest(
    "price-comparison",
    [{"name": "plain", "model_name": "price", "model_version": "1"}, {"name": "penalized", "model_name": "price", "model_version": "2"}],
    [0.6, 0.4],
)
_ALPHA, _MOST = 100000.0, 45.0
_NOW = "2010-01-01"
_DRAW = f"{md5_sql(repr(TEST.name), 'l_orderkey')} / 1152921504606846976.0"
_LOG_SQL = f"""SELECT r.*, CASE WHEN variant = 'plain' THEN '1' ELSE '2' END AS model_version,
  my + CASE WHEN variant = 'plain' THEN sxy / sxx ELSE sxy / (sxx + {_ALPHA}) END * (l_quantity - mx) AS prediction,
  (epoch_us(TIMESTAMP '{_NOW}') - epoch_us(l_shipdate)) / 1000000.0 AS latency
FROM (SELECT *, CASE WHEN {_DRAW} <= 0.6::DOUBLE THEN 'plain' ELSE 'penalized' END AS variant FROM lineitem) r,
  (SELECT regr_sxy(l_extendedprice, l_quantity) AS sxy, regr_sxx(l_extendedprice, l_quantity) AS sxx,
     avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem)"""
_SCORED_SQL = f"SELECT * FROM ({_LOG_SQL}) WHERE l_quantity BETWEEN 1 AND {_MOST}"


def scored(t) -> str:
    """The folder of the log after the requests have come as a stream, and the first batch once more."""
    lines = t.lineitem
    plain = models.train(lines, "linear_regression", ["l_quantity"], "l_extendedprice")
    penalized = models.train(lines, "ridge_regression", ["l_quantity"], "l_extendedprice", {"alpha": _ALPHA})
    root = scratch_path(t.spark, "scoring")
    job = scoring.Scorer(
        root,
        {("price", "1"): plain, ("price", "2"): penalized},
        key="request",
        user="l_orderkey",
        ts="l_shipdate",
        test=TEST,
        ranges={"price": {"l_quantity": (1.0, _MOST)}},
        now=lambda: F.lit(_NOW).cast("timestamp"),
    )
    line = F.concat_ws("-", "l_orderkey", "l_linenumber")
    requests = streams.read_stream(t.spark, t.path("lineitem"), lines.schema).withColumn("request", line)
    job.run(requests, scratch_path(t.spark, "scoring-state"))
    if job.process(lines.withColumn("request", line), 0):
        raise RuntimeError("a batch of the ledger was scored again")
    return root


@query(
    "m16_scored_stream",
    f"""SELECT l_orderkey || '-' || l_linenumber AS request, variant, model_version, round(prediction, 4) AS prediction, round(latency, 4) AS latency
FROM ({_SCORED_SQL})""",
)
def scored_stream(t):
    """Every request within bounds once, with the prediction of its user's variant."""
    log = scoring.prediction_log(t.spark, scored(t))
    kept = log.select("request", "variant", "model_version", F.col("prediction").cast("double").alias("prediction"), "latency")
    return rounded(kept, 4)


@query(
    "q12_rejected_requests",
    f"SELECT l_orderkey || '-' || l_linenumber AS request, variant, 'l_quantity: above {_MOST}' AS errors FROM ({_LOG_SQL}) WHERE l_quantity > {_MOST}",
)
def rejected_requests(t):
    found = scoring.rejected_requests(t.spark, scored(t))
    return found.select("request", "variant", F.array_join("errors", ",").alias("errors"))


@query("a5_results_of_log", results_sql(f"SELECT variant, latency FROM ({_SCORED_SQL})"))
def results_of_log(t):
    """The results of the test from the log that the scoring job wrote."""
    return rounded(abtest.ab_results(scoring.prediction_log(t.spark, scored(t)), TEST))


@query(
    "t17_metrics_of_log",
    f"""WITH l AS (SELECT 'price' AS model_name, model_version, latency / 1e9 AS latency FROM ({_SCORED_SQL})),
b AS ({bucket_rows_sql("SELECT * FROM l", "model_name, model_version", "latency", "bucket_count")}),
s AS (SELECT model_name, model_version, count(*) AS predictions, round(sum(latency), 6) AS latency_sum FROM l GROUP BY ALL)
SELECT model_name, model_version, predictions, latency_sum, le, bucket_count FROM b JOIN s USING (model_name, model_version)""",
)
def metrics_of_log(t):
    """Counts and buckets by model and version, as the scoring job's log has them; here a second is a thousand million."""
    log = scoring.prediction_log(t.spark, scored(t)).withColumn("latency", F.col("latency") / 1e9)
    return rounded(monitor.prediction_metrics(log, LATENCY_BUCKETS, ["model_name", "model_version"]))
