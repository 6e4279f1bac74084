"""Registry queries: orders stand for model versions, the priority for the model, the price for a metric."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import registry
from tidemill.plans.base import query, rounded, union_sql

_STAGE_SQL = "CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'Development' END"
_VERSIONS_SQL = f"""SELECT o_orderpriority AS model, o_orderkey AS version, {_STAGE_SQL} AS stage,
  'run-' || o_orderkey AS run_id FROM orders"""


def versions_of(t):
    stage = F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "O", "Staging")
    return t.orders.select(
        F.col("o_orderpriority").alias("model"),
        F.col("o_orderkey").alias("version"),
        stage.otherwise("Development").alias("stage"),
        F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"),
    )


@query(
    "r1_latest_version",
    f"""SELECT * FROM ({_VERSIONS_SQL}) QUALIFY row_number() OVER (PARTITION BY model ORDER BY version DESC) = 1""",
)
def latest_version(t):
    return registry.latest_version(versions_of(t))


@query(
    "r1_latest_version_in_stage",
    f"""SELECT * FROM ({_VERSIONS_SQL}) WHERE stage = 'Staging'
QUALIFY row_number() OVER (PARTITION BY model ORDER BY version DESC) = 1""",
)
def latest_version_in_stage(t):
    return registry.latest_version(versions_of(t), "Staging")


_DEMOTED_SQL = f"""SELECT model, version, CASE WHEN model = '1-URGENT' AND stage = 'Production' THEN 'Archived' ELSE stage END AS stage,
  run_id FROM ({_VERSIONS_SQL})"""


@query(
    "r2_deployable_version",
    f"""SELECT * FROM ({_DEMOTED_SQL}) QUALIFY row_number() OVER (PARTITION BY model ORDER BY
  CASE stage WHEN 'Production' THEN 2 WHEN 'Staging' THEN 1 ELSE 0 END DESC, version DESC) = 1""",
)
def deployable_version(t):
    """Urgent orders have no Production version here, so that Staging decides."""
    demoted = F.when((F.col("model") == "1-URGENT") & (F.col("stage") == "Production"), "Archived").otherwise(F.col("stage"))
    return registry.deployable_version(versions_of(t).withColumn("stage", demoted))


_WINNER_SQL = f"SELECT model, max(version) AS version FROM ({_VERSIONS_SQL}) WHERE stage = 'Staging' GROUP BY model"


@query(
    "r3_promote",
    f"""WITH v AS ({_VERSIONS_SQL}), w AS ({_WINNER_SQL})
SELECT model, version, stage AS from_stage, 'Production' AS to_stage FROM v JOIN w USING (model, version)
UNION ALL SELECT model, version, stage, 'Archived' FROM v WHERE stage = 'Production'""",
)
def promote(t):
    """The latest Staging version of every model goes to Production; unknown stages and versions change nothing."""
    versions = versions_of(t)
    good = registry.latest_version(versions, "Staging").select(
        "model", "version", F.lit("Production").alias("to_stage"), F.lit("Staging").alias("from_stage")
    )
    wrong_stage = registry.latest_version(versions, "Development").select(
        "model", "version", F.lit("Production").alias("to_stage"), F.lit("Staging").alias("from_stage")
    )
    unknown_stage = good.withColumn("to_stage", F.lit("Retired"))
    unknown_version = good.withColumn("version", -F.col("version") - 1)
    asked = good.unionByName(wrong_stage).unionByName(unknown_stage).unionByName(unknown_version)
    return registry.promote(versions, asked)


@query(
    "r3_stage_after_promote",
    f"""WITH v AS ({_VERSIONS_SQL}), w AS (SELECT model, version, true AS won FROM ({_WINNER_SQL}))
SELECT model, CASE WHEN won THEN 'Production' WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage,
  count(*) AS versions FROM v LEFT JOIN w USING (model, version) GROUP BY ALL""",
)
def stage_after_promote(t):
    after = registry.apply_changes(versions_of(t), promote(t))
    return after.groupBy("model", "stage").agg(F.count(F.lit(1)).alias("versions"))


@query(
    "r3_current_stages",
    f"""SELECT model, stage, count(*) AS versions FROM ({_VERSIONS_SQL}) GROUP BY ALL""",
)
def current_stages(t):
    """Every version starts in None and moves once: the last event counts."""
    versions = versions_of(t)
    events = versions.select("model", "version", F.lit("None").alias("stage"), F.lit(0).alias("seq")).unionByName(
        versions.select("model", "version", "stage", F.lit(1).alias("seq"))
    )
    return registry.current_stages(events).groupBy("model", "stage").agg(F.count(F.lit(1)).alias("versions"))


@query(
    "r4_rollback",
    f"""WITH v AS ({_VERSIONS_SQL}), w AS ({_WINNER_SQL}),
target AS (SELECT model, CASE WHEN model = '5-LOW' THEN (SELECT min(version) FROM v x WHERE x.model = '5-LOW') ELSE version END AS version FROM w)
SELECT model, version, stage AS from_stage, 'Production' AS to_stage FROM v JOIN target USING (model, version)
UNION ALL SELECT v.model, v.version, v.stage, 'Archived' FROM v JOIN target ON v.model = target.model
WHERE v.stage = 'Production' AND v.version <> target.version""",
)
def rollback(t):
    """Low-priority models go back to their first version, the others to the latest one in Staging."""
    versions = versions_of(t)
    asked = versions.groupBy("model").agg(F.min("version").alias("first")).select(
        "model", F.when(F.col("model") == "5-LOW", F.col("first")).alias("to_version")
    )
    return registry.rollback(versions, asked)


_METRIC_SQL = {"accuracy": "avg(o_totalprice)", "rmse": "stddev_samp(o_totalprice)", "log_loss": "min(o_totalprice)", "mae": "max(o_totalprice)"}


def _metrics_sql(status: str) -> str:
    return union_sql(
        [
            f"SELECT o_orderpriority AS model, '{m}' AS metric, {e} AS value FROM orders WHERE o_orderstatus = '{status}' GROUP BY 1"
            for m, e in _METRIC_SQL.items()
        ]
    )


def _metrics(t, status: str):
    wide = t.orders.where(F.col("o_orderstatus") == status).groupBy(F.col("o_orderpriority").alias("model")).agg(
        *[F.expr(e).alias(m) for m, e in _METRIC_SQL.items()]
    )
    return wide.unpivot("model", list(_METRIC_SQL), "metric", "value")


_COMPARED_SQL = f"""SELECT model, metric, a.value AS first_value, b.value AS second_value,
  CASE WHEN metric = 'accuracy' THEN a.value > b.value ELSE a.value < b.value END AS first_better
FROM ({_metrics_sql("F")}) a JOIN ({_metrics_sql("O")}) b USING (model, metric)"""


@query(
    "r5_compare_versions",
    f"SELECT model, metric, round(first_value, 4) AS first_value, round(second_value, 4) AS second_value, first_better FROM ({_COMPARED_SQL})",
)
def compare_versions(t):
    return rounded(registry.compare_metrics(_metrics(t, "F"), _metrics(t, "O"), ["model"]), 4)


@query(
    "r5_compare_summary",
    f"""SELECT model, count(*) FILTER (WHERE first_better) AS better_metrics, count(*) AS total_compared
FROM ({_COMPARED_SQL}) GROUP BY model""",
)
def compare_summary(t):
    compared = registry.compare_metrics(_metrics(t, "F"), _metrics(t, "O"), ["model"])
    return registry.compare_summary(compared, ["model"])


def _best_sql(direction: str) -> str:
    return f"""SELECT o_orderpriority AS model, o_orderkey AS version, o_totalprice AS value FROM orders
WHERE o_orderstatus NOT IN ('F', 'O') QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice {direction}, o_orderkey) = 1"""


def _run_metrics(t):
    return t.orders.select(
        F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"),
        F.lit("price").alias("metric"),
        F.col("o_totalprice").alias("value"),
    )


@query("r6_best_by_metric", _best_sql("DESC"))
def best_by_metric(t):
    return registry.best_by_metric(versions_of(t), _run_metrics(t), "price")


@query("r6_best_by_low_metric", _best_sql("ASC"))
def best_by_low_metric(t):
    return registry.best_by_metric(versions_of(t), _run_metrics(t), "price", higher_is_better=False)


@query(
    "r6_promote_best",
    f"SELECT model, version, 'Development' AS from_stage, 'Staging' AS to_stage FROM ({_best_sql('DESC')})",
)
def promote_best(t):
    return registry.promote_best(versions_of(t), _run_metrics(t), "price", "Staging")


@query(
    "r7_top_models",
    """SELECT o_orderpriority AS model, o_orderkey AS version, o_totalprice AS value FROM orders
ORDER BY o_totalprice DESC, o_orderpriority, o_orderkey LIMIT 10""",
)
def top_models(t):
    return registry.top_models(
        t.orders.select(
            F.col("o_orderpriority").alias("model"), F.col("o_orderkey").alias("version"), F.col("o_totalprice").alias("value")
        )
    )


@query("r7_runs_by_status", "SELECT o_orderstatus AS status, count(*) AS runs FROM orders GROUP BY 1")
def runs_by_status(t):
    return registry.runs_by_status(t.orders.withColumnRenamed("o_orderstatus", "status"))


@query(
    "r7_top_experiments",
    "SELECT o_custkey AS experiment_id, count(*) AS runs FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def top_experiments(t):
    return registry.top_experiments(t.orders.withColumnRenamed("o_custkey", "experiment_id"))


@query(
    "r8_registry_totals",
    """SELECT count(DISTINCT o_custkey) AS experiments, count(*) AS runs, count(DISTINCT o_orderpriority) AS models,
  count(*) AS model_versions, CAST(sum(o_orderkey) AS BIGINT) AS artifact_bytes FROM orders""",
)
def registry_totals(t):
    runs = t.orders.select(F.col("o_custkey").alias("experiment_id"), F.col("o_orderkey").alias("artifact_bytes"))
    return registry.registry_totals(runs, versions_of(t))
