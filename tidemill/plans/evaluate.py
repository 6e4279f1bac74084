"""Split, evaluation and explanation queries that SQL can repeat: predictions come from fixed rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import evaluate, explain, models, splits
from tidemill.plans.base import md5_sql, query, rounded, union_sql

_HASH_SQL = md5_sql("42", "o_orderkey")


@query(
    "m1_random_split",
    f"""SELECT o_orderkey, row_number() OVER (ORDER BY {_HASH_SQL}, o_orderkey)
  <= ceil(0.2 * count(*) OVER () - 1e-9) AS is_test FROM orders""",
)
def random_split(t):
    return splits.random_split(t.orders, "o_orderkey").select("o_orderkey", "is_test")


_QUOTA_SQL = """WITH c AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1),
e AS (SELECT label, t * (n / a) AS exact, floor(t * (n / a) + 1e-9) AS base, t
  FROM c, (SELECT sum(n) AS a, ceil(0.3 * sum(n) - 1e-9) AS t FROM c)),
q AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY round(exact - base, 9) DESC, label)
  <= t - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM e)"""


@query(
    "m2_stratified_split",
    f"""{_QUOTA_SQL} SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY {_HASH_SQL}, o_orderkey) <= quota AS is_test FROM orders JOIN q ON o_orderpriority = label""",
)
def stratified_split(t):
    split = splits.random_split(t.orders, "o_orderkey", 0.3, stratify="o_orderpriority")
    return split.select("o_orderkey", "o_orderpriority", "is_test")


# The predicted flag follows from the quantity alone.
_PRED_SQL = "CASE WHEN l_quantity > 40 THEN 'R' WHEN l_quantity > 10 THEN 'N' ELSE 'X' END"
_PAIRS_SQL = f"SELECT l_returnflag AS y, {_PRED_SQL} AS p FROM lineitem"
_SCORES_SQL = f"""WITH d AS ({_PAIRS_SQL}), l AS (SELECT DISTINCT v FROM (SELECT y AS v FROM d UNION SELECT p FROM d)),
k AS (SELECT v, (SELECT count(*) FROM d WHERE y = v) AS support, (SELECT count(*) FROM d WHERE p = v) AS predicted,
  (SELECT count(*) FROM d WHERE y = v AND p = v) AS hits FROM l),
s AS (SELECT v, support, hits, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN hits / support ELSE 0.0 END AS recall FROM k),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM s)"""


def predicted(t):
    flag = F.when(F.col("l_quantity") > 40, "R").when(F.col("l_quantity") > 10, "N").otherwise("X")
    return t.lineitem.select(F.col("l_returnflag").alias("y"), flag.alias("p"))


@query(
    "e1_classification_metrics",
    f"""{_SCORES_SQL} SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(sum(precision * support) / sum(support), 6) AS precision,
  round(sum(recall * support) / sum(support), 6) AS recall, round(sum(f1 * support) / sum(support), 6) AS f1 FROM f""",
)
def classification_metrics(t):
    return rounded(evaluate.classification_metrics(predicted(t), "y", "p"))


@query(
    "e2_regression_metrics",
    """SELECT round(avg(abs(y - p)), 4) AS mae, round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
  round(1 - avg((y - p) * (y - p)) / var_pop(y), 4) AS r2, round(var_pop(p) / var_pop(y), 4) AS explained_variance
FROM (SELECT l_extendedprice AS y, l_quantity * 2000 + 500 AS p FROM lineitem)""",
)
def regression_metrics(t):
    table = t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000 + 500).alias("p"))
    found = evaluate.regression_metrics(table, "y", "p")
    return rounded(found.withColumn("mse", F.round("mse", 2)), 4)


@query(
    "e3_confusion_matrix",
    f"""SELECT y AS label, count(*) FILTER (WHERE p = 'N') AS "N", count(*) FILTER (WHERE p = 'R') AS "R",
  count(*) FILTER (WHERE p = 'X') AS "X" FROM ({_PAIRS_SQL}) GROUP BY y""",
)
def confusion_matrix(t):
    return evaluate.confusion_matrix(predicted(t), "y", "p")


@query(
    "e4_classification_report",
    f"""{_SCORES_SQL} SELECT v AS label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT round(sum(hits) / sum(support), 6) AS a, CAST(sum(support) AS BIGINT) AS n FROM f)
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f""",
)
def classification_report(t):
    return rounded(evaluate.classification_report(predicted(t), "y", "p"))


@query(
    "m15_task_guard",
    """SELECT target, model, CASE WHEN few THEN 'classification' ELSE 'regression' END = task AS allowed FROM
  (SELECT 'l_returnflag' AS target, true AS few FROM (SELECT count(*) FROM lineitem)
   UNION ALL SELECT 'l_extendedprice', count(DISTINCT l_extendedprice) < 10 OR count(DISTINCT l_extendedprice) / count(*) < 0.05 FROM lineitem),
  (VALUES ('random_forest', 'classification'), ('linear_regression', 'regression')) m(model, task)""",
)
def task_guard(t):
    """Which model suits which target."""
    out = None
    for target in ("l_returnflag", "l_extendedprice"):
        found = models.detect_task(t.lineitem, target)
        for model in ("random_forest", "linear_regression"):
            part = found.select(
                F.lit(target).alias("target"),
                F.lit(model).alias("model"),
                (F.col("task") == models.model_spec(model).task).alias("allowed"),
            )
            out = part if out is None else out.unionByName(part)
    return out


@query(
    "m17_confidence",
    """SELECT l_orderkey, l_linenumber, round(greatest(l_discount, l_tax, 1 - l_discount - l_tax), 6) AS confidence FROM lineitem""",
)
def confidence(t):
    shares = F.array("l_discount", "l_tax", 1 - F.col("l_discount") - F.col("l_tax"))
    table = t.lineitem.select("l_orderkey", "l_linenumber", shares.alias("probability"))
    return rounded(models.confidence(table).drop("probability"))


# A linear model with fixed weights.
WEIGHTS = {"l_quantity": 1500.0, "l_discount": -20000.0, "l_tax": 8000.0}
INTERCEPT = 250.0


def _impacts_sql() -> str:
    parts = [
        f"""SELECT id, '{c}' AS feature, {w} * ({c} - (SELECT avg({c}) FROM lineitem)) AS impact, {c} AS value FROM k"""
        for c, w in WEIGHTS.items()
    ]
    base = " + ".join([str(INTERCEPT)] + [f"{w} * (SELECT avg({c}) FROM lineitem)" for c, w in WEIGHTS.items()])
    return f"""SELECT id, feature, impact, value, {base} AS base_value FROM ({union_sql(parts)})"""


_KEYED_SQL = "WITH k AS (SELECT l_orderkey * 10 + l_linenumber AS id, * FROM lineitem)"


def explained(t):
    keyed = t.lineitem.withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return explain.linear_shap(keyed, "id", WEIGHTS, INTERCEPT)


@query(
    "x1_linear_shap",
    f"""{_KEYED_SQL} SELECT id, round(base_value, 4) AS base_value, feature, round(impact, 4) + 0.0 AS impact, round(value, 4) AS value
FROM ({_impacts_sql()})""",
)
def linear_shap(t):
    return rounded(explained(t).select("id", "base_value", F.inline("impacts")), 4)


@query(
    "x3_top_impacts",
    f"""{_KEYED_SQL}, u AS (SELECT *, row_number() OVER (PARTITION BY id, value_q, value_d, value_t ORDER BY abs(impact) DESC, feature) AS rank FROM (
  SELECT id, l_quantity AS value_q, l_discount AS value_d, l_tax AS value_t, unnest([
    {{'feature': 'l_quantity', 'impact': 1500.0 * (l_quantity - (SELECT avg(l_quantity) FROM lineitem))}},
    {{'feature': 'l_discount', 'impact': -20000.0 * (l_discount - (SELECT avg(l_discount) FROM lineitem))}},
    {{'feature': 'l_tax', 'impact': 8000.0 * (l_tax - (SELECT avg(l_tax) FROM lineitem))}}], recursive := true) FROM
    (SELECT DISTINCT id, l_quantity, l_discount, l_tax FROM k)))
SELECT id, CAST(rank AS INTEGER) AS rank, feature, round(impact, 4) + 0.0 AS impact FROM u WHERE rank <= 2""",
)
def top_impacts(t):
    """The two largest impacts of every distinct row."""
    keyed = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), *WEIGHTS).distinct()
    means = t.lineitem.agg(*[F.avg(c).alias(c) for c in WEIGHTS]).first().asDict()
    top = explain.top_impacts(explain.linear_shap(keyed, "id", WEIGHTS, INTERCEPT, means), 2)
    ranked = top.select("id", F.posexplode("impacts").alias("rank", "i"))
    return rounded(ranked.select("id", (F.col("rank") + 1).alias("rank"), "i.feature", "i.impact"), 4)


@query(
    "x4_global_importance",
    f"{_KEYED_SQL} SELECT feature, round(avg(abs(impact)), 4) AS importance FROM ({_impacts_sql()}) GROUP BY feature",
)
def global_importance(t):
    return rounded(explain.global_importance(explained(t)), 4)


@query("x5_background_sample", "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 100")
def background_sample(t):
    return explain.background_sample(t.embeddings, "vec_id", ["label"])
