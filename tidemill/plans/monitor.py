"""Monitoring queries over events: the type is the endpoint, ``error`` a failed request, the value milliseconds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import monitor
from tidemill.operators.abtest import LATENCY_BUCKETS, histogram_buckets
from tidemill.plans.abtest import bucket_rows_sql
from tidemill.plans.base import LINEITEM_NUMBERS, query, rounded, union_sql


def sliding_sql(source: str, by: str, sums: str, window: int, step: int) -> str:
    """Every row is copied to each window that holds it; the ends are multiples of the step."""
    group = f"{by}, window_end" if by else "window_end"
    return f"""SELECT {group}, {sums} FROM (SELECT s.*,
  unnest(range(CAST(floor(epoch_us(ts) / {step * 1000000}.0) AS BIGINT) * {step} + {step},
    CAST(floor(epoch_us(ts) / {step * 1000000}.0) AS BIGINT) * {step} + {window} + 1, {step})) AS window_end FROM ({source}) s) GROUP BY {group}"""


def _rate(name: str, by: list[str], window: int, step: int, source: str, prepare) -> None:
    sql = f"SELECT {', '.join([*by, 'window_end'])}, round(n / {window}.0, 6) AS rate FROM ({sliding_sql(source, ', '.join(by), 'count(*) AS n', window, step)})"
    query(name, sql)(lambda t: rounded(monitor.event_rate(prepare(t), "ts", by, window, step)))


_rate("t1_event_rate_5m", ["event_type"], 300, 15, "SELECT ts, event_type FROM events", lambda t: t.events)
_rate("t1_event_rate_1m", [], 60, 15, "SELECT ts FROM events", lambda t: t.events)
_rate("t1_event_rate_1h", ["event_type"], 3600, 300, "SELECT ts, event_type FROM events", lambda t: t.events)
_STATUS_SQL = "SELECT ts, event_type, CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status FROM events"


@query(
    "t5_throughput",
    f"""WITH s AS ({_STATUS_SQL}), r AS ({sliding_sql(_STATUS_SQL, 'status, event_type', 'count(*) AS n', 3600, 300)}),
g AS (SELECT status, event_type, unnest(ends) AS window_end FROM (
  SELECT status, event_type, range(min(window_end), max(window_end) + 1, 300) AS ends FROM r GROUP BY status, event_type))
SELECT status, event_type, window_end, round(coalesce(n, 0) / 3600.0, 6) AS rate FROM g LEFT JOIN r USING (status, event_type, window_end)""",
)
def throughput(t):
    """Every window from the first to the last of a label set, those without traffic too."""
    table = t.events.withColumn("status", F.when(F.col("event_type") == "error", "500").otherwise("200"))
    return rounded(monitor.throughput(table, "ts", ["status", "event_type"], 3600, 300))



# Counter samples: k of the properties falls often, so resets are common.
_COUNTER_SQL = """SELECT event_type, CAST(user_id % 5 AS INTEGER) AS pod, ts,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events"""


def counters_of(t):
    return t.events.select(
        "event_type",
        (F.col("user_id") % 5).cast("int").alias("pod"),
        "ts",
        F.get_json_object("props", "$.k").cast("double").alias("value"),
    )


GROWN_SQL = f"""SELECT event_type, pod, ts, since, CASE WHEN value < last THEN value ELSE value - last END AS grown FROM (
  SELECT *, lag(value) OVER s AS last, lag(ts) OVER s AS since FROM ({_COUNTER_SQL}) WINDOW s AS (PARTITION BY event_type, pod ORDER BY ts))
WHERE last IS NOT NULL"""


def grown_sql(by: str, window: int, step: int) -> str:
    """Every increase is copied to each window that holds both of its samples."""
    first = f"CAST(floor(epoch_us(%s) / {step * 1000000}.0) AS BIGINT) * {step}"
    return f"""SELECT {by}, window_end, sum(grown) AS grown FROM (SELECT s.*,
  unnest(range({first % "ts"} + {step}, {first % "since"} + {window} + 1, {step})) AS window_end FROM ({GROWN_SQL}) s) GROUP BY {by}, window_end"""


@query(
    "t1_counter_rate_1h",
    f"SELECT event_type, pod, window_end, round(grown / 3600.0, 6) AS rate FROM ({grown_sql('event_type, pod', 3600, 300)})",
)
def counter_rate(t):
    return rounded(monitor.counter_rate(counters_of(t), ["event_type", "pod"], 3600, 300))


@query(
    "t1_counter_rate_by_pod",
    f"SELECT pod, window_end, round(grown / 3600.0, 6) AS rate FROM ({grown_sql('pod', 3600, 900)})",
)
def counter_rate_by_pod(t):
    return rounded(monitor.counter_rate(counters_of(t), ["event_type", "pod"], 3600, 900, by=["pod"]))


@query(
    "t2_irate",
    f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY event_type, pod ORDER BY ts DESC) AS n FROM ({_COUNTER_SQL}))
SELECT event_type, pod, round(CASE WHEN a.value < b.value THEN a.value ELSE a.value - b.value END
  / ((epoch_us(a.ts) - epoch_us(b.ts)) / 1000000.0), 6) AS rate
FROM (SELECT * FROM s WHERE n = 1) a JOIN (SELECT * FROM s WHERE n = 2) b USING (event_type, pod)""",
)
def irate(t):
    return rounded(monitor.instant_rate(counters_of(t), ["event_type", "pod"]))


RATIO_SQL = f"""SELECT window_end, errors / n AS ratio FROM ({sliding_sql(
    "SELECT ts, event_type FROM events", "", "count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) AS n", 3600, 300)})"""


def ratio_of(t):
    return monitor.error_ratio(t.events, "ts", F.col("event_type") == "error", window=3600, step=300)


@query("t3_error_ratio", f"SELECT window_end, round(ratio, 6) AS ratio FROM ({RATIO_SQL})")
def error_ratio(t):
    return rounded(ratio_of(t))


_ENDPOINTS_SQL = "SELECT event_type AS endpoint, value / 100 AS seconds FROM events"


def _quantile_sql(buckets: str, by: str, q: float) -> str:
    """Buckets ``(by, le, count)``; the rank lies in the first bucket that reaches it."""
    return f"""SELECT {by}, CASE WHEN le = 'inf'::DOUBLE THEN low ELSE coalesce(low, 0) + (le - coalesce(low, 0)) * (rank - below) / (count - below) END AS quantile
FROM (SELECT *, {q}::DOUBLE * max(count) OVER (PARTITION BY {by}) AS rank, lag(le) OVER (PARTITION BY {by} ORDER BY le) AS low,
  coalesce(lag(count) OVER (PARTITION BY {by} ORDER BY le), 0) AS below FROM ({buckets})) WHERE count >= rank AND rank > 0
QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY le) = 1"""


def _register_quantile(q: float) -> None:
    name = f"t4_histogram_quantile_p{round(q * 100)}"
    buckets_sql = bucket_rows_sql(_ENDPOINTS_SQL, "endpoint", "seconds")
    sql = f"SELECT endpoint, round(quantile, 6) AS quantile FROM ({_quantile_sql(buckets_sql, 'endpoint', q)})"

    def run(t):
        table = t.events.select(F.col("event_type").alias("endpoint"), (F.col("value") / 100).alias("seconds"))
        buckets = histogram_buckets(table, "seconds", ["endpoint"], LATENCY_BUCKETS)
        return rounded(monitor.histogram_quantile(buckets, q, ["endpoint"]))

    query(name, sql)(run)


for _q in (0.5, 0.95, 0.99):
    _register_quantile(_q)


WINDOWED_QUANTILE_SQL = f"""WITH w AS ({sliding_sql("SELECT ts, event_type, value / 100 AS seconds FROM events", "event_type",
        ", ".join(f"count(*) FILTER (WHERE seconds <= '{b}'::DOUBLE) AS b{i}" for i, b in enumerate(LATENCY_BUCKETS)), 3600, 900)}),
b AS ({union_sql([f"SELECT event_type || window_end AS k, event_type, window_end, '{b}'::DOUBLE AS le, b{i} AS count FROM w" for i, b in enumerate(LATENCY_BUCKETS)])}),
q AS ({_quantile_sql("SELECT k, le, count FROM b", "k", 0.95)})
SELECT DISTINCT b.event_type, b.window_end, round(q.quantile, 6) AS quantile FROM q JOIN b USING (k)"""


@query("t4_windowed_quantile", WINDOWED_QUANTILE_SQL)
def windowed_quantile(t):
    table = t.events.withColumn("seconds", F.col("value") / 100)
    buckets = monitor.windowed_buckets(table, "ts", "seconds", LATENCY_BUCKETS, ["event_type"], 3600, 900)
    return rounded(monitor.histogram_quantile(buckets, 0.95, ["event_type", "window_end"]))


@query(
    "t6_usage_ratio",
    """SELECT pod, round(sum(value) / sum(k), 6) AS ratio FROM (SELECT CAST(user_id % 5 AS INTEGER) AS pod, value,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY pod""",
)
def usage_ratio(t):
    used = t.events.select((F.col("user_id") % 5).cast("int").alias("pod"), "value")
    return rounded(monitor.usage_ratio(used, counters_of(t).select("pod", "value")))


_LATEST_SQL = f"SELECT event_type, pod, max_by(value, ts) AS value FROM ({_COUNTER_SQL}) GROUP BY ALL"


@query("t7_gauge_latest", _LATEST_SQL)
def gauge_latest(t):
    return monitor.latest_gauge(counters_of(t), ["event_type", "pod"])


@query("t7_gauge_sum_by", f"SELECT pod, sum(value) AS value FROM ({_LATEST_SQL}) GROUP BY pod")
def gauge_sum_by(t):
    return monitor.gauge_sum_by(counters_of(t), ["event_type", "pod"], ["pod"])


GAUGE_SERIES_SQL = f"""SELECT event_type, pod, CAST(floor(epoch_us(ts) / 900000000.0) AS BIGINT) * 900 + 900 AS step_end,
  max_by(value, ts) AS value FROM ({_COUNTER_SQL}) GROUP BY ALL"""


@query("t7_gauge_series", GAUGE_SERIES_SQL)
def gauge_series(t):
    return monitor.gauge_series(counters_of(t), ["event_type", "pod"], 900)


@query(
    "t7_gauge_difference",
    f"""WITH l AS ({_LATEST_SQL}) SELECT a.pod, a.value - b.value AS value FROM l a JOIN l b USING (pod)
WHERE a.event_type = 'view' AND b.event_type = 'click'""",
)
def gauge_difference(t):
    newest = monitor.latest_gauge(counters_of(t), ["event_type", "pod"])
    views, clicks = (newest.where(F.col("event_type") == e) for e in ("view", "click"))
    return monitor.gauge_difference(views, clicks, ["pod"])


@query("t8_count_distinct_label", "SELECT count(DISTINCT user_id) AS n FROM events")
def count_distinct_label(t):
    return monitor.distinct_label_values(t.events, "user_id")


@query(
    "t9_topk",
    "SELECT event_id, event_type, value FROM events ORDER BY value DESC, event_id LIMIT 10",
)
def topk(t):
    return monitor.topk(t.events.select("event_id", "event_type", "value"), "value", 10, ["event_id"])


@query(
    "t9_topk_average",
    """SELECT user_id, round(avg(value), 6) AS value FROM events WHERE ts > TIMESTAMP '2024-01-15' GROUP BY user_id
ORDER BY avg(value) DESC, user_id LIMIT 10""",
)
def topk_average(t):
    since = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return rounded(monitor.topk_average(t.events, "user_id", 10, since))


RULE = monitor.AlertRule("HighErrorRate", ">", 0.2, 900, "critical")


@query(
    "t10_alert_threshold_for",
    f"""WITH s AS (SELECT window_end AS w, window_end - 300 * row_number() OVER (ORDER BY window_end) AS island
  FROM ({RATIO_SQL}) WHERE ratio > 0.2::DOUBLE)
SELECT 'HighErrorRate' AS alert, 'critical' AS severity, min(w) AS active_at, min(w) + 900 AS fired_at, max(w) AS last_at
FROM s GROUP BY island HAVING max(w) >= min(w) + 900""",
)
def alert_threshold_for(t):
    return monitor.alert_episodes(ratio_of(t), RULE, 300, value="ratio")


def episodes_sql(rule: monitor.AlertRule, series: str, step: int) -> str:
    """Runs of evaluations in a row for which the rule holds, if they outlast its hold time. ``series``: (w, v)."""
    wait = -(-rule.hold // step) * step
    return f"""SELECT '{rule.name}' AS alert, '{rule.severity}' AS severity, min(w) AS active_at, min(w) + {wait} AS fired_at, max(w) AS last_at
FROM (SELECT w, w - {step} * row_number() OVER (ORDER BY w) AS island FROM ({series}) WHERE v {rule.comparison} {rule.threshold}::DOUBLE)
GROUP BY island HAVING max(w) >= min(w) + {wait}"""


def _quantile_series_sql(divisor: int) -> str:
    """The 95th percentile of each window, from cumulative bucket counts."""
    counts = ", ".join(f"count(*) FILTER (WHERE seconds <= '{b}'::DOUBLE) AS b{i}" for i, b in enumerate(LATENCY_BUCKETS))
    buckets = union_sql([f"SELECT window_end, '{b}'::DOUBLE AS le, b{i} AS count FROM c" for i, b in enumerate(LATENCY_BUCKETS)])
    return f"""SELECT window_end AS w, quantile AS v FROM (WITH c AS ({sliding_sql(f"SELECT ts, value / {divisor} AS seconds FROM events", "", counts, 3600, 900)})
  {_quantile_sql(buckets, "window_end", 0.95)})"""


_STEP = 900
_SPAN_SQL = f"CAST(floor(epoch_us(ts) / {_STEP * 1000000}.0) AS BIGINT) * {_STEP}"
_RATES_SQL = f"""SELECT w, coalesce(n, 0) / 3600.0 AS v FROM (
  SELECT unnest(range(min({_SPAN_SQL}) + {_STEP}, max({_SPAN_SQL}) + 3600 + 1, {_STEP})) AS w FROM events)
  LEFT JOIN (SELECT window_end AS w, n FROM ({sliding_sql("SELECT ts FROM events", "", "count(*) AS n", 3600, _STEP)})) USING (w)"""
_K_SQL = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"


def _seconds(t, divisor: int):
    table = t.events.withColumn("seconds", F.col("value") / divisor)
    buckets = monitor.windowed_buckets(table, "ts", "seconds", LATENCY_BUCKETS, [], 3600, _STEP)
    return monitor.histogram_quantile(buckets, 0.95, ["window_end"]).withColumnRenamed("quantile", "value")


def _usage(t, divisor: float):
    """Usage over a fixed limit in each step, by the newest sample."""
    used = monitor.gauge_series(counters_of(t).withColumn("one", F.lit(1)), ["one"], _STEP)
    return used.select(F.col("step_end").alias("window_end"), (F.col("value") / divisor).alias("value"))


def _usage_sql(divisor: float) -> str:
    return f"SELECT {_SPAN_SQL} + {_STEP} AS w, max_by({_K_SQL}, ts) / {divisor}::DOUBLE AS v FROM events GROUP BY 1"


# Every rule over the series that feeds it: samples, windows, values, episodes.
_RULE_SERIES = {
    "HighErrorRate": (
        f"SELECT window_end AS w, ratio AS v FROM ({RATIO_SQL})",
        300,
        lambda t: ratio_of(t).withColumnRenamed("ratio", "value"),
    ),
    "HighLatency": (_quantile_series_sql(100), _STEP, lambda t: _seconds(t, 100)),
    "LowThroughput": (
        _RATES_SQL,
        _STEP,
        lambda t: monitor.throughput(t.events, "ts", [], 3600, _STEP).withColumnRenamed("rate", "value"),
    ),
    "DriftDetected": (_usage_sql(200.0), _STEP, lambda t: _usage(t, 200.0)),
    "HighPredictionLatency": (_quantile_series_sql(1000), _STEP, lambda t: _seconds(t, 1000)),
    "HighCpuUsage": (_usage_sql(60.0), _STEP, lambda t: _usage(t, 60.0)),
    "HighMemoryUsage": (_usage_sql(40.0), _STEP, lambda t: _usage(t, 40.0)),
}


def _register_rule(rule: monitor.AlertRule) -> None:
    series, step, run = _RULE_SERIES[rule.name]
    name = "t10_rule_" + "".join("_" + c.lower() if c.isupper() else c for c in rule.name).strip("_")
    query(name, episodes_sql(rule, series, step))(lambda t: monitor.alert_episodes(run(t), rule, step))


for _rule in monitor.ALERT_RULES:
    _register_rule(_rule)


_ALERTS_SQL = """SELECT event_type AS alert, CAST(user_id AS INTEGER) AS service, CAST(user_id % 2 AS INTEGER) AS job,
  CASE WHEN value > 200 THEN 'critical' WHEN value > 50 THEN 'warning' ELSE 'info' END AS severity FROM events"""


def alerts_of(t):
    severity = F.when(F.col("value") > 200, "critical").when(F.col("value") > 50, "warning").otherwise("info")
    return t.events.select(
        F.col("event_type").alias("alert"),
        F.col("user_id").cast("int").alias("service"),
        (F.col("user_id") % 2).cast("int").alias("job"),
        severity.alias("severity"),
    )


@query(
    "t11_alert_route",
    f"""SELECT alert, job, severity, CASE severity WHEN 'critical' THEN 'slack-critical' WHEN 'warning' THEN 'slack-warnings'
  ELSE 'email-notifications' END AS receiver, count(*) AS alerts FROM ({_ALERTS_SQL}) GROUP BY ALL""",
)
def alert_route(t):
    return monitor.route_alerts(alerts_of(t))


@query(
    "t11_suppress_warnings",
    """WITH a AS (SELECT event_type AS alert, CAST(user_id AS INTEGER) AS service,
  CASE WHEN value > 200 THEN 'critical' WHEN value > 50 THEN 'warning' ELSE 'info' END AS severity FROM events)
SELECT alert, service, severity, count(*) AS alerts FROM a WHERE severity <> 'warning' OR NOT EXISTS (SELECT 1 FROM a c
  WHERE c.severity = 'critical' AND c.alert = a.alert AND c.service = a.service) GROUP BY ALL""",
)
def suppress_warnings(t):
    kept = monitor.suppress_warnings(alerts_of(t))
    return kept.groupBy("alert", "service", "severity").agg(F.count(F.lit(1)).alias("alerts"))


FEATURES = [c for c in LINEITEM_NUMBERS if c != "l_extendedprice"]


@query(
    "t16_feature_target_correlation",
    union_sql(
        [f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 6) AS correlation FROM lineitem" for c in FEATURES]
    ),
)
def feature_target_correlation(t):
    return rounded(monitor.feature_target_correlation(t.lineitem, FEATURES, "l_extendedprice"))


@query(
    "t17_prediction_metrics",
    f"""WITH b AS ({bucket_rows_sql("SELECT event_type AS model_name, CAST(user_id % 2 AS INTEGER) AS version, value / 1000 AS latency FROM events", "model_name, version", "latency", "bucket_count")}),
s AS (SELECT event_type AS model_name, CAST(user_id % 2 AS INTEGER) AS version, count(*) AS predictions, round(sum(value / 1000), 6) AS latency_sum
  FROM events GROUP BY ALL)
SELECT model_name, version, predictions, latency_sum, le, bucket_count FROM b JOIN s USING (model_name, version)""",
)
def prediction_metrics(t):
    log = t.events.select(
        F.col("event_type").alias("model_name"),
        (F.col("user_id") % 2).cast("int").alias("version"),
        (F.col("value") / 1000).alias("latency"),
    )
    return rounded(monitor.prediction_metrics(log, LATENCY_BUCKETS))
