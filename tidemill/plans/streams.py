"""Streaming queries: the event files as a stream, compared with the batch result of the closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.operators import abtest, monitor
from tidemill.operators.abtest import LATENCY_BUCKETS
from tidemill.plans import abtest as abtest_plans
from tidemill.plans import logs as log_plans
from tidemill.plans import monitor as monitor_plans
from tidemill.plans.base import query, rounded
from tidemill.streaming import monitor as streams
from tidemill.streaming import stateful

DELAY = "1 hour"
# What is still open when the last event has come: the watermark trails it by an hour.
_CLOSED_SQL = "(SELECT (epoch_us(max(ts)) - 3600000000) / 1000000.0 FROM events)"


def stream_of(t):
    return streams.read_stream(t.spark, t.path("events"), t.events.schema)


def _closed(sql: str) -> str:
    return f"SELECT * FROM ({sql}) WHERE window_end <= {_CLOSED_SQL}"


@query(
    "t1_event_rate_stream",
    _closed(
        f"SELECT event_type, window_end, round(n / 3600.0, 6) AS rate FROM ({monitor_plans.sliding_sql('SELECT ts, event_type FROM events', 'event_type', 'count(*) AS n', 3600, 900)})"
    ),
)
def event_rate(t):
    stream = streams.event_rate_stream(stream_of(t), "ts", ["event_type"], 3600, 900, DELAY)
    return rounded(streams.run_to_scratch(stream, "rate"))


@query("t3_error_ratio_stream", _closed(f"SELECT window_end, round(ratio, 6) AS ratio FROM ({monitor_plans.RATIO_SQL})"))
def error_ratio(t):
    failed = F.col("event_type") == "error"
    stream = streams.error_ratio_stream(stream_of(t), "ts", failed, window=3600, step=300, delay=DELAY)
    return rounded(streams.run_to_scratch(stream, "ratio"))


@query(
    "t4_bucket_stream",
    f"SELECT * FROM ({monitor_plans.WINDOWED_QUANTILE_SQL}) WHERE window_end <= {_CLOSED_SQL}",
)
def bucket_quantiles(t):
    """The stream keeps the buckets; their quantiles are read from the table it writes."""
    timed = stream_of(t).withColumn("seconds", F.col("value") / 100)
    stream = streams.windowed_buckets_stream(timed, "ts", "seconds", LATENCY_BUCKETS, ["event_type"], 3600, 900, DELAY)
    buckets = streams.run_to_scratch(stream, "buckets")
    return rounded(monitor.histogram_quantile(buckets, 0.95, ["event_type", "window_end"]))


@query(
    "t7_gauge_series_stream",
    f"""SELECT event_type, pod, step_end, value FROM ({monitor_plans.GAUGE_SERIES_SQL}) WHERE step_end <= {_CLOSED_SQL}""",
)
def gauge_series(t):
    samples = stream_of(t).select(
        "event_type",
        (F.col("user_id") % 5).cast("int").alias("pod"),
        "ts",
        F.get_json_object("props", "$.k").cast("double").alias("value"),
    )
    stream = streams.gauge_series_stream(samples, ["event_type", "pod"], 900, delay=DELAY)
    return streams.run_to_scratch(stream, "gauges")


@query(
    "t13_log_count_stream",
    _closed(
        f"SELECT container, {log_plans.window_sql(300)} AS window_end, count(*) AS lines FROM ({log_plans.LOGS_SQL}) GROUP BY ALL"
    ),
)
def log_count(t):
    lines = stream_of(t).select(
        "ts", F.col("event_type").alias("container"), F.concat_ws(" ", "event_type", "props").alias("line")
    )
    stream = streams.log_count_stream(lines, ["container"], 300, delay=DELAY)
    return streams.run_to_scratch(stream, "lines")


@query(
    "a2_session_stream",
    f"""SELECT user_id, session_start, last_hit, hits FROM (SELECT user_id, session, min(ts) AS session_start, max(ts) AS last_hit,
  count(*) AS hits FROM ({abtest_plans.SESSIONS_SQL}) GROUP BY user_id, session)
WHERE epoch_us(last_hit) + 3600000000 <= (SELECT epoch_us(max(ts)) - 3600000000 FROM events)""",
)
def sessions(t):
    stream = streams.session_stream(stream_of(t), "user_id", "ts", 3600, DELAY)
    return streams.run_to_scratch(stream, "sessions")


_RATIO_BY_TYPE_SQL = f"""SELECT pod, window_end, big / n AS ratio FROM ({monitor_plans.sliding_sql(
    "SELECT ts, CAST(user_id % 2 AS INTEGER) AS pod, event_type FROM events", "pod",
    "count(*) FILTER (WHERE event_type = 'error') AS big, count(*) AS n", 7200, 900)})"""


@query(
    "t10_alert_stream",
    f"""WITH s AS (SELECT pod, window_end AS w, window_end - 900 * row_number() OVER (PARTITION BY pod ORDER BY window_end) AS island
  FROM ({_closed(_RATIO_BY_TYPE_SQL)}) WHERE ratio > 0.2::DOUBLE)
SELECT 'HighErrorRate' AS alert, 'critical' AS severity, pod, min(w) AS active_at, min(w) + 900 AS fired_at
FROM s GROUP BY pod, island HAVING max(w) >= min(w) + 900""",
)
def alerts(t):
    requests = stream_of(t).select("ts", (F.col("user_id") % 2).cast("int").alias("pod"), "event_type")
    failed = F.col("event_type") == "error"
    series = streams.error_ratio_stream(requests, "ts", failed, ["pod"], 7200, 900, DELAY)
    rule = monitor.AlertRule("HighErrorRate", ">", 0.2, 900, "critical")
    folder = scratch_path(t.spark, "series")
    streams.run_to_folder(series, folder)
    evaluations = streams.read_stream(t.spark, folder, series.schema)
    return streams.run_to_scratch(streams.alert_stream(evaluations, rule, 900, "pod", value="ratio"), "alerts")


def samples_of(t):
    k = F.get_json_object("props", "$.k").cast("double")
    return stream_of(t).select("event_type", (F.col("user_id") % 5).cast("int").alias("pod"), "ts", k.alias("value"))


@query(
    "t1_counter_rate_stream",
    _closed(f"SELECT event_type, pod, window_end, round(grown / 3600.0, 6) AS rate FROM ({monitor_plans.grown_sql('event_type, pod', 3600, 300)})"),
)
def counter_rate(t):
    """Resets and gaps across batches: the last sample of each series is state."""
    stream = stateful.counter_rate_stream(samples_of(t), ["event_type", "pod"], 3600, 300, delay=DELAY)
    return rounded(streams.run_to_scratch(stream, "counter-rate"))


@query(
    "t2_irate_stream",
    f"""SELECT event_type, pod, ts, round(grown / ((epoch_us(ts) - epoch_us(since)) / 1000000.0), 6) AS rate FROM ({monitor_plans.GROWN_SQL})
WHERE epoch_us(ts) - epoch_us(since) BETWEEN 1 AND 7200000000 AND epoch_us(ts) <= {_CLOSED_SQL} * 1000000""",
)
def instant_rate(t):
    """At every sample of the stream the increase since the one before, if that is at most two hours ago."""
    stream = stateful.instant_rate_stream(samples_of(t), ["event_type", "pod"], delay=DELAY, keep=7200)
    return rounded(streams.run_to_scratch(stream, "irate").withColumn("ts", F.col("ts").cast("timestamp_ntz")))


_STICKY_SQL = f"""SELECT *, {abtest_plans.variant_sql('user_id', 'session')} AS variant FROM ({abtest_plans.SESSIONS_SQL})"""


@query(
    "a2_sticky_stream",
    f"SELECT event_id, user_id, session, variant FROM ({_STICKY_SQL}) WHERE epoch_us(ts) <= {_CLOSED_SQL} * 1000000",
)
def sticky(t):
    """Every request with the variant of its user's live session, as the batch form draws it."""
    stream = stateful.sticky_stream(stream_of(t), abtest_plans.TEST, "user_id", "ts", "event_id", DELAY)
    found = streams.run_to_scratch(stream, "sticky").where("kind = 'assigned'")
    return found.select(F.col("hit").alias("event_id"), "user_id", "session", "variant")


@query(
    "a3_expiry_stream",
    f"""SELECT user_id, session, variant, min(ts) AS session_start, max(ts) AS last_hit, count(*) AS hits FROM ({_STICKY_SQL})
GROUP BY user_id, session, variant HAVING epoch_us(max(ts)) + 3600000000 < {_CLOSED_SQL} * 1000000""",
)
def expired(t):
    """Sessions that no hit has renewed in time, each with the variant it had."""
    stream = stateful.sticky_stream(stream_of(t), abtest_plans.TEST, "user_id", "ts", "event_id", DELAY, ["expired"])
    found = streams.run_to_scratch(stream, "expired").where("kind = 'expired'")
    moments = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "last_hit")]
    return found.select("user_id", "session", "variant", *moments, "hits")


@query(
    "t6_usage_ratio_stream",
    f"""SELECT pod, window_end, round(used / top, 6) AS ratio FROM (SELECT CAST(user_id % 5 AS INTEGER) AS pod, {log_plans.window_sql(3600)} AS window_end,
  sum(value) FILTER (WHERE event_type <> 'error') AS used, sum(value) FILTER (WHERE event_type = 'error') AS top FROM events GROUP BY ALL)
WHERE top <> 0 AND used IS NOT NULL AND window_end <= least({_CLOSED_SQL}, (SELECT (least(epoch_us(max(ts) FILTER (WHERE event_type = 'error')),
  epoch_us(max(ts) FILTER (WHERE event_type <> 'error'))) - 3600000000) / 1000000.0 FROM events))""",
)
def usage_ratio(t):
    """Two streams with watermarks of their own: the slower one closes a window."""
    timed = stream_of(t).withColumn("pod", (F.col("user_id") % 5).cast("int"))
    other = stream_of(t).withColumn("pod", (F.col("user_id") % 5).cast("int"))
    used, limits = timed.where("event_type <> 'error'"), other.where("event_type = 'error'")
    return rounded(streams.run_to_scratch(streams.usage_ratio_stream(used, limits, window=3600, delay=DELAY), "usage"))


@query(
    "t11_suppress_stream",
    f"""WITH a AS (SELECT 'slow' AS alert, CAST(user_id % 5 AS INTEGER) AS service, CASE WHEN event_type = 'error' THEN 'critical' ELSE 'warning' END AS severity,
  CAST(epoch_us(ts) // 900000000 * 900 AS BIGINT) AS moment FROM events GROUP BY ALL),
k AS (SELECT DISTINCT alert, service, moment FROM a WHERE severity = 'critical')
SELECT alert, service, severity, moment FROM a WHERE severity = 'critical'
UNION ALL SELECT alert, service, severity, moment FROM a ANTI JOIN k USING (alert, service, moment)
WHERE severity = 'warning' AND moment <= (SELECT max(moment) - 3600 FROM a)""",
)
def suppressed(t):
    """A warning is written when the watermark has passed it and no critical alert of its service was active then."""
    moment = (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 900_000_000) * 900).cast("bigint")
    active = t.events.select(
        F.lit("slow").alias("alert"),
        (F.col("user_id") % 5).cast("int").alias("service"),
        F.when(F.col("event_type") == "error", "critical").otherwise("warning").alias("severity"),
        moment.alias("moment"),
    ).distinct()
    folder = scratch_path(t.spark, "active-alerts")
    active.write.parquet(folder)
    stream = streams.read_stream(t.spark, folder, active.schema)
    return streams.run_to_scratch(streams.suppress_warnings_stream(stream, at="moment", delay=DELAY), "suppressed")
