"""A/B test queries over the event log: latency is the event value in seconds, the prediction the value itself."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import abtest
from tidemill.plans.base import md5_sql, query, rounded, union_sql

TEST = abtest.ABTest(
    "events-test",
    [{"name": "control", "model_name": "iris"}, {"name": "wide", "model_name": "iris", "model_version": "2"}, {"name": "deep", "model_name": "net"}],
    [0.5, 0.3, 0.2],
    custom_metrics=["confidence"],
)


def variant_sql(*key: str) -> str:
    draw = f"{md5_sql(repr(TEST.name), *key)} / 1152921504606846976.0"
    return f"CASE WHEN {draw} <= 0.5::DOUBLE THEN 'control' WHEN {draw} <= 0.8::DOUBLE THEN 'wide' ELSE 'deep' END"


_LOG_SQL = f"""SELECT event_id, ts, user_id, value / 1000 AS latency, value AS prediction,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS confidence, {variant_sql("user_id")} AS variant FROM events"""


def log_of(t):
    """The log with variants drawn per user, one of them unknown to the test."""
    k = F.get_json_object("props", "$.k").cast("double")
    log = t.events.select(
        "event_id",
        "ts",
        "user_id",
        (F.col("value") / 1000).alias("latency"),
        F.col("value").alias("prediction"),
        F.create_map(F.lit("confidence"), k / 100, F.lit("unlisted"), k).alias("metrics"),
    )
    return abtest.assign_variants(log, TEST, ["user_id"])


@query(
    "a1_assign_variant",
    f"""SELECT event_id, variant, CASE WHEN variant = 'deep' THEN 'net' ELSE 'iris' END AS model_name,
  CASE WHEN variant = 'wide' THEN '2' ELSE 'latest' END AS model_version FROM ({_LOG_SQL})""",
)
def assign_variant(t):
    return log_of(t).select("event_id", "variant", "model_name", "model_version")


SESSIONS_SQL = """SELECT event_id, ts, user_id, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session
FROM (SELECT event_id, ts, user_id, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)
  <= 3600000000 THEN 0 ELSE 1 END AS opens FROM events)"""


@query(
    "a2_sticky_sessions",
    f"SELECT event_id, user_id, session, {variant_sql('user_id', 'session')} AS variant FROM ({SESSIONS_SQL})",
)
def sticky_sessions(t):
    assigned = abtest.sticky_assignments(t.events, TEST, "user_id", "ts", "event_id")
    return assigned.select("event_id", "user_id", "session", "variant")


@query(
    "a2_session_table",
    f"""SELECT user_id, session, min(ts) AS session_start, max(ts) AS last_hit, count(*) AS hits
FROM ({SESSIONS_SQL}) GROUP BY user_id, session""",
)
def session_table(t):
    return abtest.session_table(t.events, "user_id", "ts", "event_id")


@query(
    "a3_expire_sessions",
    """SELECT user_id, max(ts) AS last_hit FROM events GROUP BY user_id
HAVING epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(ts)) <= 3600000000""",
)
def expire_sessions(t):
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    return abtest.live_sessions(t.events, "user_id", "ts", now)


@query(
    "a4_assignment_counts",
    f"""SELECT 'events-test' AS test_name, CASE WHEN variant = 'deep' THEN 'net' ELSE 'iris' END AS model_name, variant,
  count(*) AS assignments FROM ({_LOG_SQL}) GROUP BY variant""",
)
def assignment_counts(t):
    return abtest.assignment_counts(log_of(t), TEST)


def results_sql(log: str) -> str:
    return f"""SELECT variant, count(*) AS count, round(avg(latency), 6) AS latency_mean, round(quantile_cont(latency, 0.5), 6) AS latency_median,
  round(quantile_cont(latency, 0.95), 6) AS latency_p95, round(min(latency), 6) AS latency_min, round(max(latency), 6) AS latency_max
FROM ({log}) GROUP BY variant"""


@query("a5_ab_results", results_sql(_LOG_SQL))
def ab_results(t):
    return rounded(abtest.ab_results(log_of(t), TEST))


@query(
    "a6_ab_custom_metrics",
    f"""SELECT variant, 'confidence' AS metric, round(avg(confidence), 6) AS mean, round(quantile_cont(confidence, 0.5), 6) AS median,
  min(confidence) AS min, max(confidence) AS max FROM ({_LOG_SQL}) GROUP BY variant""",
)
def ab_custom_metrics(t):
    return rounded(abtest.ab_custom_metrics(log_of(t), TEST))


@query(
    "a7_prediction_histogram",
    f"""SELECT variant, CASE WHEN prediction < 0 THEN 0 WHEN prediction >= 200 THEN 21
  ELSE CAST(floor(prediction / 10) AS BIGINT) + 1 END AS bucket, count(*) AS count FROM ({_LOG_SQL}) GROUP BY ALL""",
)
def prediction_histogram(t):
    return abtest.prediction_histogram(log_of(t), TEST, 0, 200, 20)


def bucket_rows_sql(source: str, by: str, value: str, count: str = "count") -> str:
    return union_sql(
        [
            f"SELECT {by}, CAST('{b}' AS DOUBLE) AS le, count(*) FILTER (WHERE {value} <= CAST('{b}' AS DOUBLE)) AS {count} "
            f"FROM ({source}) GROUP BY {by}"
            for b in abtest.LATENCY_BUCKETS
        ]
    )


@query("a8_latency_histogram", bucket_rows_sql(_LOG_SQL, "variant", "latency"))
def latency_histogram(t):
    return abtest.latency_histogram(log_of(t), TEST)
