"""Log queries: an event is a log line ``<type> <properties>`` of pod ``pod-<user % 5>``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import logs
from tidemill.plans.base import query, rounded

LOGS_SQL = """SELECT event_id, ts, 'prod' AS namespace, 'pod-' || (user_id % 5) AS pod, event_type AS container,
  CASE WHEN user_id % 2 = 0 THEN 'model-api' ELSE 'training' END AS app, event_type || ' ' || props AS line FROM events"""


def logs_of(t):
    return t.events.select(
        "event_id",
        "ts",
        F.lit("prod").alias("namespace"),
        F.concat(F.lit("pod-"), F.col("user_id") % 5).alias("pod"),
        F.col("event_type").alias("container"),
        F.when(F.col("user_id") % 2 == 0, "model-api").otherwise("training").alias("app"),
        F.concat_ws(" ", "event_type", "props").alias("line"),
    )


@query(
    "t12_log_filter",
    f"""SELECT event_id, pod, line FROM ({LOGS_SQL}) WHERE namespace = 'prod' AND app = 'model-api'
  AND regexp_matches(line, 'error|exception|fail', 'i')""",
)
def log_filter(t):
    found = logs.select_logs(logs_of(t), {"namespace": "prod", "app": "model-api"}, logs.ERROR_PATTERN)
    return found.select("event_id", "pod", "line")


@query(
    "t12_log_selector_set",
    f"SELECT event_id, container FROM ({LOGS_SQL}) WHERE container IN ('view', 'click', 'signup')",
)
def log_selector_set(t):
    return logs.select_logs(logs_of(t), {"container": ["view", "click", "signup"]}).select("event_id", "container")


def window_sql(seconds: int) -> str:
    return f"CAST(floor(epoch_us(ts) / {seconds * 1000000}.0) AS BIGINT) * {seconds} + {seconds}"


@query(
    "t13_log_count_over_time",
    f"""SELECT pod, {window_sql(300)} AS window_end, count(*) AS lines FROM ({LOGS_SQL})
WHERE app = 'model-api' AND regexp_matches(line, 'error|exception|fail', 'i') GROUP BY ALL""",
)
def log_count_over_time(t):
    found = logs.select_logs(logs_of(t), {"app": "model-api"}, logs.ERROR_PATTERN)
    return logs.count_over_time(found, ["pod"], 300)


@query(
    "t13_log_count_by_container",
    f"SELECT container, {window_sql(60)} AS window_end, count(*) AS lines FROM ({LOGS_SQL}) GROUP BY ALL",
)
def log_count_by_container(t):
    return logs.count_over_time(logs_of(t), ["container"], 60)


@query(
    "t14_log_json_filter",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 1 AS value FROM events
WHERE event_type = 'view' AND CAST(json_extract_string(props, '$.k') AS DOUBLE) > 50""",
)
def log_json_filter(t):
    """Views log their properties as JSON; the other lines do not parse."""
    line = F.when(F.col("event_type") == "view", F.col("props")).otherwise(F.concat_ws(" ", "event_type", "props"))
    found = logs.json_field_above(t.events.select("event_id", line.alias("line")), "k", 50, marker='"k"')
    return rounded(found.select("event_id", "value"))


_MESSAGES_SQL = """SELECT event_id, CASE WHEN value > 100 THEN 'level=error error="slow ' || event_type || '" id=' || event_id
  WHEN value > 50 THEN 'Exception: late ' || event_type || ' ' || json_extract_string(props, '$.k')
  WHEN value > 20 THEN 'Error: failed ' || event_type ELSE 'fine' END AS line FROM events"""


def _messages(t):
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    line = (
        F.when(F.col("value") > 100, F.concat(F.lit('level=error error="slow '), kind, F.lit('" id='), F.col("event_id")))
        .when(F.col("value") > 50, F.concat(F.lit("Exception: late "), kind, F.lit(" "), k))
        .when(F.col("value") > 20, F.concat(F.lit("Error: failed "), kind))
        .otherwise("fine")
    )
    return t.events.select("event_id", line.alias("line"))


@query(
    "t15_log_top_patterns",
    f"""SELECT message, count(*) AS lines FROM (SELECT coalesce(nullif(regexp_extract(line, ' error="([^"]*)"', 1), ''),
  nullif(regexp_extract(line, 'Exception: (.*)', 1), ''), nullif(regexp_extract(line, 'Error: (.*)', 1), '')) AS message
  FROM ({_MESSAGES_SQL}) WHERE regexp_matches(line, 'error|exception', 'i')) WHERE message IS NOT NULL
GROUP BY message ORDER BY lines DESC, message LIMIT 10""",
)
def log_top_patterns(t):
    return logs.top_messages(_messages(t))


@query(
    "t15_log_top_queries",
    f"""SELECT regexp_extract(line, 'late ([a-z]+)', 1) AS query_pattern, count(*) AS lines FROM ({_MESSAGES_SQL})
WHERE regexp_matches(line, 'error|exception', 'i') AND contains(line, 'late') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def log_top_queries(t):
    return logs.top_lines_with(_messages(t), "late", "late ([a-z]+)")
