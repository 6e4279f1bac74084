"""Log queries: label and text filters, counts over time, JSON fields and message patterns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.monitor import step_start

# Text patterns of the log queries.
ERROR_PATTERN = "(?i)error|exception|fail"
FAULT_PATTERN = "(?i)error|exception"
MESSAGE_PATTERNS = [' error="([^"]*)"', "Exception: (.*)", "Error: (.*)"]


def select_logs(
    logs: DataFrame, labels: Mapping[str, str | Sequence[str]] | None = None, pattern: str | None = None
) -> DataFrame:
    """Lines whose labels are equal to (or among) the given values and whose text matches the pattern."""
    for label, wanted in (labels or {}).items():
        logs = logs.where(F.col(label) == wanted if isinstance(wanted, str) else F.col(label).isin(list(wanted)))
    return logs if pattern is None else logs.where(F.col("line").rlike(pattern))


def count_over_time(logs: DataFrame, by: Sequence[str], window: int, ts: str = "ts") -> DataFrame:
    """``(by..., window_end, lines)`` per tumbling window of ``window`` seconds."""
    end = step_start(F.col(ts), window) + window
    return logs.groupBy(*by, end.alias("window_end")).agg(F.count(F.lit(1)).alias("lines"))


def json_field_above(logs: DataFrame, field: str, threshold: float, marker: str | None = None) -> DataFrame:
    """Lines with a numeric JSON field above the threshold, added as ``value``; other lines do not parse and drop out."""
    found = logs if marker is None else logs.where(F.col("line").contains(marker))
    value = F.get_json_object("line", f"$.{field}").try_cast("double")
    return found.withColumn("value", value).where(F.col("value") > threshold)


def message_of(line: Column, patterns: Sequence[str] = MESSAGE_PATTERNS) -> Column:
    """The first pattern's capture that is not empty, else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in patterns])


def top_messages(
    logs: DataFrame, k: int = 10, pattern: str | None = FAULT_PATTERN, patterns: Sequence[str] = MESSAGE_PATTERNS
) -> DataFrame:
    """``(message, lines)``: the k most frequent messages among matching lines."""
    counted = (
        select_logs(logs, pattern=pattern)
        .select(message_of(F.col("line"), patterns).alias("message"))
        .where(F.col("message").isNotNull())
        .groupBy("message")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return counted.orderBy(F.col("lines").desc(), "message").limit(k)


def top_lines_with(logs: DataFrame, word: str, extract: str, k: int = 10, pattern: str = FAULT_PATTERN) -> DataFrame:
    """``(query_pattern, lines)``: the k most frequent extracts among faulty lines that hold a word."""
    kept = select_logs(logs, pattern=pattern).where(F.col("line").contains(word))
    counted = kept.groupBy(F.regexp_extract("line", extract, 1).alias("query_pattern")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return counted.orderBy(F.col("lines").desc(), "query_pattern").limit(k)
