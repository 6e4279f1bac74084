"""Rates, ratios, counts and sessions over a stream, in append mode; what remembers more is in ``stateful``.

A window is written once, when the watermark has passed its end; rows later than the delay are dropped. State is
one row per label set and open window, or per key for sessions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.functions.columns import epoch_seconds, number, quoted, when_true
from tidemill.functions.lineage import scratch_path
from tidemill.operators.abtest import STICKY_TTL, bucket_rows
from tidemill.operators.logs import select_logs
from tidemill.operators.monitor import SCRAPE_SECONDS, WINDOW_5M
from tidemill.streaming.stateful import alert_stream  # noqa: F401

# Fixed value: log lines older than this are rejected.
LATEST_ARRIVAL = "168 hours"
# How long a metric window waits for late samples; an alert is that much late at most.
METRIC_DELAY = "1 minute"


def read_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder (or one file), in batches of at most ``files_per_batch``.

    A folder is read as it is, so that of another stream's sink only committed files count.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a single file is no folder: as a pattern it is accepted like one
    return reader.parquet(f"{path[:-1]}[{path[-1]}]" if _is_file(spark, path) else path)


def _is_file(spark: SparkSession, path: str) -> bool:
    """Whether a path names one file: the scan of a folder lists files below it."""
    files = spark.read.format("binaryFile").load(path).select("path").limit(1).collect()
    return bool(files) and files[0]["path"].rstrip("/").endswith(path.rstrip("/").rsplit("/", 1)[-1])


def with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Add ``_t``, the watermarked event time; a timestamp without zone counts as UTC."""
    time = F.col(ts)
    if stream.schema[ts].dataType.typeName() == "timestamp_ntz":
        time = F.timestamp_micros((epoch_seconds(time) * 1_000_000).cast("bigint"))
    return stream.withColumn("_t", time).withWatermark("_t", delay)


def sliding_sums_stream(
    stream: DataFrame,
    ts: str,
    by: Sequence[str],
    sums: dict[str, Column],
    window: int,
    step: int = SCRAPE_SECONDS,
    delay: str = METRIC_DELAY,
) -> DataFrame:
    """``(by..., window_end bigint, sums...)``: rows are summed per step, and the steps per sliding window."""
    if window % step:
        raise ValueError(f"window {window} is not a multiple of step {step}")
    steps = (
        with_event_time(stream, ts, delay)
        .groupBy(*by, F.window("_t", f"{step} seconds").alias("_step"))
        .agg(*[F.sum(e).alias(name) for name, e in sums.items()])
    )
    slid = steps.groupBy(
        *by, F.window(F.window_time("_step"), f"{window} seconds", f"{step} seconds").alias("_window")
    ).agg(*[F.sum(name).alias(name) for name in sums])
    return slid.select(*by, F.unix_seconds("_window.end").alias("window_end"), *sums)


def event_rate_stream(
    stream: DataFrame, ts: str, by: Sequence[str] = (), window: int = WINDOW_5M, step: int = SCRAPE_SECONDS, delay: str = METRIC_DELAY
) -> DataFrame:
    """``(by..., window_end, rate)``."""
    counted = sliding_sums_stream(stream, ts, by, {"n": F.lit(1)}, window, step, delay)
    return counted.select(*by, "window_end", (F.col("n") / window).alias("rate"))


def error_ratio_stream(
    stream: DataFrame,
    ts: str,
    is_error: Column,
    by: Sequence[str] = (),
    window: int = WINDOW_5M,
    step: int = SCRAPE_SECONDS,
    delay: str = METRIC_DELAY,
) -> DataFrame:
    """``(by..., window_end, ratio)``."""
    sums = {"errors": when_true(is_error), "n": F.lit(1)}
    counted = sliding_sums_stream(stream, ts, by, sums, window, step, delay)
    return counted.select(*by, "window_end", (F.col("errors") / F.col("n")).alias("ratio"))


def windowed_buckets_stream(
    stream: DataFrame,
    ts: str,
    value: str,
    bounds: Sequence[float],
    by: Sequence[str] = (),
    window: int = WINDOW_5M,
    step: int = SCRAPE_SECONDS,
    delay: str = METRIC_DELAY,
) -> DataFrame:
    """``(by..., window_end, le, count)``: cumulative buckets, from whose table quantiles are read."""
    sums = {f"b{i}": F.expr(f"if({quoted(value)} <= {number(b)}, 1, 0)") for i, b in enumerate(bounds)}
    return sliding_sums_stream(stream, ts, by, sums, window, step, delay).select(*by, "window_end", bucket_rows(bounds))


def gauge_series_stream(
    samples: DataFrame, labels: Sequence[str], step: int, ts: str = "ts", value: str = "value", delay: str = METRIC_DELAY
) -> DataFrame:
    """``(labels..., step_end, value)``: the newest sample of every series in each step."""
    newest = (
        with_event_time(samples, ts, delay)
        .groupBy(*labels, F.window("_t", f"{step} seconds").alias("_window"))
        .agg(F.max_by(value, ts).alias("value"))
    )
    return newest.select(*labels, F.unix_seconds("_window.end").alias("step_end"), "value")


def log_count_stream(
    logs: DataFrame, by: Sequence[str], window: int, pattern: str | None = None, ts: str = "ts", delay: str = LATEST_ARRIVAL
) -> DataFrame:
    """``(by..., window_end, lines)`` per tumbling window."""
    counted = (
        with_event_time(select_logs(logs, pattern=pattern), ts, delay)
        .groupBy(*by, F.window("_t", f"{window} seconds").alias("_window"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return counted.select(*by, F.unix_seconds("_window.end").alias("window_end"), "lines")


def session_stream(
    requests: DataFrame, user: str, ts: str, ttl: int = STICKY_TTL, delay: str = METRIC_DELAY
) -> DataFrame:
    """``(user, session_start, last_hit, hits)`` of sessions that no further hit can renew."""
    return (
        with_event_time(requests, ts, delay)
        .groupBy(user, F.session_window("_t", f"{ttl} seconds").alias("_session"))
        .agg(F.min(ts).alias("session_start"), F.max(ts).alias("last_hit"), F.count(F.lit(1)).alias("hits"))
        .drop("_session")
    )


# State is kept in RocksDB, off the heap; ``transformWithState`` needs it.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_available(stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None) -> DataFrame:
    """Process what is there now, append the result as parquet, and read all of it back.

    A checkpoint keeps its number of state partitions for life: ``partitions`` sets it on the first run (None: the
    session's number of shuffle partitions).
    """
    conf = stream.sparkSession.conf
    wanted = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    usual = {name: conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        conf.set(name, value)
    try:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        )
        query.awaitTermination()
    finally:
        for name, value in usual.items():
            conf.set(name, value) if value is not None else conf.unset(name)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_to_scratch(stream: DataFrame, name: str) -> DataFrame:
    """One run into fresh folders of the shared scratch space."""
    return run_to_folder(stream, scratch_path(stream.sparkSession, name))


def run_to_folder(stream: DataFrame, path: str) -> DataFrame:
    """One run into a folder, with a checkpoint that is not used again."""
    return run_available(stream, path, scratch_path(stream.sparkSession, "stream-state"))


def usage_ratio_stream(
    used: DataFrame,
    limits: DataFrame,
    by: str = "pod",
    window: int = WINDOW_5M,
    ts: str = "ts",
    value: str = "value",
    delay: str = METRIC_DELAY,
) -> DataFrame:
    """``(by, window_end, ratio)``: summed usage over summed limit in each tumbling window that has both.

    Two streams, each summed under its own watermark, are joined on label value and window; state of a window goes
    when both have passed it. The slower one decides when a window is written. Rows that come after the common
    watermark drop on either side.
    """

    def summed(side: DataFrame, name: str) -> DataFrame:
        timed = with_event_time(side, ts, delay)
        return timed.groupBy(by, F.window("_t", f"{window} seconds").alias("_window")).agg(F.sum(value).alias(name))

    top, bottom = summed(used, "used"), summed(limits, "limit")
    joined = top.join(bottom, [by, "_window"]).where(F.col("limit") != 0)
    return joined.select(by, F.unix_seconds("_window.end").alias("window_end"), (F.col("used") / F.col("limit")).alias("ratio"))


def suppress_warnings_stream(
    alerts: DataFrame, equal: Sequence[str] = ("alert", "service"), at: str = "at", delay: str = METRIC_DELAY
) -> DataFrame:
    """The rows of ``alerts`` without the warnings whose ``equal`` labels have a critical alert at the same evaluation.

    ``alerts`` streams a row for each alert and evaluation (epoch seconds) at which it is active. Warnings are joined with
    the critical alerts of their labels and moment, and those that have met none when the watermark has passed them
    are written. State is what the watermark has not passed yet. A null label is equal to none.
    """
    moment = F.timestamp_millis(F.col(at) * 1000 + 1)
    timed = alerts.withColumn("_at", moment).withWatermark("_at", delay)
    critical = timed.where(F.col("severity") == "critical").select(*[F.col(c).alias(f"_{c}") for c in equal], F.col("_at").alias("_when"))
    warnings = timed.where(F.col("severity") == "warning")
    same = [F.col("_at") == F.col("_when"), *[F.col(c) == F.col(f"_{c}") for c in equal]]
    free = warnings.join(critical, same, "left_outer").where(F.col("_when").isNull())
    others = timed.where((F.col("severity") != "warning") | F.col("severity").isNull())
    return others.select(*alerts.columns).union(free.select(*alerts.columns))
