"""Streams over several batches: late rows drop, sessions renew, alerts fire once."""

import datetime as dt

import pytest

from tidemill.functions.lineage import scratch_path
from tidemill.operators.monitor import AlertRule
from tidemill.streaming import monitor as streams

START = dt.datetime(2024, 1, 1)


def write_batches(spark, schema, batches):
    """One parquet file per batch, in order of name and time."""
    path = scratch_path(spark, "stream-test")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return path


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_late_rows_drop(spark, kind):
    schema = f"ts {kind}, k string"
    batches = [
        [(at(0), "a"), (at(30), "a")],
        [(at(600), "a")],
        [(at(605), "a")],
        [(at(10), "a"), (at(610), "a")],  # the first one is late: its window was written two batches ago
        [(at(2000), "a")],
    ]
    path = write_batches(spark, schema, batches)
    stream = streams.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    counted = streams.log_count_stream(stream.withColumnRenamed("k", "pod"), ["pod"], 60, delay="60 seconds")
    got = {r["window_end"] - 1704067200: r["lines"] for r in streams.run_to_scratch(counted, "late").collect()}
    assert got == {60: 2, 660: 3}


def test_sessions_renew_across_batches(spark):
    schema = "ts timestamp_ntz, u int"
    batches = [[(at(0), 1)], [(at(50), 1), (at(60), 2)], [(at(110), 1)], [(at(5000), 9)]]
    path = write_batches(spark, schema, batches)
    stream = streams.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    found = streams.run_to_scratch(streams.session_stream(stream, "u", "ts", 60, "10 seconds"), "sessions-test")
    assert sorted((r["u"], r["session_start"], r["last_hit"], r["hits"]) for r in found.collect()) == [
        (1, at(0), at(110), 3),
        (2, at(60), at(60), 1),
    ]


def test_alert_fires_once_and_again_after_recovery(spark):
    values = [(0, 2.0), (15, 2.0), (30, 2.0), (45, 2.0), (60, 0.0), (75, 2.0), (105, 2.0), (120, 2.0), (135, 2.0)]
    batches = [[(t, "s", v)] for t, v in values]
    path = write_batches(spark, "window_end bigint, s string, value double", batches)
    series = streams.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    alerts = streams.alert_stream(series, AlertRule("r", ">", 1.0, 30, "warning"), 15, "s")
    found = streams.run_to_scratch(alerts, "alerts-test")
    # 75 is followed by a missing evaluation, so the wait starts anew at 105
    assert sorted((r["active_at"], r["fired_at"]) for r in found.collect()) == [(0, 30), (105, 135)]
