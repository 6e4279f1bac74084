"""Streams with state over several batches, against their batch forms: order, resets, silence, expiry and restarts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_streaming import at, write_batches

from tidemill.functions.lineage import scratch_path
from tidemill.operators import abtest, monitor
from tidemill.operators.monitor import AlertRule
from tidemill.streaming import monitor as streams
from tidemill.streaming import stateful

RULE = AlertRule("r", ">", 1.0, 30, "warning")


def batches_of(spark, path, per_batch=1):
    return streams.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=per_batch)


def run(stream, spark, path=None, checkpoint=None):
    path, checkpoint = path or scratch_path(spark, "out"), checkpoint or scratch_path(spark, "state")
    return streams.run_available(stream, path, checkpoint, 2), path, checkpoint


def fired(found):
    return sorted((r["s"], r["active_at"], r["fired_at"]) for r in found.collect())


def series_of(draw, label, end):
    """Evaluations with gaps and recoveries."""
    return [(t, label, draw.choice([0.0, 2.0, 2.0, 2.0])) for t in range(15, end, 15) if draw.random() > 0.1]


def test_alerts_as_in_batch_whatever_the_order(spark):
    draw = random.Random(3)
    rows = [r for label in ("a", "b", None) for r in series_of(draw, label, 1500)]
    schema = "window_end bigint, s string, value double"
    batch = monitor.alert_episodes(spark.createDataFrame(rows, schema), RULE, 15, ["s"])
    want = sorted(((r["s"], r["active_at"], r["fired_at"]) for r in batch.collect()), key=str)
    assert len(want) > 10
    draw.shuffle(rows)
    by_time = [[r for r in rows if k * 300 <= r[0] < (k + 1) * 300] for k in range(5)]
    path = write_batches(spark, schema, by_time)
    found, _, _ = run(streams.alert_stream(batches_of(spark, path), RULE, 15, "s"), spark)
    assert sorted(((r["s"], r["active_at"], r["fired_at"]) for r in found.collect()), key=str) == want


def test_a_silent_label_fires_and_leaves_no_state(spark):
    schema = "window_end bigint, s string, value double"
    quiet = [(t, "quiet", 2.0) for t in (15, 30, 45)]
    batches = [[quiet[2], (15, "busy", 2.0), quiet[0], quiet[1]], *[[(t, "busy", 0.0)] for t in (120, 135, 150, 165)]]
    path = write_batches(spark, schema, batches)
    alerts = streams.alert_stream(batches_of(spark, path), RULE, 15, "s", delay="20 seconds")
    found, _, checkpoint = run(alerts, spark)
    # its last row was not followed by another one of its own
    assert fired(found) == [("quiet", 15, 45)]
    for variable in ("state", "waiting"):
        kept = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
        labels = {r[0] for r in kept.select(F.col("key").getField("s")).collect()}
        assert "quiet" not in labels


def test_alerts_after_a_restart(spark):
    schema = "window_end bigint, s string, value double"
    rows = [(t, "s", 0.0 if t == 75 else 2.0) for t in range(15, 200, 15)]
    for cut in range(1, len(rows)):
        if cut % 4 and cut != 2:
            continue
        path = write_batches(spark, schema, [rows[:cut]])
        _, out, checkpoint = run(streams.alert_stream(batches_of(spark, path), RULE, 15, "s"), spark)
        spark.createDataFrame(rows[cut:], schema).coalesce(1).write.mode("append").parquet(path)
        found, _, _ = run(streams.alert_stream(batches_of(spark, path), RULE, 15, "s"), spark, out, checkpoint)
        assert fired(found) == [("s", 15, 45), ("s", 90, 120)]


def samples():
    """Counters of two series with a gap and resets, one of them the first sample of a batch."""
    draw, rows = random.Random(5), []
    for pod in ("x", "y"):
        value, t = 100.0, 100.0
        while t < 4000:
            rows.append((at(t), pod, "k", float(value)))
            value = draw.randrange(5) if draw.random() < 0.1 else value + draw.randrange(9)
            t += 20 + draw.randrange(25) + (900 if 1500 < t < 1530 else 0)
    batches = [[r for r in rows if at(k * 500) <= r[0] < at((k + 1) * 500)] for k in range(8)]
    first = min(batches[3])
    batches[3] = [(*r[:3], 1.0) if r is first else r for r in batches[3]]
    draw.shuffle(batches[5])
    return batches


SAMPLES = "ts timestamp_ntz, pod string, kind string, value double"


def test_counter_rates_as_in_batch(spark):
    path = write_batches(spark, SAMPLES, samples())
    table = spark.read.parquet(path)
    for by in (None, ["kind"]):
        stream = stateful.counter_rate_stream(batches_of(spark, path), ["pod", "kind"], 300, 60, by=by, delay="30 seconds")
        found, _, checkpoint = run(stream, spark)
        last = table.agg(F.max("ts")).first()[0].replace(tzinfo=dt.timezone.utc).timestamp() - 30
        want = monitor.counter_rate(table, ["pod", "kind"], 300, 60, by=by).where(F.col("window_end") <= last)
        keys = by or ["pod", "kind"]
        got = {tuple(r[k] for k in [*keys, "window_end"]): r["rate"] for r in found.collect()}
        assert got == pytest.approx({tuple(r[k] for k in [*keys, "window_end"]): r["rate"] for r in want.collect()})
        assert len(got) > 50


def test_series_that_end_leave_no_state(spark):
    rows = [(at(60), "old", "k", 1.0), (at(70), "old", "k", 4.0)]
    later = [[(at(t), "new", "k", float(t))] for t in (80, 900, 1000, 1100)]
    path = write_batches(spark, SAMPLES, [rows, *later])
    stream = stateful.counter_rate_stream(batches_of(spark, path), ["pod", "kind"], 120, 60, delay="10 seconds")
    found, _, checkpoint = run(stream, spark)
    assert {r["window_end"] - 1704067200: r["rate"] * 120 for r in found.where("pod = 'old'").collect()} == {120: 3.0, 180: 3.0}
    kept = spark.read.format("statestore").option("operatorId", 1).option("stateVarName", "state").load(checkpoint)
    assert {r[0] for r in kept.select(F.col("key").getField("pod")).collect()} == {"new"}


def test_increases_and_instant_rates(spark):
    path = write_batches(spark, SAMPLES, samples())
    table = spark.read.parquet(path)
    stream = stateful.counter_increases_stream(batches_of(spark, path), ["pod", "kind"], delay="30 seconds")
    found, _, _ = run(stream, spark)
    want = monitor.counter_increases(table, ["pod", "kind"]).where("increase is not null")
    last = table.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=30)
    columns = ["pod", F.col("ts").cast("timestamp_ntz").alias("ts"), "value", "increase", F.col("since").cast("timestamp_ntz").alias("since")]
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(
        map(tuple, want.where(F.col("ts") <= F.lit(last)).select(*columns).collect())
    )
    near, _, _ = run(stateful.instant_rate_stream(batches_of(spark, path), ["pod", "kind"], delay="30 seconds", keep=40), spark)
    close = found.where(F.unix_micros("ts") - F.unix_micros("since") <= 40_000_000)
    assert 0 < near.count() == close.count() < found.count()


def requests():
    draw = random.Random(8)
    rows = sorted({(draw.randrange(6000), draw.randrange(4)) for _ in range(150)})
    rows = [(i, at(t), u) for i, (t, u) in enumerate(rows, 1)]
    rows.append((0, rows[40][1], rows[40][2]))
    return [[r for r in rows if at(k * 1000) <= r[1] < at((k + 1) * 1000)] for k in range(6)]


TEST = abtest.ABTest("t", [{"name": "a", "model_name": "m"}, {"name": "b", "model_name": "n"}], sticky_ttl=120)


def test_sticky_variants_as_in_batch(spark):
    schema = "id bigint, ts timestamp_ntz, u int"
    path = write_batches(spark, schema, requests())
    table = spark.read.parquet(path)
    found, _, checkpoint = run(stateful.sticky_stream(batches_of(spark, path), TEST, "u", "ts", "id", "30 seconds"), spark)
    found = found.persist()
    last = table.agg(F.max("ts")).first()[0] - dt.timedelta(seconds=30)
    batch = abtest.sticky_assignments(table, TEST, "u", "ts", "id").persist()
    want = batch.where(F.col("ts") <= F.lit(last)).select("id", "u", "session", "variant", "model_name")
    got = found.where("kind = 'assigned'").select("hit", "u", "session", "variant", "model_name")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.select("variant").distinct().count() == 2 and got.agg(F.max("session")).first()[0] > 5
    sessions = batch.groupBy("u", "session", "variant").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"))
    ended = sessions.where(F.col("b") < F.lit(last - dt.timedelta(seconds=120)))
    out = found.where("kind = 'expired'").select(
        "u", "session", "variant", F.col("session_start").cast("timestamp_ntz"), F.col("last_hit").cast("timestamp_ntz"), "hits"
    )
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ended.collect()))


def test_a_variant_is_kept_while_live_and_drawn_anew_after(spark):
    schema = "id bigint, ts timestamp_ntz, u int"
    hits = [[(1, at(0), 1)], [(2, at(119), 1)], [(3, at(239), 1)], [(4, at(360), 1)], [(5, at(2000), 2)], [(6, at(2100), 2)]]
    path = write_batches(spark, schema, hits)
    found, _, _ = run(stateful.sticky_stream(batches_of(spark, path), TEST, "u", "ts", "id", "0 seconds"), spark)
    rows = {(r["kind"], r["hit"] or r["session"]): r for r in found.where("u = 1").collect()}
    assert [rows["assigned", i]["session"] for i in (1, 2, 3, 4)] == [1, 1, 1, 2]
    assert len({rows["assigned", i]["variant"] for i in (1, 2, 3)}) == 1
    assert rows["expired", 1]["variant"] == rows["assigned", 1]["variant"] and rows["expired", 1]["hits"] == 3
    assert rows["expired", 2]["variant"] == rows["assigned", 4]["variant"]


def test_ratio_of_two_streams(spark):
    used = [[(at(10), "a", 2.0), (at(70), "b", 5.0)], [(at(130), "a", 4.0)], [(at(135), "d", 4.0)]]
    used += [[(at(15), "a", 50.0), (at(700), "a", 1.0)], [(at(800), "a", 1.0)]]
    limits = [[(at(20), "a", 4.0), (at(80), "b", 10.0)], [(at(140), "a", 0.0), (at(141), "c", 1.0)], [(at(142), "e", 1.0)]]
    limits += [[(at(710), "a", 2.0)], [(at(820), "a", 1.0)]]
    schema = "ts timestamp_ntz, pod string, value double"
    paths = [write_batches(spark, schema, b) for b in (used, limits)]
    stream = streams.usage_ratio_stream(*[batches_of(spark, p) for p in paths], window=60, delay="30 seconds")
    found, _, _ = run(stream, spark)
    # the late 50 is dropped, a limit of 0 has no ratio, and the last window is still open
    start = 1704067200
    got = {(r["pod"], r["window_end"] - start): r["ratio"] for r in found.collect()}
    assert got == {("a", 60): 0.5, ("b", 120): 0.5, ("a", 720): 0.5}


def test_warnings_are_held_back_while_the_critical_alert_is_active(spark):
    schema = "alert string, service string, severity string, at bigint"
    rows = [("slow", "x", "warning", t) for t in (15, 30, 45, 60)] + [("slow", "x", "critical", t) for t in (30, 45)]
    rows += [("slow", "y", "warning", 30), ("slow", None, "warning", 30), ("slow", None, "critical", 30), ("slow", "x", None, 45)]
    batches = [[r for r in rows if r[3] <= 30], [r for r in rows if r[3] > 30], [("end", "z", "info", 500)], [("end", "z", "info", 900)]]
    path = write_batches(spark, schema, batches)
    found, _, checkpoint = run(streams.suppress_warnings_stream(batches_of(spark, path), delay="15 seconds"), spark)
    table = spark.read.parquet(path)
    want = monitor.suppress_warnings(table, ["alert", "service", "at"])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert ("slow", "x", "warning", 30) not in set(map(tuple, found.collect()))
    assert spark.read.format("statestore").option("joinSide", "left").load(checkpoint).where("key is not null").count() == 0


class Held:
    """State of one key in memory, with the number of entries that were written."""

    def __init__(self):
        self.entries, self.value, self.written, self.timers = [], None, 0, []

    def getListState(self, name, schema):
        return self

    def getValueState(self, name, schema):
        return Value(self)

    def registerTimer(self, at):
        self.timers.append(at)

    def appendList(self, new):
        self.written += len(new)
        self.entries += new

    def put(self, new):
        self.entries = []
        self.appendList(new)

    def clear(self):
        self.entries = []

    def get(self):
        return iter(self.entries)

    def getCurrentWatermarkInMs(self):
        return self.watermark


class Value:
    def __init__(self, held):
        self.held = held

    def exists(self):
        return self.held.value is not None

    def get(self):
        return self.held.value

    def update(self, value):
        self.held.value = value


def test_rows_of_a_key_wait_in_few_entries():
    """Ten thousand rows of a user are three entries, and come back in order, those without a hit number as well."""
    from pyspark.sql import Row

    held, sessions = Held(), stateful._Sessions(3600, stateful.KINDS)
    sessions.names = ["user", "kind", "at", "hit", "session", "session_start", "last_hit", "hits"]
    sessions.init(held)
    rows = [Row(user="u", _t=None, t=i * 1_000_000, hit=None if i == 7 else i) for i in random.Random(1).sample(range(10_000), 10_000)]
    assert list(sessions.handleInputRows(("u",), iter(rows), None)) == [] and held.written == 3
    held.watermark = 5_000_000
    first = list(sessions.handleExpiredTimer(("u",), held, None))
    assert [r["hit"] for r in first] == [None if i == 7 else i for i in range(5001)] and held.written == 5
    held.watermark = 20_000_000
    second = list(sessions.handleExpiredTimer(("u",), held, None))
    assert [r["hit"] for r in second] == [*range(5001, 10_000), None] and second[-1]["hits"] == 10_000 and not held.entries

    only = stateful._Sessions(3600, ["expired"])
    assert only.follow(("u",), None, [(0, 1), (4000 * 10**6, 2)], 10**10)[0] == [
        r for r in stateful._Sessions(3600, stateful.KINDS).follow(("u",), None, [(0, 1), (4000 * 10**6, 2)], 10**10)[0] if r[1] == "expired"
    ]
