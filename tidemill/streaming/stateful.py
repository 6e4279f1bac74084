"""Streams that remember something of each key: alerts, counters and sticky sessions, by ``transformWithState``.

The rows of a key wait in its state until the watermark has passed them, and are then followed in order of time. So the
order of rows within and across batches doesn't matter, and what is due for a key that has gone silent is done when
others move the watermark on. Rows later than the watermark drop. What waits of one key is in memory together: the size
of a batch bounds it. Such streams need the RocksDB state store (see ``streaming.monitor.run_available``).
"""

from __future__ import annotations

import datetime as dt
import pickle
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import StructType

from tidemill.functions.columns import epoch_seconds
from tidemill.operators.abtest import ABTest, assign_variants
from tidemill.operators.monitor import SCRAPE_SECONDS, WINDOW_5M, AlertRule

# Kinds of rows of a stream of sticky sessions.
KINDS = "assigned", "expired"
# Waiting rows of a key that are one entry of its state.
PACKED = 4096
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _time(micros: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=micros)


def _packed(rows: list[tuple]) -> list[tuple]:
    """Rows as entries of the state."""
    return [(pickle.dumps(rows[i : i + PACKED]),) for i in range(0, len(rows), PACKED)]


class InOrder(StatefulProcessor):
    """Hands on the rows of a key, ``(t, ...)`` with t in microseconds, once the watermark has passed them.

    The rows that a batch brings wait as a few entries of bytes, each of many rows: columns of their own would be turned
    into the state's types and back one by one.
    """

    #: Columns of a waiting row, of what is remembered of a key, and names of those of an output row.
    row_schema: str
    state_schema: str
    names: list[str]

    def follow(self, key: tuple, state: tuple | None, rows: list[tuple], passed: int) -> tuple[list[tuple], tuple | None, int | None]:
        """Output rows, what to remember (None: nothing), and when to be called without a row (None: never).

        ``rows`` are those up to ``passed``, in order; the moment to be called at must be later.
        """
        raise NotImplementedError

    def init(self, handle) -> None:
        self._handle = handle
        self._columns = [column.split(" ")[0] for column in self.row_schema.split(", ")]
        self._waiting = handle.getListState("waiting", "rows binary")
        self._state = handle.getValueState("state", self.state_schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [tuple([getattr(row, name) for name in self._columns]) for row in rows]
        if new:
            self._waiting.appendList(_packed(new))
            self._call_at(min(row[0] for row in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = [row for entry in self._waiting.get() for row in pickle.loads(entry[0])]
        due = sorted((row for row in held if row[0] <= passed), key=lambda row: row[:2])
        rest = [row for row in held if row[0] > passed]
        if due and rest:
            self._waiting.put(_packed(rest))
        elif due:
            self._waiting.clear()
        before = self._state.get() if self._state.exists() else None
        out, after, wake = self.follow(key, before, due, passed)
        if after is not None:
            self._state.update(after)
        elif before is not None:
            self._state.clear()
        times = [row[0] for row in rest] + ([] if wake is None else [wake])
        if times:
            self._call_at(min(times))
        named = Row(*self.names)
        return iter([named(*row) for row in out])

    def _call_at(self, micros: int) -> None:
        self._handle.registerTimer(-(-micros // 1000))

    def close(self) -> None:
        pass


def _followed(stream: DataFrame, by: Sequence[str], processor: InOrder, schema: str, event_time: str = "") -> DataFrame:
    processor.names = StructType.fromDDL(schema).names
    return stream.groupBy(*by).transformWithState(processor, schema, "Append", "EventTime", eventTimeColumnName=event_time)


def _types(df: DataFrame, columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _timed(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """With the watermarked time ``_t`` and ``t``, the same in microseconds."""
    time = F.col(ts)
    if stream.schema[ts].dataType.typeName() == "timestamp_ntz":
        time = F.timestamp_micros((epoch_seconds(time) * 1_000_000).cast("bigint"))
    return stream.withColumn("_t", time).withWatermark("_t", delay).withColumn("t", F.unix_micros("_t"))


class _Alerts(InOrder):
    row_schema = "t long, holds int"
    state_schema = "active long, last long, fired boolean"

    def __init__(self, rule: AlertRule, step: int):
        self.rule, self.step = rule, step
        self.waited = -(-rule.hold // step) * step

    def follow(self, key, state, rows, passed):
        active, last, fired = state or (-1, -1, False)
        out = []
        for t, holds in rows:
            at = t // 1_000_000
            if not holds:
                active = -1
                continue
            if active < 0 or at - last > self.step:
                active, fired = at, False
            last = at
            if not fired and at - active >= self.waited:
                fired = True
                out.append((self.rule.name, self.rule.severity, *key, active, active + self.waited))
        # Without the next evaluation in time the condition is over, and nothing is kept of the label.
        over = (last + self.step) * 1_000_000
        if active < 0 or over <= passed:
            return out, None, None
        return out, (active, last, fired), over


def alert_stream(
    series: DataFrame,
    rule: AlertRule,
    step: int,
    labels: str | Sequence[str],
    at: str = "window_end",
    value: str = "value",
    delay: str = "0 seconds",
) -> DataFrame:
    """``(alert, severity, labels..., active_at, fired_at)``, written when an alert fires.

    ``series`` has one value for each label set and evaluation time (epoch seconds, ``step`` apart), in any order within
    ``delay``. State is kept of label sets whose condition holds: when it became and was last true, and whether that
    has fired. A missing evaluation ends it, so that a label set that goes silent leaves nothing behind.
    """
    labels = [labels] if isinstance(labels, str) else list(labels)
    # a millisecond later, as what is at time 0 would be late at once
    timed = series.withColumn("_at", F.timestamp_millis(F.col(at) * 1000 + 1))
    judged = _timed(timed, "_at", delay).select(*labels, "_t", "t", F.coalesce(rule.holds(F.col(value)), F.lit(False)).cast("int").alias("holds"))
    schema = f"alert string, severity string, {_types(series, labels)}, active_at bigint, fired_at bigint"
    return _followed(judged, labels, _Alerts(rule, step), schema)


class _Increases(InOrder):
    row_schema = "t long, value double"
    state_schema = "t long, value double"

    def __init__(self, keep: int | None, window: int | None, step: int):
        self.keep, self.window, self.step = keep, window, step

    def follow(self, key, state, rows, passed):
        out: list[tuple] = []
        sums: dict[int, float] = {}
        for t, value in rows:
            if state is not None and self.keep is not None and t - state[0] > self.keep * 1_000_000:
                state = None
            if state is not None:
                since, before = state
                grown = value if value < before else value - before
                if self.window is None:
                    out.append((*key, _time(t), value, grown, _time(since)))
                else:
                    wide = self.step * 1_000_000
                    enter, leave = t // wide * wide + wide, since // wide * wide + wide + self.window * 1_000_000
                    for end in range(enter, leave, wide):
                        sums[end] = sums.get(end, 0.0) + grown
            state = (t, value)
        out += [(*key, _time(end), total) for end, total in sorted(sums.items())]
        if state is None or self.keep is None:
            return out, state, None
        forgotten = state[0] + self.keep * 1_000_000 + 1
        return (out, None, None) if forgotten <= passed else (out, state, forgotten)


def _samples(samples: DataFrame, labels: Sequence[str], ts: str, value: str, delay: str) -> DataFrame:
    known = samples.where(F.col(value).isNotNull())
    return _timed(known, ts, delay).select(*labels, "_t", "t", F.col(value).cast("double").alias("value"))


def counter_increases_stream(
    samples: DataFrame, labels: Sequence[str], ts: str = "ts", value: str = "value", delay: str = "1 minute", keep: int | None = None
) -> DataFrame:
    """``(labels..., ts, value, increase, since)`` of every sample with a previous one, a reset included.

    State is the last sample of each series, for ``keep`` seconds after it (None: for ever); a later sample is a first one.
    """
    schema = f"{_types(samples, labels)}, ts timestamp, value double, increase double, since timestamp"
    return _followed(_samples(samples, labels, ts, value, delay), labels, _Increases(keep, None, 1), schema, "ts")


def instant_rate_stream(
    samples: DataFrame, labels: Sequence[str], ts: str = "ts", value: str = "value", delay: str = "1 minute", keep: int | None = WINDOW_5M
) -> DataFrame:
    """``(labels..., ts, rate)``: at every sample the per-second increase since the one before, at most ``keep`` seconds ago."""
    grown = counter_increases_stream(samples, labels, ts, value, delay, keep)
    seconds = (F.unix_micros("ts") - F.unix_micros("since")) / 1e6
    return grown.where(seconds > 0).select(*labels, "ts", (F.col("increase") / seconds).alias("rate"))


def counter_rate_stream(
    samples: DataFrame,
    labels: Sequence[str],
    window: int = WINDOW_5M,
    step: int = SCRAPE_SECONDS,
    ts: str = "ts",
    value: str = "value",
    by: Sequence[str] | None = None,
    delay: str = "1 minute",
) -> DataFrame:
    """``(by..., window_end, rate)``: per-second increase of counters, summed over ``by`` (default: per series).

    As ``operators.monitor.counter_rate``: an increase counts in the windows that hold both of its samples. So a sample
    older than a window and a step is of no use any more, and series that have ended leave no state behind.
    """
    if window % step:
        raise ValueError(f"window {window} is not a multiple of step {step}")
    by = list(labels) if by is None else list(by)
    schema = f"{_types(samples, labels)}, window_time timestamp, grown double"
    processor = _Increases(window + step, window, step)
    each = _followed(_samples(samples, labels, ts, value, delay), labels, processor, schema, "window_time")
    summed = each.groupBy(*by, "window_time").agg(F.sum("grown").alias("grown"))
    return summed.select(*by, F.unix_seconds("window_time").alias("window_end"), (F.col("grown") / window).alias("rate"))


class _Sessions(InOrder):
    row_schema = "t long, hit long"
    state_schema = "session long, live boolean, start long, last long, hits long"

    def __init__(self, ttl: int, kinds: Sequence[str]):
        self.ttl, self.assigned, self.expired = ttl * 1_000_000, "assigned" in kinds, "expired" in kinds

    def follow(self, key, state, rows, passed):
        session, live, start, last, hits = state or (0, False, 0, 0, 0)
        out = []

        def ended() -> tuple:
            return (*key, "expired", _time(last + self.ttl), None, session, _time(start), _time(last), hits)

        for t, hit in rows:
            if live and t - last > self.ttl:
                if self.expired:
                    out.append(ended())
                live = False
            if not live:
                session, live, start, hits = session + 1, True, t, 0
            last, hits = t, hits + 1
            if self.assigned:
                out.append((*key, "assigned", _time(t), hit, session, _time(start), _time(last), hits))
        if live and last + self.ttl < passed:
            if self.expired:
                out.append(ended())
            live = False
        return out, (session, live, start, last, hits), last + self.ttl + 1 if live else None


def sticky_stream(
    requests: DataFrame, test: ABTest, user: str, ts: str, hit: str, delay: str = "1 minute", kinds: Sequence[str] = KINDS
) -> DataFrame:
    """``(user, kind, at, hit, session, session_start, last_hit, hits, variant, model_name, model_version)``.

    A row of kind 'assigned' for each request, with the variant its user's session has drawn: a hit within the test's
    lifetime of the last one keeps session and variant and renews them. A row of kind 'expired' when no hit has come in time,
    with the session's variant, its first and last hit and their number. ``hit`` is a whole number that orders the hits
    of one moment. Of a user without a session one number is kept, that of the sessions so far, of which the next
    variant is drawn. ``kinds`` are those of the rows that are wanted.
    """
    timed = _timed(requests, ts, delay).select(user, "_t", "t", F.col(hit).cast("bigint").alias("hit"))
    schema = (
        f"{_types(requests, [user])}, kind string, at timestamp, hit bigint, session bigint, session_start timestamp, "
        "last_hit timestamp, hits bigint"
    )
    return assign_variants(_followed(timed, [user], _Sessions(test.sticky_ttl, kinds), schema), test, [user, "session"])
