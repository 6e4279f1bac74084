"""Monitoring queries over request events, counter samples, gauges and histogram buckets.

Times are timestamps; a sliding window is named by its end, as a rule evaluated at that moment would see it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.columns import epoch_seconds, long_rows, number, quoted, value_of, when_true
from tidemill.functions.ordered import with_previous
from tidemill.operators.abtest import bucket_rows

# Evaluation step in seconds, and the windows of the dashboards.
SCRAPE_SECONDS = 15
WINDOW_5M, WINDOW_1M, WINDOW_1H = 300, 60, 3600


@dataclass(frozen=True)
class AlertRule:
    """Fire when ``value`` compares to the threshold for ``hold`` seconds on end."""

    name: str
    comparison: str
    threshold: float
    hold: int
    severity: str

    def holds(self, value: Column) -> Column:
        return value > self.threshold if self.comparison == ">" else value < self.threshold


# The alert rules.
ALERT_RULES = [
    AlertRule("HighErrorRate", ">", 0.05, 300, "critical"),
    AlertRule("HighLatency", ">", 1.0, 300, "warning"),
    AlertRule("LowThroughput", "<", 1.0, 900, "warning"),
    AlertRule("DriftDetected", ">", 0.2, 3600, "warning"),
    AlertRule("HighPredictionLatency", ">", 0.1, 300, "warning"),
    AlertRule("HighCpuUsage", ">", 0.8, 900, "warning"),
    AlertRule("HighMemoryUsage", ">", 0.8, 900, "warning"),
]
# Receivers of an alert.
DEFAULT_RECEIVER, CRITICAL_RECEIVER, WARNING_RECEIVER = "email-notifications", "slack-critical", "slack-warnings"


def step_start(ts: Column, step: int) -> Column:
    """Start of the step that holds ``ts``, in epoch seconds."""
    return (F.floor(epoch_seconds(ts) / step) * step).cast("bigint")


def to_timestamp(epoch: Column) -> Column:
    """Epoch seconds as a timestamp without zone."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=epoch.cast("decimal(18,6)"))


def sliding_sums(
    df: DataFrame,
    ts: str,
    by: Sequence[str],
    sums: dict[str, Column],
    window: int,
    step: int = SCRAPE_SECONDS,
    filled: bool = False,
    since: str | None = None,
) -> DataFrame:
    """``(by..., window_end bigint, sums...)`` over every window that holds a row, ``step`` seconds apart.

    With ``filled`` also over the empty windows between the first and the last one of a label set, with sums 0. A row
    with a ``since`` time counts only in windows that hold this moment too.

    Rows are first summed per step. A step's sums enter the sum of its label set when the first window ends that holds
    them, and leave it again after the last one, so nothing is copied to windows but the sums that hold from one change
    to the next. Time is cut into days that stand alone: a step that is still in the sum when a day begins enters
    that day at its beginning. So a label set with a large share of all rows is as many tasks as it has days, and
    nothing is carried over or joined. Sums of whole numbers are exact; fractions carry the rounding of a day's sum.
    """
    if window % step:
        raise ValueError(f"window {window} is not a multiple of step {step}")
    start, names, by = step_start(F.col(ts), step), list(sums), list(by)
    leaves = (start if since is None else step_start(F.col(since), step)) + step + window
    steps = df.groupBy(*by, (start + step).alias("_enter"), leaves.alias("_leave")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(e).alias(n) for n, e in sums.items()]
    )
    steps = steps.where(F.col("_enter") < F.col("_leave"))
    day = -(-86400 // step) * step
    held = ["_n", *names]

    def day_of(at: Column) -> Column:
        return F.floor(at / day).cast("bigint")

    def change(number: Column, at: Column, value, until: Column | None = None) -> Column:
        end = (F.lit(None) if until is None else until).cast("bigint")
        return F.struct(number.alias("_day"), at.alias("_at"), end.alias("_until"), *[value(F.col(n)).alias(n) for n in held])

    def later_days(first: Column, last: Column, of) -> Column:
        """One entry for each day after that of ``first`` up to that of ``last``."""
        days = F.when(day_of(last) > day_of(first), F.sequence(day_of(first) + 1, day_of(last)))
        return F.coalesce(F.transform(days, of), F.array())

    enter, leave = F.col("_enter"), F.col("_leave")
    both = F.array(change(day_of(enter), enter, lambda v: v), change(day_of(leave), leave, lambda v: -v))
    again = later_days(enter, leave, lambda d: change(d, d * day, lambda v: v))
    changes = steps.select(*by, F.inline(F.concat(both, again)))
    if filled:
        # an empty change at the beginning of every day, and where the last window of the label set ends
        whole = steps.groupBy(*by).agg(F.min("_enter").alias("_enter"), F.max("_leave").alias("_leave"), *[F.sum(F.col(n) * 0).alias(n) for n in held])
        first = change(day_of(enter), enter, lambda v: v, F.least((day_of(enter) + 1) * day, leave))
        others = later_days(enter, leave, lambda d: change(d, d * day, lambda v: v, F.least((d + 1) * day, leave)))
        changes = changes.unionByName(whole.select(*by, F.inline(F.concat(F.array(first), others))))
    # the days of a label set stay where they are for the sums and for the order
    dealt = changes.repartition(*by, "_day") if by else changes.repartition("_day")
    summed = dealt.groupBy(*by, "_day", "_at").agg(F.max("_until").alias("_until"), *[F.sum(n).alias(n) for n in held])
    order = W.partitionBy(*by, "_day").orderBy("_at")
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.max("_until").over(W.partitionBy(*by, "_day")) if filled else (F.col("_day") + 1) * day
    spans = summed.select(
        *by, "_at", F.coalesce(F.lead("_at").over(order), end).alias("_next"), *[F.sum(n).over(running).alias(n) for n in held]
    )
    spans = spans.where(F.col("_next") > F.col("_at") if filled else F.col("_n") > 0)
    ends = F.sequence("_at", F.col("_next") - step, F.lit(step).cast("bigint"))
    return spans.select(*by, F.explode(ends).alias("window_end"), *names)


def event_rate(
    events: DataFrame,
    ts: str,
    by: Sequence[str] = (),
    window: int = WINDOW_5M,
    step: int = SCRAPE_SECONDS,
    filled: bool = False,
) -> DataFrame:
    """``(by..., window_end, rate)``: events per second; ``filled`` gives empty windows a rate of 0."""
    counted = sliding_sums(events, ts, by, {"n": F.lit(1)}, window, step, filled)
    return counted.select(*by, "window_end", (F.col("n") / window).alias("rate"))


def throughput(
    events: DataFrame, ts: str, by: Sequence[str], window: int = WINDOW_5M, step: int = SCRAPE_SECONDS
) -> DataFrame:
    """Events per second from the first to the last window of a label set; zero traffic is a rate of 0."""
    return event_rate(events, ts, by, window, step, filled=True)


def counter_increases(samples: DataFrame, labels: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Samples with ``increase`` since the previous one of the series, at ``since``; after a reset the value itself.

    A long series is worked day by day (see ``functions.ordered``).
    """
    daily = samples.withColumn("_day", F.date_trunc("day", F.col(ts)))
    before = with_previous(daily, labels, [ts], [value, ts], "_day")
    now, last = F.col(value), F.col(f"prev_{value}")
    grown = before.withColumn("increase", F.when(now < last, now).otherwise(now - last))
    return grown.withColumnRenamed(f"prev_{ts}", "since").drop("_day", f"prev_{value}")


def counter_rate(
    samples: DataFrame,
    labels: Sequence[str],
    window: int = WINDOW_5M,
    step: int = SCRAPE_SECONDS,
    ts: str = "ts",
    value: str = "value",
    by: Sequence[str] | None = None,
) -> DataFrame:
    """``(by..., window_end, rate)``: per-second increase of counters, summed over ``by`` (default: per series).

    An increase counts in the windows that hold both of its samples, so what a counter grew by during a gap in its
    samples is no spike afterwards; nothing is extrapolated to the window edges.
    """
    grown = counter_increases(samples, labels, ts, value).where(F.col("increase").isNotNull())
    by = list(labels) if by is None else list(by)
    summed = sliding_sums(grown, ts, by, {"grown": F.col("increase")}, window, step, since="since")
    return summed.select(*by, "window_end", (F.col("grown") / window).alias("rate"))


def instant_rate(samples: DataFrame, labels: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """``(labels..., rate)`` from the last two samples of every series."""
    newest_first = W.partitionBy(*labels).orderBy(F.col(ts).desc())
    last_two = samples.withColumn("_n", F.row_number().over(newest_first)).where(F.col("_n") <= 2)

    def at(n: int, c: str) -> Column:
        return F.max(F.when(F.col("_n") == n, F.col(c)))

    pairs = last_two.groupBy(*labels).agg(
        at(1, value).alias("v1"), at(2, value).alias("v2"), at(1, ts).alias("t1"), at(2, ts).alias("t2")
    )
    grown = F.when(F.col("v1") < F.col("v2"), F.col("v1")).otherwise(F.col("v1") - F.col("v2"))
    seconds = (epoch_seconds(F.col("t1")) - epoch_seconds(F.col("t2"))).cast("double")
    return pairs.where(F.col("t2").isNotNull()).select(*labels, (grown / seconds).alias("rate"))


def error_ratio(
    events: DataFrame,
    ts: str,
    is_error: Column,
    by: Sequence[str] = (),
    window: int = WINDOW_5M,
    step: int = SCRAPE_SECONDS,
) -> DataFrame:
    """``(by..., window_end, ratio)``: errors among all events of the window."""
    sums = sliding_sums(events, ts, by, {"errors": when_true(is_error), "n": F.lit(1)}, window, step)
    return sums.select(*by, "window_end", (F.col("errors") / F.col("n")).alias("ratio"))


def histogram_quantile(buckets: DataFrame, q: float, by: Sequence[str], le: str = "le", count: str = "count") -> DataFrame:
    """``(by..., quantile)`` from cumulative buckets, linear within a bucket.

    The first bucket starts at 0 if its bound is positive; a rank in the open last bucket gives the largest finite
    bound. A label set has as many rows as buckets.
    """
    whole = W.partitionBy(*by)
    in_order = whole.orderBy(le)
    ranked = buckets.select(
        *by,
        F.col(le).alias("le"),
        F.col(count).cast("double").alias("count"),
        F.lag(F.col(le)).over(in_order).alias("low"),
        F.coalesce(F.lag(F.col(count).cast("double")).over(in_order), F.lit(0.0)).alias("below"),
        (F.lit(q) * F.max(F.col(count).cast("double")).over(whole)).alias("rank"),
    )
    reached = ranked.where((F.col("count") >= F.col("rank")) & (F.col("rank") > 0))
    row = F.min_by(F.struct("le", "low", "count", "below", "rank"), "le").alias("b")
    le_, low, here, below, rank = (F.col(f"b.{c}") for c in ["le", "low", "count", "below", "rank"])
    start = F.coalesce(low, F.least(le_, F.lit(0.0)))
    inside = start + (le_ - start) * (rank - below) / (here - below)
    value = F.when(le_ == float("inf"), low).when(low.isNull() & (le_ <= 0), le_).otherwise(inside)
    return reached.groupBy(*by).agg(row).select(*by, value.alias("quantile"))


def windowed_buckets(
    events: DataFrame,
    ts: str,
    value: str,
    bounds: Sequence[float],
    by: Sequence[str] = (),
    window: int = WINDOW_5M,
    step: int = SCRAPE_SECONDS,
) -> DataFrame:
    """``(by..., window_end, le, count)``: cumulative buckets of the events of each window."""
    sums = {f"b{i}": F.expr(f"if({quoted(value)} <= {number(b)}, 1, 0)") for i, b in enumerate(bounds)}
    return sliding_sums(events, ts, by, sums, window, step).select(*by, "window_end", bucket_rows(bounds))


def usage_ratio(used: DataFrame, limits: DataFrame, by: str = "pod", value: str = "value") -> DataFrame:
    """``(by, ratio)``: summed usage over summed limit; label values without both sides have no result."""
    top = used.groupBy(by).agg(F.sum(value).alias("used"))
    bottom = limits.groupBy(by).agg(F.sum(value).alias("limit"))
    return top.join(bottom, by).where(F.col("limit") != 0).select(by, (F.col("used") / F.col("limit")).alias("ratio"))


def latest_gauge(samples: DataFrame, labels: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """``(labels..., value)``: the newest sample of every series."""
    return samples.groupBy(*labels).agg(F.max_by(value, ts).alias("value"))


def gauge_sum_by(
    samples: DataFrame, labels: Sequence[str], by: Sequence[str], ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Newest sample per series, summed over ``by``."""
    return latest_gauge(samples, labels, ts, value).groupBy(*by).agg(F.sum("value").alias("value"))


def gauge_series(
    samples: DataFrame, labels: Sequence[str], step: int, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """``(labels..., step_end, value)``: the newest sample of every series in each step."""
    end = step_start(F.col(ts), step) + step
    return samples.groupBy(*labels, end.alias("step_end")).agg(F.max_by(value, ts).alias("value"))


def gauge_difference(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``(on..., value)``: left minus right for label sets on both sides."""
    other = right.select(*on, F.col("value").alias("_other"))
    return left.join(other, list(on)).select(*on, (F.col("value") - F.col("_other")).alias("value"))


def distinct_label_values(samples: DataFrame, label: str) -> DataFrame:
    return samples.agg(F.countDistinct(label).alias("n"))


def topk(df: DataFrame, value: str, k: int, ties: Sequence[str]) -> DataFrame:
    """The k rows with the largest value."""
    return df.orderBy(F.col(value).desc(), *ties).limit(k)


def topk_average(
    samples: DataFrame, label: str, k: int, since: Column | None = None, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """``(label, value)``: the k largest averages over the samples after ``since``."""
    recent = samples if since is None else samples.where(F.col(ts) > since)
    return topk(recent.groupBy(label).agg(F.avg(value).alias("value")), "value", k, [label])


def alert_episodes(
    series: DataFrame, rule: AlertRule, step: int, labels: Sequence[str] = (), at: str = "window_end", value: str = "value"
) -> DataFrame:
    """``(alert, severity, labels..., active_at, fired_at, last_at)``: episodes that outlast the rule's hold time.

    ``series`` holds one value per label set and evaluation time (epoch seconds, ``step`` apart); a missing
    evaluation ends an episode. An alert fires at the first evaluation at least ``hold`` seconds after it became
    active.
    """
    true_rows = series.where(rule.holds(F.col(value))).select(*labels, F.col(at).alias("at"))
    in_order = W.partitionBy(*labels, F.lit(rule.name)).orderBy("at")
    # evaluations in a row keep at - step * number constant
    grouped = true_rows.withColumn("island", F.col("at") - F.row_number().over(in_order) * F.lit(step))
    episodes = grouped.groupBy(*labels, "island").agg(F.min("at").alias("active_at"), F.max("at").alias("last_at"))
    waited = F.ceil(F.lit(rule.hold / step)).cast("bigint") * step
    return episodes.where(F.col("last_at") >= F.col("active_at") + waited).select(
        F.lit(rule.name).alias("alert"),
        F.lit(rule.severity).alias("severity"),
        *labels,
        "active_at",
        (F.col("active_at") + waited).alias("fired_at"),
        "last_at",
    )


def route_alerts(alerts: DataFrame, group: Sequence[str] = ("alert", "job", "severity")) -> DataFrame:
    """``(group..., receiver, alerts)``: alerts per group with the receiver their severity selects."""
    receiver = (
        F.when(F.col("severity") == "critical", CRITICAL_RECEIVER)
        .when(F.col("severity") == "warning", WARNING_RECEIVER)
        .otherwise(DEFAULT_RECEIVER)
    )
    grouped = alerts.groupBy(*group).agg(F.count(F.lit(1)).alias("alerts"))
    return grouped.select(*group, receiver.alias("receiver"), "alerts")


def suppress_warnings(alerts: DataFrame, equal: Sequence[str] = ("alert", "service")) -> DataFrame:
    """Drop warnings whose ``equal`` labels have a critical alert active."""
    critical = alerts.where(F.col("severity") == "critical").select(*equal).distinct()
    warnings = alerts.where(F.col("severity") == "warning").join(critical, list(equal), "left_anti")
    others = alerts.where((F.col("severity") != "warning") | F.col("severity").isNull())
    return others.unionByName(warnings.select(*alerts.columns))


def feature_target_correlation(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(feature, correlation)``, all in one pass; a constant column has none."""
    y = value_of(df, target).cast("double")
    wide = df.agg(*[F.corr(value_of(df, c).cast("double"), y).alias(f"r{i}") for i, c in enumerate(features)])
    return wide.select(long_rows({c: {"correlation": F.col(f"r{i}")} for i, c in enumerate(features)}, "feature"))


def prediction_metrics(
    log: DataFrame, bounds: Sequence[float], by: Sequence[str] = ("model_name", "version"), latency: str = "latency"
) -> DataFrame:
    """``(by..., predictions, latency_sum, le, bucket_count)`` from the prediction log, one pass."""
    counted = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("predictions"),
        F.sum(latency).alias("latency_sum"),
        *[F.expr(f"count_if({quoted(latency)} <= {number(b)}) AS b{i}") for i, b in enumerate(bounds)],
    )
    return counted.select(*by, "predictions", "latency_sum", bucket_rows(bounds, "bucket_count"))
