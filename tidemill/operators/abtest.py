"""A/B tests over a request log: assignment, sticky sessions and per-variant results."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.columns import epoch_seconds, local_rows, md5_key, number, quoted
from tidemill.functions.ranking import exact_quantiles

# Session lifetime in seconds, tolerance of the split, default model version.
STICKY_TTL = 3600
SPLIT_TOLERANCE = 0.0001
LATEST = "latest"

# Default upper bounds of a latency histogram, in seconds.
LATENCY_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, float("inf")]

# md5_key is uniform below this.
KEY_SPACE = float(2**60)


@dataclass
class ABTest:
    """Variants as ``{name, model_name, model_version}`` and their shares of traffic."""

    name: str
    variants: list[dict]
    traffic_split: list[float] | None = None
    sticky_ttl: int = STICKY_TTL
    custom_metrics: list[str] = field(default_factory=list)

    def __post_init__(self):
        if not self.variants or len(self.variants) < 2:
            raise ValueError("a test compares two variants or more")
        for v in self.variants:
            if "name" not in v or "model_name" not in v:
                raise ValueError("a variant lacks its name or model_name")
        self.variants = [{"model_version": LATEST, **v} for v in self.variants]
        if self.traffic_split is None:
            self.traffic_split = [1.0 / len(self.variants)] * len(self.variants)
        if len(self.traffic_split) != len(self.variants):
            raise ValueError("there must be one traffic share for each variant")
        if abs(sum(self.traffic_split) - 1.0) > SPLIT_TOLERANCE:
            raise ValueError("traffic shares do not add up to 1")

    @property
    def names(self) -> list[str]:
        return [v["name"] for v in self.variants]


def variant_of(test: ABTest, draw: Column) -> Column:
    """The variant whose share of traffic holds a draw between 0 and 1."""
    # the last variant takes whatever lies above the last but one threshold
    chosen = F.lit(test.names[-1])
    for name, threshold in reversed(list(zip(test.names[:-1], accumulate(test.traffic_split)))):
        chosen = F.when(draw <= threshold, name).otherwise(chosen)
    return chosen


def assign_variants(requests: DataFrame, test: ABTest, key: Sequence[str]) -> DataFrame:
    """Add ``variant``, ``model_name`` and ``model_version``; a projection without shuffle.

    The draw is a hash of test name and key: repeatable, and free of any state.
    """
    drawn = requests.withColumn("_draw", md5_key(F.lit(test.name), *[F.col(c) for c in key]) / F.lit(KEY_SPACE))
    return with_model(drawn.withColumn("variant", variant_of(test, F.col("_draw"))).drop("_draw"), test)


def with_model(assigned: DataFrame, test: ABTest) -> DataFrame:
    model, version = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v in test.variants:
        hit = F.col("variant") == v["name"]
        model = F.when(hit, v["model_name"]).otherwise(model)
        version = F.when(hit, v["model_version"]).otherwise(version)
    return assigned.withColumns({"model_name": model, "model_version": version})


def _session_parts(requests: DataFrame, user: str, ts: str, ttl: int) -> tuple[DataFrame, Column]:
    """``(user, _part, ..., session)``: the hits of a user in each stretch of ``ttl``, and its column.

    Hits in one stretch are never further apart than the lifetime, so only its first hit can open a session. Stretches
    are counted up before they are shuffled: a user with a third of the log is a few rows in any task.
    """
    micros = (epoch_seconds(F.col(ts)) * 1_000_000).cast("bigint")
    part = F.floor(micros / max(ttl * 1_000_000, 1)).cast("bigint")
    parts = requests.groupBy(user, part.alias("_part")).agg(
        F.min(micros).alias("_first"),
        F.max(micros).alias("_last"),
        F.min(ts).alias("_start"),
        F.max(ts).alias("_end"),
        F.count(F.lit(1)).alias("_hits"),
    )
    in_order = W.partitionBy(user).orderBy("_part")
    idle = F.col("_first") - F.lag("_last").over(in_order)
    opened = parts.withColumn("_opens", F.when(idle <= ttl * 1_000_000, 0).otherwise(1))
    upto = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    return opened.withColumn("session", F.sum("_opens").over(upto)).drop("_opens"), part


def with_sessions(requests: DataFrame, user: str, ts: str, order: str, ttl: int = STICKY_TTL) -> DataFrame:
    """Add ``session``: 1, 2, ... per user. A hit within ``ttl`` seconds of the user's last one stays and renews.

    A request finds its session by its user and stretch of time; hits of one moment (``order`` tells them apart) share
    theirs. A hot user's requests stay where they are if the sessions fit a broadcast, else adaptive execution splits them.
    """
    parts, part = _session_parts(requests, user, ts, ttl)
    sessions = parts.select(F.col(user).alias("_user"), "_part", "session")
    timed = requests.withColumn("_own_part", part)
    same = F.col(quoted(user)).eqNullSafe(F.col("_user")) & F.col("_own_part").eqNullSafe(F.col("_part"))
    return timed.join(sessions, same).drop("_user", "_part", "_own_part")


def sticky_assignments(requests: DataFrame, test: ABTest, user: str, ts: str, order: str) -> DataFrame:
    """Requests with the session of their user and the variant drawn once per session."""
    sessions = with_sessions(requests, user, ts, order, test.sticky_ttl)
    return assign_variants(sessions, test, [user, "session"])


def session_table(requests: DataFrame, user: str, ts: str, order: str, ttl: int = STICKY_TTL) -> DataFrame:
    """``(user, session, session_start, last_hit, hits)``, from stretches of time and not from requests."""
    parts, _ = _session_parts(requests, user, ts, ttl)
    return parts.groupBy(user, "session").agg(
        F.min("_start").alias("session_start"), F.max("_end").alias("last_hit"), F.sum("_hits").alias("hits")
    )


def live_sessions(requests: DataFrame, user: str, ts: str, now: Column, ttl: int = STICKY_TTL) -> DataFrame:
    """``(user, last_hit)`` of users whose last hit is at most ``ttl`` seconds old; the others have expired."""
    idle = epoch_seconds(now) - epoch_seconds(F.col("last_hit"))
    return requests.groupBy(user).agg(F.max(ts).alias("last_hit")).where(idle <= ttl)


def assignment_counts(assigned: DataFrame, test: ABTest) -> DataFrame:
    """``(test_name, model_name, variant, assignments)``."""
    return (
        assigned.groupBy("model_name", "variant")
        .agg(F.count(F.lit(1)).alias("assignments"))
        .select(F.lit(test.name).alias("test_name"), "model_name", "variant", "assignments")
    )


def known_variants(log: DataFrame, test: ABTest, variant: str = "variant") -> DataFrame:
    """Records of variants outside the test are ignored."""
    return log.where(F.col(variant).isin(test.names))


def ab_results(log: DataFrame, test: ABTest, latency: str = "latency") -> DataFrame:
    """``(variant, count, latency_mean, latency_median, latency_p95, latency_min, latency_max)``, quantiles exact."""
    known = known_variants(log, test)
    basic = known.groupBy("variant").agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(latency).alias("latency_mean"),
        F.min(latency).alias("latency_min"),
        F.max(latency).alias("latency_max"),
    )
    q = F.col("q")
    marks = exact_quantiles(known, [latency], [0.5, 0.95], ["variant"]).select(
        "variant", q[0].alias("latency_median"), q[1].alias("latency_p95")
    )
    # one row per variant; variants without records keep a row of zero
    every = local_rows(log.sparkSession, [(v,) for v in test.names], "variant string")
    return (
        every.join(F.broadcast(basic), "variant", "left")
        .join(F.broadcast(marks), "variant", "left")
        .select(
            "variant",
            F.coalesce("count", F.lit(0)).alias("count"),
            "latency_mean",
            "latency_median",
            "latency_p95",
            "latency_min",
            "latency_max",
        )
    )


def ab_custom_metrics(log: DataFrame, test: ABTest, metrics: str = "metrics") -> DataFrame:
    """``(variant, metric, mean, median, min, max)`` of the listed metrics in a ``map<string,double>`` column."""
    wanted = (
        known_variants(log, test)
        .select("variant", F.explode(metrics).alias("metric", "value"))
        .where(F.col("metric").isin(test.custom_metrics) & F.col("value").isNotNull())
    )
    basic = wanted.groupBy("variant", "metric").agg(
        F.avg("value").alias("mean"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    medians = exact_quantiles(wanted, ["value"], [0.5], ["variant", "metric"]).select(
        "variant", "metric", F.col("q")[0].alias("median")
    )
    # variants x listed metrics
    return basic.join(F.broadcast(medians), ["variant", "metric"]).select(
        "variant", "metric", "mean", "median", "min", "max"
    )


def histogram_buckets(df: DataFrame, value: str, by: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    """``(by..., le, count)``: cumulative counts per upper bound, as a metrics histogram keeps them."""
    counts = [F.expr(f"count_if({quoted(value)} <= {number(b)}) AS b{i}") for i, b in enumerate(bounds)]
    return df.groupBy(*by).agg(*counts).select(*by, bucket_rows(bounds))


def bucket_rows(bounds: Sequence[float], count: str = "count") -> Column:
    """Rows ``(le, count)`` from the columns ``b0, b1, ...``, one per bound."""
    rows = [f"named_struct('le', {number(b)}, '{count}', b{i})" for i, b in enumerate(bounds)]
    return F.expr(f"inline(array({', '.join(rows)}))")


def latency_histogram(
    log: DataFrame, test: ABTest, latency: str = "latency", bounds: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    return histogram_buckets(known_variants(log, test), latency, ["variant"], bounds)


def scalar_prediction(df: DataFrame, prediction: str) -> Column:
    """The numeric value of a prediction column: a number, or the only entry of an array; else null."""
    kind = df.schema[prediction].dataType
    col = F.col(prediction)
    if kind.typeName() == "array":
        return F.when(F.size(col) == 1, F.get(col, F.lit(0)).try_cast("double"))
    if kind.typeName() in ("string", "boolean", "map", "struct"):
        return F.lit(None).cast("double")
    return col.cast("double")


def prediction_histogram(
    log: DataFrame, test: ABTest, low: float, high: float, buckets: int, prediction: str = "prediction"
) -> DataFrame:
    """``(variant, bucket, count)``: equal-width buckets of scalar predictions; 0 and ``buckets + 1`` lie outside."""
    value = scalar_prediction(log, prediction)
    return (
        known_variants(log, test)
        .select("variant", value.alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("variant", F.width_bucket("value", F.lit(float(low)), F.lit(float(high)), F.lit(buckets)).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("count"))
    )

