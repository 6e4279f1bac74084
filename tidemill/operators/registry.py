"""Model registry and run tables: latest versions, stage changes, comparisons and leaderboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import total, when_true

# Stages of a model version, and the order in which a version is chosen for deployment.
VALID_STAGES = ["None", "Development", "Staging", "Production", "Archived"]
DEPLOY_ORDER = ["Production", "Staging"]
PRODUCTION, STAGING, ARCHIVED, DEVELOPMENT = "Production", "Staging", "Archived", "Development"

# A metric counts as an error, lower being better, if its name holds or starts with one of these.
ERROR_WORDS = ["error", "loss"]
ERROR_PREFIXES = ["mse", "rmse", "mae"]


def check_stage(stage: str) -> None:
    if stage not in VALID_STAGES:
        raise ValueError(f"{stage} is no stage: {VALID_STAGES} are")


def current_stages(stage_events: DataFrame) -> DataFrame:
    """``(model, version, stage)``: the last event per version decides (``seq`` orders the events)."""
    return stage_events.groupBy("model", "version").agg(F.max_by("stage", "seq").alias("stage"))


def latest_version(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """The row of the highest version per model, optionally within one stage."""
    if stage is not None:
        check_stage(stage)
        versions = versions.where(F.col("stage") == stage)
    return _best_row(versions, F.struct(F.col("version").cast("bigint")))


def deployable_version(versions: DataFrame) -> DataFrame:
    """Per model the newest Production version, else the newest Staging one, else the highest version."""
    rank = F.lit(0)
    for i, stage in enumerate(reversed(DEPLOY_ORDER), start=1):
        rank = F.when(F.col("stage") == stage, i).otherwise(rank)
    return _best_row(versions, F.struct(rank.alias("rank"), F.col("version").cast("bigint")))


def _best_row(versions: DataFrame, by: Column) -> DataFrame:
    rest = [c for c in versions.columns if c != "model"]
    best = F.max_by(F.struct(*rest), by).alias("best")
    return versions.groupBy("model").agg(best).select("model", *[F.col(f"best.{c}").alias(c) for c in rest])


def promote(versions: DataFrame, requests: DataFrame) -> DataFrame:
    """Stage changes ``(model, version, from_stage, to_stage)`` that a batch of promotions brings about.

    ``requests`` holds ``(model, version, to_stage, from_stage)``, one per model; a null ``from_stage`` skips the
    check. Requests with an unknown stage or version, or the wrong source stage, change nothing. A promotion to
    Production archives the model's other Production versions.
    """
    asked = requests.select(
        "model", "version", "to_stage", F.col("from_stage").alias("required_stage")
    ).where(F.col("to_stage").isin(VALID_STAGES))
    accepted = versions.join(asked, ["model", "version"]).where(
        F.col("required_stage").isNull() | (F.col("required_stage") == F.col("stage"))
    )
    moved = accepted.select("model", "version", F.col("stage").alias("from_stage"), "to_stage")
    winners = accepted.where(F.col("to_stage") == PRODUCTION).select("model", F.col("version").alias("winner"))
    archived = (
        versions.where(F.col("stage") == PRODUCTION)
        .join(winners, "model")
        .where(F.col("version") != F.col("winner"))
        .select("model", "version", F.col("stage").alias("from_stage"), F.lit(ARCHIVED).alias("to_stage"))
    )
    return moved.unionByName(archived)


def apply_changes(versions: DataFrame, changes: DataFrame) -> DataFrame:
    """Versions with their stage after the changes."""
    new = changes.select("model", "version", F.col("to_stage").alias("_new"))
    return versions.join(new, ["model", "version"], "left").select(
        *[F.coalesce("_new", "stage").alias("stage") if c == "stage" else F.col(c) for c in versions.columns]
    )


def rollback(versions: DataFrame, requests: DataFrame) -> DataFrame:
    """Changes that put ``to_version`` (null: the latest Staging version) of each model into Production.

    ``requests`` holds ``(model, to_version)``. The old Production version is archived.
    """
    staging = latest_version(versions, STAGING).select("model", F.col("version").alias("staged"))
    targets = requests.join(staging, "model", "left").select(
        "model",
        F.coalesce("to_version", "staged").alias("version"),
        F.lit(PRODUCTION).alias("to_stage"),
        F.lit(None).cast("string").alias("from_stage"),
    )
    return promote(versions, targets.where(F.col("version").isNotNull()))


def lower_is_better(metric: Column) -> Column:
    name = F.lower(metric)
    words = [F.contains(name, F.lit(w)) for w in ERROR_WORDS]
    prefixes = [F.startswith(name, F.lit(p)) for p in ERROR_PREFIXES]
    found = F.lit(False)
    for test in [*words, *prefixes]:
        found = found | test
    return found


def compare_metrics(first: DataFrame, second: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., metric, first_value, second_value, first_better)`` of two ``(by..., metric, value)`` tables."""
    keys = [*by, "metric"]
    both = first.select(*keys, F.col("value").alias("first_value")).join(
        second.select(*keys, F.col("value").alias("second_value")), keys
    )
    better = F.when(lower_is_better(F.col("metric")), F.col("first_value") < F.col("second_value")).otherwise(
        F.col("first_value") > F.col("second_value")
    )
    return both.withColumn("first_better", better)


def compare_summary(compared: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., better_metrics, total_compared)``: how often the first run is strictly better."""
    return compared.groupBy(*by).agg(
        total(when_true(F.col("first_better"))).alias("better_metrics"),
        F.count(F.lit(1)).alias("total_compared"),
    )


def best_by_metric(
    versions: DataFrame, metrics: DataFrame, metric: str, higher_is_better: bool = True, stage: str = DEVELOPMENT
) -> DataFrame:
    """``(model, version, value)``: the best version of a stage by one metric of its run.

    ``metrics`` holds ``(run_id, metric, value)``. Among equals the lower version wins.
    """
    scored = (
        versions.where(F.col("stage") == stage)
        .join(metrics.where(F.col("metric") == metric).select("run_id", "value"), "run_id")
        .where(F.col("value").isNotNull())
    )
    rank = -F.col("value") if higher_is_better else F.col("value")
    best = F.min_by(F.struct("version", "value"), F.struct(rank.alias("rank"), "version")).alias("best")
    return scored.groupBy("model").agg(best).select("model", "best.version", "best.value")


def promote_best(
    versions: DataFrame, metrics: DataFrame, metric: str, to_stage: str, higher_is_better: bool = True
) -> DataFrame:
    """Stage changes that promote the best Development version of every model."""
    check_stage(to_stage)
    best = best_by_metric(versions, metrics, metric, higher_is_better)
    requests = best.select(
        "model", "version", F.lit(to_stage).alias("to_stage"), F.lit(None).cast("string").alias("from_stage")
    )
    return promote(versions, requests)


def top_models(performance: DataFrame, k: int = 10) -> DataFrame:
    """The k largest ``value`` rows; ties in model and version order."""
    return performance.orderBy(F.col("value").desc(), "model", "version").limit(k)


def runs_by_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("runs"))


def top_experiments(runs: DataFrame, k: int = 10) -> DataFrame:
    """``(experiment_id, runs)``: the k experiments with the most runs."""
    counted = runs.groupBy("experiment_id").agg(F.count(F.lit(1)).alias("runs"))
    return counted.orderBy(F.col("runs").desc(), "experiment_id").limit(k)


def registry_totals(runs: DataFrame, versions: DataFrame) -> DataFrame:
    """One row ``(experiments, runs, models, model_versions, artifact_bytes)``.

    ``runs`` holds ``(experiment_id, artifact_bytes)``; the two sides are aggregated apart and meet as single rows.
    """
    of_versions = versions.agg(
        F.struct(F.countDistinct("model").alias("models"), F.count(F.lit(1)).alias("versions"))
    ).scalar()
    return runs.agg(
        F.countDistinct("experiment_id").alias("experiments"),
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum("artifact_bytes"), F.lit(0)).alias("artifact_bytes"),
    ).select(
        "experiments",
        "runs",
        of_versions["models"].alias("models"),
        of_versions["versions"].alias("model_versions"),
        "artifact_bytes",
    )
