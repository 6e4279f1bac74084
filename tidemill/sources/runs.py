"""The run-tracking file tree as tables.

Layout: ``<root>/<experiment>/<run>/metrics/<name>`` with lines ``epoch_ms value step``,
``.../params/<name>`` with the value as text, and ``.../meta.yaml`` with ``key: value`` lines.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows
from tidemill.sources.tables import read_if_exists

METRICS = "experiment_id string, run_id string, key string, ts_ms bigint, value double, step int"
PARAMS = "experiment_id string, run_id string, key string, value string"

# A file of the tree, or a folder of part files as Spark writes it.
_RUN = r"([^/]+)/([^/]+)/{}/([^/]+)(?:/part-[^/]*)?$"


def _path_parts(kind: str) -> list[Column]:
    path = F.col("_metadata.file_path")
    pattern = _RUN.format(kind)
    return [
        F.regexp_extract(path, pattern, 1).alias("experiment_id"),
        F.regexp_extract(path, pattern, 2).alias("run_id"),
        F.regexp_extract(path, pattern, 3).alias("key"),
    ]


def run_metrics(spark: SparkSession, root: str) -> DataFrame:
    """``(experiment_id, run_id, key, ts_ms, value, step)``, one row per logged value."""
    parts = F.split("value", " ")
    files = read_if_exists(spark.read.text, f"{root}/*/*/metrics/*")
    tree = files and files.select(
        *_path_parts("metrics"),
        parts[0].cast("bigint").alias("ts_ms"),
        parts[1].cast("double").alias("value"),
        parts[2].cast("int").alias("step"),
    )
    return _both(spark, tree, f"{root}/metrics", METRICS)


def run_params(spark: SparkSession, root: str) -> DataFrame:
    """``(experiment_id, run_id, key, value)``."""
    files = read_if_exists(partial(spark.read.text, wholetext=True), f"{root}/*/*/params/*")
    # a file that Spark wrote ends in a line break
    tree = files and files.select(*_path_parts("params"), F.regexp_replace("value", r"\n$", "").alias("value"))
    return _both(spark, tree, f"{root}/params", PARAMS)


def _both(spark: SparkSession, tree: DataFrame | None, path: str, schema: str) -> DataFrame:
    """The files of the tree and what ``write_run`` has appended."""
    appended = read_if_exists(spark.read.schema(schema).parquet, path)
    found = [df for df in (tree, appended) if df is not None]
    return reduce(DataFrame.unionByName, found) if found else local_rows(spark, [], schema)


def runs(spark: SparkSession, root: str) -> DataFrame:
    """``(experiment_id, run_id, run_name, status, start_ms, end_ms, seconds)`` from the run documents."""
    text = F.col("value")

    def entry(key: str) -> Column:
        return F.regexp_extract(text, rf"(?m)^{key}:\s*'?([^'\n]*)'?\s*$", 1)

    start, end = entry("start_time").try_cast("bigint"), entry("end_time").try_cast("bigint")
    return spark.read.text(f"{root}/*/*/meta.yaml", wholetext=True).select(
        entry("experiment_id").alias("experiment_id"),
        entry("run_id").alias("run_id"),
        entry("run_name").alias("run_name"),
        entry("status").try_cast("int").alias("status"),
        start.alias("start_ms"),
        end.alias("end_ms"),
        ((end - start) / 1000).alias("seconds"),
    )


def model_versions(spark: SparkSession, root: str) -> DataFrame:
    """``(model, version, stage, run_id, status, created_ms)`` from ``<root>/models/<model>/version-<n>/meta.yaml``."""
    text = F.col("value")

    def entry(key: str) -> Column:
        return F.regexp_extract(text, rf"(?m)^{key}:\s*'?([^'\n]*)'?\s*$", 1)

    return spark.read.text(f"{root}/models/*/version-*/meta.yaml", wholetext=True).select(
        entry("name").alias("model"),
        entry("version").cast("int").alias("version"),
        entry("current_stage").alias("stage"),
        entry("run_id").alias("run_id"),
        entry("status").alias("status"),
        entry("creation_timestamp").cast("bigint").alias("created_ms"),
    )


def write_run(
    spark: SparkSession, root: str, experiment: str, run: str, metrics: dict[str, float], params: dict[str, str], ts_ms: int
) -> None:
    """Append one finished run to tables ``<root>/metrics`` and ``<root>/params`` (a few rows each), which the readers
    read with the tree."""
    rows = [(experiment, run, k, ts_ms, float(v), 0) for k, v in metrics.items()]
    local_rows(spark, rows, METRICS).coalesce(1).write.mode("append").parquet(f"{root}/metrics")
    rows = [(experiment, run, k, str(v)) for k, v in params.items()]
    local_rows(spark, rows, PARAMS).coalesce(1).write.mode("append").parquet(f"{root}/params")
