"""A session with the settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, name: str = "tidemill", partitions: int | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster the submitter sets these."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
