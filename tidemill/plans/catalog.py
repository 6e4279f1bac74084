"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.plans import (  # noqa: F401  (each registers its queries)
    abtest,
    charts,
    drift,
    evaluate,
    features,
    logs,
    models,
    monitor,
    profile,
    quality,
    registry,
    scoring,
    sources,
    streams,
)
from tidemill.plans.base import ORACLES, QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
