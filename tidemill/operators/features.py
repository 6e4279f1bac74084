"""Feature sets: fitted imputation, scaling and one-hot encoding, applied as column expressions.

Fitting reduces a table to a few values per column; those become literals of the transform, which is then a
narrow projection without any shuffle.
"""

from __future__ import annotations

import json
import logging
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import numeric_columns, one_row, quoted, require_columns, string_columns, value_of
from tidemill.operators.profile import feature_statistics, most_frequent, value_frequencies

log = logging.getLogger(__name__)

# One-hot encoding makes one column per category; beyond this the output schema itself is unusable, and
# ``operators.dictionary`` makes one sparse vector instead.
MAX_CATEGORIES = 20_000

# What an entirely empty column is filled with.
EMPTY_NUMBER = 0.0
EMPTY_TEXT = "missing"


@dataclass
class FeatureSet:
    """Fitted parameters of one feature set version."""

    name: str
    version: str
    numeric: dict[str, dict[str, float]]
    categorical: dict[str, dict]
    target: str | None = None
    created_at: str = field(default_factory=lambda: datetime.now(timezone.utc).isoformat())
    column_types: dict[str, str] = field(default_factory=dict)
    statistics: dict = field(default_factory=dict)

    @property
    def inputs(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def outputs(self) -> list[str]:
        scaled = [f"{c}_scaled" for c in self.numeric]
        return scaled + [f"{c}_{v}" for c, p in self.categorical.items() for v in p["categories"]]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> FeatureSet:
        return cls(**json.loads(text))


def fit_numeric(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float]]:
    """Mean and population sd of the mean-imputed column, one pass.

    Imputed rows sit at the mean, so they only thin out the variance of the filled ones.
    """
    require_columns(df, columns)
    wanted: dict = {"rows": F.count(F.lit(1))}
    for c in columns:
        v = value_of(df, c).cast("double")
        wanted |= {("n", c): F.count(v), ("mean", c): F.avg(v), ("var", c): F.var_pop(v)}
    got = one_row(df, wanted)
    out = {}
    for c in columns:
        filled = got[("n", c)]
        if not filled:
            out[c] = {"mean": EMPTY_NUMBER, "sd": 0.0}
            continue
        out[c] = {"mean": got[("mean", c)], "sd": (got[("var", c)] * filled / got["rows"]) ** 0.5}
    return out


def fit_categorical(df: DataFrame, columns: list[str], most: int = MAX_CATEGORIES) -> dict[str, dict]:
    """Most frequent value (the smallest of equals) and the sorted categories per column, ``most`` of them in all."""
    require_columns(df, columns)
    frequencies = value_frequencies(df, columns)
    modes = {r["column"]: r for r in most_frequent(frequencies).collect()}
    found = sum(r["unique_values"] for r in modes.values())
    if found > most:
        raise ValueError(f"{found} categories in {', '.join(columns)}: too many for one column each, fit a dictionary")
    categories: dict[str, list[str]] = {c: [] for c in columns}
    for r in frequencies.select("column", "value").orderBy("column", "value").collect():
        categories[r["column"]].append(r["value"])
    return {
        c: {
            "mode": modes[c]["most_common"] if c in modes else EMPTY_TEXT,
            "categories": categories[c] or [EMPTY_TEXT],
        }
        for c in columns
    }


def fit_feature_set(
    df: DataFrame,
    name: str,
    numeric: list[str],
    categorical: list[str] | None = None,
    target: str | None = None,
    version: str = "v1",
) -> FeatureSet:
    categorical = categorical or []
    if target is not None and target in [*numeric, *categorical]:
        raise ValueError(f"target {target} is listed as a feature")
    rows = feature_statistics(df, numeric, categorical).collect() if numeric or categorical else []
    statistics = {r["column"]: {k: v for k, v in r.asDict().items() if k != "column" and v is not None} for r in rows}
    return FeatureSet(
        name,
        version,
        fit_numeric(df, numeric) if numeric else {},
        fit_categorical(df, categorical) if categorical else {},
        target,
        column_types={f.name: f.dataType.simpleString() for f in df.schema.fields},
        statistics=statistics,
    )


def scaled(value: Column, mean: float, sd: float) -> Column:
    return (F.coalesce(value.cast("double"), F.lit(mean)) - F.lit(mean)) / F.lit(sd or 1.0)


def one_hot(value: Column, mode: str, category: str) -> Column:
    return (F.coalesce(value.cast("string"), F.lit(mode)) == F.lit(category)).cast("double")


def add_missing_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Declared columns that the input lacks come in as null, to be imputed later."""
    absent = {c: t for c, t in columns.items() if c not in df.columns}
    if absent:
        log.warning("columns missing from the input: %s", ", ".join(absent))
    return df.withColumns({c: F.lit(None).cast(t) for c, t in absent.items()})


def transform(df: DataFrame, features: FeatureSet, keep: list[str] | None = None) -> DataFrame:
    """Scaled and one-hot columns, then the target if the input has it; ``keep`` are key columns to carry."""
    full = add_missing_columns(
        df, {**dict.fromkeys(features.numeric, "double"), **dict.fromkeys(features.categorical, "string")}
    )
    out = [F.col(quoted(c)) for c in keep or []]
    out += [
        scaled(value_of(full, c), p["mean"], p["sd"]).alias(f"{c}_scaled") for c, p in features.numeric.items()
    ]
    for c, p in features.categorical.items():
        out += [one_hot(value_of(full, c), p["mode"], v).alias(f"{c}_{v}") for v in p["categories"]]
    if not features.inputs:
        log.warning("feature set %s has no features", features.name)
        return df
    if features.target and features.target in df.columns:
        out.append(F.col(quoted(features.target)))
    return full.select(*out)


def fit_imputer(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Fill value per column: the mean of numbers, the mode of anything else."""
    require_columns(df, columns)
    numbers = [c for c in columns if c in numeric_columns(df)]
    others = [c for c in columns if c not in numbers]
    means = one_row(df, {c: F.avg(value_of(df, c).cast("double")) for c in numbers}) if numbers else {}
    modes: dict[str, str] = {}
    if others:
        modes = {r["column"]: r["most_common"] for r in most_frequent(value_frequencies(df, others)).collect()}
    fills: dict[str, object] = {c: EMPTY_NUMBER if means[c] is None else means[c] for c in numbers}
    return fills | {c: modes.get(c, EMPTY_TEXT) for c in others}


def impute(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Fill with values fitted on the training rows."""
    filled = {}
    for c, fill in fills.items():
        value = value_of(df, c)
        if isinstance(fill, float):
            filled[c] = F.coalesce(value.cast("double"), F.lit(fill))
        else:
            filled[c] = F.coalesce(value.cast("string"), F.lit(fill))
    return df.withColumns(filled)


@dataclass
class DummyEncoding:
    """Output columns in training order: plain ones, then one per category without the first."""

    plain: list[str]
    categories: dict[str, list[str]]

    @property
    def encoded_columns(self) -> list[str]:
        return self.plain + [f"{c}_{v}" for c, values in self.categories.items() for v in values[1:]]


def fit_dummies(df: DataFrame, columns: list[str]) -> DummyEncoding:
    categorical = [c for c in columns if c in string_columns(df)]
    fitted = fit_categorical(df, categorical) if categorical else {}
    return DummyEncoding(
        [c for c in columns if c not in categorical], {c: p["categories"] for c, p in fitted.items()}
    )


def encode_dummies(df: DataFrame, encoding: DummyEncoding, keep: list[str] | None = None) -> DataFrame:
    """Training columns in training order, for training and scoring alike: unseen categories give zeros."""
    out = [F.col(quoted(c)) for c in [*(keep or []), *encoding.plain]]
    for c, values in encoding.categories.items():
        match = F.col(quoted(c)).cast("string")
        out += [F.coalesce(match == F.lit(v), F.lit(False)).cast("double").alias(f"{c}_{v}") for v in values[1:]]
    return df.select(*out)


def missing_features(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_features(df: DataFrame, required: list[str]) -> DataFrame:
    absent = missing_features(df, required)
    if absent:
        raise ValueError(f"features that are not in the table: {', '.join(absent)}")
    return df.select(*[quoted(c) for c in required])
