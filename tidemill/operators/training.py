"""From a raw table to a fitted model and back: missing values, categories, split, fit and score as one."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows, nan_to_null, require_columns
from tidemill.operators import evaluate, models
from tidemill.operators.features import DummyEncoding, encode_dummies, fit_dummies, fit_imputer, impute, require_features
from tidemill.operators.profile import suggest_features
from tidemill.operators.splits import DEFAULT_TEST, random_split, should_stratify

# Working name of the row number that predictions are joined back by.
KEY = "_key"


@dataclass
class TableModel:
    """A fitted model with all that turns raw rows into its features: fill values, and categories in training order."""

    features: list[str]
    fills: dict[str, object]
    encoding: DummyEncoding
    trained: models.Trained

    def prepare(self, df: DataFrame) -> DataFrame:
        """The raw columns and those that the model takes. A raw feature that is missing altogether is an error."""
        require_features(df, self.features)
        own = [F.col(f"`{c}`") for c in df.columns]
        raw = nan_to_null(df).select(F.struct(*own).alias("_row"), *[F.col(f"`{c}`") for c in self.features])
        return encode_dummies(impute(raw, self.fills), self.encoding, ["_row"])

    def predict(self, df: DataFrame) -> DataFrame:
        """The raw rows with ``prediction`` and for classes ``probability`` and ``confidence``."""
        scored = self.trained.predict(self.prepare(df))
        added = [c for c in scored.columns if c in ("prediction", "probability", "confidence")]
        return scored.select("_row.*", *added)

    def importance(self) -> DataFrame:
        return models.feature_importance(self.trained)

    def save(self, path: str) -> None:
        """Model, fill values and categories under one path."""
        models.save_model(self.trained, f"{path}/model")
        text = json.dumps(
            {"features": self.features, "fills": self.fills, "plain": self.encoding.plain, "categories": self.encoding.categories}
        )
        local_rows(SparkSession.active(), [(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/preparation")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TableModel:
        held = json.loads(spark.read.text(f"{path}/preparation", wholetext=True).first()[0])
        encoding = DummyEncoding(held["plain"], held["categories"])
        return cls(held["features"], held["fills"], encoding, models.load_model(spark, f"{path}/model"))


def train_table(
    df: DataFrame,
    target: str,
    model_name: str,
    features: list[str] | None = None,
    parameters: dict | None = None,
    key: str | None = None,
    test_size: float = DEFAULT_TEST,
    seed: int = 42,
) -> tuple[TableModel, DataFrame]:
    """Fit a catalog model on a raw table; also its predictions for the test rows.

    Features default to the suggested ones. Rows without a target are left out. Classes are split one by one; ``key``
    orders the split (default: a hash of the features and the target). Fill values and categories come from the
    training rows alone, and so do the columns of the model: a category that only test rows have counts as none.
    """
    require_columns(df, [target, *(features or [])])
    features = list(features or [r["feature"] for r in suggest_features(df, target).collect()])
    if target in features:
        raise ValueError(f"target {target} is listed as a feature")
    models.require_task(df, target, model_name)
    known = nan_to_null(df).where(F.col(f"`{target}`").isNotNull())
    own = F.col(f"`{key}`") if key else F.xxhash64(*[F.col(f"`{c}`") for c in [*features, target]])
    classes = models.model_spec(model_name).task == "classification"
    stratify = target if classes or should_stratify(known, target) else None
    split = random_split(known.withColumn(KEY, own), KEY, test_size, seed, stratify)
    train = split.where("not is_test").drop("is_test", KEY)
    fills = fit_imputer(train, features)
    encoding = fit_dummies(impute(train.select(*features), fills), features)
    encoded = encode_dummies(impute(train.select(*features, target), fills), encoding, [target])
    trained = models.train(encoded, model_name, encoding.encoded_columns, target, parameters)
    fitted = TableModel(features, fills, encoding, trained)
    return fitted, fitted.predict(split.where("is_test").drop("is_test", KEY))


def evaluate_table(scored: DataFrame, target: str, task: str) -> DataFrame:
    """The metrics of the task over scored rows."""
    if task == "classification":
        return evaluate.classification_metrics(scored, target, "prediction")
    return evaluate.regression_metrics(scored, target, "prediction")
