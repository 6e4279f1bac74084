"""Model catalog, training, scoring and importances on Spark ML, and the models Spark ML lacks."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows, quoted, require_columns, small_or_none, spread, value_of
from tidemill.functions.lineage import cut, scratch_path
from tidemill.operators import growing
from tidemill.operators.boosting import SoftmaxBoostedModel, fit_softmax_boosting
from tidemill.operators.profile import detect_task
from tidemill.operators.splits import random_split, should_stratify

log = logging.getLogger(__name__)

# Working columns of a pipeline; named so as not to meet those of a dataset.
FEATURES, LABEL = "_features", "_label"
# Spark ML grows trees at most this deep; it stands in for "no limit".
DEEPEST_TREE = 30
# Query rows of one nearest-neighbour pass: they travel to every task.
KNN_QUERY_ROWS = 20_000
KNN_QUERY_BYTES = 256 * 1024 * 1024
# Query and training rows of one matrix of distances, pairs that are measured exactly at once, and how many times k near
# rows of a query row are measured without looking for the k-th.
_QUERY_SLICE, _TRAIN_SLICE, _PAIRS, _MANY = 1024, 4096, 1 << 12, 4
# A target of more values is no set of classes: a string id, say.
MOST_CLASSES = 10_000
# Values (rows times features) that a task holds of the rows of a forest, and the fewest trees that are grown by themselves.
FOREST_VALUES, FOREST_TREES = 1 << 25, 4
# Boosting rounds between two checkpoints.
ROUNDS_PER_CUT = 10
# Fixed value: share of the largest variance added to every class variance.
VAR_SMOOTHING = 1e-9


@dataclass(frozen=True)
class ModelSpec:
    """A catalog entry: task, default parameters, and how they reach the Spark estimator."""

    description: str
    task: str
    defaults: dict
    build: object = field(repr=False, compare=False)


def _tree(params: dict) -> dict:
    depth = params.get("max_depth")
    if params.get("min_samples_split", 2) > 2:
        log.warning("min_samples_split is left out: Spark's trees bound the rows of a leaf, not those of a split")
    return {
        "maxDepth": DEEPEST_TREE if depth is None else min(int(depth), DEEPEST_TREE),
        "minInstancesPerNode": int(params.get("min_samples_leaf", 1)),
        "seed": params.get("random_state", 42),
    }


def _forest(params: dict) -> dict:
    # a row finds its node in each tree from the one it was in a level before
    return _tree(params) | {"numTrees": params["n_estimators"], "cacheNodeIds": True}


def _boosted(params: dict, rows: int, classes: int, spread: float):
    gbt = C.GBTClassifier(
        maxIter=params["n_estimators"], stepSize=params["learning_rate"], maxDepth=params["max_depth"], seed=params["random_state"]
    )
    return gbt


def _linear_svm(params: dict, rows: int, classes: int, spread: float):
    if params["kernel"] != "linear":
        raise ValueError(f"there is no distributed form of the kernel {params['kernel']}")
    svc = C.LinearSVC(regParam=1.0 / (params["C"] * max(rows, 1)), standardization=False)
    return svc if classes <= 2 else C.OneVsRest(classifier=svc)


def _linear(params: dict, penalty: float, mix: float):
    return R.LinearRegression(
        fitIntercept=params["fit_intercept"],
        regParam=penalty,
        elasticNetParam=mix,
        standardization=False,
        solver="normal" if mix == 0.0 else "l-bfgs",
        tol=1e-10,
        maxIter=1000,
    )


# Names, descriptions and default parameters of the models.
_TREE_DEFAULTS = {"max_depth": None, "min_samples_split": 2, "min_samples_leaf": 1, "random_state": 42}
CATALOG: dict[str, ModelSpec] = {
    "random_forest": ModelSpec(
        "Random Forest Classifier",
        "classification",
        {"n_estimators": 100, **_TREE_DEFAULTS},
        lambda p, rows, classes, spread: C.RandomForestClassifier(**_forest(p)),
    ),
    "logistic_regression": ModelSpec(
        "Logistic Regression",
        "classification",
        {"C": 1.0, "max_iter": 100, "random_state": 42},
        lambda p, rows, classes, spread: C.LogisticRegression(
            maxIter=p["max_iter"], regParam=1.0 / (p["C"] * max(rows, 1)), standardization=False
        ),
    ),
    "decision_tree": ModelSpec(
        "Decision Tree Classifier",
        "classification",
        dict(_TREE_DEFAULTS),
        lambda p, rows, classes, spread: C.DecisionTreeClassifier(**_tree(p)),
    ),
    "gradient_boosting": ModelSpec(
        "Gradient Boosting Classifier",
        "classification",
        {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "random_state": 42},
        _boosted,
    ),
    "svm": ModelSpec(
        "Support Vector Machine Classifier",
        "classification",
        {"C": 1.0, "kernel": "linear", "random_state": 42},
        _linear_svm,
    ),
    "knn_classifier": ModelSpec(
        "K-Nearest Neighbors Classifier", "classification", {"n_neighbors": 5, "weights": "uniform"}, None
    ),
    "mlp_classifier": ModelSpec(
        "Multi-layer Perceptron Classifier",
        "classification",
        {"hidden_layer_sizes": (100,), "max_iter": 200, "random_state": 42},
        None,
    ),
    "naive_bayes": ModelSpec(
        "Gaussian Naive Bayes",
        "classification",
        {},
        lambda p, rows, classes, spread: C.NaiveBayes(modelType="gaussian"),
    ),
    "adaboost": ModelSpec(
        "AdaBoost Classifier", "classification", {"n_estimators": 50, "learning_rate": 1.0, "random_state": 42}, None
    ),
    "linear_regression": ModelSpec(
        "Linear Regression",
        "regression",
        {"fit_intercept": True},
        lambda p, rows, classes, spread: _linear(p, 0.0, 0.0),
    ),
    "ridge_regression": ModelSpec(
        "Ridge Regression",
        "regression",
        {"alpha": 1.0, "fit_intercept": True, "random_state": 42},
        # Spark divides the penalty by the label's deviation, which suits the lasso but not the ridge
        lambda p, rows, classes, spread: _linear(p, p["alpha"] / max(rows, 1) * spread, 0.0),
    ),
    "lasso_regression": ModelSpec(
        "Lasso Regression",
        "regression",
        {"alpha": 1.0, "fit_intercept": True, "random_state": 42},
        lambda p, rows, classes, spread: _linear(p, p["alpha"], 1.0),
    ),
    "decision_tree_regressor": ModelSpec(
        "Decision Tree Regressor",
        "regression",
        dict(_TREE_DEFAULTS),
        lambda p, rows, classes, spread: R.DecisionTreeRegressor(**_tree(p)),
    ),
    "random_forest_regressor": ModelSpec(
        "Random Forest Regressor",
        "regression",
        {"n_estimators": 100, **_TREE_DEFAULTS},
        lambda p, rows, classes, spread: R.RandomForestRegressor(**_forest(p)),
    ),
    "knn_regressor": ModelSpec(
        "K-Nearest Neighbors Regressor", "regression", {"n_neighbors": 5, "weights": "uniform"}, None
    ),
}


def model_spec(name: str) -> ModelSpec:
    if name not in CATALOG:
        raise ValueError(f"the catalog has no model {name}")
    return CATALOG[name]


def model_catalog(spark: SparkSession, task: str | None = None) -> DataFrame:
    """``(name, description, task, parameters map<string,string>)``."""
    rows = [
        (name, s.description, s.task, {k: str(v) for k, v in s.defaults.items()})
        for name, s in CATALOG.items()
        if task is None or s.task == task
    ]
    return local_rows(spark, rows, "name string, description string, task string, parameters map<string,string>")


def _features_per_split(value) -> str:
    return "all" if value is None else str(value)


# Parameters beyond the defaults: the Spark parameter that each one sets, and how its value is written there.
_FOREST_EXTRA = {"max_features": ("featureSubsetStrategy", _features_per_split), "max_samples": ("subsamplingRate", float)}
_TREE_EXTRA = {"criterion": ("impurity", str), "max_bins": ("maxBins", int)}
_LINEAR_EXTRA = {"fit_intercept": ("fitIntercept", bool), "tol": ("tol", float)}
EXTRA_PARAMETERS = {
    "random_forest": _FOREST_EXTRA | _TREE_EXTRA,
    "random_forest_regressor": _FOREST_EXTRA,
    "decision_tree": _TREE_EXTRA,
    "logistic_regression": _LINEAR_EXTRA | {"l1_ratio": ("elasticNetParam", float)},
    "svm": _LINEAR_EXTRA | {"max_iter": ("maxIter", int)},
    "gradient_boosting": {"subsample": ("subsamplingRate", float), "max_features": ("featureSubsetStrategy", _features_per_split)},
    # of the neighbours: an exact search, or one by an index of hash buckets
    "knn_classifier": {"algorithm": ("", str)},
    "knn_regressor": {"algorithm": ("", str)},
    "mlp_classifier": {"tol": ("tol", float), "learning_rate_init": ("stepSize", float)},
    "linear_regression": {"tol": ("tol", float)},
    "ridge_regression": {"tol": ("tol", float)},
    "lasso_regression": {"tol": ("tol", float), "max_iter": ("maxIter", int)},
}


def known_parameters(name: str, parameters: dict | None) -> dict:
    """Defaults overlaid with the parameters the estimator knows; others are dropped with a warning."""
    spec = model_spec(name)
    merged = dict(spec.defaults)
    for key, value in (parameters or {}).items():
        if key in merged or key in EXTRA_PARAMETERS.get(name, {}):
            merged[key] = value
        else:
            log.warning("%s has no parameter %s: left out", name, key)
    return merged


def _with_extras(estimator, name: str, params: dict):
    """The estimator (or the one inside one-versus-rest) with the parameters that are no defaults."""
    inner = estimator.getClassifier() if isinstance(estimator, C.OneVsRest) else estimator
    for key, (spark_name, written) in EXTRA_PARAMETERS.get(name, {}).items():
        if key in params and key not in CATALOG[name].defaults:
            inner.set(inner.getParam(spark_name), written(params[key]))
    return estimator


def require_task(df: DataFrame, target: str, model_name: str) -> str:
    """The model's task, provided that the target suits it."""
    found, wanted = detect_task(df, target).first()["task"], model_spec(model_name).task
    if found != wanted:
        raise ValueError(f"Model {model_name} is for {wanted} tasks, but the target looks like {found}")
    return wanted


@dataclass
class Trained:
    """A fitted pipeline from feature columns to ``prediction``.

    ``labels`` are the classes in index order, which is their own order, and ``label_type`` is their Spark type.
    """

    name: str
    task: str
    features: list[str]
    target: str
    pipeline: PipelineModel
    labels: list | None
    label_type: str = "string"

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and for classes ``probability map<class,double>`` and ``confidence``."""
        return score(self.pipeline, df, self.labels, self.label_type)


def train(df: DataFrame, model_name: str, features: list[str], target: str, parameters: dict | None = None) -> Trained:
    """Fit a catalog model on numeric feature columns."""
    if target in features:
        raise ValueError(f"target {target} is listed as a feature")
    require_columns(df, [*features, target])
    spec, params = model_spec(model_name), known_parameters(model_name, parameters)
    assembler = VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="error")
    data = df.select(*features, target).dropna(subset=[target])
    label_type = "string"
    if spec.task == "classification":
        label_type = df.schema[target].dataType.simpleString()
        known = small_or_none(data.select(target, F.col(target).cast("string").alias("_written")).distinct(), MOST_CLASSES)
        if known is None:
            raise ValueError(f"target {target} has more than {MOST_CLASSES} values: no classes")
        labels, written = ([r[i] for r in sorted(known, key=lambda r: r[0])] for i in (0, 1))
        indexer = StringIndexerModel.from_labels(written, inputCol=target, outputCol=LABEL)
        prepared = assembler.transform(indexer.transform(data)).select(FEATURES, LABEL)
    else:
        labels = None
        prepared = assembler.transform(data).select(FEATURES, F.col(target).cast("double").alias(LABEL))
    if model_name.startswith("knn_"):
        if params["weights"] not in KNN_WEIGHTS:
            raise ValueError(f"neighbours are weighted {' or '.join(KNN_WEIGHTS)}, not {params['weights']}")
        if params.get("algorithm", KNN_ALGORITHMS[0]) not in KNN_ALGORITHMS:
            raise ValueError(f"the algorithm of neighbours is {' or '.join(KNN_ALGORITHMS)}, not {params['algorithm']}")
        vectors = prepared.select(vector_to_array(FEATURES).alias(FEATURES), LABEL)
        path = scratch_path(df.sparkSession, "neighbours")
        vectors.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
        hashing = None
        if params.get("algorithm") == "hash":
            from tidemill.operators.neighbors import build_index

            rows, path = df.sparkSession.read.parquet(path), scratch_path(df.sparkSession, "neighbour-index")
            hashing = build_index(rows, "_row", FEATURES, LABEL, path, params["n_neighbors"]).hashing
        fitted = NeighborModel(path, params["n_neighbors"], params["weights"], len(labels or []), hashing)
        return Trained(model_name, spec.task, features, target, PipelineModel([assembler, fitted]), labels, label_type)
    if model_name.startswith("random_forest"):
        # each row is followed through every tree: few partitions would leave cores idle
        prepared = spread(prepared)
    prepared = prepared.persist()
    try:
        size = prepared.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(LABEL).alias("spread")).first()
        if model_name == "gradient_boosting" and len(labels) > 2:
            others = set(params) - set(spec.defaults)
            if others:
                log.warning("boosting of several classes has no %s: left out", ", ".join(sorted(others)))
            own = {k: v for k, v in params.items() if k not in others}
            fitted = fit_softmax_boosting(prepared, FEATURES, LABEL, len(labels), **own)
        elif model_name == "adaboost":
            fitted = fit_adaboost(prepared, len(labels), **params)
        elif model_name == "mlp_classifier":
            layers = [len(features), *params["hidden_layer_sizes"], len(labels)]
            network = C.MultilayerPerceptronClassifier(
                layers=layers, maxIter=params["max_iter"], seed=params["random_state"]
            )
            network = _with_extras(network, model_name, params)
            fitted = network.setFeaturesCol(FEATURES).setLabelCol(LABEL).fit(prepared)
        else:
            estimator = spec.build(params, size["n"], len(labels or []), size["spread"] or 0.0)
            estimator = _with_extras(estimator, model_name, params).setFeaturesCol(FEATURES).setLabelCol(LABEL)
            if growing.suits(estimator, size["n"], len(features), len(labels or [])):
                grown = growing.grow(estimator, prepared, size["n"], len(features), len(labels))
                fitted = ForestModel(grown=grown) if model_name == "random_forest" else grown.load()
            elif model_name.startswith("random_forest"):
                fitted = fit_forest(estimator, prepared, size["n"] * len(features))
            else:
                fitted = estimator.fit(prepared)
    finally:
        prepared.unpersist()
    return Trained(model_name, spec.task, features, target, PipelineModel([assembler, fitted]), labels, label_type)


def score(pipeline: PipelineModel, df: DataFrame, labels: list | None = None, label_type: str = "string") -> DataFrame:
    """Apply a fitted pipeline; class indexes become labels and probabilities a map."""
    scored = pipeline.transform(df)
    out = [F.col(quoted(c)) for c in df.columns]
    if labels is None:
        return scored.select(*out, "prediction")
    names = F.array(*[F.lit(v) for v in labels]).cast(f"array<{label_type}>")
    out.append(F.get(names, F.col("prediction").cast("int")).alias("prediction"))
    probabilities = class_probabilities(pipeline.stages[-1], len(labels))
    out += [F.map_from_arrays(names, probabilities).alias("probability"), F.array_max(probabilities).alias("confidence")]
    return scored.select(*out)


def class_probabilities(model, classes: int) -> Column:
    """An array of class probabilities over the output of a fitted classifier.

    Margins go through the logistic link; those of one-versus-rest are scaled to add up to one, those of boosting over
    several classes are a softmax. Weighted votes go
    through the exponential link of multi-class boosting.
    """
    if isinstance(model, (AdaBoostModel, NeighborModel)):
        shares = F.col("rawPrediction")
        if isinstance(model, NeighborModel) or classes < 2:
            return shares
        edge = F.transform(shares, lambda v: F.exp((v - (1.0 - v) / (classes - 1)) / (classes - 1)))
        return _scaled_to_one(edge)
    if isinstance(model, C.OneVsRestModel):
        margins = vector_to_array("rawPrediction")
        return _scaled_to_one(F.transform(margins, lambda m: 1.0 / (1.0 + F.exp(-m))))
    if isinstance(model, C.LinearSVCModel):
        upper = 1.0 / (1.0 + F.exp(-vector_to_array("rawPrediction")[1]))
        return F.slice(F.array(1.0 - upper, upper), 1, classes)
    return F.slice(vector_to_array("probability"), 1, classes)


def _scaled_to_one(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return F.transform(values, lambda v: v / total)


def confidence(df: DataFrame, probability: str = "probability") -> DataFrame:
    """Add ``confidence``: the largest class probability of a map or array column."""
    values = F.col(probability)
    if df.schema[probability].dataType.typeName() == "map":
        values = F.map_values(values)
    return df.withColumn("confidence", F.array_max(values))


_DESCRIPTION = (
    "name string, task string, features array<string>, target string, labels array<string>, label_type string, "
    "weights array<double>, neighbours struct<k:int,weights:string,hashing:string>, boosted string, forests int"
)


def save_model(trained: Trained, path: str) -> None:
    """The pipeline and, beside it, a one-row description; both are written through Spark."""
    spark, last = SparkSession.active(), trained.pipeline.stages[-1]
    weights = neighbours = boosted = forests = None
    stages = trained.pipeline
    if isinstance(last, SoftmaxBoostedModel):
        boosted, stages = last.to_json(), PipelineModel(trained.pipeline.stages[:-1])
    if isinstance(last, AdaBoostModel):
        weights = [float(w) for w in last.weights]
        stages = PipelineModel([*trained.pipeline.stages[:-1], *last.models])
    elif isinstance(last, ForestModel):
        forests = len(last.models)
        stages = PipelineModel([*trained.pipeline.stages[:-1], *last.models])
    elif isinstance(last, NeighborModel):
        neighbours = {"k": last.k, "weights": last.weights, "hashing": last.hashing and last.hashing.to_json()}
        stages = PipelineModel(trained.pipeline.stages[:-1])
        spark.read.parquet(last.path).write.mode("overwrite").parquet(f"{path}/neighbours")
    stages.write().overwrite().save(f"{path}/pipeline")
    labels = None if trained.labels is None else [str(v) for v in trained.labels]
    row = (trained.name, trained.task, trained.features, trained.target, labels, trained.label_type, weights, neighbours, boosted, forests)
    local_rows(spark, [row], _DESCRIPTION).coalesce(1).write.mode("overwrite").json(f"{path}/description")


def load_model(spark: SparkSession, path: str) -> Trained:
    found = spark.read.schema(_DESCRIPTION).json(f"{path}/description")
    row = found.withColumn("labels", F.col("labels").cast(f"array<{found.first()['label_type']}>")).first()
    pipeline = PipelineModel.load(f"{path}/pipeline")
    labels = list(row["labels"]) if row["labels"] is not None else None
    if row["boosted"] is not None:
        pipeline = PipelineModel([*pipeline.stages, SoftmaxBoostedModel.from_json(row["boosted"])])
    elif row["weights"] is not None:
        trees = pipeline.stages[-len(row["weights"]) :]
        boosted = AdaBoostModel(list(trees), list(row["weights"]), len(labels))
        pipeline = PipelineModel([*pipeline.stages[: -len(trees)], boosted])
    elif row["forests"] is not None:
        own = len(pipeline.stages) - row["forests"]
        pipeline = PipelineModel([*pipeline.stages[:own], ForestModel(list(pipeline.stages[own:]))])
    elif row["neighbours"] is not None:
        k, weights, text = row["neighbours"]
        hashing = None
        if text:
            from tidemill.operators.neighbors import Hashing

            hashing = Hashing.from_json(text)
        near = NeighborModel(f"{path}/neighbours", k, weights, len(labels or []), hashing)
        pipeline = PipelineModel([*pipeline.stages, near])
    return Trained(row["name"], row["task"], list(row["features"]), row["target"], pipeline, labels, row["label_type"])


def train_and_test(
    df: DataFrame,
    key: str,
    model_name: str,
    features: list[str],
    target: str,
    parameters: dict | None = None,
    test_size: float = 0.2,
    seed: int = 42,
) -> tuple[Trained, DataFrame]:
    """Split, fit on the training rows, and score the test rows. Classes are split one by one."""
    stratify = target if model_spec(model_name).task == "classification" or should_stratify(df, target) else None
    split = random_split(df, key, test_size, seed, stratify)
    trained = train(split.where("not is_test"), model_name, features, target, parameters)
    return trained, trained.predict(split.where("is_test").drop("is_test"))


def feature_importance(trained: Trained) -> DataFrame:
    """``(feature, importance)``, largest first: tree importances, or absolute coefficients (mean over classes)."""
    model = trained.pipeline.stages[-1]
    spark = SparkSession.active()
    rows = [(f, float(v)) for f, v in zip(trained.features, importances(model))]
    return local_rows(spark, rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def importances(model) -> np.ndarray:
    if isinstance(model, C.OneVsRestModel):
        return np.mean([importances(m) for m in model.models], axis=0)
    if isinstance(model, SoftmaxBoostedModel):
        return np.array(model.weights)
    if isinstance(model, AdaBoostModel):
        weights = np.array(model.weights)
        return np.average([importances(m) for m in model.models], axis=0, weights=weights)
    if isinstance(model, ForestModel) and model.grown is not None:
        return model.grown.importances()
    if isinstance(model, ForestModel):
        found = np.average([importances(m) for m in model.models], axis=0, weights=model.trees)
        return found / (found.sum() or 1.0)
    if hasattr(model, "featureImportances"):
        return model.featureImportances.toArray()
    if isinstance(model, C.LogisticRegressionModel):
        return np.abs(model.coefficientMatrix.toArray()).mean(axis=0)
    if hasattr(model, "coefficients"):
        return np.abs(model.coefficients.toArray())
    raise ValueError(f"{type(model).__name__} has no importances")


# --- forests in parts -----------------------------------------------------------------------------------------


class ForestModel(Transformer):
    """Forests that were grown side by side and vote as one: every tree weighs the same.

    A ``grown`` forest stays in its table until its trees are asked for.
    """

    def __init__(self, models: list | None = None, grown: growing.Grown | None = None):
        super().__init__()
        self.held, self.grown = models or [], grown

    @property
    def models(self) -> list:
        if not self.held and self.grown is not None:
            self.held = [self.grown.load()]
        return self.held

    @property
    def trees(self) -> list[int]:
        return [self.grown.trees] if self.grown is not None else [m.getNumTrees for m in self.models]

    @property
    def classes(self) -> int:
        """The number of classes, 0 for a number that is predicted."""
        return self.grown.classes if self.grown is not None else getattr(self.models[0], "numClasses", 0)

    def _transform(self, df: DataFrame) -> DataFrame:
        names, out = [f"_votes{i}" for i in range(len(self.models))], df
        for name, model in zip(names, self.models):
            voter = model.copy()
            if self.classes:
                voter.setPredictionCol("").setRawPredictionCol(name).setProbabilityCol("")
            else:
                voter.setPredictionCol(name)
            out = voter.transform(out)
        count = float(sum(self.trees))
        if not self.classes:
            votes = [F.col(name) * F.lit(float(n)) for name, n in zip(names, self.trees)]
            return out.withColumn("prediction", reduce(add, votes) / count).drop(*names)
        out = out.withColumns({name: vector_to_array(name) for name in names})
        votes = F.array(*[reduce(add, [F.col(name)[c] for name in names]) for c in range(self.classes)])
        out = out.withColumn("_votes", votes).drop(*names)
        pairs = F.array(*[F.struct((-F.col("_votes")[c]).alias("rank"), F.lit(float(c)).alias("label")) for c in range(self.classes)])
        shares = F.transform("_votes", lambda v: v / count)
        return out.withColumns({"probability": array_to_vector(shares), "prediction": F.array_min(pairs)["label"]}).drop("_votes")


def fit_forest(estimator, prepared: DataFrame, values: int):
    """A random forest, its trees dealt to the cores as far as a task can hold the rows.

    Spark sends a table of counts for each node from each partition of the rows, and a tree without a depth limit has
    nodes in proportion to its rows. So the rows of a part of the trees are in no more partitions than their ``values``
    ask for, and the cores grow different trees. Every part draws its own rows and features.
    """
    trees, cores = estimator.getNumTrees(), prepared.sparkSession.sparkContext.defaultParallelism
    partitions = max(1, -(-values // FOREST_VALUES))
    parts = min(cores // partitions, trees // FOREST_TREES)
    if parts < 2:
        return estimator.fit(prepared)

    def grown(part: int):
        own = estimator.copy().setNumTrees(trees * (part + 1) // parts - trees * part // parts)
        # partitions draw by seeds that follow one another
        return own.setSeed(estimator.getSeed() + part * (partitions + 1)).fit(prepared.repartition(partitions))

    with ThreadPoolExecutor(parts) as pool:
        return ForestModel([f.result() for f in [pool.submit(inheritable_thread_target(prepared.sparkSession)(grown), i) for i in range(parts)]])


# --- boosting of weighted trees -------------------------------------------------------------------------------


class AdaBoostModel(Transformer):
    """Weighted vote of trees; ``rawPrediction`` is the weight per class, ``prediction`` its largest."""

    def __init__(self, models: list | None = None, weights: list[float] | None = None, classes: int = 2):
        super().__init__()
        self.models, self.weights, self.classes = models or [], weights or [], classes

    def _transform(self, df: DataFrame) -> DataFrame:
        votes = [F.lit(0.0)] * self.classes
        out = df
        for i, (model, weight) in enumerate(zip(self.models, self.weights)):
            voter = model.copy()
            voter.setPredictionCol(f"_vote{i}").setRawPredictionCol("").setProbabilityCol("")
            out = voter.transform(out)
            votes = [v + F.when(F.col(f"_vote{i}") == c, weight).otherwise(0.0) for c, v in enumerate(votes)]
        total = sum(self.weights) or 1.0
        pairs = F.array(*[F.struct((-v).alias("rank"), F.lit(float(c)).alias("label")) for c, v in enumerate(votes)])
        return out.withColumns(
            {"rawPrediction": F.array(*[v / total for v in votes]), "prediction": F.array_min(pairs)["label"]}
        ).drop(*[f"_vote{i}" for i in range(len(self.models))])


def fit_adaboost(
    prepared: DataFrame, classes: int, n_estimators: int = 50, learning_rate: float = 1.0, random_state: int = 42
) -> AdaBoostModel:
    """SAMME boosting (Hastie et al. 2009) of depth-one trees over ``features`` and ``label``.

    Each round is one weighted tree and one aggregate. The weights of a round are held while its tree reads them several
    times, and let go once the next are; a checkpoint every few rounds bounds the lineage.
    """
    rows = prepared.count()
    data = prepared.select(FEATURES, LABEL).withColumn("weight", F.lit(1.0 / rows)).persist()
    held: list[DataFrame] = [data]  # the weights of this round, and those they were made from
    models, weights = [], []
    try:
        for round_number in range(n_estimators):
            tree = C.DecisionTreeClassifier(
                maxDepth=1, weightCol="weight", seed=random_state + round_number, featuresCol=FEATURES, labelCol=LABEL
            ).fit(data)
            while len(held) > 1:
                held.pop(0).unpersist()
            missed = F.col("prediction") != F.col(LABEL)
            judged = tree.transform(data).select(FEATURES, LABEL, "weight", "prediction")
            sums = judged.agg(
                F.sum("weight").alias("all"), F.coalesce(F.sum(F.when(missed, F.col("weight"))), F.lit(0.0)).alias("wrong")
            ).first()
            error = sums["wrong"] / sums["all"]
            if error >= 1.0 - 1.0 / classes:
                break
            strength = learning_rate * (math.log((1.0 - error) / max(error, 1e-12)) + math.log(classes - 1.0))
            models.append(tree)
            weights.append(strength)
            if error <= 0.0:
                break
            raised = F.col("weight") * F.when(missed, math.exp(strength)).otherwise(1.0)
            norm = sums["all"] + sums["wrong"] * (math.exp(strength) - 1.0)
            data = judged.select(FEATURES, LABEL, (raised / norm).alias("weight"))
            if round_number % ROUNDS_PER_CUT == ROUNDS_PER_CUT - 1:
                data = cut(data)
            data = data.persist()
            held.append(data)
    finally:
        for old in held:
            old.unpersist()
    if not models:
        raise ValueError("no tree does better than chance")
    return AdaBoostModel(models, weights, classes)


# --- Gaussian naive Bayes as expressions ----------------------------------------------------------------------


def fit_gaussian_nb(df: DataFrame, features: list[str], label: str) -> list[dict]:
    """Per class its prior, and mean and variance per feature (classes x features values)."""
    values = {c: value_of(df, c).cast("double") for c in features}
    per_class = (
        df.where(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(v).alias(f"mean{i}") for i, v in enumerate(values.values())],
            *[F.var_pop(v).alias(f"var{i}") for i, v in enumerate(values.values())],
        )
        .orderBy("label")
        .collect()
    )
    spread = df.agg(*[F.var_pop(v).alias(f"v{i}") for i, v in enumerate(values.values())]).first()
    floor = VAR_SMOOTHING * max(spread)
    rows = sum(r["n"] for r in per_class)
    return [
        {
            "label": r["label"],
            "prior": r["n"] / rows,
            "mean": [r[f"mean{i}"] for i in range(len(features))],
            "var": [r[f"var{i}"] + floor for i in range(len(features))],
        }
        for r in per_class
    ]


def predict_gaussian_nb(df: DataFrame, fitted: list[dict], features: list[str]) -> DataFrame:
    """Add ``prediction``: the class of the largest log density, the smaller label among equals."""
    scores = []
    for c in fitted:
        log_density = F.lit(math.log(c["prior"]))
        for name, mean, var in zip(features, c["mean"], c["var"]):
            distance = value_of(df, name).cast("double") - F.lit(mean)
            log_density = log_density - F.lit(0.5 * math.log(2 * math.pi * var)) - distance * distance / F.lit(2 * var)
        scores.append(F.struct((-log_density).alias("rank"), F.lit(c["label"]).alias("label")))
    return df.withColumn("prediction", F.array_min(F.array(*scores))["label"])


# --- nearest neighbours ---------------------------------------------------------------------------------------


KNN_WEIGHTS = ("uniform", "distance")
KNN_ALGORITHMS = ("exact", "hash")


def knn_neighbors(train_df: DataFrame, query: DataFrame, key: str, vector: str, target: str, k: int = 5) -> DataFrame:
    """``(key, rank, neighbor, target, distance2)``: the exact k nearest training rows of every query row.

    A training row with the key of the query row is not its own neighbour; ties go to the smaller key. Query rows
    travel to the training partitions in blocks of a checked size, one pass over the training rows for each block. A
    task keeps the k best of every query row over all it reads and writes them once at its end, so at most k rows for
    each query row and task meet in a grouped top-k. Neither side is copied.
    """
    spark = train_df.sparkSession
    schema = _neighbor_schema(train_df, key, target)
    own = spread(train_df.select(key, vector, target))
    path = scratch_path(spark, "nearest")
    for part, points in query_blocks(query.select(key, vector), key, vector):
        shared = spark.sparkContext.broadcast((part[key].to_numpy(), points))

        def partial(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            keys, points = shared.value
            best = _Nearest(keys, points, k)
            for batch in batches:
                if len(batch) and len(keys):
                    best.offer(batch[key].to_numpy(), np.array(batch[vector].tolist(), dtype=np.float64), batch[target].to_numpy())
            yield best.rows()

        own.mapInPandas(partial, schema).write.mode("append").parquet(path)
    ranked = W.partitionBy("query").orderBy("distance2", "neighbor")
    return (
        spark.read.schema(schema).parquet(path)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select(F.col("query").alias(key), "rank", "neighbor", F.col("target").alias(target), "distance2")
    )


def query_blocks(query: DataFrame, key: str, vector: str) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """All query rows and their vectors, as many at a time as travel to every task of one pass; at least one block."""
    size = query.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector)).alias("d")).first()
    limit = min(KNN_QUERY_ROWS, max(KNN_QUERY_BYTES // (8 * (size["d"] or 1)), 1))
    blocks = max(1, math.ceil(size["n"] / limit))
    for block in range(blocks):
        some = query if blocks == 1 else query.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == block)
        part = some.toPandas()
        yield part, np.array(part[vector].tolist(), dtype=np.float64).reshape(len(part), -1 if len(part) else 0)


class _Nearest:
    """The k nearest rows of every query row so far, kept in arrays of one row for each query row.

    A matrix product gives every distance up to a rounding error of known size. Only rows that may be among the nearest
    within that error are measured exactly, so the result is the one of exact distances.
    """

    def __init__(self, keys: np.ndarray, points: np.ndarray, k: int):
        self.keys, self.points, self.k = keys, points, k
        self.squares = (points * points).sum(axis=1)
        self.distance = np.full((len(keys), k), np.inf)
        self.neighbor = np.empty((len(keys), k), keys.dtype)
        self.target = np.empty((len(keys), k), object)

    def offer(self, own: np.ndarray, x: np.ndarray, targets: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Training rows ``x`` with keys and targets, of which ``rows`` of the query rows (None: all) take the nearest."""
        rows = np.arange(len(self.keys)) if rows is None else rows
        if own.dtype != self.neighbor.dtype:
            own, self.neighbor = own.astype(object), self.neighbor.astype(object)
        # a slice of query rows and of training rows at a time keeps the distance matrix small
        for begin in range(0, len(own), _TRAIN_SLICE):
            some = slice(begin, begin + _TRAIN_SLICE)
            with np.errstate(all="ignore"):
                squares = (x[some] * x[some]).sum(axis=1)
                for at in range(0, len(rows), _QUERY_SLICE):
                    self._merge(rows[at : at + _QUERY_SLICE], own[some], x[some], squares, targets[some])

    def _merge(self, rows: np.ndarray, own: np.ndarray, x: np.ndarray, squares: np.ndarray, targets: np.ndarray) -> None:
        points = self.points[rows]
        rough = points @ x.T
        rough *= -2.0
        rough += self.squares[rows, None]
        rough += squares
        rough[self.keys[rows, None] == own] = np.nan
        # at most this far is either form of a distance from the true one, so twice as far from each other
        largest = squares[np.isfinite(squares)].max(initial=0.0)
        error = 8.0 * (x.shape[1] + 4) * np.finfo(float).eps * (self.squares[rows] + largest)
        reach = self.distance[rows, -1]
        limit = reach + error
        near = rough <= limit[:, None]
        if np.count_nonzero(near) > _MANY * self.k * len(points):
            take = min(self.k, len(x))
            # NaN sorts last, and is no limit
            kth = np.partition(rough, take - 1, axis=1)[:, take - 1]
            near &= ~(rough > np.fmin(limit, kth + 2 * error)[:, None])
        i, j = np.nonzero(near)
        distance = np.empty(len(i))
        for begin in range(0, len(i), _PAIRS):
            some = slice(begin, begin + _PAIRS)
            gaps = points[i[some]] - x[j[some]]
            gaps *= gaps
            total = np.zeros(len(gaps))
            for column in range(gaps.shape[1]):
                total += gaps[:, column]
            distance[some] = total
        good = np.isfinite(distance) & (distance <= reach[i])
        i, j, distance = i[good], j[good], distance[good]
        if not len(i):
            return
        touched, i = np.unique(rows[i]), rows[i]
        old, place = np.nonzero(np.isfinite(self.distance[touched]))
        old = touched[old]
        row = np.concatenate((old, i))
        distance = np.concatenate((self.distance[old, place], distance))
        neighbor = np.concatenate((self.neighbor[old, place], own[j]))
        target = np.concatenate((self.target[old, place], targets[j].astype(object)))
        by_key = np.unique(neighbor, return_inverse=True)[1] if neighbor.dtype == object else neighbor
        order = np.lexsort((by_key, distance, row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        order, place = order[place < self.k], place[place < self.k]
        row = row[order]
        for whole, part in ((self.distance, distance), (self.neighbor, neighbor), (self.target, target)):
            whole[row, place] = part[order]

    def rows(self) -> pd.DataFrame:
        i, j = np.nonzero(np.isfinite(self.distance))
        return pd.DataFrame(
            {"query": self.keys[i], "neighbor": self.neighbor[i, j], "target": self.target[i, j], "distance2": self.distance[i, j]}
        )


def _neighbor_schema(train_df: DataFrame, key: str, target: str) -> str:
    key_type = train_df.schema[key].dataType.simpleString()
    target_type = train_df.schema[target].dataType.simpleString()
    return f"query {key_type}, neighbor {key_type}, target {target_type}, distance2 double"


def _weighted(neighbors: DataFrame, key: str, weights: str) -> DataFrame:
    """``_w``: 1, or the inverse distance; if some neighbours are at no distance, only these count."""
    if weights not in KNN_WEIGHTS:
        raise ValueError(f"neighbours are weighted {' or '.join(KNN_WEIGHTS)}, not {weights}")
    if weights == "uniform":
        return neighbors.withColumn("_w", F.lit(1.0))
    exact = F.max(F.col("distance2") == 0).over(W.partitionBy(key))
    inverse = F.when(exact, (F.col("distance2") == 0).cast("double")).otherwise(1.0 / F.sqrt("distance2"))
    return neighbors.withColumn("_w", inverse)


def knn_classify(
    train_df: DataFrame, query: DataFrame, key: str, vector: str, label: str, k: int = 5, weights: str = "uniform"
) -> DataFrame:
    """``(key, prediction, votes)``: the label with the most votes, by number or by inverse distance; ties go to the smaller."""
    neighbors = _weighted(knn_neighbors(train_df, query, key, vector, label, k), key, weights)
    votes = neighbors.groupBy(key, label).agg(F.sum("_w").alias("w"), F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("w")).alias("rank"), F.col(label).alias("label"), F.col("n").alias("n")))
    return votes.groupBy(key).agg(best.alias("best")).select(
        key, F.col("best.label").alias("prediction"), F.col("best.n").alias("votes")
    )


def knn_regress(
    train_df: DataFrame, query: DataFrame, key: str, vector: str, target: str, k: int = 5, weights: str = "uniform"
) -> DataFrame:
    """``(key, prediction)``: mean of the neighbours' target, weighted alike or by inverse distance."""
    neighbors = _weighted(knn_neighbors(train_df, query, key, vector, target, k), key, weights)
    return neighbors.groupBy(key).agg((F.sum(F.col(target) * F.col("_w")) / F.sum("_w")).alias("prediction"))


class NeighborModel(Transformer):
    """Nearest neighbours as a fitted model: the training rows in a table, ``rawPrediction`` their vote shares.

    With ``hashing`` the table is the index of ``operators.neighbors``, and neighbours are those it finds.
    """

    def __init__(self, path: str = "", k: int = 5, weights: str = "uniform", classes: int = 0, hashing=None):
        super().__init__()
        self.path, self.k, self.weights, self.classes, self.hashing = path, k, weights, classes, hashing

    def _nearest(self, points: DataFrame) -> DataFrame:
        if self.hashing is None:
            known = points.sparkSession.read.parquet(self.path).select("_row", FEATURES, LABEL)
            return knn_neighbors(known, points, "_row", FEATURES, LABEL, self.k)
        from tidemill.operators.neighbors import NeighborIndex, approximate_neighbors

        index = NeighborIndex(self.path, self.hashing, "_row", LABEL)
        return approximate_neighbors(index, points, "_row", FEATURES, self.k)

    def _transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = scratch_path(spark, "neighbour-queries")
        # written once, so that a row keeps its number
        df.withColumn("_row", -1 - F.monotonically_increasing_id()).write.parquet(path)
        rows = spark.read.parquet(path)
        points = rows.select("_row", vector_to_array(FEATURES).alias(FEATURES))
        found = _weighted(self._nearest(points), "_row", self.weights)
        if not self.classes:
            out = found.groupBy("_row").agg((F.sum(F.col(LABEL) * F.col("_w")) / F.sum("_w")).alias("prediction"))
        else:
            share = [F.sum(F.when(F.col(LABEL) == c, F.col("_w")).otherwise(0.0)) / F.sum("_w") for c in range(self.classes)]
            out = found.groupBy("_row").agg(F.array(*share).alias("rawPrediction"))
            first = F.array_position("rawPrediction", F.array_max("rawPrediction")) - 1
            out = out.withColumn("prediction", first.cast("double"))
        return rows.join(out, "_row").drop("_row")


def linear_coefficients(trained: Trained) -> DataFrame:
    """``(feature, weight)`` of a linear regression, the intercept under its own name."""
    model = trained.pipeline.stages[-1]
    rows = [*zip(trained.features, [float(v) for v in model.coefficients]), ("(intercept)", float(model.intercept))]
    return local_rows(SparkSession.active(), rows, "feature string, weight double")

