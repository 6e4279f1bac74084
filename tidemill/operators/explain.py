"""Per-row feature impacts and their aggregates."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import one_row, require_columns, small_or_none, value_of
from tidemill.operators.models import ForestModel, class_probabilities

# Impacts shown per row, and rows of a background sample.
MAX_DISPLAY = 10
BACKGROUND_ROWS = 100
# Larger backgrounds are refused: they travel in the plan.
BACKGROUND_LIMIT = 1000
# Walks that a task follows at once.
_WALKS = 4096


def linear_shap(
    df: DataFrame, key: str, weights: Mapping[str, float], intercept: float, means: Mapping[str, float] | None = None
) -> DataFrame:
    """``(key, base_value, impacts array<{feature, impact, value}>)`` of a linear model.

    The impact of a feature is its weight times the distance from the background mean; together with the base
    value they add up to the prediction. Means default to those of the table.
    """
    require_columns(df, [key, *weights])
    if means is None:
        means = one_row(df, {c: F.avg(value_of(df, c).cast("double")) for c in weights})
    base = intercept + sum(weights[c] * means[c] for c in weights)
    impacts = []
    for c, w in weights.items():
        value = F.coalesce(value_of(df, c).cast("double"), F.lit(float(means[c])))
        impact = F.lit(float(w)) * (value - F.lit(float(means[c])))
        impacts.append(F.struct(F.lit(c).alias("feature"), impact.alias("impact"), value.alias("value")))
    return df.select(key, F.lit(float(base)).alias("base_value"), F.array(*impacts).alias("impacts"))


def background_sample(df: DataFrame, key: str, features: list[str], rows: int = BACKGROUND_ROWS) -> DataFrame:
    """The first rows in key order."""
    return df.orderBy(key).limit(rows).select(key, *features)


def sampled_shap(
    model,
    df: DataFrame,
    key: str,
    features: list[str],
    background: DataFrame,
    samples: int | None = None,
    seed: int = 42,
    per_class: bool = False,
    background_limit: int = BACKGROUND_LIMIT,
) -> DataFrame:
    """``(key, base_value, impacts)`` of a fitted model, by permutation sampling.

    ``model`` is a :class:`~tidemill.operators.models.Trained` or a fitted pipeline. Explains the prediction of a
    regressor and the probability of the last class of a classifier; ``per_class`` gives one row for each class
    instead, with the class itself in column ``class`` (its index if only a pipeline is given).

    Every sample pairs a row with one background row and one order of the features, and walks from the background row
    to the row one feature at a time. The change of the model output at each step is credited to the feature that
    moved, so impacts and base value add up to the prediction exactly. All rows meet the same background rows, each of
    them once (``samples`` that are more go round again), so there is one base value for a model and class. Orders are
    hashes of key and sample. A missing feature counts as its background mean. The background, a table of at most
    ``background_limit`` rows, travels as a literal array. Tree models have an exact form (``operators.tree_shap``).

    The steps of a walk down a tree or forest are evaluated together: at a node they part in two at the step that moves
    its feature, and only steps that end in different leaves change the output. Other models score every step.
    """
    size = len(features)
    if size == 0:
        raise ValueError("no features to explain")
    held = background.select(*[value_of(background, c).cast("double").alias(c) for c in features])
    held = small_or_none(held, background_limit)
    if held is None:
        raise ValueError(f"the background has more than {background_limit} rows: sample it")
    if not held:
        raise ValueError("the background is empty")
    known = [[r[c] for r in held if r[c] is not None] for c in features]
    means = [math.fsum(v) / len(v) if v else 0.0 for v in known]
    points = [[m if r[c] is None else r[c] for c, m in zip(features, means)] for r in held]
    walks = max(samples or 0, len(points))
    base_points = F.array(*[F.array(*[F.lit(v) for v in p]) for p in points])
    own = F.array(*[F.coalesce(value_of(df, c).cast("double"), F.lit(m)) for c, m in zip(features, means)])
    # spread by key once: every later grouping is by the key and more, so none of them shuffles again
    keyed = df.select(F.col(key).alias("_key"), own.alias("_x")).repartition("_key")
    trees = _walkable(model, features)
    if trees:
        # a null key joins nothing at the end of the other form
        keyed = keyed.where(F.col("_key").isNotNull()).sortWithinPartitions("_key")
    rows = keyed.select("_key", "_x", F.explode(F.sequence(F.lit(0), F.lit(walks - 1))).alias("_s"))
    order = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)),
            lambda j: F.struct(F.xxhash64(F.lit(seed), F.col("_key"), F.col("_s"), j).alias("h"), j.alias("j")),
        )
    )
    started = rows.select(
        "_key",
        "_s",
        "_x",
        F.get(base_points, F.pmod("_s", F.lit(len(points))).cast("int")).alias("_b"),
        F.transform(order, lambda o: o["j"]).alias("_order"),
    )
    names = F.array(*[F.lit(c) for c in features])
    labels = getattr(model, "labels", None)
    if trees:
        return _walked(model, started.select("_key", "_x", "_s", "_order"), np.array(points, float), features, key, per_class)
    # the place of each feature in the order, once for a walk and not for each of its steps
    ranks = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: F.array_position(F.col("_order"), j))
    started = started.withColumn("_ranks", ranks)
    steps = started.select("*", F.explode(F.sequence(F.lit(0), F.lit(size))).alias("_step"))
    at_step = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda j: F.when(F.get(F.col("_ranks"), j) <= F.col("_step"), F.get(F.col("_x"), j)).otherwise(
            F.get(F.col("_b"), j)
        ),
    )
    # the output of a step counts for the feature that it moved, and against the one that the next step moves
    moved = F.coalesce(F.get("_order", F.col("_step") - 1), F.lit(-1))
    following = F.get("_order", F.col("_step"))
    carried = ["_key", "_moved", "_following"]
    placed = steps.select("_key", moved.alias("_moved"), following.alias("_following"), at_step.alias("_at")).select(
        *carried, *[F.get("_at", F.lit(i)).alias(c) for i, c in enumerate(features)]
    )
    evaluated = getattr(model, "pipeline", model).transform(placed)
    if per_class:
        shares, classes = _probabilities(model, evaluated), len(labels) if labels is not None else _classes(model)
        found = [F.get(shares, F.lit(c)) for c in range(classes)]
    else:
        found = [_model_output(model, evaluated)]
    outputs = evaluated.select(*carried, *[f.alias(f"_f{c}") for c, f in enumerate(found)])
    # -1: the background row itself, of whose outputs the base value is the mean
    parts = F.array(F.struct(F.col("_moved").alias("_j"), F.lit(1.0).alias("_sign")), F.struct(F.col("_following").alias("_j"), F.lit(-1.0).alias("_sign")))
    signed = outputs.select("_key", F.inline(parts), *[f"_f{c}" for c in range(len(found))]).where(F.col("_j").isNotNull())
    sums = signed.groupBy("_key", "_j").agg(*[(F.sum(F.col("_sign") * F.col(f"_f{c}")) / F.count_if(F.col("_sign") > 0)).alias(f"_f{c}") for c in range(len(found))])
    each = sums.select("_key", "_j", F.posexplode(F.array(*[f"_f{c}" for c in range(len(found))])).alias("_class", "_f"))
    explained = each.groupBy("_key", "_class").agg(
        F.max(F.when(F.col("_j") < 0, F.col("_f"))).alias("base_value"),
        F.map_from_entries(F.collect_list(F.when(F.col("_j") >= 0, F.struct("_j", "_f")))).alias("_impacts"),
    )
    impacts = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda j: F.struct(F.get(names, j).alias("feature"), F.element_at("_impacts", j).alias("impact"), F.get("_x", j).alias("value")),
    )
    explained = explained.join(keyed.dropDuplicates(["_key"]), "_key").withColumn("impacts", impacts)
    return explained.select(*_key_and_class(model, key, per_class), "base_value", "impacts")


def _key_and_class(model, key: str, per_class: bool) -> list[Column]:
    out, labels = [F.col("_key").alias(key)], getattr(model, "labels", None)
    if per_class:
        index = F.col("_class")
        if labels is not None:
            index = F.get(F.array(*[F.lit(v) for v in labels]).cast(f"array<{model.label_type}>"), index)
        out.append(index.alias("class"))
    return out


def _walkable(model, features: list[str]) -> bool:
    """Whether the output is a sum over trees: a tree or forest fitted on these very features."""
    kinds = C.DecisionTreeClassificationModel, C.RandomForestClassificationModel, R.DecisionTreeRegressionModel, R.RandomForestRegressionModel, ForestModel
    return sorted(getattr(model, "features", [])) == sorted(features) and isinstance(model.pipeline.stages[-1], kinds)


def _walked(model, started: DataFrame, points: np.ndarray, features: list[str], key: str, per_class: bool) -> DataFrame:
    """The explanations by walks ``(_key, _x, _s, _order)``, which come key by key in each partition."""
    from tidemill.operators.tree_shap import node_arrays, output_nodes

    nodes, weight, values = output_nodes(started.sparkSession, model.pipeline.stages[-1])
    place, trees = np.array([features.index(c) for c in model.features]), []
    for tree, node in sorted(node_arrays(nodes).items()):
        value = values(node) * weight(tree)
        value = value[:, : len(model.labels)] if model.labels is not None else value
        feature = place[np.maximum(node["feature"], 0)]
        trees.append((feature, node["bound"], node["left"], node["right"], value if per_class else value[:, -1:]))
    shared = started.sparkSession.sparkContext.broadcast((trees, points))
    kind = started.schema["_key"].dataType.simpleString()
    found = started.mapInArrow(
        lambda batches: _walk_sums(shared, batches), f"_key {kind}, _x array<double>, _base array<double>, _impacts array<array<double>>"
    )
    found = found.select("*", F.posexplode("_impacts").alias("_class", "_own"))
    names = F.array(*[F.lit(c) for c in features])
    impacts = F.arrays_zip(names.alias("feature"), F.col("_own").alias("impact"), F.col("_x").alias("value"))
    return found.select(
        *_key_and_class(model, key, per_class),
        F.get("_base", F.col("_class")).alias("base_value"),
        impacts.cast("array<struct<feature: string, impact: double, value: double>>").alias("impacts"),
    )


def _walk_sums(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each key the means over its walks of the first output and of the changes by each feature, class by class."""
    trees, points = shared.value
    held = None  # key, row, walks, sums of the first outputs and of the changes: the last key may go on in the next batch

    def row(key: pa.Array, x: np.ndarray, walks: int, base: np.ndarray, impacts: np.ndarray) -> pa.RecordBatch:
        lists = [pa.array([v], pa.list_(pa.float64())) for v in (x, base / walks)]
        nested = pa.array([list(impacts / walks)], pa.list_(pa.list_(pa.float64())))
        return pa.RecordBatch.from_arrays([key, *lists, nested], ["_key", "_x", "_base", "_impacts"])

    for batch in batches:
        for start in range(0, batch.num_rows, _WALKS):
            part = batch.slice(start, _WALKS)
            keys, size = part.column(0), points.shape[1]
            x, order = (part.column(i).flatten().to_numpy().reshape(len(keys), size) for i in (1, 3))
            first = np.ones(len(keys), bool)
            first[1:] = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            begins, group = np.flatnonzero(first), np.cumsum(first) - 1
            base, impacts = _walk_changes(trees, x, points[part.column(2).to_numpy() % len(points)], order, group)
            walks = np.bincount(group)
            for g, at in enumerate(begins):
                own = keys.slice(at, 1)
                if held and own.equals(held[0]):
                    held = (*held[:2], held[2] + walks[g], held[3] + base[g], held[4] + impacts[g])
                    continue
                if held:
                    yield row(*held)
                held = own, x[at], walks[g], base[g], impacts[g]
    if held:
        yield row(*held)


def _walk_changes(trees: list, x: np.ndarray, b: np.ndarray, order: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by group of the output at the background rows ``b``, and of what each feature changes on the way to ``x``."""
    size, classes = x.shape[1], trees[0][4].shape[1]
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(1, size + 1, dtype=order.dtype)[None], axis=1)
    base, impacts = np.zeros((group[-1] + 1, classes)), np.zeros((group[-1] + 1, classes, size))
    for feature, bound, left, right, value in trees:
        # steps low to high - 1 of a walk are at a node; a feature has moved from its step on
        walk, low, high, node = np.arange(len(x)), np.zeros(len(x), int), np.full(len(x), size + 1), np.zeros(len(x), int)
        ended = []
        while len(walk):
            done = left[node] < 0
            ended.append((walk[done], low[done], node[done]))
            walk, low, high, node = (v[~done] for v in (walk, low, high, node))
            f = feature[node]
            before = np.where(b[walk, f] <= bound[node], left[node], right[node])
            after = np.where(x[walk, f] <= bound[node], left[node], right[node])
            moved = np.where(before == after, high, np.clip(rank[walk, f], low, high))
            early, late = moved > low, moved < high
            walk, low, high, node = (
                np.concatenate((p[early], q[late]))
                for p, q in ((walk, walk), (low, moved), (moved, high), (before, after))
            )
        walk, low, node = (np.concatenate(v) for v in zip(*ended))
        by_step = np.lexsort((low, walk))
        walk, low, out = walk[by_step], low[by_step], value[node[by_step]]
        np.add.at(base, group[walk[low == 0]], out[low == 0])
        at = np.flatnonzero(low > 0)
        change, by = out[at] - out[at - 1], order[walk[at], low[at] - 1]
        for c in range(classes):
            np.add.at(impacts, (group[walk[at]], c, by), change[:, c])
    return base, impacts


def _classes(model) -> int:
    return model.stages[-1].numClasses if hasattr(model, "stages") else model.numClasses


def _probabilities(model, df: DataFrame) -> Column:
    labels = getattr(model, "labels", None)
    if labels is not None:
        return class_probabilities(model.pipeline.stages[-1], len(labels))
    return vector_to_array("probability")


def _model_output(model, df: DataFrame) -> Column:
    """Probability of the last class for a classifier, the prediction of a regressor."""
    if getattr(model, "labels", None) is not None or "probability" in df.columns:
        return F.element_at(_probabilities(model, df), -1)
    return F.col("prediction").cast("double")


def top_impacts(explained: DataFrame, max_display: int = MAX_DISPLAY) -> DataFrame:
    """Order every row's impacts by size and keep the first ones; 0 keeps all. Ties go to the smaller name."""
    ranked = F.transform(
        F.array_sort(
            F.transform(
                F.col("impacts"),
                lambda e: F.struct((-F.abs(e["impact"])).alias("rank"), e["feature"].alias("feature"), e.alias("entry")),
            )
        ),
        lambda e: e["entry"],
    )
    return explained.withColumn("impacts", F.slice(ranked, 1, max_display) if max_display > 0 else ranked)


def global_importance(explained: DataFrame) -> DataFrame:
    """``(feature, importance)``: mean absolute impact, largest first.

    With a row per sample and class the mean runs over the classes too.
    """
    return (
        explained.select(F.inline("impacts"))
        .groupBy("feature")
        .agg(F.avg(F.abs("impact")).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
    )
