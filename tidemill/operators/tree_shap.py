"""Exact feature impacts of tree models: one pass over the rows, a sum over the leaves of the model.

The impact of a feature is its Shapley value in the game that takes some features from the row and the others from a
background row, averaged over the whole background. A leaf asks each feature on its path for an interval. A feature
whose interval both rows meet plays no part, one that neither meets closes the leaf; so the leaf is reached if the
features that only the row meets come from the row and those that only the background row meets do not. With u and w
such features the first ones get ``1 / (u C(u + w, u))`` of the leaf's value each, the others lose
``1 / (w C(u + w, u))``. Background rows that meet the same intervals of a leaf count together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.ml import classification as C
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows, spread, value_of
from tidemill.functions.lineage import scratch_path
from tidemill.operators.boosting import SoftmaxBoostedModel
from tidemill.operators.models import AdaBoostModel, ForestModel, Trained

LEAVES = "tree int, leaf int, features array<int>, low array<double>, high array<double>, value array<double>"
# Rows and (row, pattern) pairs that a task works on at once.
_ROWS, _PAIRS = 1024, 1 << 22
# Leaves of a tree that are held against rows and background at once; a tree with more is walked down instead.
_LEAVES_AT_ONCE = 256
# Places where pairs of a row and a background row part, that a task holds at once, times outputs.
_FORKS = 1 << 20
_NODES = "tree", "id", "prediction", "impurityStats", "leftChild", "rightChild", "split"


def is_tree_model(model) -> bool:
    """Whether ``tree_leaves`` reads the fitted model."""
    if isinstance(model, SoftmaxBoostedModel):
        return True
    if isinstance(model, AdaBoostModel):
        return all(is_tree_model(m) for m in model.models)
    return isinstance(model, ForestModel) or hasattr(model, "treeWeights") or hasattr(model, "numNodes")


def _nodes(spark: SparkSession, model) -> tuple[DataFrame, dict[int, float]]:
    """One row for each node of every tree, as the model itself stores them, and the weights of the trees."""
    if isinstance(model, ForestModel):
        first, found, weights = 0, [], {}
        for part in model.models:
            nodes, own = _nodes(spark, part)
            found.append(nodes.withColumn("tree", F.col("tree") + first))
            weights |= {first + tree: weight for tree, weight in own.items()}
            first += len(own)
        return reduce(DataFrame.union, found), weights
    path = scratch_path(spark, "tree-model")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" not in data.columns:
        return data.withColumn("tree", F.lit(0)).select(*_NODES), {0: 1.0}
    # number, description and weight of each tree; the names of these columns differ between versions
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{path}/treesMetadata").collect()}
    return data.select(F.col("treeID").alias("tree"), "nodeData.*").select(*_NODES), weights


def node_arrays(nodes: DataFrame) -> dict[int, dict[str, np.ndarray]]:
    """For each tree its nodes as arrays in the order of their numbers; ``left`` is negative at a leaf."""
    split = F.col("split")
    held = nodes.select(
        "tree",
        "id",
        "prediction",
        "impurityStats",
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        split["featureIndex"].alias("feature"),
        F.coalesce(F.get(split["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)).alias("bound"),
        split["numCategories"].alias("categories"),
    ).toArrow()
    columns = {c: held.column(c).combine_chunks() for c in held.column_names}
    stats = columns.pop("impurityStats")
    columns = {c: v.to_numpy(zero_copy_only=False) for c, v in columns.items()}
    columns["stats"] = stats.flatten().to_numpy(zero_copy_only=False).reshape(len(stats), -1) if len(stats) else np.empty((0, 0))
    if (columns["categories"][columns["left"] >= 0] >= 0).any():
        raise ValueError("a split by categories has no interval")
    out = {}
    for tree in np.unique(columns["tree"]).tolist():
        own = np.flatnonzero(columns["tree"] == tree)
        own = own[np.argsort(columns["id"][own])]
        out[tree] = {c: v[own] for c, v in columns.items()}
        # children by place, in case numbers have gaps
        for c in ("left", "right"):
            out[tree][c] = np.where(out[tree][c] < 0, -1, np.searchsorted(out[tree]["id"], out[tree][c]))
    return out


def _leaf_rows(trees: dict[int, dict[str, np.ndarray]], weight, values) -> Iterator[tuple]:
    """Leaves with the interval, open below and closed above, that each feature of their path must be in."""
    for tree, node in sorted(trees.items()):
        value = values(node) * weight(tree)
        # a node is stored before its children, and nobody's child is the root
        waiting = [(0, {})]
        while waiting:
            at, path = waiting.pop()
            if node["left"][at] < 0:
                order = sorted(path)
                low, high = ([path[f][i] for f in order] for i in (0, 1))
                yield tree, int(node["id"][at]), order, low, high, value[at].tolist()
                continue
            feature, bound = int(node["feature"][at]), float(node["bound"][at])
            low, high = path.get(feature, (-math.inf, math.inf))
            waiting.append((int(node["left"][at]), path | {feature: (low, min(high, bound))}))
            waiting.append((int(node["right"][at]), path | {feature: (max(low, bound), high)}))


def tree_leaves(spark: SparkSession, model) -> DataFrame:
    """The leaves of a fitted tree model: ``tree, leaf, features, low, high, value``.

    A row reaches a leaf if ``low < x <= high`` for each of ``features`` (numbers of the columns); the values of the
    leaves it reaches add up to the model's output. That is the prediction of a regressor, the probability of each class
    of a tree or forest, the share of votes for each class of weighted trees, of a boosted classifier the margin of its
    second class, and of boosting over several classes the score of each. As large as the model, which the driver has.
    """
    return local_rows(spark, _all_leaves(spark, model), LEAVES)


def output_nodes(spark: SparkSession, model) -> tuple[DataFrame, object, object]:
    """The nodes of a fitted tree, forest or boosted model, the weight of each tree and the outputs of its nodes."""
    nodes, weights = _nodes(spark, model)
    shares = isinstance(model, (C.DecisionTreeClassificationModel, C.RandomForestClassificationModel))
    shares = shares or isinstance(model, ForestModel) and model.classes > 0
    boosted = isinstance(model, C.GBTClassificationModel) or type(model).__name__ == "GBTRegressionModel"
    count = 1 if boosted else len(weights)

    def values(node) -> np.ndarray:
        if not shares:
            return node["prediction"][:, None]
        return node["stats"] / node["stats"].sum(axis=1, keepdims=True)

    # Trees of a forest weigh alike, those of a boosted model as it says.
    return nodes, (lambda tree: weights[tree]) if boosted else (lambda tree: 1.0 / count), values


def _all_leaves(spark: SparkSession, model) -> Iterator[tuple]:
    """The rows of ``tree_leaves``, tree by tree."""
    if isinstance(model, SoftmaxBoostedModel):
        yield from _softmax_leaves(model)
    elif isinstance(model, AdaBoostModel):
        total = sum(model.weights) or 1.0
        for i, (one, weight) in enumerate(zip(model.models, model.weights, strict=True)):
            nodes, _ = _nodes(spark, one)
            votes = lambda n: (n["prediction"][:, None] == np.arange(model.classes)).astype(float)
            for row in _leaf_rows(node_arrays(nodes), lambda _, w=weight: w / total, votes):
                yield i, *row[1:]
    else:
        nodes, weight, values = output_nodes(spark, model)
        yield from _leaf_rows(node_arrays(nodes), weight, values)


def _softmax_leaves(model: SoftmaxBoostedModel) -> Iterator[tuple]:
    """The scores that all rows start with, as a tree of one leaf, and the leaves of the trees of each class."""
    yield 0, 0, [], [], [], list(map(float, model.start))
    number = 0
    for trees in model.rounds:
        for c, tree in enumerate(trees):
            number += 1
            waiting = [(0, {})]
            while waiting:
                at, path = waiting.pop()
                if tree.left[at] == at:
                    order = sorted(path)
                    value = [0.0] * len(model.start)
                    value[c] = float(tree.value[at])
                    yield number, at, order, *([path[f][i] for f in order] for i in (0, 1)), value
                    continue
                feature, bound = int(tree.feature[at]), float(tree.threshold[at])
                low, high = path.get(feature, (-math.inf, math.inf))
                waiting.append((int(tree.left[at]), path | {feature: (low, min(high, bound))}))
                waiting.append((int(tree.right[at]), path | {feature: (max(low, bound), high)}))


@dataclass(frozen=True)
class _Leaves:
    """Some leaves of one tree as it is sent to the tasks: ``sizes`` entries of feature and interval each, and values."""

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sizes: np.ndarray
    value: np.ndarray

    @staticmethod
    def parts(rows: Iterator[tuple], last_only: bool) -> Iterator[_Leaves]:
        """The leaves of each tree, a bounded number at a time."""
        for _, tree in groupby(rows, key=lambda r: r[0]):
            while some := list(islice(tree, _LEAVES_AT_ONCE)):
                flat = [np.array([v for r in some for v in r[i]], kind) for i, kind in ((2, np.int32), (3, float), (4, float))]
                value = np.array([r[5][-1:] if last_only else r[5] for r in some])
                yield _Leaves(*flat, np.array([len(r[2]) for r in some]), value)


@dataclass(frozen=True)
class _Tree:
    """Some leaves of one tree laid end to end, and the patterns in which background rows meet their intervals.

    ``feature, low, high, bit``: an entry for each leaf and feature of its path, ``start`` where a leaf's entries begin.
    ``leaf, mask, share``: an entry for each pattern. ``full``: the pattern in which a leaf is reached.
    """

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    bit: np.ndarray
    start: np.ndarray
    full: np.ndarray
    value: np.ndarray
    leaf: np.ndarray
    mask: np.ndarray
    share: np.ndarray

    @staticmethod
    def of(leaves: _Leaves, background: np.ndarray) -> _Tree:
        sizes = leaves.sizes
        start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        bit = np.arange(len(leaves.feature)) - np.repeat(start, sizes)
        full = (np.int64(1) << sizes.astype(np.int64)) - 1
        empty = np.empty(0, np.int64)
        tree = _Tree(leaves.feature, leaves.low, leaves.high, bit.astype(np.int64), start, full, leaves.value, empty, empty, empty)
        met = tree.masks(background)
        leaf, mask, share = [], [], []
        for i in range(len(sizes)):
            found, counts = np.unique(met[:, i], return_counts=True)
            leaf.append(np.full(len(found), i, np.int16))
            mask.append(found.astype(np.min_scalar_type(-int(full[i]) - 1)))
            share.append((counts / len(background)).astype(np.float64))
        parts = {"leaf": np.concatenate(leaf), "mask": np.concatenate(mask), "share": np.concatenate(share)}
        return _Tree(**{**tree.__dict__, **parts})

    def masks(self, rows: np.ndarray) -> np.ndarray:
        """For each row and leaf which intervals the row meets, as bits."""
        if not len(self.feature):
            return np.zeros((len(rows), len(self.full)), np.int64)
        x = rows[:, self.feature]
        met = ((x > self.low) & (x <= self.high)).astype(np.int64) << self.bit
        # a tree that is one leaf has no entries; no other leaf has none
        return np.add.reduceat(met, self.start, axis=1)

    def base(self) -> np.ndarray:
        reached = self.mask == self.full[self.leaf]
        return (self.share[reached, None] * self.value[self.leaf[reached]]).sum(axis=0)

    def add(self, rows: np.ndarray, impacts: np.ndarray) -> None:
        """Adds the impacts (class, row, feature) of the rows."""
        # the patterns of the rows and the full ones are as wide as those of the background
        own, full = self.masks(rows).astype(self.mask.dtype), self.full.astype(self.mask.dtype)
        step = max(1, _PAIRS // max(1, len(rows)))
        for begin in range(0, len(self.leaf), step):
            some = slice(begin, begin + step)
            leaf, other = self.leaf[some], self.mask[some]
            row, at = np.nonzero((own[:, leaf] | other) == full[leaf])
            leaf, other, share = leaf[at], other[at], self.share[some][at]
            mine = own[row, leaf]
            only, lacks = mine & ~other, other & ~mine
            u, w = np.bitwise_count(only).astype(np.int64), np.bitwise_count(lacks).astype(np.int64)
            split = share / _BINOMIAL[u + w, u]
            gain, loss = split / np.maximum(u, 1), -split / np.maximum(w, 1)
            for bits, part in ((only, gain), (lacks, loss)):
                left = np.flatnonzero(bits)
                while len(left):
                    lowest = bits[left] & -bits[left]
                    place = np.bitwise_count(lowest - 1).astype(np.int64)
                    feature = self.feature[self.start[leaf[left]] + place]
                    where = row[left] * impacts.shape[2] + feature
                    # a leaf that has grown to the end counts for one class
                    for c in range(len(impacts)):
                        value = self.value[leaf[left], c]
                        met = np.flatnonzero(value)
                        np.add.at(impacts[c].reshape(-1), where[met], part[left[met]] * value[met])
                    bits = bits & (bits - 1)
                    left = left[bits[left] != 0]


@dataclass(frozen=True)
class _Walked:
    """A tree of many leaves, which each pair of a row and a background row walks down together.

    ``bit``: of the feature of a node among the features on its path. Where both rows of a pair go to the same side, so
    do they together. Where they part, one walk goes on with the feature taken from the row, one with it taken from the
    background row, and later splits by the feature go by that row. So a pair meets only leaves that it reaches, and the
    feature of a fork is credited with what the leaves below it gain and lose.
    """

    feature: np.ndarray
    bound: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bit: np.ndarray

    @staticmethod
    def of(node: dict[str, np.ndarray], value: np.ndarray) -> _Walked:
        left, right, feature = (node[c].astype(np.int32) for c in ("left", "right", "feature"))
        bit = np.zeros(len(left), np.uint64)
        # for each node of a level the features on its path, as far as they fit the longest one
        at, paths = np.zeros(1, np.int64), np.empty((1, 0), np.int32)
        while len(at):
            inner = left[at] >= 0
            at, paths = at[inner], paths[inner]
            own = feature[at]
            known = paths == own[:, None]
            free = (paths >= 0).sum(axis=1)
            place = np.where(known.any(axis=1), known.argmax(axis=1) if paths.shape[1] else 0, free)
            bit[at] = np.uint64(1) << place.astype(np.uint64)
            if len(at) and place.max() == paths.shape[1]:
                paths = np.concatenate((paths, np.full((len(at), 1), -1, np.int32)), axis=1)
            paths[np.arange(len(at)), place] = own
            at, paths = np.concatenate((left[at], right[at])), np.concatenate((paths, paths))
        return _Walked(np.maximum(feature, 0), node["bound"], left, right, value, bit)

    def base(self, background: np.ndarray) -> np.ndarray:
        at = np.zeros(len(background), np.int64)
        rows = np.arange(len(at))
        while len(rows := rows[self.left[at[rows]] >= 0]):
            own = at[rows]
            at[rows] = np.where(background[rows, self.feature[own]] <= self.bound[own], self.left[own], self.right[own])
        return self.value[at].mean(axis=0)

    def add(self, rows: np.ndarray, background: np.ndarray, impacts: np.ndarray) -> None:
        """Adds the impacts (class, row, feature) of the rows."""
        most, pairs, begin, step = max(1, _FORKS // len(impacts)), len(rows) * len(background), 0, 64
        while begin < pairs:
            row, other = np.divmod(np.arange(begin, min(pairs, begin + step)), len(background))
            begin += len(row)
            forks = self._walk(rows, background, row, other, impacts)
            # as many pairs as the last ones let expect
            step = int(min(4 * step, max(1, most * len(row) // max(1, forks))))

    def _walk(self, rows: np.ndarray, background: np.ndarray, row: np.ndarray, other: np.ndarray, impacts: np.ndarray) -> int:
        """The impacts of some pairs; the number of their forks."""
        classes, _, size = impacts.shape
        x, z = np.ascontiguousarray(rows).ravel(), np.ascontiguousarray(background).ravel()
        row, other = row * size, other * size
        node, end = np.zeros(len(row), np.int32), np.full(len(row), -1)
        mine, theirs = (np.zeros(len(row), np.uint64) for _ in range(2))
        # of a fork: the end of the walk it is on, and the place of its impact; of a level of forks: the first one
        above, credited, firsts, count = [], [], [], 0
        leaves = []
        while len(node):
            done = self.left[node] < 0
            if done.any():
                leaf = np.flatnonzero(done & (end >= 0))
                leaves.append((end[leaf], node[leaf], np.bitwise_count(mine[leaf]), np.bitwise_count(theirs[leaf])))
                on = np.flatnonzero(~done)
                node, end, row, other, mine, theirs = (v[on] for v in (node, end, row, other, mine, theirs))
            feature, bound, bit = self.feature[node], self.bound[node], self.bit[node]
            by_x, by_z = x.take(row + feature) <= bound, z.take(other + feature) <= bound
            taken = (theirs & bit) != 0
            fork = np.flatnonzero((by_x != by_z) & ~taken & ((mine & bit) == 0))
            left, right = self.left[node], self.right[node]
            node = np.where(np.where(taken, by_z, by_x), left, right)
            number = count + np.arange(len(fork))
            firsts.append(count)
            count += len(fork)
            above.append(end[fork])
            credited.append(row[fork] + feature[fork])
            beyond = np.where(by_z[fork], left[fork], right[fork])
            theirs_too, own = theirs[fork] | bit[fork], mine[fork]
            mine[fork] |= bit[fork]
            end[fork] = 2 * number
            pairs = (node, beyond), (end, 2 * number + 1), (row, row[fork]), (other, other[fork]), (mine, own), (theirs, theirs_too)
            node, end, row, other, mine, theirs = (np.concatenate(p) for p in pairs)
        if not count:
            return 0
        # what the features of the row gain and those of the background row lose below each end of a fork
        sums = np.empty((2 * count, 2 * classes))
        at, leaf, u, w = (np.concatenate(c) for c in zip(*leaves))
        u, w = u.astype(np.int64), w.astype(np.int64)
        split = 1 / (len(background) * _BINOMIAL[u + w, u])
        value = self.value[leaf]
        sums[at, :classes] = value * (split / np.maximum(u, 1))[:, None]
        sums[at, classes:] = value * (-split / np.maximum(w, 1))[:, None]
        for up, first in zip(above[::-1], firsts[::-1]):
            both = sums[2 * first : 2 * (first + len(up))]
            held = up >= 0
            sums[up[held]] = (both[::2] + both[1::2])[held]
        place = np.concatenate(credited)
        gained = sums[::2, :classes] + sums[1::2, classes:]
        for c in range(classes):
            impacts[c].reshape(-1)[:] += np.bincount(place, gained[:, c], impacts[c].size)
        return count


def _parts(spark: SparkSession, model, last_only: bool) -> list[_Leaves | _Walked]:
    """The model as it is sent to the tasks: trees of many leaves to be walked, the leaves of others a bounded number at a time."""
    if isinstance(model, (SoftmaxBoostedModel, AdaBoostModel)):
        return list(_Leaves.parts(_all_leaves(spark, model), last_only))
    nodes, weight, values = output_nodes(spark, model)
    trees, walked = node_arrays(nodes), []
    for tree in [t for t, node in trees.items() if np.count_nonzero(node["left"] < 0) > _LEAVES_AT_ONCE]:
        node = trees.pop(tree)
        value = values(node) * weight(tree)
        walked.append(_Walked.of(node, value[:, -1:] if last_only else value))
    return walked + list(_Leaves.parts(_leaf_rows(trees, weight, values), last_only))


_BINOMIAL = np.array([[float(math.comb(n, k)) for k in range(64)] for n in range(64)])


def _explained(shared, features: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batch and, for each of its rows, the impacts of all features, class by class."""
    leaves, background, classes = shared.value
    trees = None
    for batch in batches:
        trees = trees or [some if isinstance(some, _Walked) else _Tree.of(some, background) for some in leaves]
        for begin in range(0, batch.num_rows, _ROWS):
            part = batch.slice(begin, _ROWS)
            rows = part.column(1).flatten().to_numpy().reshape(part.num_rows, features)
            impacts = np.zeros((classes, len(rows), features))
            for tree in trees:
                if isinstance(tree, _Walked):
                    tree.add(rows, background, impacts)
                else:
                    tree.add(rows, impacts)
            flat = pa.array(np.moveaxis(impacts, 0, 1).reshape(-1))
            inner = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, features), pa.int32()), flat)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(inner) + 1, classes), pa.int32()), inner)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], ["_key", "_x", "_impacts"])


def tree_shap(
    model: Trained, df: DataFrame, key: str, background: DataFrame, per_class: bool = False
) -> DataFrame:
    """``(key, base_value, impacts array<{feature, impact, value}>)`` of a fitted tree model, exactly.

    Explains the output that ``tree_leaves`` names: of classes the last one, or with ``per_class`` each one in a row of
    its own, with the class in column ``class``. Base value and impacts add up to the output. A missing feature counts as
    its mean over the background; an empty background is an error. The background and the leaves reach every task, once;
    rows are not copied, and shuffled only if they are in fewer partitions than there are cores; repeated keys give
    repeated rows.
    """
    spark, features = df.sparkSession, model.features
    held = background.select(*[value_of(background, c).cast("double").alias(c) for c in features]).toPandas()
    if held.empty:
        raise ValueError("the background is empty")
    means = held.mean().fillna(0.0)
    points = held.fillna(means).to_numpy(float)
    leaves = _parts(spark, model.pipeline.stages[-1], not per_class)
    # the patterns of the background are many times the leaves: here only those of a few leaves at a time
    base = np.sum([some.base(points) if isinstance(some, _Walked) else _Tree.of(some, points).base() for some in leaves], axis=0)
    shared = spark.sparkContext.broadcast((leaves, points, len(base)))
    own = F.array(*[F.coalesce(value_of(df, c).cast("double"), F.lit(float(means[c]))) for c in features])
    rows = spread(df.select(F.col(key).alias("_key"), own.alias("_x")))
    key_type = df.schema[key].dataType.simpleString()
    found = rows.mapInArrow(
        lambda batches: _explained(shared, len(features), batches),
        f"_key {key_type}, _x array<double>, _impacts array<array<double>>",
    )
    bases = F.array(*[F.lit(float(b)) for b in base])
    names = F.array(*[F.lit(c) for c in features])
    found = found.select("*", F.posexplode("_impacts").alias("_class", "_own"))
    impacts = F.arrays_zip(names.alias("feature"), F.col("_own").alias("impact"), F.col("_x").alias("value"))
    shape = "array<struct<feature: string, impact: double, value: double>>"
    out = [F.col("_key").alias(key)]
    if per_class:
        labels = model.labels if model.labels is not None and len(model.labels) == len(base) else None
        index = F.col("_class")
        out.append((index if labels is None else F.get(F.array(*[F.lit(v) for v in labels]).cast(f"array<{model.label_type}>"), index)).alias("class"))
    return found.select(*out, F.get(bases, F.col("_class")).alias("base_value"), impacts.cast(shape).alias("impacts"))
