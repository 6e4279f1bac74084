"""Gradient boosting over several classes: one small tree for each class and round, on the residuals of the softmax.

A round fits a regression tree to what each class lacks of its probability, and replaces the mean of each leaf by a
Newton step. Rows become bins once, in blocks that carry their scores along; the trees of a round are grown side by side,
a level of all of them in one pass, by sums over the bins. The blocks are written to the shared folder every few rounds.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.lineage import cut, scratch_path
from tidemill.operators.growing import bounds_of, place, to_bins

# Rounds between two checkpoints, and bins of a feature.
ROUNDS_PER_CUT, BINS = 10, 32
# Values and rows of a block, blocks of a task, and sums of one pass that a task sends to the driver.
_BLOCK_VALUES, _BLOCK_ROWS, _BLOCKS, _SUMS = 1 << 18, 1 << 12, 128, 1 << 18
# What rounding may make of no gain, as a part of what it is the difference of.
_LEAST_GAIN = 1e-13
# A leaf with less weight than this takes no step.
_LEAST_WEIGHT = 1e-12


@dataclass(frozen=True)
class Tree:
    """Nodes of a tree in order; a leaf has itself as children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            to = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            if np.array_equal(to, at):
                return self.value[at]
            at = to

    def lists(self) -> dict:
        return {name: getattr(self, name).tolist() for name in ("feature", "threshold", "left", "right", "value")}

    @staticmethod
    def of(lists: dict) -> Tree:
        whole = {n: np.array(lists[n], np.int64) for n in ("feature", "left", "right")}
        return Tree(threshold=np.array(lists["threshold"], float), value=np.array(lists["value"], float), **whole)


_STATE = "bins binary, labels binary, scores binary, lacking binary"


class _Growing:
    """A tree of a round on bins, level by level; ``up`` and ``down`` are the sums of the Newton step of each node."""

    def __init__(self):
        self.feature, self.cut, self.left, self.up, self.down = [0], [0], [-1], [0.0], [0.0]
        self.open, self.weights = [0], {}

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.cut), np.array(self.left)

    def split(self, at: int, sums: np.ndarray, deeper: bool) -> list[int]:
        """Splits a node, if trees are ``deeper``, by the sums ``(count, up, down)`` of feature and bin; the children, or none."""
        left = sums.cumsum(axis=2)
        total = left[:, :1, -1:]
        right = total - left
        self.up[at], self.down[at] = total[1, 0, 0], total[2, 0, 0]
        with np.errstate(all="ignore"):
            parts = left[1] ** 2 / left[0] + right[1] ** 2 / right[0]
            gain = parts - total[1] ** 2 / total[0]
        gain[(left[0] < 1) | (right[0] < 1)] = -np.inf
        best = int(gain.argmax())
        feature, cut_ = divmod(best, gain.shape[1])
        if not deeper or not gain.flat[best] > _LEAST_GAIN * parts.flat[best]:
            return []
        first = len(self.left)
        self.feature[at], self.cut[at], self.left[at] = feature, cut_, first
        self.weights[feature] = self.weights.get(feature, 0.0) + gain.flat[best]
        for side in (left, right):
            for column, value in ((self.feature, 0), (self.cut, 0), (self.left, -1), (self.up, side[1, feature, cut_]), (self.down, side[2, feature, cut_])):
                column.append(value)
        return [first, first + 1]

    def values(self, factor: float) -> np.ndarray:
        up, down = np.array(self.up), np.array(self.down)
        ends = (np.array(self.left) < 0) & (down > _LEAST_WEIGHT)
        return np.where(ends, factor * up / np.where(ends, down, 1.0), 0.0)

    def tree(self, bounds: list[np.ndarray], factor: float) -> Tree:
        feature, cut_, left = self.arrays()
        own, inner = np.arange(len(left)), left >= 0
        threshold = np.array([bounds[f][c] if i else math.inf for f, c, i in zip(feature, cut_, inner)])
        return Tree(feature, threshold, np.where(inner, left, own), np.where(inner, left + 1, own), self.values(factor))

    def importances(self, features: int) -> np.ndarray:
        out = np.zeros(features)
        out[list(self.weights)] = list(self.weights.values())
        return out / (out.sum() or 1.0)


def softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    powers = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, v: a + v)
    return F.transform(powers, lambda v: v / total)


class SoftmaxBoostedModel(Transformer):
    """``rawPrediction`` are the scores of the classes, ``probability`` their softmax, ``prediction`` the likeliest class."""

    def __init__(
        self, start: list[float] | None = None, rounds: list[list[Tree]] | None = None, features: str = "features", weights: list[float] | None = None
    ):
        super().__init__()
        self.start, self.rounds, self.features, self.weights = start or [], rounds or [], features, weights or []

    def to_json(self) -> str:
        rounds = [[t.lists() for t in trees] for trees in self.rounds]
        return json.dumps({"start": self.start, "rounds": rounds, "features": self.features, "weights": self.weights})

    @staticmethod
    def from_json(text: str) -> SoftmaxBoostedModel:
        held = json.loads(text)
        rounds = [[Tree.of(t) for t in trees] for trees in held["rounds"]]
        return SoftmaxBoostedModel(held["start"], rounds, held["features"], held["weights"])

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast((np.array(self.start), self.rounds))

        @F.pandas_udf("array<double>")
        def scores(vectors: pd.Series) -> pd.Series:
            start, rounds = shared.value
            out = np.tile(start, (len(vectors), 1))
            if len(vectors):
                x = np.stack(vectors.to_numpy())
                for trees in rounds:
                    for c, tree in enumerate(trees):
                        out[:, c] += tree.score(x)
            return pd.Series(list(out))

        raw = df.withColumn("_scores", scores(vector_to_array(self.features)))
        raw = raw.withColumn("_chances", softmax(F.col("_scores")))
        first = F.array_position("_chances", F.array_max("_chances")) - 1
        return raw.withColumns(
            {"rawPrediction": array_to_vector("_scores"), "probability": array_to_vector("_chances"), "prediction": first.cast("double")}
        ).drop("_scores", "_chances")


def fit_softmax_boosting(
    prepared: DataFrame,
    features: str,
    label: str,
    classes: int,
    n_estimators: int = 100,
    learning_rate: float = 0.1,
    max_depth: int = 3,
    random_state: int = 42,
    losses: list[float] | None = None,
) -> SoftmaxBoostedModel:
    """Fit on a vector column and class indexes 0, 1, ...; ``losses`` gets the mean log-loss before every round.

    Scores start at the logarithms of the class shares. Every leaf steps by ``(K - 1) / K`` times the sum of its
    residuals over the sum of ``|r| (1 - |r|)``, times the learning rate. A split is the best of variance among quantiles of
    a sample. What reaches the driver is the sample, the trees, and from each task the sums of a bounded number of nodes.
    """
    spark = prepared.sparkSession
    shares = prepared.groupBy(label).count().collect()
    rows = sum(r["count"] for r in shares)
    start = [math.log(1e-12)] * classes
    for r in shares:
        start[int(r[label])] = math.log(r["count"] / rows)
    plain = prepared.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"))
    size = plain.select(F.size("x")).first()[0]
    bounds = bounds_of(plain, rows, size, min(BINS, rows), random_state % (1 << 40))
    path = scratch_path(spark, "boosted")
    plain.mapInArrow(partial(_binned, bounds), _STATE).write.parquet(path)
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows // (_BLOCKS * _block_rows(size))))
    data = spark.read.schema(_STATE).parquet(path).repartition(tasks)
    factor = learning_rate * (classes - 1) / classes
    rounds: list[list[Tree]] = []
    weights: list[np.ndarray] = []
    last: list[tuple] = []  # the trees of the last round on bins, with the values of their leaves
    held: list[DataFrame] = []  # what the present round was made from
    try:
        for number in range(n_estimators):
            step = data.mapInArrow(partial(_moved, np.array(start), last), _STATE).persist()
            trees = [_Growing() for _ in range(classes)]
            for depth in range(max(1, max_depth)):
                loss = _split_level(step, trees, size, depth < max_depth)
                if depth == 0 and losses is not None:
                    losses.append(loss / rows)
            for old in held:
                old.unpersist()
            held = [step]
            last = [(t.arrays(), t.values(factor)) for t in trees]
            rounds.append([t.tree(bounds, factor) for t in trees])
            weights += [t.importances(size) for t in trees]
            data = cut(step) if number % ROUNDS_PER_CUT == ROUNDS_PER_CUT - 1 else step
    finally:
        for old in held:
            old.unpersist()
    return SoftmaxBoostedModel(start, rounds, features, np.mean(weights, axis=0).tolist() if weights else [])


def _block_rows(features: int) -> int:
    return max(64, min(_BLOCK_ROWS, _BLOCK_VALUES // max(features, 1)))


def _binned(bounds: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows without scores yet."""
    most = _block_rows(len(bounds))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            labels = part.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
            yield _block(to_bins(x, bounds), labels, np.empty(0), np.empty(0))


def _block(*parts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["bins", "labels", "scores", "lacking"])


def _blocks(classes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for i in range(batch.num_rows):
            bins, labels, scores, lacking = (
                np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in enumerate((np.uint8, np.int32, float, float))
            )
            yield bins.reshape(len(labels), -1), labels, scores.reshape(-1, classes), lacking.reshape(-1, classes)


def _moved(start: np.ndarray, last: list[tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks with the scores after the last round, and what each class lacks."""
    for bins, labels, scores, _ in _blocks(len(start), batches):
        scores = scores.copy() if len(scores) else np.tile(start, (len(labels), 1))
        for c, (arrays, values) in enumerate(last):
            scores[:, c] += values[place(bins, *arrays)]
        chances = np.exp(scores - scores.max(axis=1, keepdims=True))
        lacking = -chances / chances.sum(axis=1, keepdims=True)
        lacking[np.arange(len(labels)), labels] += 1.0
        yield _block(bins, labels, scores, lacking)


def _split_level(step: DataFrame, trees: list[_Growing], features: int, deeper: bool) -> float:
    """Splits the open nodes of all trees, in one pass unless they are very many; the sum of the log-losses of the rows."""
    asked = [(c, node) for c, tree in enumerate(trees) for node in tree.open]
    size, loss, following = 3 * features * BINS, 0.0, [[] for _ in trees]
    at_once = max(1, _SUMS // size)
    for at in range(0, len(asked), at_once):
        some = asked[at : at + at_once]
        nodes = {c: [n for t, n in some if t == c] for c in sorted({c for c, _ in some})}
        arrays = {c: trees[c].arrays() for c in nodes}
        parts = step.mapInArrow(partial(_sums, arrays, nodes, features, len(trees)), "loss double, sums binary").collect()
        loss = math.fsum(r["loss"] for r in parts)
        sums = np.sum([np.frombuffer(r["sums"]) for r in parts], axis=0).reshape(len(some), 3, features, BINS)
        for (c, node), own in zip([(c, n) for c, many in nodes.items() for n in many], sums, strict=True):
            following[c] += trees[c].split(node, own, deeper)
    for tree, own in zip(trees, following, strict=True):
        tree.open = own
    return loss


def _sums(
    arrays: dict[int, tuple], nodes: dict[int, list[int]], features: int, classes: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Over all rows of a task, for each node, feature and bin: rows, what they lack, and the weight of their Newton step."""
    out = {c: np.zeros((len(own), 3, features * BINS)) for c, own in nodes.items()}
    loss, offsets = 0.0, np.arange(features) * BINS
    for bins, labels, _, lacking in _blocks(classes, batches):
        chance = 1.0 - lacking[np.arange(len(labels)), labels]
        loss -= np.log(np.maximum(chance, np.finfo(float).tiny)).sum()
        cells = bins + offsets
        for c, own in nodes.items():
            at, r = place(bins, *arrays[c]), lacking[:, c]
            newton = np.abs(r) * (1 - np.abs(r))
            for i, node in enumerate(own):
                some = slice(None) if len(arrays[c][2]) == 1 else np.flatnonzero(at == node)
                flat, up, down = cells[some].ravel(), r[some], newton[some]
                out[c][i, 0] += np.bincount(flat, minlength=features * BINS)
                for row, values in ((1, up), (2, down)):
                    out[c][i, row] += np.bincount(flat, np.repeat(values, features), features * BINS)
    whole = np.concatenate([out[c].ravel() for c in nodes]) if nodes else np.empty(0)
    yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([whole.tobytes()], pa.binary())], ["loss", "sums"])
