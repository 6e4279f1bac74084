"""Classification trees without a depth limit: large nodes by histograms, small ones whole.

Rows become bins once, in blocks. A node with more rows than a task should hold is split by histograms, which tasks sum up
for all trees at once, level by level. The rows of a smaller node come together in one task, which grows all that is below
it; nodes and trees are spread over the cores. What Spark ML does for each node (a table of counts of all bins and classes
from every partition) is done only where a node has many more rows than such a table has numbers.

Candidates and splits are those of Spark ML: quantiles of a sample, the first of the best gini gains, and splits below
which all predictions agree are taken back. Fitted trees are Spark ML's own models.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import classification as C
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows, spread
from tidemill.functions.lineage import scratch_path

# Spark ML grows trees of fewer rows, of another depth, and of more classes or features.
GROWN_ROWS, UNLIMITED, MOST_CLASSES, MOST_FEATURES = 1 << 13, 30, 256, 2048
# Rows of a node that one task takes: at most so many, and values; and no fewer for the sake of more tasks.
MOST_ROWS, MOST_VALUES, LEAST_ROWS = 1 << 17, 1 << 24, 1 << 12
# Rows of a block, numbers of the histograms of one pass, and rows that candidates are read off.
_BLOCK, _CELLS, _SAMPLE = 1 << 12, 1 << 23, 10_000
# What rounding may make of no gain.
_LEAST_GAIN = 1e-13
_STRATEGIES = ("auto", "sqrt", "log2", "onethird", "all")
_GROWN = "tree int, root int, local int, left int, feature int, bound double, gain double, stats array<double>"
_OPEN, _INNER, _LEAF, _GONE = range(4)


def suits(estimator, rows: int, features: int, classes: int) -> bool:
    """Whether ``grow`` fits what the estimator asks for: gini trees without a depth limit, on many rows."""
    forest = isinstance(estimator, C.RandomForestClassifier)
    if not forest and not isinstance(estimator, C.DecisionTreeClassifier):
        return False
    return (
        rows >= GROWN_ROWS
        and features <= MOST_FEATURES
        and 2 <= classes <= MOST_CLASSES
        and estimator.getMaxDepth() >= UNLIMITED
        and 2 <= estimator.getMaxBins() <= 256
        and estimator.getImpurity() == "gini"
        and estimator.getMinInfoGain() == 0
        and estimator.getMinWeightFractionPerNode() == 0
        and not estimator.isSet("weightCol")
        and (not forest or estimator.getBootstrap() and estimator.getFeatureSubsetStrategy() in _STRATEGIES)
    )


def candidates(values: np.ndarray, splits: int) -> np.ndarray:
    """At most so many bounds between the values, as Spark ML chooses them: all of them, or about equal counts between."""
    found, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= splits:
        return between
    stride = counts.sum() / (splits + 1)
    below, chosen, target = np.cumsum(counts), [], stride
    for i in range(1, len(found)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            chosen.append(between[i - 1])
            target += stride
    return np.array(chosen)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _child_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of the left and right child of each node, in turn."""
    return _mixed((keys[:, None] * np.uint64(3) + np.array([1, 2], np.uint64)).reshape(-1))


def _columns(keys: np.ndarray, features: int, chosen: int) -> np.ndarray:
    """The features that each node may split by: those with the smallest hashes of node and feature."""
    if chosen >= features:
        return np.broadcast_to(np.arange(features), (len(keys), features))
    hashes = _mixed(keys[:, None] + np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.sort(np.argpartition(hashes, chosen - 1, axis=1)[:, :chosen], axis=1)


@dataclass(frozen=True)
class _Job:
    """What all tasks know: how rows are drawn and nodes are split."""

    features: int
    classes: int
    bins: int
    chosen: int
    least: int
    depth: int
    seed: int
    rate: float | None
    bounds: list[np.ndarray] = field(repr=False, default_factory=list)

    def weights(self, tree: int, block: int, rows: int) -> np.ndarray:
        """How often the rows of a block are in the sample of a tree."""
        if self.rate is None:
            return np.ones(rows, np.uint16)
        return np.random.default_rng([self.seed, tree, block]).poisson(self.rate, rows).astype(np.uint16)

    def root(self, tree: int) -> int:
        return int(_mixed(np.array([self.seed * 1_000_003 + tree + 1], np.uint64))[0])


class _Top:
    """The nodes of a tree that the driver holds; open ones are not split yet."""

    def __init__(self, key: int):
        self.state, self.feature, self.cut, self.left, self.gain = [_OPEN], [0], [0], [-1], [-1.0]
        self.key, self.depth, self.stats = [key], [0], [None]

    def split(self, at: int, feature: int, cut: int, gain: float, sides: np.ndarray, keys: np.ndarray) -> list[int]:
        first = len(self.state)
        self.state[at], self.feature[at], self.cut[at], self.gain[at], self.left[at] = _INNER, feature, cut, gain, first
        for stats, key in zip(sides, keys.tolist(), strict=True):
            for column, value in (
                (self.state, _OPEN), (self.feature, 0), (self.cut, 0), (self.left, -1), (self.gain, -1.0),
                (self.key, key), (self.depth, self.depth[at] + 1), (self.stats, stats),
            ):
                column.append(value)
        return [first, first + 1]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return np.array(self.feature), np.array(self.cut), np.array(self.left)


def place(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The node of each row; a right child has the number after the left one."""
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(rows := rows[left[at[rows]] >= 0]):
        own = at[rows]
        at[rows] = left[own] + (bins[rows, feature[own]] > cut[own])
    return at


def to_bins(x: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """The number of bounds below each value; a missing one is beyond all of them."""
    bins = np.empty(x.shape, np.uint8)
    for i, own in enumerate(bounds):
        bins[:, i] = np.searchsorted(own, x[:, i])
    return bins


def bounds_of(rows: DataFrame, size: int, features: int, bins: int, seed: int) -> list[np.ndarray]:
    """The candidates of each feature of arrays ``x``, read off a sample."""
    share = max(bins * bins, _SAMPLE) / max(size, 1)
    some = (rows if share >= 1 else rows.sample(False, share, seed)).select("x").toArrow().column("x").combine_chunks()
    x = some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), features)
    return [candidates(x[:, i], bins - 1) for i in range(features)]


def _binned(bounds: list[np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows: the bin of every value, and the classes."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(start, _BLOCK)
            x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            bins = to_bins(x, bounds)
            labels = part.column(1).to_numpy(zero_copy_only=False).astype(np.uint8)
            columns = [pa.array([number], pa.int64()), *[pa.array([v.tobytes()], pa.binary()) for v in (bins, labels)]]
            yield pa.RecordBatch.from_arrays(columns, ["block", "bins", "labels"])
            number += 1


def _blocks(job: _Job, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            bins, labels = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint8) for c in (1, 2))
            yield batch.column(0)[i].as_py(), bins.reshape(-1, job.features), labels


def _histograms(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each wide node the weights of its rows by chosen feature, bin and class, summed over the task."""
    job, trees, wide = shared.value
    sums: dict[int, np.ndarray] = {}
    size = job.chosen * job.bins * job.classes
    for block, bins, labels in _blocks(job, batches):
        for tree, (nodes, columns) in wide.items():
            weight = job.weights(tree, block, len(bins))
            number = np.full(len(trees[tree][0]), -1)
            number[nodes] = np.arange(len(nodes))
            at = number[place(bins, *trees[tree])]
            some = np.flatnonzero((at >= 0) & (weight > 0))
            at = at[some]
            cells = (at[:, None] * job.chosen + np.arange(job.chosen)) * job.bins + bins[some[:, None], columns[at]]
            cells = cells * job.classes + labels[some, None]
            own = np.bincount(cells.ravel(), np.repeat(weight[some], job.chosen).astype(float), len(nodes) * size)
            sums[tree] = sums[tree] + own if tree in sums else own
    for tree, own in sums.items():
        nodes = wide[tree][0]
        columns = [pa.array(v, pa.int32()) for v in ([tree] * len(nodes), nodes)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([h.tobytes() for h in own.reshape(len(nodes), size)], pa.binary())], ["tree", "node", "sums"])


def _gain(left: np.ndarray, right: np.ndarray, left2: np.ndarray, right2: np.ndarray, total, total2, least: int) -> np.ndarray:
    """Gini gains from the weights of both sides and the sums of their squares over the classes."""
    with np.errstate(all="ignore"):
        gain = (left2 / left + right2 / right) / total - total2 / total**2
    gain[(left < least) | (right < least)] = -np.inf
    return gain


def _best_split(shared, key: tuple, table: pa.Table) -> pa.Table:
    """The best split of a wide node from the histograms of all tasks; a feature of -1 says that there is none."""
    job, _, wide = shared.value
    tree, node = (k.as_py() for k in key)
    sums = np.sum([np.frombuffer(b.as_buffer()) for b in table.column("sums")], axis=0).reshape(job.chosen, job.bins, job.classes)
    left = sums.cumsum(axis=1)
    total = left[0, -1]
    right = total - left
    weight = left.sum(axis=2)
    gain = _gain(weight, total.sum() - weight, (left * left).sum(axis=2), (right * right).sum(axis=2), total.sum(), (total * total).sum(), job.least)
    nodes, columns = wide[tree]
    at = int(gain.argmax())
    row, cut = divmod(at, job.bins)
    found = gain.flat[at] > _LEAST_GAIN
    feature = int(columns[list(nodes).index(node)][row]) if found else -1
    stats = [total.tolist(), left[row, cut].tolist(), right[row, cut].tolist()]
    values = [[tree], [node], [feature], [cut], [float(gain.flat[at])], *[[s] for s in stats]]
    kinds = [pa.int32()] * 4 + [pa.float64()] + [pa.list_(pa.float64())] * 3
    return pa.table([pa.array(v, k) for v, k in zip(values, kinds)], ["tree", "node", "feature", "cut", "gain", "stats", "left", "right"])


def _packs(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each block by the open node of each tree that they are in."""
    job, trees, groups = shared.value
    for block, bins, labels in _blocks(job, batches):
        for tree, arrays in trees.items():
            weight = job.weights(tree, block, len(bins))
            at = place(bins, *arrays)
            at[weight == 0] = -1
            order = np.argsort(at, kind="stable")
            edges = np.flatnonzero(np.diff(at[order], prepend=-1))
            rows: list[tuple] = []
            for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
                node, some = int(at[order[a]]), order[a:b]
                if (tree, node) in groups:
                    rows.append((tree, node, bins[some].tobytes(), labels[some].tobytes(), weight[some].tobytes()))
            if rows:
                kinds = [pa.int32()] * 2 + [pa.binary()] * 3
                columns = [pa.array(v, k) for v, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "bins", "labels", "weights"])


def _with(function, shared):
    """The function of a key and its rows that knows what all tasks do."""
    return lambda key, table: function(shared, key, table)


def _grown_below(shared, key: tuple, table: pa.Table) -> pa.Table:
    """All nodes from an open one downwards."""
    job, _, groups = shared.value
    tree, node = (k.as_py() for k in key)
    root, depth = groups[tree, node]
    bins, labels, weights = (
        np.concatenate([np.frombuffer(b.as_buffer(), kind) for b in table.column(c)])
        for c, kind in (("bins", np.uint8), ("labels", np.uint8), ("weights", np.uint16))
    )
    feature, cut, gain, left, stats = subtree(job, bins.reshape(-1, job.features), labels, weights.astype(float), root, depth)
    count = len(left)
    bound = np.zeros(count)
    for f in np.unique(feature[left >= 0]):
        own = np.flatnonzero((left >= 0) & (feature == f))
        bound[own] = job.bounds[f][cut[own]]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, count * job.classes + 1, job.classes), pa.int32()), pa.array(stats.ravel()))
    whole = [np.full(count, tree), np.full(count, node), np.arange(count), left, feature]
    columns = [*[pa.array(v.astype(np.int32)) for v in whole], pa.array(bound), pa.array(gain), lists]
    return pa.table(columns, ["tree", "root", "local", "left", "feature", "bound", "gain", "stats"])


def subtree(job: _Job, bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, key: int, depth: int) -> tuple[np.ndarray, ...]:
    """``feature, cut, gain, left, stats`` of the nodes of a tree over the rows, level by level.

    A leaf has -1 for ``left``; a right child comes after the left one.
    """
    size, classes = bins.shape[0], job.classes
    flat = np.ascontiguousarray(bins.T).ravel()
    rows, node = np.arange(size), np.zeros(size, np.int64)
    stats, keys = np.bincount(labels, weights, classes)[None], np.array([key], np.uint64)
    levels: list[tuple] = []
    base = 0
    while True:
        opened = (np.count_nonzero(stats, axis=1) > 1) & (stats.sum(axis=1) >= 2 * job.least) & (depth < job.depth)
        feature, cut = np.full(len(stats), -1), np.zeros(len(stats), np.int64)
        gain, left = np.full(len(stats), -1.0), np.full(len(stats), -1)
        # only rows of open nodes, node by node
        keep = np.flatnonzero(opened[node])
        keep = keep[np.argsort(_small(node[keep], len(stats)), kind="stable")]
        rows, node = rows[keep], (np.cumsum(opened) - 1)[node[keep]]
        at = np.flatnonzero(opened)
        if len(at):
            best, of, below = _best_splits(job, flat, size, rows, node, labels, weights, stats[at], keys[at])
            good = best > _LEAST_GAIN
            at = at[good]
            feature[at], cut[at], gain[at] = of[good], below[good], best[good]
            left[at] = base + len(stats) + 2 * np.arange(len(at))
        levels.append((feature, cut, gain, left, stats))
        if not len(at):
            break
        base += len(stats)
        keep = np.flatnonzero(good[node])
        rows, parent = rows[keep], (np.cumsum(good) - 1)[node[keep]]
        node = 2 * parent + (flat.take(feature[at][parent] * size + rows) > cut[at][parent])
        stats = np.bincount(node * classes + labels[rows], weights[rows], 2 * len(at) * classes).reshape(-1, classes)
        keys, depth = _child_keys(keys[at]), depth + 1
    return _pruned(levels)


def _small(numbers: np.ndarray, count: int) -> np.ndarray:
    """The numbers in a type that numpy sorts by digits, if they fit."""
    return numbers.astype(np.uint8 if count <= 1 << 8 else np.uint16 if count <= 1 << 16 else np.int64)


def _best_splits(
    job: _Job, flat: np.ndarray, size: int, rows: np.ndarray, node: np.ndarray, labels: np.ndarray, weights: np.ndarray, stats: np.ndarray, keys: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature and bin of the best split of each node; ``rows`` come node by node.

    Along the bins of a feature the sums of squares of both sides change with each row by what its class has already.
    """
    count = len(stats)
    of_row, weight = labels[rows], weights[rows]
    small = _small(node, count)
    begin = np.searchsorted(node, np.arange(count))
    total, total2 = stats.sum(axis=1), (stats * stats).sum(axis=1)
    best, feature, cut = np.full(count, -np.inf), np.full(count, -1), np.zeros(count, np.int64)
    columns = _columns(keys, job.features, job.chosen)
    turns = np.flatnonzero(np.diff(node))

    def running(steps: np.ndarray) -> np.ndarray:
        """Sums up to and with each row of its node."""
        sums = np.cumsum(steps)
        return sums - (sums[begin] - steps[begin])[node]

    for j in range(columns.shape[1]):
        own = columns[:, j]
        b = flat.take(own[node] * size + rows)
        order = np.argsort(b, kind="stable")
        order = order[np.argsort(small[order], kind="stable")]
        b, y, w = b[order], of_row[order], weight[order]
        by_class = np.argsort(y, kind="stable")
        by_class = by_class[np.argsort(small[by_class], kind="stable")]
        sums = np.cumsum(w[by_class]) - w[by_class]
        changes = y[by_class][1:] != y[by_class][:-1]
        changes[turns] = True
        starts = np.concatenate(([0], np.flatnonzero(changes) + 1))
        before = np.empty(len(rows))
        before[by_class] = sums - np.repeat(sums[starts], np.diff(starts, append=len(rows)))
        left, left2 = running(w), running(w * (2 * before + w))
        right2 = running(w * (w - 2 * (stats[node, y] - before)))
        ends = b[1:] != b[:-1]
        ends[turns] = False
        at = np.flatnonzero(ends)
        if not len(at):
            continue
        who = node[at]
        gain = _gain(left[at], total[who] - left[at], left2[at], total2[who] + right2[at], total[who], total2[who], job.least)
        first = np.flatnonzero(np.diff(who, prepend=-1))
        top = np.maximum.reduceat(gain, first)
        hit = np.flatnonzero(gain == np.repeat(top, np.diff(first, append=len(at))))
        hit = hit[np.flatnonzero(np.diff(who[hit], prepend=-1))]
        better = top > best[who[hit]]
        hit, mine = hit[better], who[hit[better]]
        best[mine], feature[mine], cut[mine] = top[better], own[mine], b[at[hit]]
    return best, feature, cut


def _pruned(levels: list[tuple]) -> tuple[np.ndarray, ...]:
    """The levels as one, without splits both of whose sides are leaves with the same prediction."""
    feature, cut, gain, left, stats = (np.concatenate(c) for c in zip(*levels))
    first = np.cumsum([0, *[len(x[0]) for x in levels]])
    likeliest = stats.argmax(axis=1)
    for a, b in zip(first[-2::-1], first[:0:-1]):
        at = a + np.flatnonzero(left[a:b] >= 0)
        child = left[at]
        same = (left[child] < 0) & (left[child + 1] < 0) & (likeliest[child] == likeliest[child + 1])
        left[at[same]] = -1
    kept = np.zeros(len(left), bool)
    kept[0] = True
    for a, b in zip(first[:-1], first[1:]):
        child = left[a + np.flatnonzero(kept[a:b] & (left[a:b] >= 0))]
        kept[child] = kept[child + 1] = True
    number = np.cumsum(kept) - 1
    left = np.where(left >= 0, number[left], -1)
    gain, feature = np.where(left >= 0, gain, -1.0), np.where(left >= 0, feature, -1)
    return feature[kept], cut[kept], gain[kept], left[kept], stats[kept]


@dataclass
class Grown:
    """Fitted trees: nodes of the upper levels here, those below in a table, by ``(tree, root)``."""

    estimator: object
    features: int
    classes: int
    path: str
    upper: list[tuple]
    groups: list[tuple]

    @property
    def trees(self) -> int:
        return self.estimator.getNumTrees() if isinstance(self.estimator, C.RandomForestClassifier) else 1

    def nodes(self) -> DataFrame:
        """One row for each node of every tree, as Spark ML stores them; children have larger numbers than their parents."""
        spark = SparkSession.active()
        groups = local_rows(spark, self.groups, "tree int, root int, at int, shift int")
        below = spark.read.schema(_GROWN).parquet(self.path).join(F.broadcast(groups), ["tree", "root"])
        below = below.select(
            "tree",
            F.when(F.col("local") == 0, F.col("at")).otherwise(F.col("local") + F.col("shift")).alias("id"),
            F.when(F.col("left") >= 0, F.col("left") + F.col("shift")).otherwise(-1).alias("left"),
            "feature", "bound", "gain", "stats",
        )
        upper = local_rows(spark, self.upper, "tree int, id int, left int, feature int, bound double, gain double, stats array<double>")
        inner, total = F.col("left") >= 0, F.aggregate("stats", F.lit(0.0), lambda a, v: a + v)
        return below.unionByName(upper).select(
            "tree",
            "id",
            (F.array_position("stats", F.array_max("stats")) - 1).cast("double").alias("prediction"),
            (1 - F.aggregate(F.transform("stats", lambda v: v * v), F.lit(0.0), lambda a, v: a + v) / (total * total)).alias("impurity"),
            F.col("stats").alias("impurityStats"),
            total.cast("long").alias("rawCount"),
            "gain",
            F.col("left").alias("leftChild"),
            F.when(inner, F.col("left") + 1).otherwise(-1).alias("rightChild"),
            F.struct(
                F.when(inner, F.col("feature")).otherwise(-1).alias("featureIndex"),
                F.when(inner, F.array("bound")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
                F.lit(-1).alias("numCategories"),
            ).alias("split"),
        )

    def importances(self) -> np.ndarray:
        """What the splits by each feature gain, of each tree as a part of one; summed where the nodes are."""
        gained = F.sum(F.col("gain") * F.col("rawCount")).alias("gained")
        found = self.nodes().where("leftChild >= 0").groupBy("tree", F.col("split.featureIndex").alias("feature")).agg(gained).collect()
        out = np.zeros((self.trees, self.features))
        for r in found:
            out[r["tree"], r["feature"]] = r["gained"]
        whole = out.sum(axis=1, keepdims=True)
        out = (out / np.where(whole > 0, whole, 1.0)).sum(axis=0)
        return out / (out.sum() or 1.0)

    def load(self):
        """The model of Spark ML: the form it saves a model without splits in, with these nodes."""
        spark, path = SparkSession.active(), scratch_path(SparkSession.active(), "grown-model")
        zeros = F.array_repeat(F.lit(0.0), self.features)
        rows = local_rows(spark, [(float(c),) for c in range(self.classes)], "label double")
        rows = rows.select(array_to_vector(zeros).alias(self.estimator.getFeaturesCol()), F.col("label").alias(self.estimator.getLabelCol()))
        bare = self.estimator.copy({self.estimator.maxDepth: 0}).fit(rows)
        bare.write().save(f"{path}/bare")

        def deep(text: str) -> str:
            return re.sub(r'("maxDepth"\s*:\s*)0\b', rf"\g<1>{self.estimator.getMaxDepth()}", text)

        text = deep(spark.read.text(f"{path}/bare/metadata").first()[0])
        local_rows(spark, [(text,)], "value string").coalesce(1).write.text(f"{path}/whole/metadata")
        nodes, form = self.nodes(), spark.read.parquet(f"{path}/bare/data").schema
        if "nodeData" in form.names:
            parts = [r.asDict() for r in spark.read.parquet(f"{path}/bare/treesMetadata").collect()]
            kind = spark.read.parquet(f"{path}/bare/treesMetadata").schema
            parts = [[deep(v) if isinstance(v, str) else v for v in r.values()] for r in parts]
            local_rows(spark, parts, kind).coalesce(1).write.parquet(f"{path}/whole/treesMetadata")
            nodes = nodes.select(F.col("tree").alias("treeID"), F.struct(*[F.col(c) for c in form["nodeData"].dataType.names]).alias("nodeData"))
        nodes.select(*[F.col(f.name).cast(f.dataType) for f in form]).write.parquet(f"{path}/whole/data")
        return type(bare).load(f"{path}/whole")


def _chosen(estimator, features: int) -> int:
    strategy = estimator.getFeatureSubsetStrategy() if isinstance(estimator, C.RandomForestClassifier) else "all"
    if strategy == "auto":
        strategy = "sqrt" if estimator.getNumTrees() > 1 else "all"
    sizes = {"sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}
    return sizes.get(strategy, features)


def grow(estimator, prepared: DataFrame, rows: int, features: int, classes: int) -> Grown:
    """Fit the estimator on vectors and class indexes 0, 1, ...

    What reaches the driver is a sample of 10,000 rows for the candidates, the nodes of the upper levels, and one row for
    each group of rows that a task grows a subtree from.
    """
    spark = prepared.sparkSession
    forest = isinstance(estimator, C.RandomForestClassifier)
    trees = estimator.getNumTrees() if forest else 1
    plain = prepared.select(vector_to_array(estimator.getFeaturesCol()).alias("x"), F.col(estimator.getLabelCol()).cast("int").alias("y"))
    bins, seed = min(estimator.getMaxBins(), rows), estimator.getSeed() % (1 << 40)
    bounds = bounds_of(plain, rows, features, bins, seed)
    job = _Job(
        features, classes, bins, _chosen(estimator, features), estimator.getMinInstancesPerNode(), estimator.getMaxDepth(), seed,
        estimator.getSubsamplingRate() if forest else None, bounds,
    )
    path = scratch_path(spark, "binned")
    spread(plain).mapInArrow(lambda batches: _binned(bounds, batches), "block long, bins binary, labels binary").write.parquet(path)
    blocks = spark.read.schema("block long, bins binary, labels binary").parquet(path)
    cores = spark.sparkContext.defaultParallelism
    most = min(MOST_ROWS, MOST_VALUES // features)
    most = max(LEAST_ROWS, min(most, rows * trees // (4 * cores)))
    tops = {tree: _Top(job.root(tree)) for tree in range(trees)}
    _split_wide(job, blocks, tops, [(tree, 0) for tree in tops] if rows * (job.rate or 1.0) > most else [], most)
    groups = {(t, i): (top.key[i], top.depth[i]) for t, top in tops.items() for i, s in enumerate(top.state) if s == _OPEN}
    path = scratch_path(spark, "grown")
    shared = spark.sparkContext.broadcast((job, {t: tops[t].arrays() for t in sorted({t for t, _ in groups})}, groups))
    packs = blocks.mapInArrow(lambda batches: _packs(shared, batches), "tree int, node int, bins binary, labels binary, weights binary")
    tasks = max(1, min(len(groups), 4 * cores))
    grown = packs.repartition(tasks, "tree", "node").groupBy("tree", "node")
    grown.applyInArrow(_with(_grown_below, shared), _GROWN).write.parquet(path)
    return Grown(estimator, features, classes, path, *_assembled(spark, job, tops, path))


def _split_wide(job: _Job, blocks: DataFrame, tops: dict[int, _Top], wide: list[tuple[int, int]], most: int) -> None:
    """Splits nodes of more than ``most`` rows, a level of all trees at once."""
    spark, size = blocks.sparkSession, job.chosen * job.bins * job.classes
    while wide:
        at_once, following = max(1, _CELLS // size), []
        for start in range(0, len(wide), at_once):
            some: dict[int, list[int]] = {}
            for tree, node in wide[start : start + at_once]:
                some.setdefault(tree, []).append(node)
            plan = {t: (np.array(n), _columns(np.array([tops[t].key[i] for i in n], np.uint64), job.features, job.chosen)) for t, n in some.items()}
            shared = spark.sparkContext.broadcast((job, {t: tops[t].arrays() for t in some}, plan))
            sums = blocks.mapInArrow(lambda batches, shared=shared: _histograms(shared, batches), "tree int, node int, sums binary")
            schema = "tree int, node int, feature int, cut int, gain double, stats array<double>, left array<double>, right array<double>"
            best = sums.groupBy("tree", "node").applyInArrow(_with(_best_split, shared), schema)
            for r in sorted(best.collect(), key=lambda r: (r["tree"], r["node"])):
                top, node = tops[r["tree"]], r["node"]
                top.stats[node] = np.array(r["stats"])
                if r["feature"] < 0:
                    top.state[node] = _LEAF
                    continue
                keys = _child_keys(np.array([top.key[node]], np.uint64))
                for child in top.split(node, r["feature"], r["cut"], r["gain"], np.array([r["left"], r["right"]]), keys):
                    stats = top.stats[child]
                    if np.count_nonzero(stats) < 2 or stats.sum() < 2 * job.least or top.depth[child] >= job.depth:
                        top.state[child] = _LEAF
                    elif stats.sum() > most:
                        following.append((r["tree"], child))
        wide = following


def _assembled(spark: SparkSession, job: _Job, tops: dict[int, _Top], path: str) -> tuple[list[tuple], list[tuple]]:
    """Rows of the upper nodes as they are numbered in the end, and the places of the subtrees in their trees."""
    root = F.max(F.when(F.col("local") == 0, F.struct("left", "stats"))).alias("first")
    found = spark.read.schema(_GROWN).parquet(path).groupBy("tree", "root").agg(F.count(F.lit(1)).alias("n"), root).collect()
    sizes: dict[tuple[int, int], int] = {}
    for r in found:
        sizes[r["tree"], r["root"]] = r["n"]
        tops[r["tree"]].stats[r["root"]] = np.array(r["first"]["stats"])
    upper, groups = [], []
    for tree, top in tops.items():
        # a sample without rows is one empty leaf
        top.state = [_LEAF if s == _OPEN and (tree, i) not in sizes else s for i, s in enumerate(top.state)]
        top.stats = [np.zeros(job.classes) if s is None else s for s in top.stats]
        for i in reversed(range(len(top.state))):
            if top.state[i] == _INNER:
                ends = [top.state[c] == _LEAF or top.state[c] == _OPEN and sizes[tree, c] == 1 for c in (top.left[i], top.left[i] + 1)]
                if all(ends) and top.stats[top.left[i]].argmax() == top.stats[top.left[i] + 1].argmax():
                    top.state[i] = _LEAF
                    top.state[top.left[i]] = top.state[top.left[i] + 1] = _GONE
        kept = np.array([s != _GONE for s in top.state])
        number, end = np.cumsum(kept) - 1, int(kept.sum())
        for i, state in enumerate(top.state):
            if state == _OPEN:
                groups.append((tree, i, int(number[i]), end - 1))
                end += sizes[tree, i] - 1
            elif state != _GONE:
                inner = state == _INNER
                bound = float(job.bounds[top.feature[i]][top.cut[i]]) if inner else 0.0
                left = int(number[top.left[i]]) if inner else -1
                upper.append((tree, int(number[i]), left, top.feature[i] if inner else -1, bound, top.gain[i] if inner else -1.0, top.stats[i].tolist()))
    return upper, groups
