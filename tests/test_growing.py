"""Trees grown on binned rows against those of Spark ML, and against the rows that reach their leaves."""

import numpy as np
import pytest

from tidemill.operators import growing, models
from tidemill.operators.tree_shap import tree_leaves

NAMES = [f"x{i}" for i in range(6)]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(3000, 6)).round(1)
    x[:, 5] = draw.integers(0, 4, 3000)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int) + (x[:, 5] > 2) + (draw.random(3000) < 0.1)) % 4
    rows = [(i, *map(float, v), f"c{c}") for i, (v, c) in enumerate(zip(x, y, strict=True))]
    # repeated rows with other classes are what no split parts
    rows += [(3000 + i, *rows[0][1:-1], f"c{i % 3}") for i in range(30)]
    return spark.createDataFrame(rows, ["id", *NAMES, "label"]).repartition(3).persist()


def leaves(spark, trained):
    return {tuple(map(str, (l.features, l.low, l.high))): np.array(l.value) for l in tree_leaves(spark, trained.pipeline.stages[-1]).collect()}


@pytest.mark.parametrize("least", [1 << 12, 400, 25])
def test_trees_are_those_of_spark(spark, table, monkeypatch, least):
    """However few rows a task takes: leaves agree but where splits are equally good."""
    theirs = models.train(table, "decision_tree", NAMES, "label")
    monkeypatch.setattr(growing, "GROWN_ROWS", 100)
    monkeypatch.setattr(growing, "LEAST_ROWS", least)
    monkeypatch.setattr(growing, "_BLOCK", 300)
    fit = models.C.DecisionTreeClassifier.fit
    monkeypatch.setattr(models.C.DecisionTreeClassifier, "fit", lambda self, df, *a: fit(self, df, *a) if self.getMaxDepth() == 0 else pytest.fail("by Spark"))
    ours = models.train(table, "decision_tree", NAMES, "label")
    one, other = leaves(spark, theirs), leaves(spark, ours)
    assert abs(len(one) - len(other)) < 0.02 * len(one)
    assert len(one.keys() & other.keys()) > 0.85 * len(one)
    assert np.allclose(models.importances(theirs.pipeline.stages[-1]), models.importances(ours.pipeline.stages[-1]), atol=0.02)
    predicted = [{r.id: r.prediction for r in t.predict(table).collect()} for t in (theirs, ours)]
    assert predicted[0] == predicted[1]
    assert ours.pipeline.stages[-1].getMaxDepth() == models.DEEPEST_TREE


@pytest.mark.parametrize("least", [1 << 12, 400])
def test_a_grown_forest(spark, table, monkeypatch, tmp_path, least):
    theirs = models.train(table, "random_forest", NAMES, "label", {"n_estimators": 12})
    monkeypatch.setattr(growing, "GROWN_ROWS", 100)
    monkeypatch.setattr(growing, "LEAST_ROWS", least)
    ours = models.train(table, "random_forest", NAMES, "label", {"n_estimators": 12})
    forest = ours.pipeline.stages[-1]
    found = models.importances(forest)
    # read off the table of nodes, without a model
    assert not forest.held and abs(found.sum() - 1) < 1e-12 and forest.trees == [12] and forest.classes == 4
    assert np.allclose(found, forest.models[0].featureImportances.toArray(), atol=1e-9)
    assert np.abs(found - models.importances(theirs.pipeline.stages[-1])).max() < 0.12
    right = [t.predict(table).where("prediction = label").count() for t in (theirs, ours)]
    assert right[1] > 0.98 * right[0]
    sizes = [sum(m.totalNumNodes for m in t.pipeline.stages[-1].models) for t in (theirs, ours)]
    assert abs(sizes[0] - sizes[1]) < 0.1 * sizes[0]
    models.save_model(ours, str(tmp_path / "model"))
    again = models.load_model(spark, str(tmp_path / "model"))
    one, other = ({r.id: r.prediction for r in t.predict(table).collect()} for t in (ours, again))
    assert one == other


def test_stats_are_of_the_rows(spark, table, monkeypatch):
    """Every node counts the rows that reach it, and a leaf that no split parts keeps all its classes."""
    monkeypatch.setattr(growing, "GROWN_ROWS", 100)
    monkeypatch.setattr(growing, "LEAST_ROWS", 200)
    trained = models.train(table, "decision_tree", NAMES, "label", {"min_samples_leaf": 5})
    labels = {v: i for i, v in enumerate(trained.labels)}
    rows = table.collect()
    x = np.array([[r[c] for c in NAMES] for r in rows])
    y = np.array([labels[r.label] for r in rows])
    seen = 0
    for leaf in tree_leaves(spark, trained.pipeline.stages[-1]).collect():
        met = np.all([(x[:, f] > a) & (x[:, f] <= b) for f, a, b in zip(leaf.features, leaf.low, leaf.high, strict=True)], axis=0)
        counts = np.bincount(y[met], minlength=4)
        assert counts.sum() >= 5 and np.allclose(counts / counts.sum(), leaf.value)
        seen += counts.sum()
    assert seen == len(rows)


def test_candidates():
    assert growing.candidates(np.array([3.0, 1.0, np.nan, 1.0, 2.0]), 31).tolist() == [1.5, 2.5]
    assert growing.candidates(np.array([4.0, 4.0]), 31).tolist() == []
    assert growing.candidates(np.arange(100.0), 3).tolist() == [24.5, 49.5, 74.5]


def test_what_is_left_to_spark():
    tree = models.C.DecisionTreeClassifier(maxDepth=30)
    assert growing.suits(tree, 1 << 20, 64, 10)
    assert not growing.suits(tree, 100, 64, 10) and not growing.suits(tree.copy().setMaxDepth(5), 1 << 20, 64, 10)
    assert not growing.suits(tree.copy().setImpurity("entropy"), 1 << 20, 64, 10)
    assert not growing.suits(models.R.DecisionTreeRegressor(maxDepth=30), 1 << 20, 64, 0)
    forest = models.C.RandomForestClassifier(maxDepth=30)
    assert growing.suits(forest, 1 << 20, 64, 10) and not growing.suits(forest.copy().setFeatureSubsetStrategy("3"), 1 << 20, 64, 10)
