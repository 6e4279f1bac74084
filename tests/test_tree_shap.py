"""Exact impacts of tree models against all subsets of features, evaluated by the models themselves."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemill.operators import explain, models
from tidemill.operators.tree_shap import is_tree_model, tree_leaves, tree_shap

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(7)
    x = draw.integers(0, 6, (240, 4)).astype(float)
    y = (x[:, 0] > 2) * 2.0 + (x[:, 1] * x[:, 2] > 6) * 1.0 + x[:, 3] * (x[:, 0] < 2) + draw.random(240) * 0.3
    label = np.where(y > 3, "high", np.where(y > 1.2, "mid", "low"))
    rows = [(i, *map(float, r), float(v), str(s), str(s == "low")) for i, (r, v, s) in enumerate(zip(x, y, label, strict=True))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double, label string, two string").persist()


def outputs(trained, df):
    """What is explained, from the model's own columns."""
    last = trained.pipeline.stages[-1]
    scored = trained.pipeline.transform(df)
    if trained.task == "regression":
        return scored.select("n", F.array("prediction").alias("f"))
    if type(last).__name__ == "SoftmaxBoostedModel":
        return scored.select("n", vector_to_array("rawPrediction").alias("f"))
    if type(last).__name__ == "AdaBoostModel":
        return scored.select("n", F.col("rawPrediction").alias("f"))
    if type(last).__name__ == "GBTClassificationModel":
        return scored.select("n", F.slice(vector_to_array("rawPrediction"), 2, 1).alias("f"))
    return scored.select("n", vector_to_array("probability").alias("f"))


def brute_force(spark, trained, rows, background):
    subsets = [s for k in range(5) for s in itertools.combinations(range(4), k)]
    mixed, at = [], {}
    for i, x in enumerate(rows):
        for s in subsets:
            for z in background:
                at.setdefault((i, s), []).append(len(mixed))
                mixed.append((len(mixed), *[float(x[j] if j in s else z[j]) for j in range(4)]))
    df = spark.createDataFrame(mixed, "n long, a double, b double, c double, d double")
    f = {r["n"]: np.array(r["f"]) for r in outputs(trained, df).collect()}
    value = {k: np.mean([f[n] for n in ns], axis=0) for k, ns in at.items()}
    out = []
    for i in range(len(rows)):
        phi = []
        for j in range(4):
            total = 0
            for s in subsets:
                if j not in s:
                    share = math.factorial(len(s)) * math.factorial(3 - len(s)) / 24
                    total = total + share * (value[i, tuple(sorted((*s, j)))] - value[i, s])
            phi.append(total)
        out.append((value[i, ()], phi))
    return out


CASES = [
    ("decision_tree_regressor", "y", {}),
    ("decision_tree", "label", {}),
    ("random_forest", "label", {"n_estimators": 4}),
    ("random_forest_regressor", "y", {"n_estimators": 3, "max_depth": 5}),
    ("gradient_boosting", "two", {"n_estimators": 4}),
    ("gradient_boosting", "label", {"n_estimators": 3}),
    ("adaboost", "label", {"n_estimators": 3}),
]


@pytest.mark.parametrize(("name", "target", "parameters"), CASES)
def test_against_all_subsets(spark, table, name, target, parameters):
    trained = models.train(table, name, FEATURES, target, parameters)
    background = explain.background_sample(table, "id", FEATURES, 7)
    some = table.where("id >= 200 and id < 206")
    per_class = trained.task == "classification"
    found = tree_shap(trained, some, "id", background, per_class)
    rows = [tuple(r[c] for c in FEATURES) for r in some.orderBy("id").collect()]
    points = [tuple(r[c] for c in FEATURES) for r in background.collect()]
    want = brute_force(spark, trained, rows, points)
    by = {}
    for r in found.collect():
        by.setdefault(r["id"], []).append(r)
    for i, (base, phi) in enumerate(want):
        got = by[200 + i]
        assert len(got) == len(base)
        for c, r in enumerate(got):
            assert r["base_value"] == pytest.approx(base[c], abs=1e-9)
            assert [e["feature"] for e in r["impacts"]] == FEATURES
            assert [e["value"] for e in r["impacts"]] == list(rows[i])
            assert [e["impact"] for e in r["impacts"]] == pytest.approx([p[c] for p in phi], abs=1e-9)


def test_last_class_and_missing_values(spark, table):
    trained = models.train(table, "decision_tree", FEATURES, "label")
    background = explain.background_sample(table, "id", FEATURES, 9)
    some = table.where("id < 4").withColumn("b", F.when(F.col("id") != 1, F.col("b")))
    each = {(r["id"], r["class"]): r for r in tree_shap(trained, some, "id", background, per_class=True).collect()}
    for r in tree_shap(trained, some, "id", background).collect():
        same = each[r["id"], "mid"]
        assert r["base_value"] == same["base_value"] and r["impacts"] == same["impacts"]
    mean = np.mean([r["b"] for r in background.collect()])
    assert each[1, "mid"]["impacts"][1]["value"] == pytest.approx(mean)


def test_leaves_cover_every_row_once(spark, table):
    trained = models.train(table, "decision_tree_regressor", FEATURES, "y")
    leaves = tree_leaves(spark, trained.pipeline.stages[-1]).collect()
    for row in trained.pipeline.transform(table).collect():
        x = [row[c] for c in FEATURES]
        met = [v for v in leaves if all(lo < x[f] <= hi for f, lo, hi in zip(v["features"], v["low"], v["high"], strict=True))]
        assert len(met) == 1 and met[0]["value"] == [row["prediction"]]


def test_one_leaf_and_edges(spark, table):
    flat = table.withColumn("y", F.lit(3.0))
    trained = models.train(flat, "decision_tree_regressor", FEATURES, "y")
    found = tree_shap(trained, flat.where("id < 3"), "id", explain.background_sample(flat, "id", FEATURES)).collect()
    assert [(r["base_value"], {e["impact"] for e in r["impacts"]}) for r in found] == [(3.0, {0.0})] * 3
    assert tree_shap(trained, flat.limit(0), "id", flat).count() == 0
    with pytest.raises(ValueError, match="background is empty"):
        tree_shap(trained, flat, "id", flat.limit(0))
    assert not is_tree_model(models.train(table, "linear_regression", FEATURES, "y").pipeline.stages[-1])


def test_leaves_in_parts_give_the_same_impacts(spark, table, monkeypatch):
    """Leaves are sent in parts of a bounded size, without the patterns of the background; their impacts add up alike."""
    from tidemill.operators import tree_shap as module

    trained = models.train(table, "decision_tree", FEATURES, "y")
    background = table.orderBy("id").limit(9)
    whole = sorted(map(str, tree_shap(trained, table, "id", background, True).select("id", "class", "base_value").collect()))
    monkeypatch.setattr(module, "_LEAVES_AT_ONCE", 2)
    rows = list(module._all_leaves(spark, trained.pipeline.stages[-1]))
    parts = list(module._Leaves.parts(iter(rows), False))
    assert max(len(p.sizes) for p in parts) == 2 and sum(len(p.sizes) for p in parts) == len(rows) > 2
    found = tree_shap(trained, table, "id", background, True)
    assert sorted(map(str, found.select("id", "class", "base_value").collect())) == whole
    own = {(r["id"], k): v for r in trained.predict(table).collect() for k, v in r["probability"].items()}
    for r in found.collect():
        assert abs(r["base_value"] + sum(i["impact"] for i in r["impacts"]) - own[r["id"], r["class"]]) < 1e-9


def test_walks_and_patterns_agree(spark, monkeypatch):
    """A tree of many leaves is walked by each pair of rows; the impacts are those of the patterns of its leaves."""
    from tidemill.operators import tree_shap as module

    draw = np.random.default_rng(7)
    rows = [(i, *map(float, v), f"c{int(v[0] + v[1] > 1) + int(v[2] * v[3] > 0.3)}") for i, v in enumerate(draw.random((900, 6)).round(2))]
    rows = [(*r[:-1], f"c{draw.integers(3)}" if i % 4 == 0 else r[-1]) for i, r in enumerate(rows)]
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame(rows, ["id", *names, "label"])
    background = explain.background_sample(df, "id", names, 20)
    for name, parameters in (("decision_tree", None), ("random_forest", {"n_estimators": 3})):
        trained = models.train(df, name, names, "label", parameters)
        found = []
        for most in (1 << 20, 4):
            monkeypatch.setattr(module, "_LEAVES_AT_ONCE", most)
            monkeypatch.setattr(module, "_FORKS", 1 << 8)
            for per_class in (True, False):
                some = df.where("id < 60")
                out = module.tree_shap(trained, some, "id", background, per_class).collect()
                found.append(sorted((r["id"], r["class"] if per_class else "", r["base_value"], *[e["impact"] for e in r["impacts"]]) for r in out))
        for patterns, walks in zip(found[:2], found[2:]):
            assert [r[:2] for r in patterns] == [r[:2] for r in walks]
            assert np.allclose([r[2:] for r in patterns], [r[2:] for r in walks], atol=1e-12)
            assert np.abs([r[3:] for r in walks]).max() > 0.01
