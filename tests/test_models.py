"""Fitted models: better than guessing, reloadable, probabilities and importances that add up."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.operators import charts, evaluate, explain, models, training
from tidemill.operators.splits import should_stratify
from tidemill.operators.tree_shap import tree_leaves

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def table(spark):
    """Three classes that the features separate well, and a price that is linear in them."""
    i = F.col("id")
    a, b = (i % 20) / 2.0, (i * 7 % 23) / 2.0
    label = F.when(a > 6, "high").when(b > 6, "wide").otherwise("low")
    return spark.range(0, 400, 1, 1).select("id", a.alias("a"), b.alias("b"), label.alias("y"), (3 * a - 2 * b + 1).alias("price"))


def accuracy(scored):
    return evaluate.classification_metrics(scored, "y", "prediction").first()["accuracy"]


@pytest.mark.parametrize(
    "name,parameters",
    [
        ("random_forest", {"n_estimators": 10, "max_depth": 5}),
        ("decision_tree", {"max_depth": 5}),
        ("logistic_regression", {}),
        ("gradient_boosting", {"n_estimators": 5}),
        ("svm", {}),
        ("mlp_classifier", {"hidden_layer_sizes": (8,), "max_iter": 30}),
        ("naive_bayes", {}),
        ("adaboost", {"n_estimators": 11}),
        ("knn_classifier", {}),
        ("knn_classifier", {"weights": "distance", "n_neighbors": 3}),
    ],
)
def test_classifiers_beat_the_largest_class(table, name, parameters):
    trained, scored = models.train_and_test(table, "id", name, FEATURES, "y", parameters)
    assert scored.count() == 80
    largest = table.groupBy("y").count().agg(F.max("count")).first()[0] / 400
    assert accuracy(scored) > largest + 0.1
    for r in scored.limit(20).collect():
        assert sum(r["probability"].values()) == pytest.approx(1.0)
        assert r["confidence"] == max(r["probability"].values()) == r["probability"][r["prediction"]]


def test_save_and_load(spark, table):
    for name, parameters in (
        ("decision_tree", {"max_depth": 3}),
        ("adaboost", {"n_estimators": 3}),
        ("knn_classifier", {}),
    ):
        trained = models.train(table, name, FEATURES, "y", parameters)
        path = scratch_path(spark, "model-test")
        models.save_model(trained, path)
        loaded = models.load_model(spark, path)
        assert (loaded.features, loaded.labels, loaded.task) == (FEATURES, trained.labels, "classification")
        ours = [r["prediction"] for r in trained.predict(table).orderBy("id").collect()]
        assert ours == [r["prediction"] for r in loaded.predict(table).orderBy("id").collect()]


def test_importances_add_up(table):
    trained = models.train(table, "random_forest", FEATURES, "y", {"n_estimators": 5, "max_depth": 4})
    rows = models.feature_importance(trained).collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert rows[0]["importance"] >= rows[1]["importance"]
    linear = models.feature_importance(models.train(table, "linear_regression", FEATURES, "price")).collect()
    assert [(r["feature"], round(r["importance"], 6)) for r in linear] == [("a", 3.0), ("b", 2.0)]


def test_regression_recovers_the_line(table):
    _, scored = models.train_and_test(table, "id", "linear_regression", FEATURES, "price")
    assert evaluate.regression_metrics(scored, "price", "prediction").first()["r2"] > 0.999


def test_wrong_requests(table):
    with pytest.raises(ValueError, match="catalog has no model"):
        models.model_spec("oracle")
    with pytest.raises(ValueError, match="listed as a feature"):
        models.train(table, "linear_regression", ["a", "price"], "price")
    with pytest.raises(ValueError, match="tasks"):
        models.require_task(table, "y", "linear_regression")
    assert models.known_parameters("svm", {"C": 2.0, "trees": 3}) == {"C": 2.0, "kernel": "linear", "random_state": 42}
    assert models.known_parameters("random_forest", {"max_features": 1})["max_features"] == 1
    with pytest.raises(ValueError, match="kernel rbf"):
        models.train(table, "svm", FEATURES, "y", {"kernel": "rbf"})
    with pytest.raises(ValueError, match="weighted"):
        models.train(table, "knn_classifier", FEATURES, "y", {"weights": "odd"})


def test_labels_keep_type_and_order(table):
    numbered = table.withColumn("y", (F.col("id") % 12).cast("int"))
    trained = models.train(numbered, "decision_tree", FEATURES, "y", {"max_depth": 3, "criterion": "entropy"})
    assert trained.labels == list(range(12))
    scored = trained.predict(numbered)
    assert dict(scored.dtypes)["prediction"] == "int" and dict(scored.dtypes)["probability"] == "map<int,double>"


def test_neighbour_regression(table):
    _, scored = models.train_and_test(table, "id", "knn_regressor", FEATURES, "price", {"weights": "distance"})
    assert evaluate.regression_metrics(scored, "price", "prediction").first()["r2"] > 0.9


def test_partial_neighbours_do_not_grow_with_batches(spark, monkeypatch):
    """What a task writes is bounded by query rows times k, whatever the batch size."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist(), float(i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, y double").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    written = []
    monkeypatch.setattr(models, "scratch_path", lambda s, n: written.append(scratch_path(s, n)) or written[-1])
    try:
        assert models.knn_neighbors(df, df.where("id < 20"), "id", "v", "y", 3).count() == 60
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert spark.read.parquet(written[-1]).count() <= 8 * 20 * 3


def _brute_neighbors(points, k):
    out = {}
    for i, p in points.items():
        ranked = sorted((float(((p - q) ** 2).sum()), j) for j, q in points.items() if j != i)
        out[i] = [j for _, j in ranked[:k]]
    return out


@pytest.mark.parametrize("limit", [20_000, 13])
def test_neighbors_in_one_pass_and_in_blocks(spark, monkeypatch, limit):
    monkeypatch.setattr(models, "KNN_QUERY_ROWS", limit)
    rng = np.random.default_rng(4)
    points = {i: rng.integers(0, 6, 3).astype(float) for i in range(60)}  # many ties
    df = spark.createDataFrame([(i, p.tolist(), float(i % 4)) for i, p in points.items()], "id bigint, v array<double>, y double")
    found = models.knn_neighbors(df, df, "id", "v", "y", 5)
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbor"])
    assert got == _brute_neighbors(points, 5)


def test_sampled_impacts_add_up(table):
    trained = models.train(table, "random_forest", FEATURES, "y", {"n_estimators": 5, "max_depth": 4})
    background = explain.background_sample(table, "id", FEATURES, 6)
    found = explain.sampled_shap(trained, table, "id", FEATURES, background, samples=6)
    last = trained.labels[-1]
    probability = {r["id"]: r["probability"][last] for r in trained.predict(table).collect()}
    rows = found.collect()
    assert len(rows) == 400
    for r in rows:
        assert {i["feature"] for i in r["impacts"]} == set(FEATURES)
        assert r["base_value"] + sum(i["impact"] for i in r["impacts"]) == pytest.approx(probability[r["id"]])
    # one base value: the mean output over the background
    outputs = [r["probability"][last] for r in trained.predict(table.where("id < 6")).collect()]
    assert rows[0]["base_value"] == pytest.approx(sum(outputs) / 6)
    assert max(r["base_value"] for r in rows) - min(r["base_value"] for r in rows) < 1e-9


def test_impacts_per_class_have_the_class_and_its_base_value(table):
    trained = models.train(table, "adaboost", FEATURES, "y", {"n_estimators": 3})
    background = explain.background_sample(table, "id", FEATURES, 4)
    gaps = table.withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    found = explain.sampled_shap(trained, gaps, "id", FEATURES, background, per_class=True)
    bases = {}
    for r in found.collect():
        bases.setdefault(r["class"], set()).add(round(r["base_value"], 9))
    assert set(bases) == set(trained.labels) and all(len(b) == 1 for b in bases.values())
    assert sum(b.pop() for b in bases.values()) == pytest.approx(1.0)


def test_sampled_impacts_of_a_linear_model_are_exact_on_one_background_row(table):
    trained = models.train(table, "linear_regression", FEATURES, "price")
    background = table.where("id = 0")
    found = explain.sampled_shap(trained.pipeline, table, "id", FEATURES, background, samples=2)
    for r in found.limit(30).collect():
        impact = {i["feature"]: (i["impact"], i["value"]) for i in r["impacts"]}
        assert impact["a"][0] == pytest.approx(3 * impact["a"][1], abs=1e-6)
        assert impact["b"][0] == pytest.approx(-2 * impact["b"][1], abs=1e-6)


def test_pca_shares_fall(table):
    points, shares = charts.pca_2d(table, "id", ["a", "b", "price"])
    assert points.count() == 400
    assert shares[0] >= shares[1] and sum(shares) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        charts.pca_2d(table, "id", ["a", "y"])


def test_training_on_a_raw_table(spark):
    """Strings, missing values, a category that training rows never show, and scoring after a reload."""
    i = F.col("id")
    raw = spark.range(0, 600, 1, 3).select(
        "id",
        F.when(i % 7 > 0, (i % 20).cast("double")).alias("size"),
        F.when(i % 11 > 0, F.when(i % 3 == 0, "red").when(i % 3 == 1, "blue").otherwise("green")).alias("colour"),
        F.when(i % 50 == 3, None).otherwise(F.when((i % 3 == 0) | (i % 20 > 14), "yes").otherwise("no")).alias("y"),
    )
    fitted, scored = training.train_table(raw, "y", "random_forest", ["size", "colour"], {"n_estimators": 10}, "id")
    assert scored.columns == [*raw.columns, "prediction", "probability", "confidence"]
    assert scored.count() == 118 and accuracy(scored) > 0.75
    assert fitted.encoding.encoded_columns == ["size", "colour_green", "colour_red"]
    path = scratch_path(spark, "table-model")
    fitted.save(path)
    again = training.TableModel.load(spark, path)
    new = raw.withColumn("colour", F.when(i % 5 == 0, "purple").otherwise(F.col("colour")))
    ours, theirs = fitted.predict(new).orderBy("id").collect(), again.predict(new).orderBy("id").collect()
    assert [r["prediction"] for r in ours] == [r["prediction"] for r in theirs] and len(ours) == 600
    with pytest.raises(ValueError, match="size"):
        again.predict(new.drop("size"))
    with pytest.raises(ValueError, match="listed as a feature"):
        training.train_table(raw, "y", "random_forest", ["size", "y"])


def test_registered_background_is_whole(tables, monkeypatch):
    """The registered explanation of every class meets the background sample at its own size."""
    from tidemill.plans import models as plans

    sizes = []

    def stop(model, df, key, features, background, *args, **kwargs):
        sizes.append((len(features), background.count()))
        raise InterruptedError

    monkeypatch.setattr(explain, "sampled_shap", stop)
    with pytest.raises(InterruptedError):
        plans.sampled_shap_per_class(tables)
    assert sizes == [(len(plans.VECTOR), explain.BACKGROUND_ROWS)]


def test_registered_tree_impacts(spark, tables):
    """Of two features each walk goes one of two ways: impacts lie between the sums over the background of either."""
    from tidemill.plans import models as plans
    from tidemill.plans.base import QUERIES

    parts, features = plans._sized_parts(tables)
    trained = models.train(parts, "decision_tree_regressor", features, "p_retailprice", {"max_depth": 5})
    rows = sorted((r.p_partkey, r.p_size, r.name_length) for r in parts.collect())
    sizes, lengths = sorted({r[1] for r in rows}), sorted({r[2] for r in rows})
    grid = spark.createDataFrame([(a, b) for a in sizes for b in lengths], "p_size double, name_length double")
    price = {(r.p_size, r.name_length): r.prediction for r in trained.predict(grid).collect()}
    background = rows[:100]
    base = np.mean([price[a, b] for _, a, b in background])
    found = {}
    for r in QUERIES["x2_sampled_shap_tree"](spark, tables.folder).collect():
        found.setdefault(r.p_partkey, {})[r.feature] = r.impact
        assert abs(r.base_value - base) < 1e-6
    assert sorted(found) == [r[0] for r in rows]
    for key, a, b in rows:
        ways = np.array([(price[a, b0] - price[a0, b0], price[a, b] - price[a0, b]) for _, a0, b0 in background])
        assert ways.min(axis=1).mean() - 1e-6 <= found[key]["p_size"] <= ways.max(axis=1).mean() + 1e-6
        assert abs(base + sum(found[key].values()) - price[a, b]) < 1e-6


def test_registered_projection_of_four_columns(spark, tables):
    """The projection against the eigenvectors of the correlations of all four columns."""
    from tidemill.plans import charts as plans
    from tidemill.plans.base import QUERIES

    rows = tables.lineitem.select("l_orderkey", "l_returnflag", *plans.COLUMNS).collect()
    points = np.array([r[2:] for r in rows], float)
    standard = (points - points.mean(axis=0)) / points.std(axis=0)
    values, vectors = np.linalg.eigh(np.cov(standard.T))
    expected = np.abs(standard @ vectors[:, ::-1][:, :2])
    shares = values[::-1][:2] / values.sum()
    found = QUERIES["v8_pca_2d_four_columns"](spark, tables.folder).collect()
    assert len(found) == len(rows) and shares[0] < 0.99
    for i, c in enumerate(("pc1", "pc2")):
        ours = sorted((r.l_orderkey, r.l_returnflag, r[c]) for r in found)
        theirs = sorted((r.l_orderkey, r.l_returnflag, v) for r, v in zip(rows, expected[:, i], strict=True))
        assert [r[:2] for r in ours] == [r[:2] for r in theirs]
        assert np.allclose([r[2] for r in ours], [r[2] for r in theirs], atol=1e-3)
        assert {round(r[f"share{i + 1}"], 5) for r in found} == {round(shares[i], 5)}


def test_walks_down_trees_are_those_of_every_step(table):
    """Steps of a walk that are evaluated together give what scoring each of them gives, for repeated keys too."""
    twice = table.where("id < 30").unionByName(table.where("id < 4").withColumn("a", F.col("a") + 3))
    for name, target in (("decision_tree", "y"), ("random_forest_regressor", "price")):
        trained = models.train(table, name, FEATURES, target, {"max_depth": 6} | ({"n_estimators": 3} if "forest" in name else {}))
        background = explain.background_sample(table, "id", FEATURES, 7)
        together = explain.sampled_shap(trained, twice, "id", FEATURES, background, samples=9)
        assert "MapInArrow" in together._jdf.queryExecution().toString()
        apart = explain.sampled_shap(trained.pipeline, twice, "id", FEATURES, background, samples=9)
        found, want = ({r["id"]: r for r in df.collect()} for df in (together, apart))
        assert len(found) == len(want) == 30
        for i, r in found.items():
            assert r["base_value"] == pytest.approx(want[i]["base_value"])
            assert [e["feature"] for e in r["impacts"]] == FEATURES
            assert [e["impact"] for e in r["impacts"]] == pytest.approx([e["impact"] for e in want[i]["impacts"]], abs=1e-9)


def test_boosting_holds_the_weights_of_a_round(spark, monkeypatch):
    """A tree reads its rows several times: their weights are held meanwhile, and let go afterwards."""
    rows = [(float(i % 7), float(i * 5 % 11), "a" if i * i % 13 < 6 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, label string")
    fit, held = models.C.DecisionTreeClassifier.fit, []

    def watched(self, data, params=None):
        held.append(data.storageLevel.useMemory)
        return fit(self, data, params)

    monkeypatch.setattr(models.C.DecisionTreeClassifier, "fit", watched)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    trained = models.train(df, "adaboost", ["x", "y"], "label", {"n_estimators": 4})
    assert held and all(held) and len(held) >= len(trained.pipeline.stages[-1].models)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_a_forest_grows_on_all_cores(spark, monkeypatch):
    """Rows of one partition are dealt to all cores, and a row's nodes are kept from level to level."""
    df = spark.range(300).select((F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y")).coalesce(1)
    fit, seen = models.R.RandomForestRegressor.fit, []

    def watched(self, data, params=None):
        seen.append((data.rdd.getNumPartitions(), self.getCacheNodeIds()))
        return fit(self, data, params)

    monkeypatch.setattr(models.R.RandomForestRegressor, "fit", watched)
    trained = models.train(df, "random_forest_regressor", ["x"], "y", {"n_estimators": 3})
    assert seen == [(spark.sparkContext.defaultParallelism, True)]
    assert trained.predict(df).count() == 300


def test_parts_of_a_forest_vote_as_one(spark, monkeypatch, tmp_path):
    """Trees that are grown side by side: few partitions each, and the mean over all trees, also once saved and loaded."""
    rows = [(i, float(i % 17), float(i * 5 % 11), "abc"[i * i % 13 % 7 % 3], float(i % 17 * 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, x double, y double, label string, size double")
    fit, seen = models.C.RandomForestClassifier.fit, []

    def watched(self, data, params=None):
        seen.append((data.rdd.getNumPartitions(), self.getNumTrees(), self.getSeed()))
        return fit(self, data, params)

    monkeypatch.setattr(models.C.RandomForestClassifier, "fit", watched)
    trained = models.train(df, "random_forest", ["x", "y"], "label", {"n_estimators": 13})
    forest = trained.pipeline.stages[-1]
    assert [p for p, _, _ in seen] == [1] * len(seen) and len({s for _, _, s in seen}) == len(seen) > 1
    assert sum(forest.trees) == 13 and sum(n for _, n, _ in seen) == 13
    assert abs(models.importances(forest).sum() - 1) < 1e-12

    each = [m.transform(trained.pipeline.stages[0].transform(df)).orderBy("id").collect() for m in forest.models]
    expected = [sum(np.array(part[i]["rawPrediction"]) for part in each) / 13 for i in range(400)]
    found = trained.predict(df).orderBy("id").collect()
    for row, shares in zip(found, expected, strict=True):
        assert np.allclose([row["probability"][c] for c in "abc"], shares, atol=1e-9)
        assert row["prediction"] == "abc"[int(np.argmax(shares))]

    models.save_model(trained, str(tmp_path / "m"))
    again = models.load_model(spark, str(tmp_path / "m"))
    assert again.pipeline.stages[-1].trees == forest.trees
    assert [r["prediction"] for r in again.predict(df).orderBy("id").collect()] == [r["prediction"] for r in found]

    leaves = tree_leaves(spark, forest).collect()
    assert len({r["tree"] for r in leaves}) == 13
    reached = [r["value"] for r in leaves if all(lo < [3.0, 4.0][f] <= hi for f, lo, hi in zip(r["features"], r["low"], r["high"]))]
    point = trained.predict(spark.createDataFrame([(3.0, 4.0)], "x double, y double")).first()
    assert np.allclose(np.sum(reached, axis=0), [point["probability"][c] for c in "abc"], atol=1e-9)

    sized = models.train(df, "random_forest_regressor", ["x"], "size", {"n_estimators": 9})
    assert sum(sized.pipeline.stages[-1].trees) == 9
    worst = sized.predict(df).selectExpr("max(abs(prediction - size)) AS d").first()["d"]
    assert worst < 4


def test_rows_of_a_forest_stay_in_bounded_tasks(spark, monkeypatch):
    """Where a task could not hold the rows, a part of the trees has as many partitions as they need."""
    df = spark.range(300).select((F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    seen = []
    fit = models.R.RandomForestRegressor.fit

    def watched(self, data, params=None):
        seen.append(data.rdd.getNumPartitions())
        return fit(self, data, params)

    monkeypatch.setattr(models.R.RandomForestRegressor, "fit", watched)
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(models, "FOREST_VALUES", 150)
    models.train(df, "random_forest_regressor", ["x"], "y", {"n_estimators": 8})
    assert set(seen) == ({2} if cores >= 4 else {cores})
    seen.clear()
    monkeypatch.setattr(models, "FOREST_VALUES", 1)
    models.train(df, "random_forest_regressor", ["x"], "y", {"n_estimators": 8})
    assert len(seen) == 1 and seen[0] >= cores


def test_a_target_of_many_values_is_not_shuffled(spark):
    """Whether a split goes by classes: a sketch tells many values from few, and few are counted."""
    many = spark.range(5000).select(F.col("id").cast("double").alias("y"))
    found = {n: should_stratify(spark.range(200).select(F.when(F.col("id") % 7 > 0, F.col("id") % n).alias("y")), "y") for n in (9, 10, 11)}
    assert found == {9: True, 10: False, 11: False}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("stratify", "")
    try:
        assert not should_stratify(many, "y")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one aggregate: the stage of its partial sketches and the one that joins them
    assert len(tracker.getJobIdsForGroup("stratify")) <= 2
