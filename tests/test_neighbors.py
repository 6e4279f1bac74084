"""The hash-bucket index against the exact neighbours: recall, probes, ties, types, and models that carry it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.operators import models, neighbors


def clustered(spark, rows=3000, dimensions=12, seed=1, first=0):
    draw = np.random.default_rng(seed)
    centres = np.random.default_rng(0).normal(0, 5, (40, dimensions))
    x = centres[draw.integers(0, 40, rows)] + draw.normal(0, 0.5, (rows, dimensions))
    data = [(first + i, v.tolist(), f"t{i % 5}") for i, v in enumerate(x)]
    return spark.createDataFrame(data, "id long, v array<double>, label string").repartition(4)


def pairs(found):
    return {(r["id"], r["neighbor"]) for r in found.collect()}


def test_recall_with_few_probes(spark):
    train, query = clustered(spark).persist(), clustered(spark, 300, seed=2, first=10_000).persist()
    index = neighbors.build_index(train, "id", "v", "label", scratch_path(spark, "index"), rows_per_bucket=64)
    exact = pairs(models.knn_neighbors(train, query, "id", "v", "label"))
    found = neighbors.approximate_neighbors(index, query, "id", "v").persist()
    assert len(pairs(found) & exact) >= 0.9 * len(exact)
    assert index.hashing.bits == 6 and index.hashing.probes < 32
    vectors = {r["id"]: np.array(r["v"]) for r in train.union(query).collect()}
    labels = {r["id"]: r["label"] for r in train.collect()}
    for r in found.collect():
        assert r["distance2"] == pytest.approx(((vectors[r["id"]] - vectors[r["neighbor"]]) ** 2).sum())
        assert r["label"] == labels[r["neighbor"]]
    assert found.groupBy("id").agg(F.max("rank").alias("m"), F.count("*").alias("n")).where("m <> n OR n > 5").count() == 0


def test_all_probes_are_exact(spark, monkeypatch):
    train = clustered(spark, 700, 5)
    # copies: distances tie, the smaller key comes first, and nobody is its own neighbour
    train = train.union(train.where("id < 30").withColumn("id", F.col("id") + 5000)).persist()
    monkeypatch.setattr(neighbors, "PACK_ROWS", 50)
    monkeypatch.setattr(neighbors, "QUERY_ROWS", 20)
    monkeypatch.setattr(neighbors, "HELD_ROWS", 90)
    index = neighbors.build_index(train, "id", "v", "label", scratch_path(spark, "index"), rows_per_bucket=64)
    whole = neighbors.Hashing(index.hashing.mean, index.hashing.planes, 1 << index.hashing.bits)
    index = neighbors.NeighborIndex(index.path, whole, "id", "label")
    found = neighbors.approximate_neighbors(index, train, "id", "v", 3)
    want = models.knn_neighbors(train, train, "id", "v", "label", 3)
    columns = ["id", "rank", "neighbor", "label"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_probes_are_the_nearest_buckets():
    draw = np.random.default_rng(3)
    hashing = neighbors.Hashing(np.zeros(6), np.linalg.qr(draw.normal(size=(6, 6)))[0][:5])
    x = draw.normal(size=(50, 6))
    found = hashing.probed(x, 32)
    sides = hashing.sides(x)
    assert (found[:, 0] == hashing.buckets(x)).all()
    for row, buckets in zip(sides, found, strict=True):
        own = row > 0
        price = [sum(row[j] ** 2 for j in range(5) if bool(b >> j & 1) != own[j]) for b in buckets.tolist()]
        assert price == sorted(price) and len(set(buckets.tolist())) == 32
    again = neighbors.Hashing.from_json(hashing.to_json())
    assert np.array_equal(again.probed(x, 7), found[:, :7])


def test_few_rows_nulls_and_other_keys(spark):
    schema = "k string, v array<float>, y double"
    train = spark.createDataFrame([("a", [1.0, 2.0], 1.0), ("b", [1.5, 2.0], 2.0), ("c", None, 3.0)], schema)
    index = neighbors.build_index(train, "k", "v", "y", scratch_path(spark, "index"))
    found = neighbors.approximate_neighbors(index, train, "k", "v").collect()
    assert sorted((r["k"], r["neighbor"], r["y"], r["distance2"]) for r in found) == [("a", "b", 2.0, 0.25), ("b", "a", 1.0, 0.25)]
    assert neighbors.approximate_neighbors(index, train.limit(0), "k", "v").count() == 0


def test_a_model_carries_its_index(spark):
    train = clustered(spark, 1500, 6).select("id", "label", *[F.get("v", F.lit(i)).alias(f"x{i}") for i in range(6)]).persist()
    features = [f"x{i}" for i in range(6)]
    exact = models.train(train, "knn_classifier", features, "label")
    quick = models.train(train, "knn_classifier", features, "label", {"algorithm": "hash"})
    path = scratch_path(spark, "model")
    models.save_model(quick, path)
    again = models.load_model(spark, path)
    assert again.pipeline.stages[-1].hashing.probes == quick.pipeline.stages[-1].hashing.probes
    new = train.where("id % 5 = 0")
    found = [{r["id"]: r["prediction"] for r in m.predict(new).collect()} for m in (exact, quick, again)]
    assert found[1] == found[2] and len(found[1]) == 300
    assert sum(found[0][i] == found[1][i] for i in found[0]) >= 0.9 * 300
    with pytest.raises(ValueError, match="algorithm"):
        models.train(train, "knn_classifier", features, "label", {"algorithm": "guess"})


def test_a_query_row_is_not_copied_for_its_buckets(spark):
    """No join, which the planner would broadcast: query rows times buckets are more than it guesses."""
    train = clustered(spark, 600, 6).persist()
    index = neighbors.build_index(train, "id", "v", "label", scratch_path(spark, "index"), rows_per_bucket=32)
    found = neighbors.approximate_neighbors(index, train, "id", "v")
    assert "Join" not in found._jdf.queryExecution().toString()
    assert found.count() == 600 * 5


@pytest.mark.parametrize("bits", [0, 5, 14])
def test_reach_is_the_last_probe(bits):
    draw = np.random.default_rng(3)
    planes = np.linalg.qr(draw.normal(size=(16, 16)))[0][:bits]
    x = draw.normal(size=(40, 16))
    hashing = neighbors.Hashing(np.zeros(16), planes.reshape(-1, 16), 9)
    probed, reach, sides = hashing.probed(x), hashing.reach(x), hashing.sides(x)
    for bucket in np.unique(probed).tolist():
        assert (hashing.looks_into(sides, reach, bucket) == (probed == bucket).any(axis=1)).all()


def test_nearest_of_odd_rows():
    """Rows that are not finite are nobody's neighbour and hide no other row; ties far from the origin go to the smaller key."""
    x = np.array([[np.nan, 0], [1, 0], [np.inf, 1], [2, 0], [0, 2]]) + 1e8
    best = models._Nearest(np.array([90, 91]), np.array([[0.0, 0], [np.nan, 0]]) + 1e8, 2)
    best.offer(np.array([5, 4, 3, 2, 1]), x, np.array(list("abcde"), object))
    found = best.rows()
    assert found.values.tolist() == [[90, 4, "b", 1.0], [90, 1, "e", 4.0]]
