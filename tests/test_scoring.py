"""Scored request batches: the log, replays, cut-off batches, rejected requests and registered features."""

import pytest
from pyspark.sql import functions as F
from test_streaming import at, write_batches

from tidemill.functions.lineage import scratch_path
from tidemill.operators import abtest, models
from tidemill.sources.stores import FeatureStore
from tidemill.streaming import monitor as streams
from tidemill.streaming import scoring

SCHEMA = "id bigint, u string, ts timestamp_ntz, x double, z string"
TEST = abtest.ABTest("t", [{"name": "a", "model_name": "m"}, {"name": "b", "model_name": "n"}], [0.5, 0.5])


@pytest.fixture(scope="module")
def trained(spark):
    rows = spark.createDataFrame([(float(i), float(2 * i), "big" if i > 5 else "small") for i in range(12)], "x double, y double, c string")
    return models.train(rows, "linear_regression", ["x"], "y"), models.train(rows, "decision_tree", ["x"], "c")


def requests(first, count):
    return [(i, f"u{i % 7}", at(i), None if i % 10 == 3 else float(i % 12), "extra") for i in range(first, first + count)]


def scorer(spark, trained, **options):
    fitted = {("m", "latest"): trained[0], ("n", "latest"): trained[1]}
    options = {"test": TEST, "ranges": {"m": {"x": (0.0, 10.0)}}} | options
    return scoring.Scorer(scratch_path(spark, "scored"), fitted, "id", "u", "ts", now=lambda: F.lit("2024-01-02").cast("timestamp"), **options)


def test_a_stream_of_batches(spark, trained):
    batches = [requests(0, 30), requests(30, 20), requests(50, 25)]
    path = write_batches(spark, SCHEMA, batches)
    job = scorer(spark, trained)
    stream = streams.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    job.run(stream, scratch_path(spark, "state"))
    log = {int(r["request"]): r for r in scoring.prediction_log(spark, job.root).collect()}
    rejected = {int(r["request"]): r for r in scoring.rejected_requests(spark, job.root).collect()}
    assert set(log) | set(rejected) == set(range(75)) and not set(log) & set(rejected)
    variants = {r["id"]: r["variant"] for r in abtest.assign_variants(spark.read.parquet(path), TEST, ["u"]).collect()}
    for i, r in rejected.items():
        assert r["errors"] == (["x: missing value"] if i % 10 == 3 else ["x: above 10.0"])
        assert variants[i] == "a" or i % 10 == 3
    for i, r in log.items():
        assert r["variant"] == variants[i] and r["latency"] == 86400 - i
        if r["variant"] == "a":
            assert float(r["prediction"]) == pytest.approx(2 * (i % 12)) and r["confidence"] is None and r["metrics"] is None
        else:
            assert r["metrics"] == {"confidence": r["confidence"]}
            assert r["prediction"] == ("big" if i % 12 > 5 else "small")
    assert scoring.ledger(spark, job.root).agg(F.sum("scored"), F.sum("rejected"), F.count("*")).first()[:] == (len(log), len(rejected), 3)


def test_replays_and_cut_off_batches(spark, trained):
    job = scorer(spark, trained, test=None, model=("m", "latest"), ranges={})
    assert scoring.prediction_log(spark, job.root).count() == 0
    batch = spark.createDataFrame([r for r in requests(0, 9) if r[3] is not None], SCHEMA)
    assert job.process(batch, 0)
    assert not job.process(batch, 0)
    assert scoring.prediction_log(spark, job.root).count() == 8
    # written but not in the ledger: not there, and written anew when the batch comes again
    done = f"{job.root}/log/job=scoring/batch=1"
    spark.read.parquet(f"{job.root}/log/job=scoring/batch=0").write.parquet(done)
    assert scoring.prediction_log(spark, job.root).count() == 8
    assert job.process(batch.limit(3), 1)
    assert scoring.prediction_log(spark, job.root).count() == 11
    other = scorer(spark, trained, test=None, model=("m", "latest"), ranges={}, job="second")
    other.root = job.root
    assert other.process(batch.limit(2), 0)
    assert scoring.prediction_log(spark, job.root).count() == 13


def test_registered_features_and_missing_models(spark, trained):
    rows = spark.createDataFrame([(float(i), float(3 * i)) for i in range(10)], "x double, y double")
    store = FeatureStore(spark, scratch_path(spark, "store"))
    store.create(rows, "m", ["x"])
    scaled = store.transform(rows, "m").withColumn("y", F.col("x_scaled") * 5)
    fitted = models.train(scaled, "linear_regression", ["x_scaled"], "y")
    job = scorer(spark, (fitted, trained[1]), store=store, ranges={})
    job.models = {("m", "latest"): fitted}
    assert job.process(spark.createDataFrame(requests(0, 20), SCHEMA), 0)
    log = scoring.prediction_log(spark, job.root).collect()
    deviation = (sum((i - 4.5) ** 2 for i in range(10)) / 10) ** 0.5
    assert len(log) > 3
    for r in log:
        i = int(r["request"])
        x = 4.5 if i % 10 == 3 else i % 12
        assert float(r["prediction"]) == pytest.approx(5 * (x - 4.5) / deviation, abs=0.6)
    assert {tuple(r["errors"]) for r in scoring.rejected_requests(spark, job.root).collect()} == {("model not found",)}


def test_variants_are_drawn_once_a_batch(spark, trained, monkeypatch):
    """What both tables and all models read is held: the columns that are read, with variant and model."""
    held = []
    whole = scoring.Scorer.score_assigned

    def watched(self, assigned, columns):
        held.append((assigned.columns, assigned.storageLevel.useMemory))
        return whole(self, assigned, columns)

    monkeypatch.setattr(scoring.Scorer, "score_assigned", watched)
    job = scorer(spark, trained)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    batch = spark.createDataFrame(requests(0, 30), SCHEMA)
    assert job.process(batch.withColumnRenamed("u", "U"), 0)
    assert held == [(["id", "U", "ts", "x", "variant", "model_name", "model_version"], True)]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert scoring.prediction_log(spark, job.root).count() + scoring.rejected_requests(spark, job.root).count() == 30
