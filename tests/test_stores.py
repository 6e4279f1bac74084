"""Versions in the stores, the run tree, and the sinks."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from tidemill.functions.lineage import scratch_path
from tidemill.operators import quality
from tidemill.sources import runs, stores
from tidemill.sources.stores import FeatureStore, SuiteStore


def test_feature_versions(spark):
    store = FeatureStore(spark, scratch_path(spark, "store"))
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "x double, c string")
    assert store.catalog().count() == 0
    with pytest.raises(FileNotFoundError):
        store.load("f")
    for _ in range(10):
        last = store.create(df, "f", ["x"], ["c"])
    assert last.version == "v10"
    assert store.load("f").version == "v10"  # by number, not by text
    assert store.load("f", "v2").version == "v2"
    with pytest.raises(FileNotFoundError):
        store.load("f", "v11")
    with pytest.raises(FileNotFoundError):
        store.cached("f")
    store.cache(df, "f", 9)
    store.cache(df, "f")
    assert sorted(store.cached("f").columns) == ["c_a", "c_b", "x_scaled"]
    assert store.transform_if_registered(df, "other") is df
    assert store.catalog().count() == 10


def test_suite_versions_and_large_sets(spark, monkeypatch):
    monkeypatch.setattr(quality, "INLINE_SET", 2)
    store = SuiteStore(spark, scratch_path(spark, "suites"))
    df = spark.range(100).selectExpr("concat('v', id % 4) AS c")
    first = store.generate(df, "d")
    assert first.version == "v1"
    assert store.generate(df.limit(5), "d").version == "v1"
    assert store.generate(df, "d", overwrite=True).version == "v2"
    loaded = store.load("d", "latest")
    assert loaded.version == "v2" and loaded.large_sets["c"].count() == 4
    assert all(r["success"] for r in quality.validate(df, loaded).collect())


def test_run_tree(spark, tmp_path):
    run = tmp_path / "7" / "abc"
    for folder in ("metrics", "params"):
        (run / folder).mkdir(parents=True)
    (run / "metrics" / "r2").write_text("1700000000000 -1.5 0\n1700000001000 0.5 1\n")
    (run / "params" / "features").write_text("['a', 'b']")
    (run / "meta.yaml").write_text(
        "end_time: 1700000004500\nexperiment_id: '7'\nrun_id: abc\nrun_name: calm\nstart_time: 1700000000000\nstatus: 3\n"
    )
    version = tmp_path / "models" / "m" / "version-2"
    version.mkdir(parents=True)
    (version / "meta.yaml").write_text(
        "creation_timestamp: 1700000000001\ncurrent_stage: None\nname: m\nrun_id: abc\nstatus: READY\nversion: 2\n"
    )
    root = str(tmp_path)
    assert [tuple(r) for r in runs.run_metrics(spark, root).orderBy("step").collect()] == [
        ("7", "abc", "r2", 1700000000000, -1.5, 0),
        ("7", "abc", "r2", 1700000001000, 0.5, 1),
    ]
    assert tuple(runs.run_params(spark, root).first()) == ("7", "abc", "features", "['a', 'b']")
    assert runs.runs(spark, root).first()["seconds"] == 4.5
    assert tuple(runs.model_versions(spark, root).first()) == ("m", 2, "None", "abc", "READY", 1700000000001)


def test_run_tables(spark):
    root = scratch_path(spark, "run-tables")
    runs.write_run(spark, root, "e", "r1", {"accuracy": 0.9}, {"depth": "3"}, 1700000000000)
    runs.write_run(spark, root, "e", "r2", {"accuracy": 0.8}, {"depth": "4"}, 1700000000000)
    assert spark.read.parquet(f"{root}/metrics").count() == 2
    assert spark.read.parquet(f"{root}/params").count() == 2


def test_two_writers_at_once_get_two_versions(spark):
    store = FeatureStore(spark, scratch_path(spark, "store"))
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "x double, c string")
    store.create(df, "f", ["x"])
    with ThreadPoolExecutor(6) as pool:
        found = list(pool.map(lambda _: store.create(df, "f", ["x"], ["c"]).version, range(6)))
    assert sorted(found) == [f"v{n}" for n in range(2, 8)]
    assert store.load("f").version == "v7" and store.catalog().count() == 7
    with pytest.raises(FileExistsError):
        store.create(df, "f", ["x"], version="v3")


def test_a_cut_off_write_is_never_read(spark):
    root = scratch_path(spark, "store")
    store, df = FeatureStore(spark, root), spark.createDataFrame([(1.0,), (3.0,)], "x double")
    store.create(df, "f", ["x"])
    first = store.cache(df, "f")
    # a table without a manifest, a manifest that was claimed but not written, and half a manifest
    df.write.parquet(f"{root}/features/name=f/version=1/half")
    for number, text in ((2, ""), (3, '{"name": "f", ')):
        stores._claim(spark, f"{root}/schemas/name=f/version={number}/manifest", text)
    stores._claim(spark, f"{root}/cached/name=f@1/version=2/manifest", "")
    assert store.load("f").version == "v1" and store.catalog().count() == 1
    assert store.cached("f").columns == ["x_scaled"] and store.cached("f").count() == 2
    assert store.create(df, "f", ["x"]).version == "v4"
    reading = store.cached("f", 1)
    assert store.cache(df.limit(1), "f", 1) != first
    assert reading.count() == 2 and store.cached("f", 1).count() == 1


def test_suites_at_once(spark):
    store = SuiteStore(spark, scratch_path(spark, "suites"))
    df = spark.range(10).selectExpr("concat('v', id % 4) AS c")
    with ThreadPoolExecutor(3) as pool:
        found = list(pool.map(lambda _: store.generate(df, "d", overwrite=True).version, range(3)))
    assert sorted(found) == ["v1", "v2", "v3"]
