"""Drift from stored sketches, and categories by dictionary, against their exact and wide forms."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions.lineage import scratch_path
from tidemill.operators import drift, features
from tidemill.operators.dictionary import fit_dictionary, sparse_features
from tidemill.operators.drift_store import DriftStore, error_bound

DAY = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(4)
    rows = []
    for i in range(24_000):
        day = i % 12
        x = float(draw.normal(0.02 * day, 1))
        rows.append((DAY + dt.timedelta(days=day, minutes=i % 1000), x, float(draw.integers(0, 5) + (day > 8)), None if i % 50 == 0 else float(draw.exponential()), "abc"[draw.integers(0, 3 - (day > 8))]))
    return spark.createDataFrame(rows, "ts timestamp_ntz, x double, k double, e double, c string").persist()


def between(table, first, last):
    return table.where((F.col("ts") >= F.lit(DAY + dt.timedelta(days=first))) & (F.col("ts") < F.lit(DAY + dt.timedelta(days=last))))


def test_drift_of_stored_periods(spark, table):
    store = DriftStore(spark, scratch_path(spark, "drift-store"))
    # two batches, one of them twice, and days that both of them have
    store.append(table.where("x < 0"), "ts", ["x", "k", "e"], ["c"], "one")
    for _ in range(2):
        store.append(table.where("x >= 0"), "ts", ["x", "k", "e"], ["c"], "two")
    for a, b in [((0, 6), (6, 12)), ((0, 1), (11, 12)), ((2, 4), (4, 6))]:
        periods = [tuple(str((DAY + dt.timedelta(days=d)).date()) for d in p) for p in (a, b)]
        sides = [between(table, *p) for p in (a, b)]
        exact = {r["column"]: r for r in drift.numeric_drift(*sides, ["x", "k", "e"]).collect()}
        found = {r["column"]: r for r in store.numeric_drift(*periods).collect()}
        assert set(found) == {"x", "k", "e"}
        for c, r in found.items():
            assert (r["n_reference"], r["n_current"]) == (exact[c]["n_reference"], exact[c]["n_current"])
            assert abs(r["statistic"] - exact[c]["statistic"]) <= error_bound()
        whole = drift.categorical_drift(*sides, ["c"]).first()
        ours = store.categorical_drift(*periods).first()
        assert ours["statistic"] == pytest.approx(whole["statistic"]) and ours["dof"] == whole["dof"]
        assert {r["column"]: r["drift_detected"] for r in store.column_drift(*periods).collect()}["c"] == whole["drift_detected"]
    assert store.column_drift(("2020-01-01", "2020-01-02"), periods[0]).count() == 0
    assert DriftStore(spark, scratch_path(spark, "empty")).column_drift(*periods).count() == 0


def test_a_comparison_reads_no_raw_row(spark, table):
    store = DriftStore(spark, scratch_path(spark, "drift-store"))
    store.append(table, "ts", ["x"], [], "all")
    plan = store.numeric_drift(("2024-03-01", "2024-03-03"), ("2024-03-05", "2024-03-09"))._jdf.queryExecution().toString()
    assert "kll_merge_agg" in plan.lower() and "LogicalRDD" not in plan


def test_dictionary_as_the_wide_form(spark):
    draw = np.random.default_rng(2)
    rows = [(i, None if i % 9 == 0 else f"v{draw.integers(30)}", ["x", "y", None][i % 3], float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, a string, b string, n double").repartition(3)
    fitted = fit_dictionary(df, ["a", "b"], numeric=["n"])
    wide = features.fit_feature_set(df, "f", ["n"], ["a", "b"])
    assert fitted.width == len(wide.outputs) and fitted.size["b"] == 2
    new = df.union(spark.createDataFrame([(900, "unknown", "y", 1.0), (901, None, None, None)], df.schema))
    dense = {r["id"]: list(r)[1:] for r in features.transform(new, wide, ["id"]).collect()}
    for r in sparse_features(new, fitted, ["id"]).collect():
        row = [0.0] * r["size"]
        for i, v in zip(r["indices"], r["values"], strict=True):
            row[i] = v
        assert row == pytest.approx(dense[r["id"]])
    less = {r["id"]: r for r in sparse_features(df, fitted, ["id"], drop_first=True).collect()}
    first = sorted({r[1] for r in rows if r[1]})[0]
    for i, a, b, _ in rows:
        gone = ((a or fitted.mode["a"]) == first) + ((b or fitted.mode["b"]) == "x")
        assert len(less[i]["indices"]) == 3 - gone


def test_a_million_categories(spark):
    df = spark.range(1_000_000).select(F.col("id"), F.concat(F.lit("k"), F.col("id") * 7).alias("c"), F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("h"))
    fitted = fit_dictionary(df, ["c", "h"])
    assert fitted.size == {"c": 1_000_000, "h": 2} and fitted.width == 1_000_002
    table = fitted.table(spark).where("column = 'c'")
    assert table.agg(F.min("index"), F.max("index"), F.countDistinct("index")).first()[:] == (0, 999_999, 1_000_000)
    order = table.select("value", F.lag("value").over(Window.orderBy("index")).alias("before"))
    assert order.where("before >= value").count() == 0
    found = sparse_features(df, fitted, ["id"])
    assert found.where(F.size("indices") == 2).count() == 1_000_000


def test_no_rows_and_empty_columns(spark):
    df = spark.createDataFrame([(1, None)], "id long, c string")
    fitted = fit_dictionary(df, ["c"])
    assert fitted.width == 0 and sparse_features(df, fitted, ["id"]).first()["indices"] == []
    assert fit_dictionary(df.limit(0), ["c"]).size == {"c": 0}
