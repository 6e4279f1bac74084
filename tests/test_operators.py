"""Edge cases: empty tables, missing values, ties, unknown names, resets and thresholds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemill.operators import abtest, charts, drift, evaluate, explain, logs, monitor, profile, quality, registry, splits
from tidemill.operators import features as fs
from tidemill.sources.tables import drop_empty_rows, read_table

NAN = float("nan")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# --- profiling ---


def test_validate_dataset_messages(spark):
    def verdict(rows, schema):
        return profile.validate_dataset(spark.createDataFrame(rows, schema)).first()

    assert verdict([], "a int, b int")["message"] == "Dataset is empty"
    assert verdict([(1, 2)] * 9, "a int, b int")["message"] == "Dataset has fewer than 10 samples"
    assert not verdict([(1,)] * 12, "a int")["valid"]
    fine = verdict([("x", None)] * 12, "a string, b string")
    assert fine["valid"]
    assert fine["warnings"] == [
        "Columns with >50% missing values: b",
        "Dataset has no numeric columns, which might limit model choices",
    ]


def test_empty_table_profiles(spark):
    empty = spark.createDataFrame([], "a double, b string")
    assert profile.dataset_info(empty).first()["has_missing_values"] is False
    assert profile.infer_target(empty).first()[0] is None
    assert profile.suggest_features(empty, "b").count() == 0
    assert profile.detect_task(empty, "a").first()[0] == "classification"
    assert profile.describe(empty, ["a"]).first()["count"] == 0


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,), (3.0,)], "x double")
    row = profile.describe(df).first()
    assert (row["count"], row["mean"], row["max"], row["q50"]) == (2, 2.0, 3.0, 2.0)
    assert profile.missing_rate(df).first()["missing_rate"] == 0.5


def test_infer_target_prefers_known_names_then_first_of_equals(spark):
    assert profile.infer_target(spark.createDataFrame([(1, 2)], "x int, label int")).first()[0] == "label"
    many = spark.range(1000).select("id", (F.col("id") % 3).alias("p"), (F.col("id") % 3).alias("q"))
    assert profile.infer_target(many).first()[0] == "p"
    assert profile.infer_target(spark.range(1000).select("id", (-F.col("id")).alias("m"))).first()[0] is None


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert profile.most_frequent(profile.value_frequencies(df, ["c"])).first()["most_common"] == "a"


def test_detect_task(spark):
    def task(values):
        return profile.detect_task(spark.createDataFrame([(v,) for v in values], "y double"), "y").first()[0]

    assert task([float(i % 15) for i in range(60)]) == "classification"  # integer-like, under 20 values
    assert task([i % 15 + 0.5 for i in range(60)]) == "regression"
    assert task([float(i) for i in range(60)]) == "regression"


# --- quality ---


def test_suite_edge_columns(spark):
    df = spark.createDataFrame([(None, 1.0, "a")] * 20, "empty double, constant double, c string")
    suite = quality.generate_suite(df, "d")
    result = {(r["expectation_type"], r["column"]): r for r in quality.validate(df, suite).collect()}
    assert all(r["success"] for r in result.values())
    mostly = {e["kwargs"]["column"]: e["kwargs"]["mostly"] for e in suite.expectations if e["expectation_type"] == quality.NOT_NULL}
    assert mostly["empty"] == 0.0  # clamped, not negative
    assert mostly["constant"] == pytest.approx(0.95)


def test_validation_failures_errors_and_unknown_types(spark):
    suite = quality.Suite(
        "d",
        "v1",
        [
            {"expectation_type": "expect_the_unexpected", "kwargs": {}},
            {"expectation_type": quality.NOT_NULL, "kwargs": {"column": "gone", "mostly": 0.5}},
            {"expectation_type": quality.MEAN_BETWEEN, "kwargs": {"column": "s", "min_value": 0, "max_value": 1}},
            {"expectation_type": quality.IN_SET, "kwargs": {"column": "s", "value_set": ["a"], "mostly": 0.7}},
            {"expectation_type": quality.VALUES_BETWEEN, "kwargs": {"column": "x", "min_value": 0.0, "max_value": 2.0, "mostly": 0.99}},
        ],
    )
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), (None, NAN), ("a", 3.0)], "s string, x double")
    result = {r["position"]: r for r in quality.validate(df, suite).collect()}
    assert set(result) == {1, 2, 3, 4}
    assert "not found" in result[1]["error"] and "not numeric" in result[2]["error"]
    assert result[3]["observed"] == pytest.approx(2 / 3) and not result[3]["success"]
    assert result[4]["observed"] == pytest.approx(2 / 3)
    summary = quality.summarize(quality.validate(df, suite)).first()
    assert (summary["passed"], summary["total_expectations"], summary["success_percent"]) == (False, 4, 0.0)


def test_existing_suite_is_kept(spark):
    df = spark.range(5)
    first = quality.generate_suite(df, "d")
    assert quality.generate_suite(spark.range(50), "d", existing=first) is first
    assert quality.generate_suite(spark.range(50), "d", existing=first, overwrite=True) is not first


def test_value_set_beyond_inline_limit(spark, monkeypatch):
    monkeypatch.setattr(quality, "INLINE_SET", 2)
    df = spark.range(100).select(F.concat(F.lit("v"), F.col("id") % 5).alias("c"))
    suite = quality.generate_suite(df, "d")
    assert set(suite.large_sets) == {"c"}
    odd = spark.createDataFrame([("v1",)] * 9 + [("zz",)], "c string")
    shares = [r["observed"] for r in quality.validate(odd, suite).collect() if r["expectation_type"] == quality.IN_SET]
    assert shares == [0.9]


def test_row_rules(spark):
    df = spark.createDataFrame([(5.0, 3.0, 1.4, 0.2), (9.0, NAN, 1.4, 0.2)], "sepal_length double, sepal_width double, petal_length double, petal_width double")
    good, bad = quality.row_errors(df, quality.schema_ranges("iris")).orderBy("sepal_length").collect()
    assert good["is_valid"] and good["errors"] == []
    assert bad["errors"] == ["sepal_length: above 8.0", "sepal_width: missing value"]
    missing = quality.row_errors(df.drop("petal_width"), quality.schema_ranges("iris")).first()
    assert missing["errors"] == ["petal_width: field required"]
    assert quality.schema_verdict(quality.row_errors(df.limit(0), quality.schema_ranges("iris"))).first()["is_valid"]
    with pytest.raises(ValueError):
        quality.schema_ranges("unknown")
    assert quality.model_ranges("iris-classifier") == quality.schema_ranges("iris")
    assert quality.row_errors(df, quality.model_ranges("other")).where("is_valid").count() == 2


# --- features ---


def test_constant_and_empty_numeric_features(spark):
    df = spark.createDataFrame([(2.0, None)] * 3, "c double, e double")
    out = fs.transform(df, fs.fit_feature_set(df, "f", ["c", "e"])).first()
    assert (out["c_scaled"], out["e_scaled"]) == (0.0, 0.0)


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert fs.fit_numeric(df, ["x"])["x"] == {"mean": 2.0, "sd": 1.0}


def test_target_must_not_be_a_feature(spark):
    with pytest.raises(ValueError):
        fs.fit_feature_set(spark.range(3), "f", ["id"], target="id")


def test_missing_required_feature(spark):
    with pytest.raises(ValueError, match="not in the table: y"):
        fs.require_features(spark.range(3), ["id", "y"])


# --- readers ---


def test_reader_rejects_other_formats(spark):
    with pytest.raises(ValueError, match="no reader for files ending in .xml"):
        read_table(spark, "/tmp/x.xml")


def test_json_array_document(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"a": 1, "b": "x"}, {"a": null, "b": null}, {"a": 2, "b": null}]')
    assert read_table(spark, str(tmp_path / "d.json")).count() == 2


def test_rows_empty_throughout(spark):
    df = spark.createDataFrame([(NAN, None), (None, "x"), (None, None), (1.0, None)], "a double, b string")
    assert drop_empty_rows(df).count() == 2


# --- evaluation ---


def test_classification_with_no_hits(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a")], "y string, p string")
    assert tuple(evaluate.classification_metrics(df, "y", "p").first()) == (0.0, 0.0, 0.0, 0.0)


def test_perfect_regression_has_no_explained_variance(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "y double, p double")
    row = evaluate.regression_metrics(df, "y", "p").first()
    assert row["r2"] == 1.0 and row["explained_variance"] is None


# --- drift ---


def test_chi_square_tail():
    assert drift._chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05)
    assert drift._chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05)
    assert drift._chi_square_tail(124.34211340400407, 100) == pytest.approx(0.05)
    assert drift._chi_square_tail(0.0, 3) == 1.0


def test_no_drift_between_equal_tables(spark):
    df = spark.range(200).select((F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("c"))
    found = {r["column"]: r for r in drift.column_drift(df, df).collect()}
    assert not found["x"]["drift_detected"] and not found["c"]["drift_detected"]
    assert found["x"]["statistic"] == 0.0
    assert drift.target_drift(df, df) is None
    assert {r["psi"] for r in drift.psi_numeric(df, df, ["x"]).collect()} == {0.0}


def test_new_category_is_drift(spark):
    old = spark.createDataFrame([("a",)] * 50, "c string")
    new = spark.createDataFrame([("b",)] * 50, "c string")
    row = drift.categorical_drift(old, new, ["c"]).first()
    assert row["drift_detected"] and row["total_variation"] == 1.0


def test_severity_bands(spark):
    scores = spark.createDataFrame([(0.05,), (0.1,), (0.2,)], "score double")
    assert [r["severity"] for r in drift.drift_severity(scores).collect()] == ["green", "yellow", "red"]


# --- A/B tests ---


def two_variants(**kwargs):
    return abtest.ABTest("t", [{"name": "a", "model_name": "m"}, {"name": "b", "model_name": "m"}], **kwargs)


def test_config_checks():
    with pytest.raises(ValueError, match="two variants"):
        abtest.ABTest("t", [{"name": "a", "model_name": "m"}])
    with pytest.raises(ValueError, match="one traffic share for each"):
        two_variants(traffic_split=[1.0])
    with pytest.raises(ValueError, match="add up to 1"):
        two_variants(traffic_split=[0.5, 0.4])
    assert two_variants().traffic_split == [0.5, 0.5]
    assert two_variants().variants[0]["model_version"] == "latest"


def test_split_is_followed(spark):
    assigned = abtest.assign_variants(spark.range(20_000), two_variants(traffic_split=[0.8, 0.2]), ["id"])
    share = assigned.where("variant = 'a'").count() / 20_000
    assert abs(share - 0.8) < 0.01


def test_gap_equal_to_ttl_stays(spark):
    at = dt.datetime(2024, 1, 1, 23, 30)
    hits = [at, at + dt.timedelta(seconds=3600), at + dt.timedelta(seconds=7201)]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(hits)], "u int, i int, ts timestamp_ntz")
    sessions = {r["i"]: r["session"] for r in abtest.with_sessions(df, "u", "ts", "i", 3600).collect()}
    assert sessions == {0: 1, 1: 1, 2: 2}


def test_unknown_variants_and_empty_variants(spark):
    log = spark.createDataFrame([("a", 0.1), ("x", 9.0)], "variant string, latency double")
    got = {r["variant"]: r for r in abtest.ab_results(log, two_variants()).collect()}
    assert got["a"]["count"] == 1 and got["a"]["latency_max"] == 0.1
    assert got["b"]["count"] == 0 and got["b"]["latency_mean"] is None


def test_only_scalar_predictions_are_counted(spark):
    log = spark.createDataFrame([("a", [1.0]), ("a", [1.0, 2.0]), ("a", [])], "variant string, prediction array<double>")
    assert [r["count"] for r in abtest.prediction_histogram(log, two_variants(), 0, 10, 5).collect()] == [1]


# --- registry ---


VERSIONS = [("m", 1, "Archived"), ("m", 2, "Production"), ("m", 10, "Staging"), ("m", 3, "Development"), ("n", 1, "None")]


def versions(spark):
    return spark.createDataFrame(VERSIONS, "model string, version int, stage string")


def test_latest_is_numeric(spark):
    assert rows_of(registry.latest_version(versions(spark)).select("model", "version")) == [("m", 10), ("n", 1)]
    with pytest.raises(ValueError):
        registry.latest_version(versions(spark), "Retired")


def test_rollback_to_staging_and_to_version(spark):
    asked = spark.createDataFrame([("m", None), ("n", None)], "model string, to_version int")
    assert rows_of(registry.rollback(versions(spark), asked)) == [
        ("m", 2, "Production", "Archived"),
        ("m", 10, "Staging", "Production"),
    ]
    back = spark.createDataFrame([("m", 1)], "model string, to_version int")
    assert ("m", 1, "Archived", "Production") in rows_of(registry.rollback(versions(spark), back))


def test_error_metrics_are_better_when_lower(spark):
    first = spark.createDataFrame([("mae", 1.0), ("accuracy", 1.0), ("val_loss", 2.0), ("only", 1.0)], "metric string, value double")
    second = spark.createDataFrame([("mae", 2.0), ("accuracy", 2.0), ("val_loss", 2.0)], "metric string, value double")
    got = {r["metric"]: r["first_better"] for r in registry.compare_metrics(first, second).collect()}
    assert got == {"mae": True, "accuracy": False, "val_loss": False}


# --- monitoring ---


def at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_counter_reset_and_rate(spark):
    samples = [("s", at(t), v) for t, v in [(0, 10.0), (15, 16.0), (30, 4.0), (45, 10.0)]]
    df = spark.createDataFrame(samples, "s string, ts timestamp_ntz, value double")
    grown = [r["increase"] for r in monitor.counter_increases(df, ["s"]).orderBy("ts").collect()]
    assert grown == [None, 6.0, 4.0, 6.0]
    last = monitor.instant_rate(df, ["s"]).first()["rate"]
    assert last == pytest.approx(6 / 15)


def test_no_spike_after_a_gap_in_the_samples(spark):
    samples = [("s", at(t), v) for t, v in [(0, 0.0), (15, 3.0), (3000, 900.0), (3015, 906.0)]]
    df = spark.createDataFrame(samples, "s string, ts timestamp_ntz, value double")
    rates = {r["window_end"] - 1704067200: r["rate"] for r in monitor.counter_rate(df, ["s"], 60, 15).collect()}
    assert rates == {t: 3 / 60 for t in (30, 45, 60)} | {t: 6 / 60 for t in (3030, 3045, 3060)}


def test_zero_traffic_has_a_rate_and_fires(spark):
    events = spark.createDataFrame([(at(t),) for t in (0, 5, 1200)], "ts timestamp_ntz")
    rates = monitor.throughput(events, "ts", [], 60, 15)
    got = {r["window_end"] - 1704067200: r["rate"] for r in rates.collect()}
    assert sorted(got) == list(range(15, 1261, 15)) and got[60] == 2 / 60 and got[600] == 0
    rule = monitor.AlertRule("LowThroughput", "<", 0.01, 900, "warning")
    fired = monitor.alert_episodes(rates, rule, 15, value="rate").collect()
    assert [(r["active_at"] - 1704067200, r["fired_at"] - 1704067200) for r in fired] == [(75, 975)]


def test_sliding_sums_of_days_and_labels(spark):
    """Running sums against every row copied to every window."""
    rows = [(at(t * 4001 % 400_000), f"k{t % 3}", t % 7) for t in range(300)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, k string, v int")
    got = {(r["k"], r["window_end"]): r["s"] for r in monitor.sliding_sums(df, "ts", ["k"], {"s": F.col("v")}, 3600, 300).collect()}
    expected = {}
    for ts, k, v in rows:
        start = int((ts - dt.datetime(1970, 1, 1)).total_seconds()) // 300 * 300
        for end in range(start + 300, start + 3601, 300):
            expected[k, end] = expected.get((k, end), 0) + v
    assert got == expected


def test_window_must_be_whole_steps(spark):
    with pytest.raises(ValueError):
        monitor.event_rate(spark.createDataFrame([(at(0),)], "ts timestamp_ntz"), "ts", [], 100, 15)


def test_histogram_quantile_edges(spark):
    def quantile(rows, q):
        return monitor.histogram_quantile(spark.createDataFrame(rows, "g string, le double, count bigint"), q, ["g"]).collect()

    inf = float("inf")
    rows = [("g", 1.0, 2), ("g", 2.0, 4), ("g", inf, 5)]
    assert quantile(rows, 0.2)[0]["quantile"] == pytest.approx(0.5)
    assert quantile(rows, 0.6)[0]["quantile"] == pytest.approx(1.5)
    assert quantile(rows, 0.99)[0]["quantile"] == 2.0
    assert quantile([("g", 1.0, 0), ("g", inf, 0)], 0.5) == []


def test_alert_holds_and_gaps(spark):
    rule = monitor.AlertRule("r", ">", 1.0, 30, "warning")
    on = [0, 15, 30, 45, 75, 90, 120, 135, 150]
    series = spark.createDataFrame([(t, 2.0) for t in on] + [(60, 0.0)], "window_end bigint, value double")
    got = rows_of(monitor.alert_episodes(series, rule, 15).select("active_at", "fired_at", "last_at"))
    assert got == [(0, 30, 45), (120, 150, 150)]


def test_all_rules_have_a_direction():
    assert {r.comparison for r in monitor.ALERT_RULES} == {">", "<"}
    assert len(monitor.ALERT_RULES) == 7


def test_messages(spark):
    lines = ['x error="disk full" y', "Exception: late", "Error: bad", "Error: bad", "fine"]
    df = spark.createDataFrame([(v,) for v in lines], "line string")
    assert rows_of(logs.top_messages(df)) == [("bad", 2), ("disk full", 1), ("late", 1)]


def test_json_lines_that_do_not_parse(spark):
    df = spark.createDataFrame([('{"s": 0.2}',), ('{"s": "x"}',), ("s 0.5",), ('{"s": 0.1}',)], "line string")
    assert [r["value"] for r in logs.json_field_above(df, "s", 0.1).collect()] == [0.2]


# --- explanations and charts ---


def test_impacts_add_up(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 4.0, None)], "id int, a double, b double")
    weights = {"a": 2.0, "b": -1.0}
    for r in explain.linear_shap(df, "id", weights, 5.0).collect():
        total = r["base_value"] + sum(i["impact"] for i in r["impacts"])
        assert total == pytest.approx(5.0 + sum(weights[i["feature"]] * i["value"] for i in r["impacts"]))


def test_top_impacts_order(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0, -9.0)], "id int, a double, b double, c double")
    means = {"a": 0.0, "b": 0.0, "c": 0.0}
    explained = explain.linear_shap(df, "id", {"a": 1.0, "b": 1.0, "c": 1.0}, 0.0, means)
    assert [i["feature"] for i in explain.top_impacts(explained, 2).first()["impacts"]] == ["c", "b"]
    assert len(explain.top_impacts(explained, 0).first()["impacts"]) == 3


def test_constant_histogram_has_one_bin(spark):
    df = spark.createDataFrame([(2.0,)] * 3 + [(None,)], "x double")
    assert [(r["bin"], r["count"]) for r in charts.histogram(df, ["x"]).collect()] == [(0, 3)]


def test_unknown_chart(spark):
    with pytest.raises(ValueError, match="no chart is named radar"):
        charts.chart_data(spark.range(1), "radar")


def test_charts_take_all_columns(spark):
    df = spark.range(1).select("id", F.lit("s").alias("s"), *[F.lit(i).alias(f"c{i}") for i in range(6)])
    numbers = ["id", *[f"c{i}" for i in range(6)]]
    assert charts.pair_columns(df, None, "s").columns == [*numbers, "s"]
    assert {r["column"] for r in charts.histogram(df).collect()} == set(numbers)
    many = spark.range(200).select((F.col("id") % 150).alias("v"))
    assert charts.count_plot(many, "v").count() == 150 and charts.value_counts(many, "v", 3).count() == 3


def test_split_size_is_exact_when_the_key_repeats(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    assert splits.random_split(df, "k", 0.25).where("is_test").count() == 250


def test_column_names_and_values_with_quotes(spark):
    df = spark.createDataFrame([("it's", 1.0), ("a\\b", 2.0)] * 20, "`it's \\\\ odd` string, `x.y` double")
    suite = quality.generate_suite(df, "d")
    results = quality.validate(df, suite).collect()
    assert all(r["success"] for r in results) and len(results) == 8
    assert {r["column"] for r in results} == {None, *df.columns}
    gone = quality.validate(df.drop(df.columns[0]), suite).collect()
    assert sum(r["error"] is not None for r in gone) == 2
