"""Order statistics against brute force, with ties, skew, gaps and missing values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.functions.ordered import with_previous, with_running_sum
from tidemill.functions.ranking import column_quantiles, exact_quantiles, ks_statistic
from tidemill.operators.splits import random_split

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]


def _values(kind):
    rng = random.Random(7)
    if kind == "skewed":  # one value holds a third of the rows
        return [5.0] * 400 + [rng.expovariate(0.1) for _ in range(800)]
    if kind == "ties":
        return [float(rng.randrange(4)) for _ in range(997)]
    if kind == "one":
        return [3.5]
    return [rng.gauss(0, 100) for _ in range(1234)]


@pytest.mark.parametrize("kind", ["smooth", "skewed", "ties", "one"])
@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_column_quantiles(spark, kind, accuracy):
    """A coarse sketch costs more sorting, never a different answer."""
    values = _values(kind)
    rows = [(v,) for v in values] + [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double").repartition(4)
    n, q = column_quantiles(df, ["x"], PROBS, accuracy)["x"]
    assert n == len(values)
    assert q == pytest.approx(list(np.quantile(values, PROBS)))


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_grouped_quantiles(spark, accuracy):
    groups = {k: _values(k) for k in ("smooth", "skewed", "ties", "one")}
    rows = [(k, v, -v) for k, vs in groups.items() for v in vs] + [("empty", None, None), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {(r["g"], r["column"]): r for r in exact_quantiles(df, ["x", "y"], PROBS, ["g"], accuracy).collect()}
    assert set(got) == {(k, c) for k in groups for c in ("x", "y")}
    for k, vs in groups.items():
        assert got[(k, "x")]["n"] == len(vs)
        assert got[(k, "x")]["q"] == pytest.approx(list(np.quantile(vs, PROBS)))
        assert got[(k, "y")]["q"] == pytest.approx(list(np.quantile([-v for v in vs], PROBS)))


def test_grouped_quantiles_without_broadcast(spark, monkeypatch):
    """More groups than may be held: the joins are left to the planner, the answer stays."""
    from tidemill.functions import ranking

    monkeypatch.setattr(ranking, "SMALL_GROUPS", 3)
    rows = [(i % 7, float((i * 37) % 101)) for i in range(700)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r["g"]: r["q"][0] for r in exact_quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {g: pytest.approx(float(np.median([x for k, x in rows if k == g]))) for g in range(7)}


def _brute_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(v <= p for v in a) / len(a) - sum(v <= p for v in b) / len(b)) for p in points)


@pytest.mark.parametrize("partitions", ["1", "8", "64"])
def test_ks_statistic(spark, partitions):
    rng = random.Random(3)
    a = [rng.gauss(0, 1) for _ in range(300)] + [0.5] * 200
    b = [rng.gauss(0.2, 1.3) for _ in range(400)]
    both = spark.createDataFrame([(v, 1.0) for v in a], "x double, same double")
    other = spark.createDataFrame([(v, 1.0) for v in b], "x double, same double")
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["column"]: r for r in ks_statistic(both, other, ["x", "same"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
    assert got["x"]["statistic"] == pytest.approx(_brute_ks(a, b))
    assert got["same"]["statistic"] == 0.0
    assert (got["x"]["n_reference"], got["x"]["n_current"]) == (500, 400)


def test_ks_leaves_out_empty_columns(spark):
    full = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    empty = spark.createDataFrame([(None,)], "x double")
    assert ks_statistic(full, empty, ["x"]).count() == 0


@pytest.mark.parametrize("rows,share", [(150, 0.2), (101, 0.5), (10, 0.1), (7, 0.9)])
def test_split_is_exact_and_stable(spark, rows, share):
    df = spark.range(rows).withColumn("v", F.col("id") * 2)
    first = {r["id"] for r in random_split(df, "id", share).where("is_test").collect()}
    again = {r["id"] for r in random_split(df.repartition(5), "id", share).where("is_test").collect()}
    assert len(first) == math.ceil(share * rows - 1e-9)
    assert first == again
    assert first != {r["id"] for r in random_split(df, "id", share, seed=1).where("is_test").collect()} or rows < 11


def test_stratified_split_of_150(spark):
    df = spark.range(150).withColumn("label", (F.col("id") % 3).cast("int"))
    split = random_split(df, "id", 0.2, stratify="label")
    assert split.where("is_test").count() == 30
    assert {r["count"] for r in split.where("is_test").groupBy("label").count().collect()} == {10}


def test_stratified_split_keeps_skewed_classes(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") < 900, "big").when(F.col("id") < 995, "mid").otherwise("tiny"))
    counts = {r["label"]: r["count"] for r in random_split(df, "id", 0.2, stratify="label").where("is_test").groupBy("label").count().collect()}
    assert counts == {"big": 180, "mid": 19, "tiny": 1}


def test_unlabelled_rows_stay(spark):
    df = spark.range(50).withColumn("label", F.when(F.col("id") < 40, "a"))
    split = random_split(df, "id", 0.5, stratify="label")
    assert (split.count(), split.where("is_test").count()) == (50, 20)
    assert split.where("is_test and label is null").count() == 0


def test_split_size_is_checked(spark):
    with pytest.raises(ValueError):
        random_split(spark.range(10), "id", 0.95)


def test_chunks_do_not_show(spark):
    """Previous value and running sum are those of the whole key, wherever the chunks end."""
    rng = random.Random(5)
    rows = sorted((rng.choice("aab"), t, rng.randrange(9)) for t in range(200))
    df = spark.createDataFrame(rows, "k string, t int, v int").withColumn("part", (F.col("t") / 17).cast("int"))
    out = with_running_sum(with_previous(df, ["k"], ["t"], ["v"], "part"), ["k"], ["t"], F.col("v"), "total", "part")
    got = {(r["k"], r["t"]): (r["prev_v"], r["total"]) for r in out.collect()}
    for key in "ab":
        before, total = None, 0
        for _, t, v in [r for r in rows if r[0] == key]:
            total += v
            assert got[(key, t)] == (before, total)
            before = v


def test_only_rows_at_the_border_of_a_selection_move(spark):
    """The border of a selection is sent to the rows, not the rows to it."""
    from tidemill.functions import ranking

    seen = []
    whole = ranking.small_or_none
    rows = spark.range(0, 20_000, 1, 4)

    def watched(df, most):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df, most)

    old, ranking.small_or_none = ranking.small_or_none, watched
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ranking.smallest_by_hash(rows, "id", 1, spark.createDataFrame([(700,)], "quota bigint"))
    finally:
        ranking.small_or_none = old
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert found.where("selected").count() == 700
    assert "BroadcastHashJoin" in seen[-1] and "SortMergeJoin" not in seen[-1]
