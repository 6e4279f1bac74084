import math
import random

import pytest
from oracle import connect, difference

import __spark_entry__ as entry_points
from tidemill.llm import topk

SMALL = "/root/testdata/sf0.001"


def plain(rows, k, every):
    whole = [
        (i, [math.floor(1024 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, v in {(i, tuple(v)) for i, v in whole if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, c, strict=True)), i) for i, c in whole if i != q and len(c) == len(v))
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return sorted(out)


def test_query_against_its_sql(spark):
    assert difference(connect(SMALL), entry_points.oracle_sql()["op6_exact_top_k"], entry_points.queries()["op6_exact_top_k"](spark, SMALL)) is None


@pytest.mark.parametrize("block", [8192, 3])
def test_nasty_rows(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1) for _ in range(16)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 16) for i in range(30)]  # ties
    rows += [(300, [1.0, float("nan")]), (310, None), (320, [float("inf")] * 16), (330, [None] * 16), (None, [0.5] * 16)]
    rows += [(340, [0.25] * 7), (341, [0.5] * 7), (350, []), (351, []), (360, [1.0, 2.0]), rows[7], rows[8]]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(5)
    rounded = [(r.vec_id, r.embedding) for r in df.collect()]
    found = topk.top_k(df, 4, 10)
    assert sorted(map(tuple, found.collect())) == plain(rounded, 4, 10)


def test_equal_query_rows_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, 3, 5).collect())) == plain(rows, 3, 5)
    assert topk.top_k(df.where("false")).count() == 0
    assert topk.top_k(df.where("vec_id = 1")).count() == 0
