import math

import pytest
from cases import WORDS, documents, nasty, table
from pyspark.sql import functions as F

from tidemill.llm import mixing

SMALL = "/root/testdata/sf0.001"


def shares_of(spark, tokens):
    total = sum(tokens)
    return spark.createDataFrame([(f"s{i}", n / total) for i, n in enumerate(tokens)], "source string, share double")


def weights(tokens, t):
    powers = [(n / sum(tokens)) ** t for n in tokens]
    return [p / sum(powers) for p in powers]


def test_entropy_and_repetition(spark):
    tokens = [1000, 200, 50, 10]
    shares = shares_of(spark, tokens)
    assert mixing.temperature(shares) == 1.0
    t = mixing.temperature(shares, entropy=0.8)
    w = weights(tokens, t)
    assert abs(-sum(x * math.log(x) for x in w) / math.log(4) - 0.8) < 1e-6
    assert mixing.temperature(shares, entropy=0.1) == 1.0 and mixing.temperature(shares, entropy=1.0) < 1e-5
    t = mixing.temperature(shares, repeats=5.0)
    w = weights(tokens, t)
    used = [x / n for x, n in zip(w, tokens, strict=True)]
    assert abs(max(used) / min(used) - 5) < 1e-5
    t = mixing.temperature(shares, repeats=3.0, budget_share=0.5)
    assert abs(max(x * 630 / n for x, n in zip(weights(tokens, t), tokens, strict=True)) - 3) < 1e-5
    assert mixing.temperature(shares, entropy=1.0, repeats=5.0) == mixing.temperature(shares, repeats=5.0)
    assert mixing.temperature(shares_of(spark, [5]), repeats=2.0) == 1.0
    assert mixing.temperature(shares_of(spark, [5, 5]), repeats=2.0) == 0.0


def uses(found):
    out = {}
    for r in found:
        out.setdefault((r.row.doc_id, r.row.text), []).append(r)
    return out


@pytest.mark.parametrize("budget", [None, 5_000, 60_000])
def test_budgets(spark, budget):
    docs = documents(spark, SMALL)
    # One large source, some small ones.
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), (F.col("doc_id") % 7).cast("string"))))
    found = mixing.mix_sources(docs, repeats=2.5, budget=budget).collect()
    own = docs.collect()
    tokens = {r.doc_id: max(1, len(WORDS.findall(r.text))) for r in own}
    totals = {}
    for r in own:
        totals[r.source] = totals.get(r.source, 0) + tokens[r.doc_id]
    whole = sum(totals.values())
    shares = shares_of(spark, list(totals.values()))
    t = mixing.temperature(shares, repeats=2.5, budget_share=budget / whole if budget else None)
    w = dict(zip(totals, weights(list(totals.values()), t), strict=True))
    spend = budget or max(totals[s] / w[s] for s in w)
    per = uses(found)
    for s, total in totals.items():
        goal = w[s] * spend
        mine = [r for r in found if r.row.source == s]
        spent = sum(r.n_tokens for r in mine)
        largest = max(tokens[r.doc_id] for r in own if r.source == s)
        assert goal - 1 <= spent <= goal + largest
        assert goal / total <= 2.5 + 1e-4
        # Whole epochs hold every document, the last one some, and nothing comes twice in an epoch.
        whole_epochs = int(goal / total + 1e-6)
        for r in own:
            if r.source == s:
                epochs = sorted(x.epoch for x in per.get((r.doc_id, r.text), []))
                assert epochs in (list(range(whole_epochs)), list(range(whole_epochs + 1)))
    if budget is None:
        assert {r.doc_id for r in own} == {r.row.doc_id for r in found}
        blocks = {}
        for r in found:
            blocks[r.block] = blocks.get(r.block, 0) + r.n_tokens
        assert set(blocks) <= set(range(64)) and len(blocks) > 50
    assert all(r.n_tokens == tokens[r.row.doc_id] for r in found)
    again = mixing.mix_sources(docs.repartition(7), repeats=2.5, budget=budget).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_nasty_rows(spark):
    docs = table(spark)
    mixed = mixing.mix_sources(docs, repeats=3.0)
    assert mixed.select("row.*").columns == docs.columns
    found = mixed.collect()
    assert {(r.row.doc_id, r.row.text) for r in found} == {r[:2] for r in nasty()}
    # The repeated row is used as often as the other one like it.
    assert sum(r.row.doc_id == 6 for r in found) % 2 == 0
    assert mixing.mix_sources(table(spark, [])).count() == 0
    assert mixing.mix_sources(table(spark, nasty()[:1])).count() == 1
