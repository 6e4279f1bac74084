import zlib

import numpy as np
from cases import documents, nasty, table

from tidemill.llm import sharding

SMALL = "/root/testdata/sf0.001"


def check(rows, found, shards):
    assert len(found) == len(rows)
    expected = sorted(((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in found), key=str) == expected
    assert {r.law for r in found} <= {"bytes"} and all(r.grown_shard is None for r in found)
    for s in range(shards):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    assert all(0 <= r.shard < shards for r in found)


def test_documents(spark):
    docs = documents(spark, SMALL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = sharding.shard_documents(docs, 24).collect()
    check(rows, found, 24)
    loads = np.bincount([r.shard for r in found], [r.size for r in found], 24)
    assert loads.max() <= max(max(r.size for r in found), loads.mean() + 16)


def test_nasty_rows(spark):
    found = sharding.shard_documents(table(spark), 4, slots=64).collect()
    check(nasty(), found, 4)
    by_id = {}
    for r in found:
        if r.doc_id is not None:
            assert by_id.setdefault(r.doc_id, r.shard) == r.shard


def test_empty(spark):
    assert sharding.shard_documents(table(spark, []), 24).count() == 0


def test_rebalance_edits_few_slots():
    draw = np.random.default_rng(1)
    loads = draw.integers(1, 1000, 8192)
    first = sharding.first_map(24)
    second = sharding.rebalance(first, loads, 24)
    total = np.bincount(second.shard, loads, 24)
    assert total.max() - total.min() <= 2 and (first.shard != second.shard).mean() < 0.1
    assert (sharding.rebalance(second, loads, 24).shard == second.shard).all()
    grown = sharding.rebalance(second, loads, 25)
    total = np.bincount(grown.shard, loads, 25)
    assert total.max() - total.min() <= 2 and (grown.shard != second.shard).mean() < 0.06
    shrunk = sharding.rebalance(grown, loads, 20)
    total = np.bincount(shrunk.shard, loads, 20)
    assert set(shrunk.shard) == set(range(20)) and total.max() - total.min() <= 2


def test_versions_are_kept(spark, tmp_path):
    folder = str(tmp_path / "map")
    sharding.first_map(4, 64).save(spark, folder)
    docs = documents(spark, SMALL)
    once = {r.doc_id: r.shard for r in sharding.shard_documents(docs, 4, slots=64, folder=folder).collect()}
    again = sharding.shard_documents(docs, 4, slots=64, folder=folder).collect()
    assert {r.doc_id: r.shard for r in again} == once and {r.map_version for r in again} == {3}
    assert (sharding.load_map(spark, folder, 1).shard == sharding.first_map(4, 64).shard).all()
    assert sharding.load_map(spark, folder).version == 3
