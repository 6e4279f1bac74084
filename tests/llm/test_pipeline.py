"""The stages one after the other, each against a plain version over what it got."""

import base64

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from cases import nasty, plain_repeats, sha, table

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemill.llm import mixing

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, out = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(folder / str(i)))
        docs = spark.read.parquet(str(folder / str(i)))
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        out.append(docs)
    return [d.collect() for d in out]


def test_languages_keep_texts(stages):
    assert sorted(map(str, stages[1])) == sorted(map(str, stages[0]))


def test_one_of_each_near_group(stages):
    from test_simhash import expected

    first = {c for _, _, c in expected([(r.doc_id, r.text) for r in stages[1]])}
    assert sorted(map(str, stages[2])) == sorted(str(r) for r in stages[1] if r.doc_id in first)
    assert len(stages[2]) < len(stages[1])


def test_passages(stages):
    rows = [(r.doc_id, r.text) for r in stages[2]]
    expected = {i: (words, gone) for (i, _), (_, words, gone) in plain_repeats(rows).items()}
    left = {r.doc_id: r for r in stages[3]}
    changed = 0
    for r in stages[2]:
        words, gone = expected[r.doc_id]
        if words and all(gone):
            assert r.doc_id not in left
        elif any(gone):
            changed += 1
            kept = [w for w, g in zip(words, gone, strict=True) if not g]
            assert left[r.doc_id].text.encode().split() == [w.encode() for w in kept]
            assert left[r.doc_id].n_chars == len(left[r.doc_id].text)
        else:
            assert left[r.doc_id] == r
    again = plain_repeats([(r.doc_id, r.text) for r in stages[3]])
    assert sum(any(gone) for _, _, gone in again.values()) <= changed


def test_mixing_uses_every_document(stages):
    uses = {}
    for r in stages[4]:
        uses[str(r)] = uses.get(str(r), 0) + 1
    assert set(uses) == {str(r) for r in stages[3]} and set(uses.values()) <= {1, 2, 3}


def test_mix_is_written_in_its_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    corpus_pipeline.mixed(spark, docs, SMALL).write.parquet(str(tmp_path / "mix"))
    files = sorted((tmp_path / "mix").glob("part-*.parquet"))
    written = [i for f in files for i in pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()]
    mix = mixing.mix_sources(docs, repeats=2.0).select("block", "place", "row.doc_id").collect()
    assert written == [r.doc_id for r in sorted(mix, key=lambda r: (r.block, r.place, r.doc_id))]


def test_tokens(stages):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for r in stages[4]:
        ids = library.encode_ordinary(r.text)
        expected.append((r.doc_id, r.lang, r.source, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(r.text.encode()), ids))
    assert sorted(map(str, map(tuple, stages[5]))) == sorted(map(str, expected))


def test_run_is_all_stages(spark, stages):
    found = entry_points.queries()["pipeline"](spark, SMALL).collect()
    assert sorted(map(str, found)) == sorted(map(str, stages[5]))


def test_nasty_rows_and_no_rows(spark, tmp_path):
    for name, rows in (("nasty", nasty()), ("none", [])):
        docs = table(spark, rows)
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{name}{i}")
            stage(spark, docs, SMALL).write.parquet(path)
            docs = spark.read.parquet(path)
        assert docs.count() == 0 or rows


def test_what_is_dropped_stays_out(spark, tmp_path):
    """Rows that language ID drops, of unlearned languages or without a letter, are in no token row at the end."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられている。",
        "12 + 30 = 42 !",
        None,
    ]
    extra = spark.createDataFrame([(10**9 + i, t, None, "s", len(t or "")) for i, t in enumerate(texts)], docs.schema)
    docs.unionByName(extra).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id for r in entry_points.queries()["pipeline"](spark, str(tmp_path)).select("doc_id").collect()}
    assert found and max(found) < 10**9
