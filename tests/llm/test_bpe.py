import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from cases import documents, nasty, sha, table

from tidemill.llm import bpe
from tidemill.llm.common import Splitter

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    encoder, splitter, spelled = bpe.load(public_tokenizers.path(request.param), public_tokenizers.PATTERN)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}
    )

    def ours(text):
        return np.frombuffer(
            b"".join(encoder.encode_piece(p) for part in splitter.lists(text) for p in part), "<u4"
        ).tolist()

    return ours, library, encoder, spelled


def test_every_code_point(both):
    ours, library, _, _ = both
    wrong = []
    for start in range(0, 0x110000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        for c in chars if start < 0x3400 else chars[::16]:
            text = f"a{c}1{c}{c} {c}b {c}."
            if ours(text) != library.encode_ordinary(text):
                wrong.append(hex(ord(c)))
    assert not wrong


def test_random_strings(both):
    ours, library, _, _ = both
    draw = random.Random(3)
    parts = ["a", "e", "th", "'", "s", " ", "  ", "\n", "1", "é", "<", "abc", "zz", "你好", "😀", "ll", "-", "tion", "ing", "\x1c", "²"]
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(60)))
        assert ours(text) == library.encode_ordinary(text), text


def test_long_pieces_and_decoding(both):
    ours, library, encoder, spelled = both
    draw = random.Random(4)
    for text in ("ab" * 4000 + "thequick" * 500, "a" * 3001, "".join(draw.choice("abcdeiost") for _ in range(5000))):
        ids = encoder.encode_bytes(text.encode())
        assert ids == library.encode_ordinary(text)
        assert bpe.decode(spelled, np.array(ids)) == text.encode()
    assert bpe.decode(spelled, np.array([], int)) == b""


def test_neighbours_fit_as_the_merges_say(both):
    _, _, encoder, _ = both
    draw = random.Random(6)
    tokens = [r for r in range(len(encoder.bytes)) if encoder.tails[r]]
    for _ in range(4000):
        a, b = draw.choice(tokens[:3000]), draw.choice(tokens[:3000])
        merged = encoder.merged(encoder.bytes[a] + encoder.bytes[b])[0]
        assert encoder.fits(a, b) == (merged == [encoder.bytes[a], encoder.bytes[b]])


def test_split_in_parts():
    splitter = Splitter(public_tokenizers.PATTERN)
    for text in ("word " * 1000, "é²½ x" * 500, "  \n " * 300 + "x"):
        assert [p for part in splitter.lists(text, 100) for p in part] == splitter.full.findall(text)


def check(rows, found, library):
    expected = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha((text or "").encode()), ids))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_operator(spark, both):
    ranks = public_tokenizers.path(bpe.RANKS)
    encoder = bpe.load(ranks, public_tokenizers.PATTERN)[0]
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}
    )
    for docs, rows in (
        (documents(spark, SMALL), [(r.doc_id, r.text) for r in documents(spark, SMALL).collect()]),
        (table(spark), [r[:2] for r in nasty()]),
    ):
        check(rows, bpe.encode(docs, ["doc_id"], with_ids=True).collect(), library)
    assert bpe.encode(table(spark, []), ["doc_id"]).count() == 0
    assert bpe.encode(table(spark), ["row", "doc_id"]).columns == ["row", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_kept_columns_of_any_type(spark):
    df = table(spark).select(
        F.col("doc_id").cast("int").alias("doc_id"),
        "text",
        F.col("doc_id").cast("decimal(9,2)").alias("price"),
        F.timestamp_seconds("doc_id").alias("at"),
        F.lit(None).cast("date").alias("none"),
        F.array("lang", "source").alias("names"),
        F.struct(F.col("doc_id").cast("short").alias("a"), "lang").alias("both"),
    )
    keep = [c for c in df.columns if c != "text"]
    found = bpe.encode(df, keep, with_ids=True)
    assert [f.dataType for f in found.schema.fields][: len(keep)] == [df.schema[c].dataType for c in keep]
    assert sorted(map(str, found.select(keep).collect())) == sorted(map(str, df.select(keep).collect()))
