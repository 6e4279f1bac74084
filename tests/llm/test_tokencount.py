import public_tokenizers
import pytest
import tokenizers
from cases import documents, nasty, table, text_of

from tidemill.llm import tokencount

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path(tokencount.TOKENIZER))


def expected(rows, library):
    out = []
    for i, text in rows:
        count = len(library.encode(text or "", add_special_tokens=False).ids)
        out.append((i, len((text or "").encode()), count, count > 1024))
    return sorted(out, key=str)


def test_documents_and_cache(spark, library, tmp_path):
    docs, cache = documents(spark, SMALL), str(tmp_path / "cache")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    half = docs.where("doc_id < 90")
    found = tokencount.count_tokens(half, cache=cache).collect()
    assert sorted(map(tuple, found), key=str) == expected([r for r in rows if r[0] < 90], library)
    assert spark.read.parquet(cache).count() == len({t for i, t in rows if i < 90})
    for _ in range(2):
        found = tokencount.count_tokens(docs, cache=cache).collect()
        assert sorted(map(tuple, found), key=str) == expected(rows, library)
        # What was there is not encoded again.
        assert spark.read.parquet(cache).count() == len({t for _, t in rows})


def test_another_tokenizer_counts_anew(spark, tmp_path):
    cache, rows = str(tmp_path / "cache"), [r[:2] for r in nasty()]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        found = tokencount.count_tokens(table(spark), path=path, cache=cache).collect()
        assert sorted(map(tuple, found), key=str) == expected(rows, tokenizers.Tokenizer.from_file(path))
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {(r.doc_id, r.n_bytes): r.n_tokens for r in tokencount.count_tokens(table(spark), path=path, cache=cache).collect()}
    assert found == {(i, len((t or "").encode())): len(model.encode(t or "")) for i, t in rows}


def test_special_strings_and_long_texts(spark, library, monkeypatch):
    texts = ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", text_of(400, 1) + "<|endoftext|>" + "  \n x" * 90]
    rows = [(i, t, None, None, None, *["x"] * 13) for i, t in enumerate(texts)]
    found = tokencount.count_tokens(table(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == expected([r[:2] for r in rows], library)
    monkeypatch.setattr(tokencount, "_CALL", 64)
    count, cut = tokencount._counter(public_tokenizers.path(tokencount.TOKENIZER))
    for text in [*texts, "x" * 500, "é ½²" * 200, " " * 300 + "a", "  \n…" * 100, "a \n\n b" * 60]:
        assert tokencount._long(text, count, cut) == len(library.encode(text, add_special_tokens=False).ids)


def test_no_rows(spark):
    assert tokencount.count_tokens(table(spark, [])).count() == 0
