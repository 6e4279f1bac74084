import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from cases import documents, nasty, sha, table

from tidemill.llm import alignment

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    """A slow version by its own means: bytes of tokens from the libraries, ranges compared one by one."""
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [c for c in range(256) if 33 <= c < 127 or 161 <= c < 173 or c >= 174]
    others = [c for c in range(256) if c not in printable]
    letter = {chr(c): c for c in printable} | {chr(256 + i): c for i, c in enumerate(others)}

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def run(rows):
        encoded = []
        for _, text in rows:
            ids = [], []
            if text:
                ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
                spelled = [bytes(letter[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes_b(i) for i in ids[1]]
                if any(b"".join(s) != (" " + text).encode() for s in spelled):
                    ids = [], []
            links, groups = [], []
            if ids[0]:
                edges = [np.cumsum([0, *map(len, s)]).tolist() for s in spelled]
                j = 0
                for i in range(len(ids[0])):
                    while edges[1][j + 1] <= edges[0][i]:
                        j += 1
                    k = j
                    while k < len(ids[1]) and edges[1][k] < edges[0][i + 1]:
                        links.append((ids[0][i], ids[1][k]))
                        k += 1
                common = sorted(set(edges[0]) & set(edges[1]))
                for p, q in zip(common, common[1:]):
                    group = [[i for i, e in zip(ids[s], edges[s][1:]) if p < e <= q] for s in (0, 1)] if len(common) < 300 else [
                        ids[s][edges[s].index(p) : edges[s].index(q)] for s in (0, 1)
                    ]
                    groups.append("|".join(",".join(map(str, g)) for g in group))
            encoded.append((ids, links, groups))
        count = Counter(pair for _, links, _ in encoded for pair in set(links))
        best = defaultdict(int)
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        out = []
        for (i, _), (ids, links, groups) in zip(rows, encoded, strict=True):
            top = sum(count[p] == best[p[0]] for p in links)
            name = sha(";".join(groups).encode()) if groups else ""
            out.append((i, len(ids[0]), len(ids[1]), len(groups), len(links), top, sum(count[p] for p in links), name))
        return sorted(out, key=str)

    return run


def found(df, **options):
    return sorted([tuple(r) for r in alignment.align_tokenizers(df, **options).collect()], key=str)


ODD = [
    "<s> [INST] hi </s> <|endoftext|> <unk> <0x41>",
    "a▁b is not spelled",
    "ﬁ ligature ½ Ａ full width",
    "  two  leading   and trailing  ",
    "\n\n\ttabs\r\n",
    "é combining 👩‍👩‍👧 family ﻿ bom   nbsp",
    "\x1c\x1d\x85 controls \x00",
    " ",
    "ǅungla ᚠᛇᚻ ꦱꦲ 𝔘𝔫𝔦",
]


def odd_rows():
    rest = nasty()[0][2:]
    rows = [r for r in nasty() if r[0] != 12]
    return rows + [(100 + i, t, *rest) for i, t in enumerate(ODD)]


def test_against_plain_version(spark, plain):
    rows = odd_rows()
    want = plain([r[:2] for r in rows])
    assert found(table(spark, rows)) == want
    # The counts of most pairs are joined, not sent.
    assert found(table(spark, rows), sent=40) == want
    assert found(table(spark, rows), sent=0) == want


def test_whole_documents(spark, plain):
    df = documents(spark, SMALL)
    assert found(df) == plain([(r.doc_id, r.text) for r in df.collect()])


def test_long_text_is_encoded_in_parts(spark, plain, monkeypatch):
    draw = random.Random(5)
    text = "".join(draw.choice(["word", " ", "  ", "\n", "é", "naïve", " the", "1984", "…", "東", "x" * 30]) for _ in range(9000))
    whole = [t.encode([text]) for t in map(alignment.load, map(public_tokenizers.path, (alignment.TOKENIZER_A, alignment.TOKENIZER_B)))]
    monkeypatch.setattr(alignment, "LONG", 2000)
    monkeypatch.setattr(alignment, "STEP", 1000)
    parts = [t.encode([text]) for t in map(alignment.load, map(public_tokenizers.path, (alignment.TOKENIZER_A, alignment.TOKENIZER_B)))]
    assert [[i.tolist() for i in side] for side in parts] == [[i.tolist() for i in side] for side in whole]


def test_plain_text_is_encoded_alike():
    """Every plain character in every kind of neighbourhood, and words that merge in many orders."""
    tokens = alignment.load(public_tokenizers.path(alignment.TOKENIZER_A))
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path(alignment.TOKENIZER_A))
    library.encode_special_tokens = True
    plain = [c for c in map(chr, range(0x250)) if alignment.is_plain(c)]
    assert len(plain) > 500
    texts = ["".join(f"{p}{c}{q}" for p in ("a", " ", "1", "!", "\n", "'") for q in ("b", " ", "2", "?", "\t", "'s")) for c in plain]
    draw = random.Random(9)
    texts += ["".join(draw.choice("aeinorst lhdcumpfgybwvkxjqz'  \nABC019.,-é") for _ in range(400)) for _ in range(300)]
    texts += ["<|endoftext|>", "x" * 3000, " " * 50, "\n \n  a"]
    want = [e.ids for e in library.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]
    assert all(map(alignment.is_plain, texts))
    assert [i.tolist() for i in tokens.encode(texts)] == want


def test_gallop_is_a_search():
    draw = np.random.default_rng(1)
    for few, many, top in [(0, 5, 9), (1, 1, 3), (7, 400, 500), (400, 7, 500), (1000, 1000, 100_000), (33, 2000, 50)]:
        a, b = np.sort(draw.integers(0, top, few)), np.sort(draw.integers(0, top, many))
        assert alignment.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_ids_are_kept(spark):
    row = alignment.align_tokenizers(table(spark, [(1, "Hello naïve world", *nasty()[0][2:])]), with_ids=True).first()
    a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(row.ids_a, "<u2").tolist() == a.encode(" Hello naïve world").ids
    assert len(row.ids_b) == 2 * row.n_b


def test_empty_table(spark):
    assert found(table(spark, [])) == []
