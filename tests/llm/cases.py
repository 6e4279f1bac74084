"""Rows that operators must bear, and plain versions of what they compute."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import types as T

WORDS = re.compile("[^\x20\x09-\x0d]+")
# Names that operators use inside, as columns that they must not mix up with their own.
CLASHING = ["fp", "node", "row", "tokens", "bucket", "range", "guest", "ranges", "text_key", "a", "b", "content", "place"]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


def words(count: int, seed: int, alphabet: int = 400) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(alphabet)}é" if draw.random() < 0.1 else f"w{draw.randrange(alphabet)}" for _ in range(count)]


def text_of(count: int, seed: int) -> str:
    return " ".join(words(count, seed))


def nasty() -> list[tuple]:
    """Nulls, empty and white-space texts, ties, repeated rows, copies, shared passages and a long text."""
    passage = text_of(70, 1)
    texts = {
        0: text_of(120, 2),
        1: None,
        2: "",
        3: " \t\n\x0b ",
        4: "One",
        5: "two words",
        6: text_of(30, 3) + " " + passage + " " + text_of(30, 4),
        7: text_of(10, 5) + "\n" + passage + "  " + text_of(80, 6) + " ",
        8: passage,
        9: passage,
        10: "x" * 5000,
        11: "same " * 300,
        12: text_of(30_000, 7),
        13: "12345 !!! ???",
        14: "naïve café 東京 😀 \x00 end",
        15: text_of(40, 8) + " " + text_of(40, 8),
    }
    rows = [(i, t, None if i in (3, 9) else ["en", "de"][i % 2], None if i == 5 else f"s{i % 3}") for i, t in texts.items()]
    rows += [(6, texts[6], "en", "s0"), (20, texts[6], "en", "s0"), (None, texts[0], None, None), (None, None, None, None)]
    return [(i, t, lang, source, None if t is None else len(t), *CLASHING) for i, t, lang, source in rows]


def table(spark, rows: list[tuple] | None = None, parts: int = 3):
    return spark.createDataFrame(nasty() if rows is None else rows, SCHEMA).repartition(parts)


def documents(spark, folder: str):
    return spark.read.parquet(f"{folder}/documents.parquet")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def plain_repeats(rows: list[tuple], window: int = 50) -> dict[tuple, tuple[int, list[str], list[bool]]]:
    """By (id, text): words and which of them are in a window that a smaller id has."""
    big = 2**63 - 1
    first: dict[tuple, int] = {}
    split = {(r[0], r[1]): WORDS.findall(r[1] or "") for r in rows}
    for (i, _), w in split.items():
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            first[key] = min(first.get(key, big), big if i is None else i)
    out = {}
    for (i, t), w in split.items():
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < (big if i is None else i):
                gone[j : j + window] = [True] * window
        out[i, t] = (len(w), w, gone)
    return out


def roots(count: int, pairs) -> list[int]:
    """Smallest index that each index is connected with."""
    parent = list(range(count))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(count)]
