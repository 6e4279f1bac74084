import random
import re

from cases import nasty, sha, table, text_of
from pyspark.sql import types as T

from tidemill.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("hits", T.StringType())])


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, window=10, shingle=3, containment=1.0):
    out = []
    for i, text in docs:
        w, hit, names = split(text), set(), set()
        where = {(k, *w[p : p + k]): [] for k in range(1, shingle + 1) for p in range(len(w))}
        for k in range(1, shingle + 1):
            for p in range(len(w) - k + 1):
                where[k, *w[p : p + k]].append(p)
        for name, item in items:
            v = split(item)
            for s in range(max(1, len(v) - window + 1) if v else 0):
                want = v[s : s + window]
                k = min(shingle, len(want))
                count = len(want) - k + 1
                starts = {p - j for j in range(count) for p in where.get((k, *want[j : j + k]), [])}
                for at in (a for a in starts if 0 <= a <= len(w) - len(want)):
                    have = w[at : at + len(want)]
                    same = sum(have[j : j + k] == want[j : j + k] for j in range(count))
                    if same and same >= containment * count - 1e-9:
                        hit |= set(range(at, at + len(want)))
                        names.add("" if name is None else str(name))
        names = sorted(names)
        out.append((i, len(w), len(hit), len(names), sha(",".join(names).encode()), bool(hit)))
    return sorted(out, key=str)


def benchmark_rows():
    by = {r[0]: r[1] for r in nasty() if r[0] is not None}
    return [
        (1, text_of(70, 1).upper(), "x"),
        (2, " ".join(by[12].split()[500:520]), "x"),
        (3, "TWO, words!", "x"),
        (4, "same same", "x"),
        (5, "", "x"),
        (6, None, "x"),
        (7, "nowhere " * 12, "x"),
        (8, "東京", "x"),
        (9, text_of(40, 8)[3:], "x"),
        (10, by[0], "x"),
        (10, by[6], "x"),
        (1, text_of(70, 1).upper(), "x"),
        (None, " ".join(by[0].split()[5:17]), "x"),
    ]


def found(spark, docs, items, **options):
    bench = spark.createDataFrame(items, ITEMS)
    return sorted([tuple(r) for r in decontam.report(docs, bench, **options).collect()], key=str)


def test_against_plain_version(spark):
    docs, items = nasty(), benchmark_rows()
    want = plain([r[:2] for r in docs], [r[:2] for r in items])
    assert sum(r[5] for r in want) > 8
    assert found(spark, table(spark, docs), items) == want


def test_several_blocks_agree(spark):
    docs, items = nasty(), benchmark_rows()
    assert found(spark, table(spark, docs), items, block=4000) == found(spark, table(spark, docs), items)


def test_partial_containment(spark):
    draw = random.Random(3)
    items = [(i, text_of(30, 50 + i), "x") for i in range(6)]
    docs = []
    for i in range(30):
        w = text_of(40, 200 + i).split() + items[i % 6][1].split()[draw.randrange(10) :] + text_of(5, 300 + i).split()
        w = [x if draw.random() > 0.06 else "changed" for x in w]
        docs.append((i, " ".join(w), *table_rest()))
    for containment in (0.5, 0.7, 1.0):
        want = plain([r[:2] for r in docs], [r[:2] for r in items], containment=containment)
        assert found(spark, table(spark, docs), items, containment=containment) == want


def table_rest():
    return nasty()[0][2:]


def test_spans_name_the_words(spark):
    docs = [(1, text_of(20, 1) + " " + text_of(12, 2) + " " + text_of(9, 3), *table_rest())]
    out = decontam.contaminated_words(table(spark, docs), spark.createDataFrame([(5, text_of(12, 2), "x")], ITEMS)).first()
    assert [tuple(h) for h in out.hits] == [(20, 32)] and out["items"] == ["5"] and out.n_words == 41


def test_empty_tables(spark):
    docs, items = nasty(), benchmark_rows()
    assert found(spark, table(spark, []), items) == []
    assert found(spark, table(spark, docs), []) == plain([r[:2] for r in docs], [])


def test_prefix_is_as_long_as_it_must_be():
    assert decontam.needed(10, 3, 1.0) == (8, 1)
    assert decontam.needed(10, 3, 0.5) == (4, 5)
    assert decontam.needed(2, 3, 1.0) == (1, 1)
    assert decontam.needed(10, 3, 0.0) == (1, 8)
