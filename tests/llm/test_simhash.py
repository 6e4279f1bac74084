import random

import numpy as np
import pytest
import xxhash
from cases import WORDS, documents, nasty, roots, table

from tidemill.llm import simhash
from tidemill.llm.components import components

SMALL = "/root/testdata/sf0.001"


def plain(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows, distance=2):
    prints = np.array([plain(t) for _, t in rows], np.uint64)
    pairs = [(i, j) for i in range(len(rows)) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= distance)]
    found = roots(len(rows), pairs)
    low = {}
    for (i, _), r in zip(rows, found, strict=True):
        low[r] = min(low.get(r, 2**63), 2**63 if i is None else i)
    none = {2**63: None}
    return sorted(((i, f"{p:016x}", none.get(low[r], low[r])) for (i, _), p, r in zip(rows, prints.tolist(), found, strict=True)), key=str)


def test_documents(spark):
    docs = documents(spark, SMALL)
    found = simhash.near_duplicates(docs).collect()
    assert sorted(map(tuple, found), key=str) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_nasty_rows(spark):
    found = simhash.near_duplicates(table(spark)).collect()
    assert sorted(map(tuple, found), key=str) == expected([r[:2] for r in nasty()])
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def chain():
    """Three texts of which the middle one is close to both others, and these are not close to each other."""
    draw = random.Random(11)
    words = [f"w{draw.randrange(400)}" for _ in range(400)]
    found = [" ".join(words)]
    for _ in range(20_000):
        changed = found[-1].split()
        changed[draw.randrange(400)] = f"v{draw.randrange(10**6)}"
        text = " ".join(changed)
        prints = [simhash.fingerprint(t.encode()) for t in [*found, text]]
        if (prints[-1] ^ prints[-2]).bit_count() in (1, 2) and (len(found) == 1 or (prints[-1] ^ prints[0]).bit_count() > 2):
            found.append(text)
            if len(found) == 3:
                return found
    raise AssertionError("no chain")


def test_a_text_without_id_links_others(spark):
    a, b, c = chain()
    rows = [(1, a), (None, b), (None, b), (3, c), (4, "another text")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows)
    assert {r.component_id for r in found} == {1, 4}
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4]


def test_texts_of_one_id_are_documents_of_their_own(spark):
    x, y, p, q = (" ".join(f"{t}{i}" for i in range(60)) for t in "xypq")
    rows = [(1, x), (2, x), (2, y), (3, y), (5, p), (5, q), (5, q), (7, p + "!"), (7, p + "!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = expected(rows)
    kept = sorted((r.doc_id, r.text) for r in simhash.keep_first(docs).collect())
    near = simhash.near_duplicates(docs).collect()
    assert sorted(map(tuple, near), key=str) == groups
    assert {(1, x), (2, y), (5, p), (5, q)} <= set(kept) and len(kept) == len(set(kept))
    assert not {(2, x), (3, y)} & set(kept)
    # both texts that an id has in one component: the one of the smaller hash stays
    same = spark.createDataFrame([(1, "A b c"), (1, "a B c"), (2, "a b c")], "doc_id long, text string")
    assert [r.doc_id for r in simhash.keep_first(same).collect()] == [1]


def test_one_of_each_group_stays(spark):
    kept = simhash.keep_first(table(spark))
    assert kept.columns == table(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    groups = {i: c for i, _, c in expected([r[:2] for r in nasty()]) if i is not None}
    assert sorted(i for i in ids if i is not None) == sorted(set(groups.values()))
    assert ids.count(None) == 2


@pytest.mark.parametrize(("distance", "segments", "bucket"), [(2, 2, 256), (2, 2, 3), (3, 2, 3), (3, 4, 2), (1, 2, 2), (4, 3, 5)])
def test_links_connect_what_is_close(spark, distance, segments, bucket):
    draw = random.Random(distance * 10 + segments)
    prints = {0}
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(25):
            prints.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randrange(6))))
    # Many that agree in a whole half.
    prints |= {(7 << 32) | draw.getrandbits(8) << draw.randrange(20) for _ in range(60)}
    values = np.array(sorted(prints), np.uint64)
    rows = [(int(v), 1000 + i) for i, v in enumerate(values.view(np.int64))]
    links = simhash.links(spark.createDataFrame(rows, "fp long, node long"), distance, segments, bucket)
    found = [(r.a - 1000, r.b - 1000) for r in links.collect()]
    assert all(np.bitwise_count(values[a] ^ values[b]) <= distance for a, b in found)
    close = [(i, j) for i in range(len(values)) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance)]
    assert roots(len(values), found) == roots(len(values), close)


def test_components(spark):
    draw = random.Random(5)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(5, 5), (300, 200)]
    pairs += [(400 + draw.randrange(60), 400 + draw.randrange(60)) for _ in range(45)]
    pairs += pairs[:10]
    draw.shuffle(pairs)
    links = spark.createDataFrame([*pairs, (None, 3), (4, None)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    whole = roots(500, pairs)
    assert found == {x: r for x, r in enumerate(whole) if r != x}
    assert components(links.where("a < 0")).count() == 0


def test_plan_covers_each_distance():
    for distance in range(5):
        for segments in (1, 2, 3, 4):
            plan = simhash.index_plan(distance, segments)
            draw = random.Random(distance)
            for _ in range(200):
                x = sum(1 << b for b in draw.sample(range(64), distance))
                assert any(x & mask in flips for mask, flips in plan)
