import random
import statistics

from cases import documents, nasty, sha, table, text_of

from tidemill.llm import parsing

SMALL = "/root/testdata/sf0.001"


def check(rows, found):
    """Next documents by sorting everything in one place."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    expected = []
    for (i, text), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        text, after = text or "", after or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        prints = parsing.fingerprints([text.encode(), changed.encode(), after.encode()])
        near = [parsing.likeness(prints[0], p) for p in prints[1:]]
        expected.append((i, len(text), sha(changed.encode()), *prints[:2], *near))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_documents(spark):
    docs = documents(spark, SMALL)
    found = parsing.fingerprint_documents(docs).collect()
    check([(r.doc_id, r.text) for r in docs.collect()], found)
    assert 0.4 < statistics.mean(r.near_edited for r in found) < 0.6
    assert statistics.mean(r.near_next for r in found) < 0.05


def test_nasty_rows(spark):
    check([r[:2] for r in nasty()], parsing.fingerprint_documents(table(spark)).collect())
    one = parsing.fingerprint_documents(table(spark, nasty()[:1])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert parsing.fingerprint_documents(table(spark, [])).count() == 0
    assert parsing.fingerprint_documents(table(spark, nasty()[-2:])).count() == 2


def test_batches_do_not_matter():
    texts = [text_of(n, n).encode() for n in (1, 3, 50, 400)] + [b"", b"a", b"aaaa", b"ab" * 200, b"", bytes(range(256)) * 4]
    assert parsing.fingerprints(texts) == [parsing.fingerprints([t])[0] for t in texts]


def test_shared_interior_has_the_same_names_at_any_offset():
    draw = random.Random(2)
    shared = text_of(600, 1)
    for _ in range(5):
        a = text_of(draw.randrange(1, 9), draw.randrange(999)) + " " + shared
        b = "x" * draw.randrange(1, 30) + shared + text_of(draw.randrange(1, 9), draw.randrange(999))
        first, second = parsing.fingerprints([a.encode(), b.encode()])
        assert parsing.likeness(first, second) > 0.85
    other = parsing.fingerprints([text_of(600, 77).encode()])[0]
    assert parsing.likeness(first, other) < 0.2


def test_likeness_follows_the_share_that_is_kept():
    base = text_of(900, 11).split()
    whole = parsing.fingerprints([" ".join(base).encode()])[0]
    before = 1.0
    for kept in (800, 600, 400, 200):
        mixed = " ".join(base[:kept] + text_of(900 - kept, kept).split())
        now = parsing.likeness(whole, parsing.fingerprints([mixed.encode()])[0])
        assert now < before and abs(now - kept / (1800 - kept)) < 0.2
        before = now
