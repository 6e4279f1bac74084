import pytest
from cases import documents, nasty, plain_repeats, sha, table, text_of

import __spark_entry__ as entry_points
from tidemill.llm import suffixes, windows

SMALL = "/root/testdata/sf0.001"


def many() -> list[tuple]:
    """A passage in many documents, with edits, so that some super-k-mers and suffixes are hot."""
    passage = text_of(90, 1).split()
    rows = []
    for i in range(60):
        words = list(passage)
        if i % 4 == 1:
            words[45] = f"edit{i}"
        if i % 4 == 2:
            words = words[20:]
        rows.append((i, " ".join(text_of(i, i).split() + words + text_of(60 - i, 100 + i).split())))
    rows += [(100 + i, " ".join(passage)) for i in range(20)]
    return [(i, t, "en", "s", len(t), *["x"] * 13) for i, t in rows]


def check(rows, found, joined=True):
    expected = plain_repeats(rows)
    assert len(found) == len(rows)
    texts = {}
    for i, text, *_ in rows:
        texts.setdefault(i, []).append(text)
    for r in found:
        mine = [(t, *expected[r.doc_id, t]) for t in texts[r.doc_id]]
        answers = []
        for _text, count, words, gone in mine:
            left = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
            answers.append((count, sum(gone), left))
        kept = r.kept if joined else " ".join(r.kept.encode().decode().replace(" ", "\x01").split()).replace("\x01", " ")
        if not joined:
            kept = " ".join(x.decode() for x in r.kept.encode().split())
        assert (r.n_words, sum(x.end - x.begin for x in r.removed), kept) in answers


@pytest.fixture(params=["as it is", "all hot", "small rounds"])
def limits(request, monkeypatch):
    if request.param == "all hot":
        monkeypatch.setattr(windows, "HOT", 3)
    if request.param == "small rounds":
        monkeypatch.setattr(windows, "SORTED", 40)
        monkeypatch.setattr(windows, "PACK", 1 << 12)
        monkeypatch.setattr(suffixes, "SORTED", 30)


@pytest.mark.parametrize("rows", [nasty(), many()], ids=["nasty", "many"])
def test_windows(spark, limits, rows):
    check(rows, windows.remove_repeats(table(spark, rows)).collect())


@pytest.mark.parametrize("rows", [nasty(), many()], ids=["nasty", "many"])
def test_suffixes(spark, limits, rows):
    check(rows, suffixes.remove_repeated_passages(table(spark, rows)).collect(), joined=False)


def test_queries(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SMALL).collect()]
    expected = plain_repeats(rows)
    answers = {}
    for (i, _), (count, words, gone) in expected.items():
        left = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        answers[i] = (count, sum(gone), sha(left.encode()))
    for r in entry_points.queries()["op10_super_kmer_dedup"](spark, SMALL).collect():
        assert (r.n_words, r.n_removed, r.kept_sha256) == answers[r.doc_id]
    found = entry_points.queries()["op7_suffix_dedup"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in found} == {i: a[:2] for i, a in answers.items()}
    assert sum(r.n_removed for r in found) > 0


def test_no_rows(spark):
    assert windows.remove_repeats(table(spark, [])).count() == 0
    assert suffixes.remove_repeated_passages(table(spark, [])).count() == 0
    assert suffixes.clean(table(spark, [])).count() == 0


def test_cut_out_keeps_the_rest_as_it_was():
    text = b"  a b\t\tc d\n e  f "
    words = text.split()
    assert windows.cut_out(text, words, []) == text
    assert windows.cut_out(text, words, [[1, 3]]) == b"  a d\n e  f "
    assert windows.cut_out(text, words, [[0, 2], [4, 6]]) == b"  c d\n "
    assert windows.cut_out(text, words, [[0, 6]]) == b"  "


def test_clean_texts(spark):
    rows = nasty()
    expected = plain_repeats(rows)
    found = suffixes.clean(table(spark, rows))
    assert found.columns == table(spark, rows).columns
    found = found.collect()
    for r in found:
        options = [t for i, t, *_ in rows if i == r.doc_id]
        answers = []
        for t in options:
            _, words, gone = expected[r.doc_id, t]
            answers.append((t is None, any(gone), [w for w, g in zip(words, gone, strict=True) if not g]))
        got = [x.decode() for x in (r.text or "").encode().split()]
        assert (r.text is None, True, got) in answers or (r.text is None, False, got) in answers
        assert r.n_chars == (None if r.text is None else len(r.text))
        if (r.text is None, False, got) in answers:
            assert r.text in options
    stay = [i for i, t, *_ in rows if not (expected[i, t][2] and all(expected[i, t][2]))]
    assert len(stay) < len(rows) and sorted((r.doc_id for r in found), key=str) == sorted(stay, key=str)
