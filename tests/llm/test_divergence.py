import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from cases import nasty, table, text_of

from tidemill.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def plain(rows, least=3, ranks=200):
    docs = [(r[2] or "", r[3] or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        df = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = [t for t, n in df.items() if n >= least]
        count = defaultdict(Counter)
        for x, source, terms in docs:
            if x == lang:
                count[source].update(t for t in terms if t in set(kept))
        whole = sum(count.values(), Counter())

        def p(c):
            total = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        by, q = {s: p(count[s]) for s in count}, p(whole)
        for s in count:
            pairs = [(-sum((by[s][t] - by[o][t]) ** 2 // by[o][t] for t in kept), o.encode(), "pair") for o in count if o != s]
            over = [(-((by[s][t] - q[t]) ** 2 // q[t]), t.encode(), "term") for t in kept if count[s][t] and by[s][t] > q[t]]
            for part in (sorted(pairs), sorted(over)[:ranks]):
                out += [(lang, s, kind, item.decode(), -v, i) for i, (v, item, kind) in enumerate(part, 1)]
    return sorted(out)


def rows_of(count=90):
    rest = nasty()[0][4:]
    out = []
    for i in range(count):
        lang = [None, "", "en", "de", "fr"][i % 5]
        source = [None, "", "a", "b", "é", "B"][(i * 7) % 6 if i % 5 < 4 else 2]
        text = [text_of(25 + i % 9, i % 40), "One two TWO Été été x-y z1z", None, "", "1 2 3", "only" + "x" * i][i % 6 if lang != "de" else 5]
        words = ["Alpha", "beta", "Gamma", "δ"] * (i % 4)
        out.append((i, None if text is None else text.replace("w", f"{'abc'[i % 3]}k") + " " + " ".join(words[: i % 11]), lang, source, *rest))
    return out


def found(spark, rows, **options):
    return sorted(tuple(r) for r in divergence.audit(table(spark, rows), **options).collect())


@pytest.mark.parametrize("rows", [rows_of(), nasty(), rows_of(4), [], [r for r in rows_of() if r[3] == "a"]])
def test_against_plain_version(spark, rows):
    assert found(spark, rows) == plain(rows)


def test_several_vocabularies_and_blocks_of_sources(spark, monkeypatch):
    rows = rows_of()
    want = plain(rows, ranks=3)
    assert found(spark, rows, ranks=3, terms=20) == want


def test_sums_of_a_task():
    """Pairs, probabilities and terms of a task against all pairs one by one, for batches that cut terms."""
    draw = np.random.default_rng(4)
    rows, pairs, alone, over, groups = [], Counter(), Counter(), [], []
    f = lambda a, b: (a - b) ** 2 // b
    for lang in (0, 1):
        total, size = draw.integers(100, 10**12, 5), 40
        p0 = [1 + 10**9 // (int(t) + size) for t in total]
        groups += [(int(total[s]), p0[s], size, int(total.sum())) for s in range(5)]
        for term in range(40):
            some = np.flatnonzero(draw.random(5) < 0.5)
            n = {int(s): int(draw.integers(1, 10 ** draw.integers(1, 11))) for s in some}
            p = {s: 1 + 10**9 * (c + 1) // (int(total[s]) + size) for s, c in n.items()}
            q = 1 + 10**9 * (sum(n.values()) + 1) // (int(total.sum()) + size)
            if n:
                rows.append((lang, 0, term, sorted(n), [n[s] for s in sorted(n)]))
            for s in n:
                alone[lang, s, p[s]] += 1
                over += [(lang, s, term, f(p[s], q))] if p[s] > q else []
                for t in n:
                    if s != t:
                        pairs[lang, s, t] += f(p[s], p[t]) - f(p[s], p0[t]) - f(p0[s], p[t]) + f(p0[s], p0[t])
    names = ["lang", "shard", "index", "numbers", "counts"]
    shared = SimpleNamespace(value=divergence._Groups({0: 0, 1: 5}, *map(np.array, zip(*groups, strict=True))))
    for size in (7, 10_000):
        for dense in (0, 3, 100):
            batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows[i : i + size]]) for i in range(0, len(rows), size)]
            got = [Counter(), Counter(), []]
            for batch in divergence._compared(shared, dense, iter(batches)):
                for r in batch.to_pylist():
                    if r["kind"] == 0:
                        got[0][r["lang"], r["a"], r["b"]] += r["x"]
                    elif r["kind"] == 1:
                        got[1][r["lang"], r["a"], r["x"]] += r["y"]
                    else:
                        got[2].append((r["lang"], r["a"], r["y"], r["x"]))
            assert {k: v for k, v in got[0].items() if v} == {k: v for k, v in pairs.items() if v}
            assert got[1] == alone and sorted(got[2]) == sorted(over)


def test_sums_of_vectors(monkeypatch):
    draw = np.random.default_rng(5)
    vocabulary = divergence.Indices({f"t{i}".encode(): i for i in range(7)})
    rows = [{"number": int(draw.integers(3)), "terms": " ".join(f"t{i}" for i in draw.integers(0, 9, draw.integers(1, 30)))} for _ in range(400)]
    doc, index, count = divergence.vectors_of([r["terms"].encode() for r in rows], vocabulary)
    each = [Counter(t for t in r["terms"].split() if t.encode() in vocabulary) for r in rows]
    assert [(int(d), f"t{i}", int(n)) for d, i, n in zip(doc, index, count, strict=True)] == [
        (d, t, c[t]) for d, c in enumerate(each) for t in sorted(c)
    ]
    want = Counter()
    for r, c in zip(rows, each, strict=True):
        for t, n in c.items():
            want[r["number"] << 32 | int(t[1:])] += n
    for held in (20, 1 << 20):
        monkeypatch.setattr(divergence, "_HELD", held)
        packs = list(divergence._summed(3, SimpleNamespace(value=vocabulary), iter([pa.RecordBatch.from_pylist(rows)])))
        by = {}
        for batch in packs:
            for r in batch.to_pylist():
                by.setdefault(r["bucket"], []).append({"keys": r["keys"], "counts": r["counts"]})
        assert len(by) > 1
        got = Counter()
        for bucket in by.values():
            for batch in divergence._met(iter([pa.RecordBatch.from_pylist([r]) for r in bucket])):
                for r in batch.to_pylist():
                    assert r["numbers"] == sorted(set(r["numbers"]))
                    for s, n in zip(r["numbers"], r["counts"], strict=True):
                        assert (s << 32 | r["index"]) not in got
                        got[s << 32 | r["index"]] = n
        assert got == want


def test_number_of_different_terms():
    param = divergence.Smallest()
    held = {}
    for part in range(5):
        some = np.random.default_rng(part % 3).integers(0, 2**64, 20_000, np.uint64)
        held = param.addInPlace(held, {7: np.unique(some)[: divergence.SKETCH]})
    assert 54_000 < divergence.different(held[7]) < 66_000
    assert divergence.different(np.arange(5, dtype=np.uint64)) == 5
