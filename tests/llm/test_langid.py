import base64
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from cases import documents, nasty, table
from pyspark.sql import functions as F

from tidemill.llm import langid

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = documents(spark, MEDIUM)
    found = langid.predict(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_nothing_is_learned_from_held_out_labels_or_other_columns(spark):
    docs = documents(spark, SMALL)
    wrong = F.when(langid.held_out(), F.lit("xx")).otherwise(F.col("lang"))
    changed = docs.withColumn("lang", wrong).withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(0))
    one = {r.doc_id: r for r in langid.predict(docs).collect()}
    assert {r.doc_id: r for r in langid.predict(changed.repartition(5)).collect()} == one


def test_folded_weights_are_the_kernel_machine():
    """The decision by weights is the one by kernels with every landmark."""
    draw = random.Random(1)
    texts = ["".join(draw.choice(a) for _ in range(80)).encode() for a in ("abc ", "cde ") for _ in range(12)]
    labels = np.array([0] * 12 + [1] * 12)
    rows = np.array([langid.presence(t) for t in texts])
    model = langid.fit(["x", "y"], labels, np.packbits(rows, axis=1), landmarks=8)
    unit = rows / np.sqrt(rows.sum(axis=1, keepdims=True))
    marks = unit[[0, 1, 2, 3, 12, 13, 14, 15]]
    kernel, among = unit @ marks.T, marks @ marks.T
    weight = np.full((24, 1), 1 / 12)
    left = kernel.T @ (kernel * weight) + langid.RIDGE * 2 * among + 1e-9 * np.eye(8)
    target = np.where(labels[:, None] == [0, 1], 1.0, -1.0)
    expected = kernel @ np.linalg.solve(left, kernel.T @ (target * weight))
    assert np.allclose(model.decide(texts), expected, atol=1e-3)
    assert (model.decide(texts).argmax(axis=1) == labels).all()


def test_presence_reads_the_whole_text_in_parts(monkeypatch):
    text = "".join(random.Random(2).choice("abcdefgh ") for _ in range(3000)).encode()
    whole = langid.presence(text)
    monkeypatch.setattr(langid, "_STEP", 100)
    assert (langid.presence(text) == whole).all()
    assert (langid.presence(text.upper()) == whole).all() and not langid.presence(b"").any()


def test_nasty_rows(spark):
    found = langid.predict(table(spark)).collect()
    assert len(found) == len(nasty())
    unknown = [r for r in found if r.lang_pred == langid.UNKNOWN]
    assert {r.doc_id for r in unknown} == {1, 2, 3, 13, None} and all(r.score == 0 for r in unknown)
    assert {r.lang_pred for r in found} <= {"en", "de", langid.UNKNOWN}
    assert all(r.held_out for r in found if r.doc_id is None)
    assert langid.predict(table(spark, [])).count() == 0
    no_labels = table(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict(no_labels).collect()} == {langid.UNKNOWN}


def test_keep_known(spark):
    kept = langid.keep_known(table(spark), minimum=-1.0)
    assert kept.columns == table(spark).columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        str(r[0]) for r in nasty() if r[1] and any(c.isalpha() for c in r[1])
    )
    docs = documents(spark, SMALL)
    assert langid.keep_known(docs).count() == docs.count()


def test_keep_known_goes_by_evidence(spark):
    """Unlearned scripts and languages, random letters and base64 go; long and short texts of learned languages stay."""
    docs = documents(spark, MEDIUM)
    draw = random.Random(5)
    letters = [" ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 10))) for _ in range(n)) for n in (30, 3000)]
    unlearned = [
        "すべての人間は、生まれながらにして自由であり、かつ、尊厳と権利とについて平等である。人間は、理性と良心とを授けられている。",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα.",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
        "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokaisella on oikeus elämään ja vapauteen.",
        *letters,
        base64.b64encode(draw.randbytes(3000)).decode(),
    ]
    held = docs.where(langid.held_out()).orderBy("doc_id").collect()
    passages = {lang: " ".join(r.text for r in held if r.lang == lang and r.text) for lang in ("de", "en", "es", "fr")}
    learned = [" ".join(passages.values()), " ".join(p[:4000] for p in passages.values()), "One", "same " * 300]
    texts = unlearned + learned
    extra = spark.createDataFrame([(10**9 + i, t, None, "s", len(t)) for i, t in enumerate(texts)], docs.schema)
    kept = [r.doc_id for r in langid.keep_known(docs.unionByName(extra)).collect()]
    assert sorted(i - 10**9 for i in kept if i >= 10**9) == list(range(len(unlearned), len(texts)))
    assert sum(i < 10**9 for i in kept) == docs.where(langid.has_letter()).count()


def test_stretches_are_the_whole_text(monkeypatch):
    monkeypatch.setattr(langid, "STRETCH", 7)
    assert b"".join(langid.stretches("Für 12 Äpfel, 3.50€!".encode())) == "Für Äpfel €".encode() + b" "
    assert langid.stretches(b"") == [b""]


def test_a_fit_takes_little_memory():
    """The driver holds the packed rows and the landmarks once, in single precision."""
    draw = np.random.default_rng(1)
    packed = np.packbits(draw.random((512, 1 << langid.BITS), dtype=np.float32) < 0.05, axis=1)
    labels = np.arange(512) % 4
    tracemalloc.start()
    try:
        langid.fit(list("abcd"), labels, packed)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    landmarks = langid.LANDMARKS * 4 << langid.BITS
    assert peak < 2.2 * landmarks


def test_keep_known_identifies_languages(spark):
    """Documents without a label, or with another one that nobody learns from, leave with the language of their text."""
    docs = documents(spark, MEDIUM)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    wrong = F.when(langid.held_out(), F.lit("xx")).when(F.col("doc_id") % 3 != 0, F.col("lang"))
    kept = langid.keep_known(docs.withColumn("lang", wrong))
    found = {r.doc_id: r.lang for r in kept.collect()}
    assert len(found) == docs.where(langid.has_letter()).count() and kept.schema == docs.schema
    assert sum(truth[i] == lang for i, lang in found.items()) / len(found) > 0.98


def test_no_language_is_left_out(spark, monkeypatch):
    """More languages than landmarks: each is learned and stays."""
    draw = random.Random(3)
    words = {f"l{i}": ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(20)] for i in range(300)}
    rows = [(i, " ".join(draw.choices(words[f"l{i % 300}"], k=60)), f"l{i % 300}") for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = langid.keep_known(docs).collect()
    assert len({r.lang for r in kept}) == 300 and len(kept) > 0.97 * len(rows)
    assert sum(r.lang == f"l{r.doc_id % 300}" for r in kept) / len(kept) > 0.95
    monkeypatch.setattr(langid, "LANGUAGES", 299)
    with pytest.raises(ValueError, match="more than 299"):
        langid.keep_known(docs)
