"""Language identification by string kernels: blended-spectrum presence kernel, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.columns import local_rows, small_or_none
from tidemill.llm.common import give_back, rows

UNKNOWN = "und"
#: n-grams of 1 to GRAMS bytes of the text in lower case; their hashes name one of 2 ** BITS features.
GRAMS, BITS = 4, 16
#: Bound on the labelled documents a model is fitted on and on its landmarks (of each language one at least), and the
#: languages beyond which a column is an error: it names something else.
SAMPLE, LANDMARKS, LANGUAGES = 2048, 256, 4096
RIDGE = 1e-4
#: Evidence of a feature that no language has, as a part of its chance; allowance for texts with few features, in errors
#: of a mean over places (the n-grams of a place are not independent).
FLOOR, ERRORS = 1 / 8, 2.0
STRETCH = 1 << 12
_STEP = 1 << 20
_NO_LETTERS = re.compile(rb"[^A-Za-z\x80-\xff]+")


def presence(text: bytes, flags: np.ndarray | None = None) -> np.ndarray:
    """Which features occur anywhere in the whole text."""
    if flags is None:
        flags = np.zeros(1 << BITS, bool)
    text = text.lower()
    for start in range(0, len(text), _STEP):
        letters = np.frombuffer(text, np.uint8, min(len(text) - start, _STEP + GRAMS - 1), start).astype(np.uint32)
        letters += np.uint32(1)
        gram = np.zeros(len(letters), np.uint32)
        for n in range(min(GRAMS, len(letters))):
            gram = gram[: len(letters) - n] * np.uint32(0x01000193) + letters[n:]
            flags[((gram ^ (gram >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)] = True
    return flags


def stretches(text: bytes) -> list[bytes]:
    """The whole text in parts of STRETCH bytes, so that a long text is judged like a short one.

    What is between its letters becomes a space: figures, marks and symbols are of no language.
    """
    letters = _NO_LETTERS.sub(b" ", text)
    return [letters[i : i + STRETCH] for i in range(0, max(1, len(letters)), STRETCH)]


@dataclass(frozen=True)
class Model:
    """``weights``: a row for each feature, a column for each language.

    The decision for a text is the sum over landmarks of coefficient times normalised kernel. The kernel counts shared
    features, so the sum over landmarks is folded into one weight for each feature and language: the same number,
    from one matrix product with the presence rows.

    ``evidence``: for each feature of ``stretches`` how typical it is of the language that has it most, 0 to 1 (see ``_evidence``);
    ``spread`` is its deviation within the labelled texts, and ``least`` what nearly all of these reach.
    """

    languages: list[str]
    weights: np.ndarray
    evidence: np.ndarray
    spread: float = 0.0
    least: float = 0.0

    def decide(self, texts: list[bytes | None]) -> np.ndarray:
        """Decision of each one-versus-rest machine; 1 is certain, -1 certainly not."""
        out = np.zeros((len(texts), len(self.languages)))
        flags = np.zeros(1 << BITS, bool)
        for i, text in enumerate(texts):
            if text:
                flags[:] = False
                found = np.flatnonzero(presence(text, flags))
                out[i] = self.weights[found].sum(axis=0) / np.sqrt(len(found))
        return out

    def weigh(self, texts: list[bytes | None]) -> np.ndarray:
        """Evidence that a text is of learned languages at all, whichever and however many."""
        out = np.zeros(len(texts))
        flags = np.zeros(1 << BITS, bool)
        for i, text in enumerate(texts):
            if text:
                total, size = 0.0, 0
                for part in stretches(text):
                    flags[:] = False
                    found = np.flatnonzero(presence(part, flags))
                    total, size = total + self.evidence[found].sum(), size + len(found)
                out[i] = total / size + ERRORS * self.spread * np.sqrt(GRAMS / size)
        return out


def _evidence(labels: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Evidence of each feature, its deviation within a text, and the least evidence of a text of a learned language.

    A language's share of a feature is the mean over its texts of one part in as many as the text has features. The
    evidence is the logarithm of the largest share, from FLOOR of what chance gives to all of a text, as 0 to 1. Each
    text is judged by the shares without its own part, so that unlearned texts of the same language do as well. What a
    text must reach lies below the hundredth of them that does worst, by one and a half times its distance from the median.
    """

    def scale(share: np.ndarray) -> np.ndarray:
        lowest = FLOOR / (1 << BITS)
        return np.log(np.maximum(share, lowest) / lowest) / np.log(1 / lowest)

    def parts(of: int) -> Iterator[tuple[np.ndarray, int]]:
        for row in packed[labels == of]:
            found = np.flatnonzero(np.unpackbits(row))
            yield found, max(1, len(found))

    def summed(of: int) -> np.ndarray:
        sums = np.zeros(1 << BITS, np.float32)
        for found, size in parts(of):
            sums[found] += 1 / size
        return sums

    count = int(labels.max()) + 1
    first, second, owner = np.zeros(1 << BITS), np.zeros(1 << BITS), np.full(1 << BITS, -1)
    many = np.bincount(labels, minlength=count)
    for c in range(count):
        share = summed(c) / many[c]
        ahead = share > first
        second = np.where(ahead, first, np.maximum(second, share))
        first, owner = np.where(ahead, share, first), np.where(ahead, c, owner)
    means, sizes, variances = [], [], []
    for c in range(count):
        others, sums = np.where(owner == c, second, first), summed(c)
        for found, size in parts(c):
            own = np.maximum(sums[found] - 1 / size, 0) / max(1, many[c] - 1)
            values = scale(np.maximum(others[found], own))
            means.append(values.mean() if len(found) else 0.0)
            variances.append(values.var() if len(found) else 0.0)
            sizes.append(size)
    spread = float(np.sqrt(np.mean(variances)))
    low, middle = np.percentile(np.array(means) + ERRORS * spread * np.sqrt(GRAMS / np.array(sizes)), [1, 50])
    return scale(first), spread, float(low - 1.5 * (middle - low))


def fit(
    languages: list[str], labels: np.ndarray, packed: np.ndarray, landmarks: int = LANDMARKS, letters: np.ndarray | None = None
) -> Model:
    """From packed presence rows, ordered so that the first ones of each language are its landmarks.

    ``letters`` are those of one of the ``stretches`` of each text (None: the same rows).
    """
    count = len(languages)
    if not count:
        return Model([], np.zeros((1 << BITS, 0)), np.zeros(1 << BITS))
    chosen = np.concatenate([np.flatnonzero(labels == c)[: max(1, landmarks // count)] for c in range(count)])

    def unpacked(some: np.ndarray) -> np.ndarray:
        rows_ = np.unpackbits(packed[some], axis=1).astype(np.float32)
        rows_ /= np.sqrt(np.maximum(rows_.sum(axis=1, keepdims=True), 1))
        return rows_

    marks = unpacked(chosen)
    kernel = np.concatenate([unpacked(part) @ marks.T for part in np.array_split(np.arange(len(labels)), len(labels) // 128 + 1)])
    kernel = kernel.astype(np.float64)
    among = kernel[chosen]
    target = np.where(labels[:, None] == np.arange(count), 1.0, -1.0)
    # Every language weighs the same, however many of its documents are in the sample.
    weight = (1 / np.bincount(labels, minlength=count))[labels][:, None]
    left = kernel.T @ (kernel * weight) + RIDGE * count * among + 1e-9 * np.eye(len(chosen))
    factors = np.linalg.solve(left, kernel.T @ (target * weight))
    # twice as large in double precision: some features at a time
    weights = np.concatenate([marks[:, i : i + STRETCH].T.astype(np.float64) @ factors for i in range(0, 1 << BITS, STRETCH)])
    del marks
    return Model(languages, weights, *_evidence(labels, packed if letters is None else letters))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document's id puts it into the fifth that nothing is learned from; null ids belong there too."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def has_letter(text_col: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))


def _presence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits, letters = [], []
        for rank, text in rows(iter([batch]), "rank", "text", step=64):
            parts = stretches(text)
            bits.append(np.packbits(presence(text)).tobytes())
            letters.append(np.packbits(presence(parts[rank % len(parts)])).tobytes())
        columns = [batch.column(0), batch.column(1), pa.array(bits, pa.binary()), pa.array(letters, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "rank", "bits", "letters"])


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents outside the held-out fifth.

    Every language has an equal share of the sample, one document at least, chosen by a hash of the id; more than
    LANGUAGES are an error. Texts without a letter and rows without a language are not learned from. What reaches the
    driver is one count for each language and 16 KB for each document of the sample.
    """
    usable = df.where(~held_out(id_col) & F.col(f"`{lang_col}`").isNotNull() & has_letter(text_col)).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.xxhash64(F.lit("langid"), F.col(f"`{id_col}`").cast("long")).alias("rank"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
    )
    counts = small_or_none(usable.groupBy("lang").agg(F.count("*").alias("n")), LANGUAGES)
    if counts is None:
        raise ValueError(f"column {lang_col} has more than {LANGUAGES} values: no languages")
    if not counts:
        return fit([], np.zeros(0, int), np.zeros((0, 0), np.uint8))
    share = max(1, sample // len(counts))
    # By the law of large numbers twice the share below this mark of the hash; then exactly the share.
    marks = [(r.lang, min(2**63 - 1, (2 * share + 64) * 2**63 // r.n)) for r in counts]
    marks = local_rows(df.sparkSession, marks, "lang string, mark long")
    below = F.col("rank").bitwiseAND(2**63 - 1) <= F.col("mark")
    few = usable.join(F.broadcast(marks), "lang").where(below).select("lang", "rank", "text")
    drawn = few.mapInArrow(_presence_rows, "lang string, rank long, bits binary, letters binary")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("rank").bitwiseAND(2**63 - 1), "rank", "bits"))
    found = drawn.withColumn("place", place).where(F.col("place") <= share).orderBy("lang", "place").drop("rank", "place").toArrow()
    langs = found.column("lang").to_pylist()
    if not langs:
        return fit([], np.zeros(0, int), np.zeros((0, 0), np.uint8))
    languages = sorted(set(langs))
    labels = np.array([languages.index(lang) for lang in langs])
    # rows of one width: the bytes are read where they are, and let go with the table
    bits, letters = (np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in found.column(c)]) for c in ("bits", "letters"))
    del found, langs
    model = fit(languages, labels, bits, letters=letters)
    del bits, letters
    give_back()
    return model


def classify(model: Model, df: DataFrame, text_col: str = "text") -> Column:
    """A struct of ``lang`` and ``score`` for the whole text; ``und`` with score 0 for a text without a letter."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def decide(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for texts, letters in batches:
            decisions = model.decide([t if ok else None for t, ok in zip(texts, letters, strict=True)])
            known = letters.to_numpy(bool) & (len(model.languages) > 0)
            best = decisions.argmax(axis=1) if model.languages else np.zeros(len(texts), int)
            top = decisions.max(axis=1) if model.languages else np.zeros(len(texts))
            score = np.where(known, np.clip((top + 1) / 2, 0.0, 1.0), 0.0)
            yield pd.DataFrame({"lang": names[np.where(known, best, len(model.languages))], "score": score})

    return decide(F.col(f"`{text_col}`").cast("binary"), has_letter(text_col))


def predict(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, by a model that is trained on the same table.

    The language column, the source and the id decide who is learned from, never a prediction. A text that is null or
    has no letter is ``und`` with score 0; so is every text if there is nothing to learn from. A score is the winning
    machine's decision, moved from -1..1 to 0..1; of equal decisions the language that sorts first wins. Repeated rows
    give repeated rows, no rows none. Very long texts are read in parts.
    """
    model = train(df, id_col, text_col, lang_col)
    found = classify(model, df, text_col)
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), found.alias("found")
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def keep_known(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", minimum: float | None = None
) -> DataFrame:
    """The rows of ``df`` with a letter whose features are those of learned languages, each with its language identified.

    ``minimum`` is the evidence a text must exceed; None is what the labelled sample says. A text in several learned
    languages has the evidence of each. A text of a few letters has little for or against it, and mostly stays. All
    columns stay; the language column names the language whose machine decides for the whole text, as ``predict`` does,
    labelled or not. If there is nothing to learn from, it stays as it is.
    """
    model = train(df, id_col, text_col, lang_col)
    if not model.languages:
        return df.where(has_letter(text_col))
    shared, least = df.sparkSession.sparkContext.broadcast(model), model.least if minimum is None else minimum
    letter = "_letter"
    while letter in df.columns:
        letter += "_"
    marked = df.withColumn(letter, has_letter(text_col))
    run = partial(_identified, shared, least, marked.columns.index(text_col), marked.columns.index(lang_col))
    return marked.mapInArrow(run, df.schema)


def _identified(shared, least: float, text: int, lang: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with a letter, which the last column tells, whose evidence is enough, and their languages; a few at a time."""
    names = pa.array(shared.value.languages)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            letters = part.column(part.num_columns - 1).to_pylist()
            texts = part.column(text).cast(pa.binary()).to_pylist()
            found = shared.value.weigh([t if ok else None for t, ok in zip(texts, letters, strict=True)])
            kept = (found > least) & np.array(letters, bool)
            part = part.filter(pa.array(kept)).drop_columns(part.schema.names[-1:])
            best = shared.value.decide([t for t, ok in zip(texts, kept, strict=True) if ok]).argmax(axis=1)
            columns = part.columns
            columns[lang] = names.take(pa.array(best)).cast(columns[lang].type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)
    give_back()
