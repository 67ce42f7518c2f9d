"""Language ID by string-kernel classification.

The kernel of two texts is the number of character n-grams (1 to ``ORDER``) present in both, divided by the
root of the product of their own numbers: the normalised blended-spectrum presence kernel. Grams are
hashed to ``BUCKETS`` places. Kernel ridge regression, one language against the rest, is solved on
Nystroem landmarks. A prediction is linear in the text's presence vector, so a batch of texts is scored by
one matrix product with the landmarks' presence vectors already multiplied by their coefficients.

Learning uses at most ``SAMPLE`` texts per language, those with the smallest hash of doc_id, ``LANDMARKS``
of them as landmarks; this bounds the driver's work. Every text is scored whole.

Null text and text without a letter are ``und`` with score 0, as is everything if nothing can be learned.
Rows with null doc_id are not held out and not learned from. Of rows that repeat a
doc_id only the least (by language, then text) is learned from, so that the order of rows doesn't matter. Ties go to the smaller language name.
Repeated rows give repeated results; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landmart.llm.common import sample

ORDER = 3
BUCKETS = 1 << 18
SAMPLE = 300
LANDMARKS = 48
RIDGE = 1e-3
FOLDS, HELD = 4, 2
BATCH = 128
LETTER = regex.compile(r"\p{L}")
UND = "und"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def places(text: str) -> np.ndarray:
    """The places of all grams of a text, with repetitions."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    grams, g = [c], c
    for n in range(1, ORDER):
        g = g[:-1] | (c[n:] << np.uint64(21 * n))
        grams.append(g)
    return (np.concatenate(grams) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKETS.bit_length() + 1)


@dataclass(frozen=True)
class Model:
    """``column`` gives a place's row in ``weights``; places that no landmark has share the last, zero, row."""

    languages: list[str]
    column: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Texts by languages."""
        here = np.zeros((len(texts), len(self.weights)), np.float32)
        norm = np.ones(len(texts), np.float32)
        seen = np.zeros(BUCKETS, bool)
        for i, text in enumerate(texts):
            at = places(text)
            seen[at] = True
            norm[i] = max(1, np.count_nonzero(seen))
            seen[:] = False
            here[i, self.column[at]] = 1
        return (here @ self.weights) / np.sqrt(norm)[:, None]


def fit(found: list[tuple[str, np.ndarray]]) -> Model:
    """``found``: language and distinct places of each sampled text, landmarks of a language first."""
    languages = sorted({lang for lang, _ in found})
    used: dict[str, int] = {}
    marks = []
    for k, (lang, _) in enumerate(found):
        used[lang] = used.get(lang, 0) + 1
        if used[lang] <= LANDMARKS:
            marks.append(k)
    dictionary = np.unique(np.concatenate([found[k][1] for k in marks]))
    column = np.full(BUCKETS, len(dictionary), np.int32)
    column[dictionary] = np.arange(len(dictionary))

    def present(rows: list[int]) -> np.ndarray:
        out = np.zeros((len(rows), len(dictionary) + 1), np.float32)
        for i, k in enumerate(rows):
            out[i, column[found[k][1]]] = 1
            out[i] /= np.sqrt(len(found[k][1]))
        out[:, -1] = 0
        return out

    landmarks = present(marks)
    kernel = np.concatenate([present(list(range(i, min(i + BATCH, len(found))))) @ landmarks.T for i in range(0, len(found), BATCH)]).astype(np.float64)
    own = (landmarks @ landmarks.T).astype(np.float64)
    goal = np.array([[1.0 if lang == x else -1.0 for x in languages] for lang, _ in found])
    left = kernel.T @ kernel + RIDGE * len(found) * (own + 1e-6 * np.eye(len(marks)))
    return Model(languages, column, (landmarks.T @ np.linalg.solve(left, kernel.T @ goal)).astype(np.float32))


def train(docs: DataFrame) -> Model | None:
    """Learns from text and non-null lang of documents that are not held out."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))
    )
    chosen = sample(rows, "lang", SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(places(x.as_py())).astype(np.int32) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("n"), pa.array(found, pa.list_(pa.int32()))], ["lang", "n", "at"])

    got = chosen.select("lang", "n", "text").mapInArrow(run, "lang string, n int, at array<int>").orderBy("lang", "n").collect()
    found = [(r["lang"], np.array(r["at"], np.int64)) for r in got if r["at"]]
    return fit(found) if found else None


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column("text")
            langs: list[str] = []
            sure: list[float] = []
            for start in range(0, len(texts), BATCH):
                part = texts.slice(start, BATCH).to_pylist()
                real = [i for i, x in enumerate(part) if known and x and LETTER.search(x)]
                lang, score = [UND] * len(part), [0.0] * len(part)
                if real:
                    f = known.scores([part[i] for i in real])
                    best = f.argmax(1)
                    odds = np.exp(np.clip(4 * (f - f.max(1, keepdims=True)), -60, 0))
                    share = 1 / odds.sum(1)
                    for i, b, s in zip(real, best, share):
                        lang[i], score[i] = known.languages[b], float(s)
                langs += lang
                sure += score
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(sure, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def digest(docs: DataFrame) -> DataFrame:
    return predicted(docs, train(docs))
