"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, takes accents off, and maps look-alike letters of other scripts and digits or signs
used as letters to a to z; entries that have accents are sought in the text with its accents. The lexicon is learned: beginnings of words (``SHORT`` to ``LONG`` letters)
weighted by their log odds between toxic and clean labelled documents. Of an entry and its own beginnings the
one that explains most toxic documents stays. An entry counts where a word begins, unless an exception phrase covers it: fixed phrases with
harmless meanings, and whole words that clean documents use more than toxic ones. The weights found in a
document, as they are and per word, go through a logistic regression to a score from 0 to 1.

Learning uses at most ``TOXIC`` toxic and ``CLEAN`` clean labelled documents, those with the smallest hash of
doc_id; this bounds lexicon and driver work. Every text is scored whole.

Null and empty texts have no hits and get the score of such texts, which is always below 1/2. If one of the classes has no learnable
document, every score is 0. Null doc_ids are not held out. Repeated label rows count once, conflicting ones as
toxic. Repeated rows give repeated results, empty tables empty results; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landmart.llm.common import documents, sample

FOLDS, HELD = 5, 0
TOXIC, CLEAN = 1500, 3000
SHORT, LONG = 3, 9
MIN_TOXIC = 5
MIN_ODDS = 2.5
#: Log odds that a text without hits has at most, so it is never predicted toxic.
CALM = -1.0
#: Letters of other scripts, digits and signs that are written for Latin letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "п": "n", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "υ": "u", "ѵ": "v", "ԝ": "w", "х": "x",
    "у": "y", "α": "a", "β": "b", "ϲ": "c", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ø": "o", "ł": "l", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s",
    "7": "t", "8": "b", "@": "a", "$": "s",
}
#: Phrases in which an entry has a harmless meaning.
PHRASES = ("trash can", "trash bin", "clown fish", "clownfish", "idiot proof", "pond scum")
WORD = re.compile(r"[^\W\d_]+")
MARKS = {c: None for c in range(0x300, 0x370)}
FOLD = MARKS | {ord(k): v for k, v in LOOKALIKES.items()}


def fold(text: str) -> str:
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
    return text.lower().translate(FOLD)


def with_marks(text: str) -> str:
    """The lower-cased text with its accents, which tell some words apart that fold to the same."""
    return unicodedata.normalize("NFC", text).lower()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = PHRASES

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for phrase in self.exceptions:
            out.add_word(phrase, (len(phrase), None, not phrase.isascii()))
        for entry, weight in self.weights.items():
            out.add_word(entry, (len(entry), weight, not entry.isascii()))
        out.make_automaton()
        return out


def weight_in(form: str, automaton: ahocorasick.Automaton, marked: bool) -> float:
    """The weight of all hits in one form of a text; in the ``marked`` form only entries with marks count."""
    hits, spared = [], []
    for end, (size, weight, has_marks) in automaton.iter(form):
        start = end + 1 - size
        if (marked and not has_marks) or (start and form[start - 1].isalpha()):
            continue
        (spared if weight is None else hits).append((start, end, weight))
    if spared:
        hits = [h for h in hits if not any(s <= h[0] and h[1] <= e and not form[e + 1:e + 2].isalpha() for s, e, _ in spared)]
    return sum(h[2] for h in hits)


def features(text: str, automaton: ahocorasick.Automaton) -> tuple[float, float]:
    """The weight of all hits, and that per word, both on a log scale."""
    if not text or not len(automaton):
        return 0.0, 0.0
    folded = fold(text)
    total = weight_in(folded, automaton, False)
    if not text.isascii():
        total += weight_in(with_marks(text), automaton, True)
    return float(np.log1p(total)), float(np.log1p(100 * total / (len(folded) / 6 + 10)))


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    coefficients: tuple[float, ...]

    def score(self, found: tuple[float, float]) -> float:
        a, b, c = self.coefficients
        return float(1 / (1 + np.exp(-np.clip(a + b * found[0] + c * found[1], -40, 40))))


def sample_of(labels: DataFrame) -> DataFrame:
    """At most TOXIC and CLEAN labelled doc_ids that may be learned from."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    pick = lambda toxic, n: sample(rows.filter(F.col("toxic") == toxic), "toxic", n).drop("n")
    return pick(1, TOXIC).unionByName(pick(0, CLEAN))


def beginnings(text: str) -> set[str]:
    """Beginnings of the folded words, and whole words marked by a blank at their end."""
    words = set(WORD.findall(fold(text)))
    if not text.isascii():
        words |= {w for w in WORD.findall(with_marks(text)) if not w.isascii()}
    out = {w[:n] for w in words for n in range(SHORT, min(LONG, len(w)) + 1)}
    return out | {w + " " for w in words if len(w) >= SHORT}


def learn_lexicon(rows: DataFrame) -> Lexicon | None:
    """From (text, toxic) rows: counts of documents by entry, summed in tasks before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic].update(beginnings(text or ""))
                seen[toxic][""] += 1
        entries = sorted(set(seen[0]) | set(seen[1]))
        for i in range(0, len(entries), 100_000):
            part = entries[i:i + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), *(pa.array([c[e] for e in part], pa.int64()) for c in seen)], ["entry", "clean", "toxic"])

    counts = rows.select("text", "toxic").mapInArrow(count, "entry string, clean long, toxic long").groupBy("entry").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).persist()
    try:
        totals = counts.filter("entry = ''").collect()
        if not totals or not totals[0]["clean"] or not totals[0]["toxic"]:
            return None
        odds = F.log((F.col("toxic") + 0.5) / (totals[0]["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (totals[0]["clean"] + 1))
        # the labelled sample is bounded, and nothing else bounds its entries: a few tasks, which send their best to the driver
        rated = counts.filter("entry <> ''").coalesce(8).withColumn("odds", odds)
        best = rated.filter(~F.col("entry").endswith(" ") & (F.col("toxic") >= MIN_TOXIC) & (F.col("odds") >= MIN_ODDS)).orderBy(
            F.desc(F.col("odds") * F.col("toxic")), F.desc(F.length("entry")), "entry").collect()
        weights: dict[str, float] = {}
        started: set[str] = set()  # what entries begin with
        for r in best:
            e = r["entry"]
            if e not in started and not any(e[:n] in weights for n in range(SHORT, len(e))):
                weights[e] = r["odds"]
                started.update(e[:n] for n in range(SHORT, len(e) + 1))
        harmless = rated.filter(F.col("entry").endswith(" ") & (F.col("odds") < 0) & (F.col("clean") >= 1)).filter(
            F.substring("entry", 1, SHORT).isin(sorted({w[:SHORT] for w in weights}))).select("entry").collect()
    finally:
        counts.unpersist()
    spared = {w for w in (r["entry"][:-1] for r in harmless) if any(w[:n] in weights for n in range(SHORT, LONG + 1))}
    return Lexicon(weights, tuple(sorted((spared | set(PHRASES)) - set(weights))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton steps for a ridge-penalised logistic regression; the first column of ``x`` is 1."""
    b = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(b))
    penalty[0, 0] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ b)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return b


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Lexicon and logistic regression from labelled documents that are not held out."""
    chosen = sample_of(labels)
    # of rows that repeat a doc_id the least text is learned, whatever their order
    learned = documents(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.min(F.struct("text", "toxic")).alias("row")).select("doc_id", "row.*").persist()
    try:
        lexicon = learn_lexicon(learned)
        if lexicon is None:
            return None

        def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = lexicon.automaton()
            for batch in batches:
                found = [features(x, automaton) for x in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic"), *(pa.array([f[i] for f in found], pa.float64()) for i in (0, 1))], ["toxic", "a", "b"])

        rows = learned.select("toxic", "text").mapInArrow(rate, "toxic int, a double, b double").orderBy("toxic", "a", "b").collect()
    finally:
        learned.unpersist()
    x = np.array([[1.0, r["a"], r["b"]] for r in rows])
    found = logistic(x, np.array([float(r["toxic"]) for r in rows]))
    return Model(lexicon, (min(found[0], CALM), *found[1:]))


def scored(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score and the columns ``keep`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        automaton = known.lexicon.automaton() if known else None
        for batch in batches:
            scores = [known.score(features(x.as_py() or "", automaton)) if known else 0.0 for x in batch.column("_text")]
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(scores, pa.float64())], [*names, "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, F.col("text").cast("string").alias("_text"))
    schema = rows.drop("_text").schema.add("score", "double")
    return rows.mapInArrow(run, schema)


def clean(docs: DataFrame, model: Model | None, limit: float = 0.5) -> DataFrame:
    """The documents with a score below ``limit``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        automaton = known.lexicon.automaton() if known else None
        for batch in batches:
            fine = [not known or known.score(features(x.as_py() or "", automaton)) < limit for x in batch.column("text")]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return scored(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
