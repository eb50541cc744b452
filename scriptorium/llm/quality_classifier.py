"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

Features are the words, the word pairs, the words' shapes (letters and digits
folded), the pairs of shapes and a word's immediate repetition, hashed to ``2 ** BITS`` columns; a feature's
value is its share of all occurrences in the text.  Scoring is a sparse dot
product over the whole text.

Training uses at most ``SAMPLE`` labelled rows of the training fold, those with
the smallest hash of their id: a documented bound, the same at every input
size.  One task learns from them and returns the weights, ``2 ** BITS`` small
numbers, which go to the scoring tasks.  Everything else covers all rows.

Cases: a null or empty text scores the bias alone.  Without labelled rows every
text scores 0.5.  Null labels are no labels; rows with equal ids learn the
label of their id; a null id is never held out and never labelled.
Building the frame runs Spark jobs and lowers the session's Arrow batch size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import blocks, bounded_batches, texts

BITS = 18
SAMPLE = 6000
FOLDS, HELD_FOLD = 4, 2
EPOCHS = 4
# Rates of the FTRL-proximal update.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-5, 1e-4
SCALE = 8.0  # the shares of a text sum to this, for each kind of feature
KNOWN_WORDS = 1_000_000

_RUN = re.compile(r"([a-z])+|([0-9])+|([^\x00-\x7f])+")


def _shape(word: str) -> str:
    folded = _RUN.sub(lambda m: "a" if m[1] or m[3] and m[0].isalpha() else "9" if m[2] else m[0][:1], word.lower())
    return ("A" if word[:1].isupper() else "") + ("U" if len(word) > 1 and word.isupper() else "") + folded[:12]


class Features:
    """Column numbers of whole texts; words are hashed once and remembered."""

    def __init__(self):
        import xxhash

        self._hash = xxhash.xxh64_intdigest
        self._known: dict[str, int] = {}
        self._table = np.zeros((1 << 10, 2), np.uint64)

    def _number(self, word: str) -> int:
        k = len(self._known)
        if k == len(self._table):
            self._table = np.concatenate((self._table, np.zeros_like(self._table)))
        self._table[k] = self._hash(word.lower().strip(".,")), self._hash(_shape(word), 7)
        self._known[word] = k
        return k

    def of(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(columns, text number of each column), every occurrence one entry; kinds follow one another."""
        if len(self._known) > KNOWN_WORDS:
            self._known.clear()
        get, fresh = self._known.get, self._number
        numbers, sizes = [], []
        for text in docs:
            words = text.split()
            sizes.append(len(words))
            for w in words:
                k = get(w)
                numbers.append(fresh(w) if k is None else k)
        sizes = np.asarray(sizes, np.int64)
        of = np.repeat(np.arange(len(docs)), sizes)
        word, shape = self._table[np.asarray(numbers, np.int64)].T if numbers else np.zeros((2, 0), np.uint64)
        pair = of[1:] == of[:-1]
        mix = lambda h, k: (h * np.uint64(0x9E3779B97F4A7C15) ^ (h >> np.uint64(29)) + np.uint64(k)) >> np.uint64(64 - BITS)
        two = lambda h: (h[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + h[1:])[pair]
        again = of[1:][pair & (word[1:] == word[:-1])]
        columns = np.concatenate([mix(word, 1), mix(shape, 2), mix(two(word), 3), mix(two(shape), 4), np.zeros(len(again), np.uint64)])
        return columns.astype(np.int64), np.concatenate([of, of, of[1:][pair], of[1:][pair], again])


def _shares(features: Features, docs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    columns, of = features.of(docs)
    count = np.bincount(of, minlength=len(docs))
    return columns, of, SCALE / np.maximum(count, 1)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def train(docs: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> tuple[np.ndarray, float]:
    """(weights, bias) after ``epochs`` passes in a seeded order."""
    n = 1 << BITS
    z, g2, features = np.zeros(n + 1), np.zeros(n + 1), Features()
    examples = []
    for text in docs:
        columns, _, share = _shares(features, [text])
        own, count = np.unique(columns, return_counts=True)
        examples.append((np.append(own, n), np.append(count * share[0], 1.0)))

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(g2[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            at, x = examples[i]
            w = weights(at)
            grad = (_sigmoid(w @ x) - labels[i]) * x
            rate = (np.sqrt(g2[at] + grad * grad) - np.sqrt(g2[at])) / ALPHA
            z[at] += grad - rate * w
            g2[at] += grad * grad
    w = weights(np.arange(n + 1))
    return w[:n], float(w[n])


def held_out(doc_id: Column) -> Column:
    """Whether a row is in the fold that training never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_FOLD, F.lit(False))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [r for b in batches for r in b.to_pylist()]
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    w, bias = train([r["text"] for r in rows], np.asarray([r["label"] for r in rows], float)) if rows else (np.zeros(1 << BITS), 0.0)
    yield pa.RecordBatch.from_arrays([pa.array([w.astype("<f4").tobytes()]), pa.array([bias])], names=["weights", "bias"])


def learned(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[np.ndarray, float]:
    """Weights and bias from a bounded sample of the labelled rows of the training fold."""
    bounded_batches(docs.sparkSession)
    own = labels.select("doc_id", F.col(label).cast("double").alias("label")).where("doc_id is not null and label is not null")
    sample = (
        own.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    )
    # The sample has at most SAMPLE rows of two numbers.
    rows = texts(docs, "doc_id").join(F.broadcast(sample), "doc_id").repartition(1)
    first = rows.mapInArrow(_learn, "weights binary, bias double").first()
    return (np.frombuffer(first.weights, "<f4").astype(float), first.bias) if first else (np.zeros(1 << BITS), 0.0)


def _scorer(weights: bytes, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, features = np.frombuffer(weights, "<f4").astype(float), Features()
        for table in blocks(batches):
            docs = table["text"].to_pylist()
            columns, of, share = _shares(features, docs)
            score = _sigmoid(np.bincount(of, w[columns], minlength=len(docs)) * share + bias)
            yield from table.select(["doc_id"]).append_column("score", pa.array(score)).to_batches()

    return run


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """(doc_id, held_out, score) of every row of ``docs``."""
    w, bias = learned(docs, labels, label)
    scores = texts(docs, "doc_id").mapInArrow(_scorer(w.astype("<f4").tobytes(), bias), "doc_id long, score double")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
