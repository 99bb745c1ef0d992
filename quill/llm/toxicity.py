"""Toxicity: non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; other documents, whatever they are,
are the unlabelled. A linear classifier in numpy over hashed words and
word beginnings (present, and repeated) minimises the class-prior-corrected risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with the logistic loss; while the second term is negative a step goes up its
gradient instead, so unlabelled toxic texts are not learned as clean. The prior is
the share of toxic rows among the labelled training rows. Training takes at most
``POSITIVES`` and ``UNLABELLED`` rows, the first by hash of ``doc_id`` and of rows that
share an id the one whose text has the least hash: a bounded sample, whose bound makes the fit a fixed cost. Scores cover every whole text.

Only rows whose crc32(doc_id as text) mod 4 is not 2 serve for training; labels,
lang, source and doc_id are no inputs of a score.

Defined results: a null or empty text gets the classifier's score for no words;
equal texts get equal scores; rows with null doc_id are scored, never trained on,
and not held out; without any positive label every score is the prior 0; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quill.llm.text import LOWER, PUNCT, prefix_sums, range_hash, text_slices, word_spans

POSITIVES = 4000
UNLABELLED = 8000
FOLDS, HELD_OUT = 4, 2
BITS = 18
SIZE = 1 << (BITS + 1)
#: bytes of the beginnings that are features besides whole words
BEGINNINGS = (4, 6, 8)
REPEATS = 2
#: a feature that fewer training rows have gets no weight
LEAST_ROWS = 10
STEPS = 120
RATE, BIAS_RATE = 8.0, 0.8
DECAY = 3e-5
THRESHOLD = 0.3


def fold():
    """crc32 of ``doc_id`` as text, modulo ``FOLDS``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def features(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(indices, bounds)`` per slice of a text column: the distinct hashed words and
    word beginnings of row ``i`` are ``indices[bounds[i]:bounds[i + 1]]``; one that
    occurs ``REPEATS`` times or more has another entry."""
    for _, buf, offs in text_slices(column, 1 << 19):
        buf = LOWER[buf]
        starts, ends, first = word_spans(buf, offs, PUNCT)
        row = np.repeat(np.arange(len(offs) - 1), np.diff(first)) << (BITS + 1)
        acc, shift = prefix_sums(buf), np.uint64(64 - BITS)
        keys = [row | (range_hash(acc, starts, ends) >> shift).astype(np.int64)]
        for n in BEGINNINGS:
            longer = ends - starts > n
            s = starts[longer]
            keys.append(row[longer] | (range_hash(acc, s, s + n) * np.uint64(2 * n + 1) >> shift).astype(np.int64))
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        key = np.sort(np.concatenate([key, key[count >= REPEATS] | (1 << BITS)]))
        bounds = np.searchsorted(key >> (BITS + 1), np.arange(len(offs)))
        yield (key & ((1 << BITS + 1) - 1)).astype(np.int32), bounds


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Classifier:
    """Linear scorer over tf-idf-like unit rows, trained by the non-negative PU risk."""

    def __init__(self):
        self.weights = np.zeros(SIZE)
        self.idf = np.zeros(SIZE)           # 0 for features too rare to count
        self.bias = 0.0

    def values(self, index: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        v = self.idf[index]
        size = np.sqrt(row_sums(v * v, bounds))
        size[size == 0] = 1
        return v / np.repeat(size, np.diff(bounds))

    def margins(self, index: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return row_sums(self.values(index, bounds) * self.weights[index], bounds) + self.bias

    def fit(self, positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
            steps: int = STEPS) -> "Classifier":
        """Accelerated full-batch descent; ``positives`` and ``unlabelled`` are rows."""
        rows = [*positives, *unlabelled]
        n_p, n_u = len(positives), len(unlabelled)
        with_it = np.bincount(np.concatenate(rows), minlength=SIZE)
        self.idf = np.where(with_it >= LEAST_ROWS, np.log((len(rows) + 1) / (with_it + 1)), 0.0)
        rows = [x[with_it[x] >= LEAST_ROWS] for x in rows]
        bounds = np.cumsum([0, *map(len, rows)])
        index = np.concatenate(rows)
        value = self.values(index, bounds)
        self.bias = ahead_bias = float(np.log(prior / (1 - prior)))
        ahead, t = self.weights.copy(), 1.0
        for _ in range(steps):
            q = sigmoid(row_sums(value * ahead[index], bounds) + ahead_bias)
            slope = self._slopes(q, n_p, n_u, prior)
            grad = np.bincount(index, np.repeat(slope, np.diff(bounds)) * value, SIZE) + DECAY * ahead
            new, new_bias = ahead - RATE * grad, ahead_bias - BIAS_RATE * float(slope.sum())
            t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
            ahead = new + (t - 1) / t_new * (new - self.weights)
            ahead_bias = new_bias + (t - 1) / t_new * (new_bias - self.bias)
            self.weights, self.bias, t = new, new_bias, t_new
        return self

    @staticmethod
    def _slopes(q: np.ndarray, n_p: int, n_u: int, prior: float) -> np.ndarray:
        """Derivative of the risk by each row's margin; positives come first."""
        as_negative = -np.log1p(-np.minimum(q, 1 - 1e-9))
        negative_risk = as_negative[n_p:].mean() - prior * as_negative[:n_p].mean()
        out = np.empty(len(q))
        if negative_risk >= 0:
            out[:n_p] = prior * (q[:n_p] - 1) / n_p - prior * q[:n_p] / n_p
            out[n_p:] = q[n_p:] / n_u
        else:                                   # back out of the over-fitted negative part
            out[:n_p] = prior * q[:n_p] / n_p
            out[n_p:] = -q[n_p:] / n_u
        return out


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[list[np.ndarray], list[np.ndarray], float]:
    """Features of the bounded training sample, and the class prior."""
    usable = labels.where(F.col("doc_id").isNotNull() & (fold() != HELD_OUT) & F.col("toxic").isNotNull())
    stats = usable.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("t")).first()
    if not stats["n"] or not stats["t"]:
        return [], [], 0.0
    by_hash = (F.xxhash64("doc_id"), "doc_id")
    positive = usable.where("toxic = 1").select("doc_id").distinct().orderBy(*by_hash).limit(POSITIVES)
    other = docs.where(F.col("doc_id").isNotNull() & (fold() != HELD_OUT)).select("doc_id").distinct().orderBy(
        *by_hash).limit(UNLABELLED)
    # at most POSITIVES + UNLABELLED rows of one number and a flag: safe to broadcast
    chosen = positive.select("doc_id", F.lit(1).alias("p")).unionAll(other.select("doc_id", F.lit(0).alias("p")))
    chosen = chosen.groupBy("doc_id").agg(F.max("p").alias("p"), (F.min("p") == 0).alias("u"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "p", "u").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("m")).select("m.text", "p", "u", "doc_id")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [index[a:b].tobytes() for index, bounds in features(batch.column(0))
                     for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), *batch.columns[1:]],
                                             ["words", "p", "u", "doc_id"])

    p, u = [], []
    sample = rows.mapInArrow(encode, "words binary, p int, u boolean, doc_id long").orderBy(*by_hash, "words")
    for r in sample.toLocalIterator():
        words = np.frombuffer(bytes(r.words), np.int32)
        if r.p:
            p.append(words)
        if r.u:
            u.append(words)
    return p, u, min(0.9, stats["t"] / stats["n"])


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    p, u, prior = training_rows(docs, labels)
    if not p or not u:
        nothing = Classifier()
        nothing.bias = float("-inf")
        return nothing
    return Classifier().fit(p, u, prior)


def score_toxicity(docs: DataFrame, model: Classifier) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document."""
    weights = docs.sparkSession.sparkContext.broadcast(
        (model.weights, model.idf, model.bias))  # twice SIZE floats, always

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classifier()
        own.weights, own.idf, own.bias = weights.value
        for batch in batches:
            z = [own.margins(index, bounds) for index, bounds in features(batch.column(1))]
            q = sigmoid(np.concatenate(z)) if z and np.isfinite(own.bias) else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(q)], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        score, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
