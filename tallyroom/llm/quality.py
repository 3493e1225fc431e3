"""Document quality: logistic regression on hashed word n-grams, trained with FTRL-proximal updates."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import held_out, sample_labelled
from .store import fresh, sliced, text_or_empty

BITS = 18
#: Most labelled documents that the model is fitted on.
SAMPLE = 8_000
EPOCHS = 2
THRESHOLD = 0.3

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SAME = np.uint64(xxhash.xxh64_intdigest(b"the same word again"))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: counts of its words and word pairs, scaled to length one.

    Words are runs of letters and digits, or of marks. A pair of equal words falls into one bucket of
    its own, whatever the word.
    """
    words = _TOKEN.findall(text)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    with np.errstate(over="ignore"):
        pairs = np.where(h[1:] == h[:-1], _SAME, h[:-1] * _STEP + h[1:])
        hashed = np.concatenate((h, pairs)) * _MIX
    at, count = np.unique((hashed >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    value = count.astype(np.float64)
    norm = np.sqrt((value * value).sum())
    return at, value / norm if norm else value


class Ftrl:
    """Follow-the-regularised-leader for a sparse logistic model; one bias without regularisation."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | None = None) -> np.ndarray:
        z, n = (self.z, self.n) if at is None else (self.z[at], self.n[at])
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        at, x = np.append(at, 1 << BITS), np.append(x, 1.0)
        w = self.weights(at)
        g = (_sigmoid(float(w @ x)) - y) * x
        s = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - s * w
        self.n[at] += g * g


def _sigmoid(v: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(v, -35.0, 35.0))))


def fit(rows: list[tuple[str, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last one is the bias) after passes over the rows in the given order.

    Without rows all weights are zero and every score is one half.
    """
    model, made = Ftrl(), [(*features(t), y) for t, y in rows]
    for _ in range(epochs):
        for at, x, y in made:
            model.learn(at, x, y)
    return model.weights()


def score(weights: np.ndarray, text: str) -> float:
    at, x = features(text)
    return _sigmoid(float(weights[at] @ x + weights[-1]))


def _fit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drawn = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]
    drawn.sort(key=lambda r: (r[2], r[0]))
    w = fit([(t, y) for t, y, _ in drawn])
    at = np.nonzero(w)[0]
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["bucket", "weight"])


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> np.ndarray:
    """The model from at most ``bound`` labelled documents, in one task; held-out rows never take part.

    The result has a fixed size (2**18 buckets), so it may come to the driver and go to all tasks.
    """
    drawn = sample_labelled(docs, labels, "quality", bound).repartition(1)
    weights = np.zeros((1 << BITS) + 1)
    for bucket, weight in drawn.mapInArrow(_fit_batches, "bucket long, weight double").collect():
        weights[bucket] = weight
    return weights


def scored(docs: DataFrame, weights: np.ndarray, name: str) -> DataFrame:
    """``docs`` with a last column ``name``; all other columns pass through untouched."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    width, names = len(docs.columns), [*docs.columns, name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for b in sliced(batches):
            got = pa.array([score(w, t) for t in b.column(width).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(width)), got], names)

    given = docs.select("*", text_or_empty().alias(fresh(docs, "text_")))
    return given.mapInArrow(run, docs.withColumn(name, F.lit(0.0)).schema)


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Only the text is looked at; null text counts as empty and gets the score of the bias. Rows that
    repeat an id are scored one by one, null ids are held out, an empty table gives no rows, and
    without labels every score is one half. Other columns are ignored.
    """
    return scored(docs.select("doc_id", "text"), train(docs, labels), "score").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` whose quality score reaches the threshold, with all their columns.

    Null and empty texts are judged by the bias alone; rows that repeat an id are judged one by one.
    """
    name = fresh(docs, "score")
    return scored(docs, train(docs, labels), name).where(F.col(name) >= threshold).select(*docs.columns)
