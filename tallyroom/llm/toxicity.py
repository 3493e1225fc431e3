"""Toxicity: gradient-boosted trees over a few dense features, calibrated by isotonic regression."""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folds import held_out, sample_labelled
from .store import sliced, text_or_empty

#: Most labelled documents that lexicon, trees and calibration are fitted on.
SAMPLE = 8_000
THRESHOLD = 0.5
#: Insults known without any labels, and words for the person spoken to (fixed values).
INSULTS = ("idiot", "moron", "loser", "scum", "stupid", "worthless", "pathetic", "disgusting", "trash", "clown")
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine ihr euch euer usted ti vosotros".split()
)
NEAR = 5
#: Look-alike characters and the letters they stand for (fixed values).
_PLAIN = str.maketrans("@4310$57!", "aaeiossti", "*._-")
_WORD = re.compile(r"\w+")
#: One or two marks between two letters; a word around them is sought only in texts that have any.
_HIDDEN = re.compile(r"[^\W\d_][@$!0-9*._-]{1,2}[^\W\d_]")
FEATURES = (
    "lexicon_density", "lexicon_count", "near_second_person", "second_person_rate", "capital_rate", "mark_rate",
    "exclamation_rate", "hidden_rate", "hidden_lexicon", "log_words",
)


def features(text: str, lexicon: frozenset[str], stems: frozenset[str]) -> list[float]:
    """Dense features of a whole text; all zero for a text without words.

    A word is a lexicon hit as a whole or by its first four to six letters. Time is linear in the text,
    also without blanks.
    """
    words = _WORD.findall(text.lower())
    if not words:
        return [0.0] * len(FEATURES)
    hits = [i for i, w in enumerate(words) if w in lexicon or w[:6] in stems or w[:5] in stems or w[:4] in stems]
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    close = 0
    if hits and persons:
        p = np.array(persons)
        at = np.searchsorted(p, hits)
        before = np.array(hits) - p[np.maximum(at - 1, 0)]
        after = p[np.minimum(at, len(p) - 1)] - np.array(hits)
        close = int(((np.abs(before) <= NEAR) | (np.abs(after) <= NEAR)).sum())
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    capitals = int(((raw >= 65) & (raw <= 90)).sum())
    small = int(((raw >= 97) & (raw <= 122)).sum())
    marks = int(((raw >= 33) & (raw <= 47)).sum())
    marked = [t for t in text.split() if _HIDDEN.search(t)] if _HIDDEN.search(text) else []
    hidden = [t.lower().strip(".,;:!?\"'()").translate(_PLAIN) for t in marked]
    n = len(words)
    disguised = sum(t in lexicon for t in hidden)
    return [
        1000.0 * (len(hits) + disguised) / n,
        float(len(hits) + disguised),
        1000.0 * close / n,
        1000.0 * len(persons) / n,
        capitals / max(1, capitals + small),
        marks / n,
        text.count("!") / n,
        1000.0 * len(hidden) / n,
        float(disguised),
        math.log(n),
    ]


def learn_lexicon(rows: list[tuple[str, int]], most: int = 300) -> tuple[frozenset[str], frozenset[str]]:
    """Words and word stems that occur almost only in toxic texts and in enough of them; insults known before."""
    held = (Counter(), Counter())
    for text, y in rows:
        words = {w for w in _WORD.findall(text.lower()) if not w.isdigit()}
        held[y].update(words)
        held[y].update({f"{w[:n]}*" for w in words for n in (4, 5, 6) if len(w) >= n})
    toxic = sum(y for _, y in rows)
    share = (len(rows) - toxic + 1) / (toxic + 1)
    least = max(4, toxic // 50)
    sure = [(c, w) for w, c in held[1].items() if c >= least and c * share >= 19 * held[0][w]]
    top = [w for _, w in sorted(sure, key=lambda x: (-x[0], x[1]))[:most]]
    return (
        frozenset(INSULTS) | {w for w in top if not w.endswith("*")},
        frozenset(w[:-1] for w in top if w.endswith("*")),
    )


class Boosted:
    """Logistic loss, trees of a fixed depth grown on binned features."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.trees: list[list[tuple[int, float, float]]] = []  # heap order: (feature or -1, cut, value)
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.start = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])] if len(y) else []
        binned = [np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]
        f = np.full(len(y), self.start)
        for _ in range(self.rounds if len(y) else 0):
            p = 1 / (1 + np.exp(-f))
            self.trees.append(self._grow(cuts, binned, y - p, p * (1 - p)))
            f += self._one(self.trees[-1], x)
        return self

    def _grow(self, cuts, binned, gradient, curvature):
        tree = [(-1, 0.0, 0.0)] * (2 ** (self.depth + 1) - 1)
        member = {0: np.arange(len(gradient))}
        for node in range(len(tree)):
            rows = member.pop(node, None)
            if rows is None:
                continue
            g, h = gradient[rows], curvature[rows]
            value = self.rate * float(g.sum() / (h.sum() + self.ridge))
            best = (1e-6, -1, 0)
            if node < 2**self.depth - 1:
                whole = g.sum() ** 2 / (h.sum() + self.ridge)
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    b = binned[j][rows]
                    gl = np.cumsum(np.bincount(b, g, len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(b, h, len(c) + 1))[:-1]
                    gain = gl**2 / (hl + self.ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + self.ridge) - whole
                    gain[(hl < 0.5) | (h.sum() - hl < 0.5)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, k)
            if best[1] < 0:
                tree[node] = (-1, 0.0, value)
                continue
            j, k = best[1:]
            tree[node] = (j, float(cuts[j][k]), value)
            right = binned[j][rows] > k
            member[2 * node + 1], member[2 * node + 2] = rows[~right], rows[right]
        return tree

    @staticmethod
    def _one(tree, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        feature, cut, value = (np.array(v) for v in zip(*tree, strict=True))
        while True:
            inner = feature[at] >= 0
            if not inner.any():
                return value[at]
            over = x[np.arange(len(x)), np.maximum(feature[at], 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + over, at)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((self._one(t, x) for t in self.trees), np.zeros(len(x)))


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the rising step-wise fit by pooling neighbours; scores in between are interpolated."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # sum of labels, weight, lowest and highest score
    for v, t in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        pools.append([float(t), 1.0, v, v])
        while len(pools) > 1 and (
            pools[-2][3] == pools[-1][2] or pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]
        ):
            s, w, _, hi = pools.pop()
            pools[-1] = [pools[-1][0] + s, pools[-1][1] + w, pools[-1][2], hi]
    xs, ys = [], []
    for s, w, lo, hi in pools:
        for v in (lo, hi) if hi > lo else (lo,):
            xs.append(v)
            ys.append((s + 0.01) / (w + 0.02))  # never quite 0 or 1
    return xs, ys


class Model:
    """Lexicon, trees and calibration; ``scores`` takes whole texts."""

    def __init__(self, lexicon: tuple[frozenset[str], frozenset[str]], trees: Boosted, knots: tuple[list, list]):
        self.lexicon, self.trees, self.knots = lexicon, trees, knots

    @classmethod
    def fit(cls, rows: list[tuple[str, int]]) -> Model:
        """Thirds of the rows give the lexicon, the trees and the calibration, each unseen by the others.

        Without rows of both kinds the calibrated score is the share of toxic rows, or a half.
        """
        thirds = [rows[i::3] for i in range(3)]
        lexicon = learn_lexicon(thirds[0])
        x, y = _matrix(thirds[1], lexicon)
        trees = Boosted().fit(x, y)
        x, y = _matrix(thirds[2], lexicon)
        return cls(lexicon, trees, isotonic(trees.raw(x), y))

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        raw = self.trees.raw(np.array([features(t, *self.lexicon) for t in texts]))
        return np.interp(raw, *self.knots) if self.knots[0] else np.full(len(texts), 0.5)

    def dump(self) -> str:
        return json.dumps([[sorted(x) for x in self.lexicon], self.trees.start, self.trees.trees, self.knots])

    @classmethod
    def load(cls, made: str) -> Model:
        lexicon, start, trees, knots = json.loads(made)
        boosted = Boosted()
        boosted.start, boosted.trees = start, trees
        return cls(tuple(map(frozenset, lexicon)), boosted, knots)


def _matrix(rows: list[tuple[str, int]], lexicon: tuple[frozenset[str], frozenset[str]]) -> tuple[np.ndarray, np.ndarray]:
    x = np.array([features(t, *lexicon) for t, _ in rows]).reshape(-1, len(FEATURES))
    return x, np.array([y for _, y in rows], dtype=np.float64)


def _fit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    drawn = [r for b in batches for r in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)]
    drawn.sort(key=lambda r: (r[2], r[0]))
    yield pa.RecordBatch.from_arrays([pa.array([Model.fit([(t, y) for t, y, _ in drawn]).dump()])], ["model"])


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> str:
    """The model from at most ``bound`` labelled documents, in one task; held-out rows never take part."""
    drawn = sample_labelled(docs, labels, "toxic", bound).repartition(1)
    made = drawn.mapInArrow(_fit_batches, "model string").first()
    return made["model"] if made else Model.fit([]).dump()


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``.

    Only the text is looked at; null text counts as empty and all texts without words get the same
    score. Rows that repeat an id are scored one by one, null ids are held out, an empty table gives
    no rows, and without labels every score is one half. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.load(shared.value)
        for b in sliced(batches):
            got = pa.array(model.scores(b.column(1).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), got], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
