"""What the classifiers are worth on documents they never learned from, and their scores by other means."""

from __future__ import annotations

import math

import numpy as np
import pytest
from llm_data import MIDDLE, shipped  # noqa: F401
from tallyroom.llm import folds, quality
from tallyroom.llm.queries import op3_quality, op6_toxicity, table


#: Large enough for a hundred unseen documents of the rarer kind.
LARGE = "/root/testdata/sf0.1"


def auc(score, label):
    """Share of (positive, negative) pairs in the right order, ties half."""
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        ranks[score == s] = ranks[score == s].mean()
    p = label.sum()
    return (ranks[label == 1].sum() - p * (p + 1) / 2) / (p * (len(label) - p))


@pytest.mark.parametrize(("query", "label", "rare"), [(op3_quality, "quality", 0), (op6_toxicity, "toxic", 1)])
def test_unseen_documents_are_told_apart(spark, query, label, rare):
    got = query(spark, LARGE).toPandas().merge(table(spark, LARGE, "labels").toPandas(), on="doc_id")
    unseen = got[got.held_out]
    assert (unseen[label] == rare).mean() < 0.25  # so that always giving one answer finds none of these
    assert auc(unseen.score.to_numpy(), unseen[label].to_numpy()) >= 0.93
    found, meant = unseen.predicted == rare, unseen[label] == rare
    assert (found & meant).sum() / meant.sum() >= 0.7  # recall
    assert (found & meant).sum() / max(1, found.sum()) >= 0.7  # precision


def test_quality_scores_by_a_plain_learner(spark):
    """Follow the regularised leader with dictionaries, one coordinate at a time."""
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    drawn = sorted(((r["_draw"], r["text"], r["y"]) for r in folds.sample_labelled(docs, labels, "quality", quality.SAMPLE).collect()))
    model = quality.Ftrl()
    z: dict[int, float] = {}
    n: dict[int, float] = {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= model.l1:
            return 0.0
        return -(z[i] - math.copysign(model.l1, z[i])) / ((model.beta + math.sqrt(n.get(i, 0.0))) / model.alpha + model.l2)

    last = 1 << quality.BITS  # the bias
    made = []
    for _, text, y in drawn:
        at, x = quality.features(text)
        made.append(([*zip(at.tolist(), x.tolist(), strict=True)], y))
    for _ in range(quality.EPOCHS):
        for pairs, y in made:
            every = [*pairs, (last, 1.0)]
            w = {i: weight(i) for i, _ in every}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] * v for i, v in every)))))
            for i, v in every:
                g = (p - y) * v
                s = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / model.alpha
                z[i] = z.get(i, 0.0) + g - s * w[i]
                n[i] = n.get(i, 0.0) + g * g
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in op3_quality(spark, MIDDLE).collect():
        at, x = quality.features(texts[r.doc_id])
        total = sum(weight(i) * v for i, v in zip(at.tolist(), x.tolist(), strict=True)) + weight(last)
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-4
