from __future__ import annotations

import zlib

import numpy as np
import pytest
from llm_data import MIDDLE, ODD, SMALL, docs_of, shipped  # noqa: F401
from tallyroom.llm import folds, quality, toxicity
from tallyroom.llm.queries import op3_quality, op6_toxicity, table


@pytest.mark.parametrize(("query", "label", "cut"), [(op3_quality, "quality", 0.3), (op6_toxicity, "toxic", 0.5)])
def test_query(spark, query, label, cut):
    got = query(spark, MIDDLE).toPandas()
    ids = [r.doc_id for r in table(spark, MIDDLE, "documents").select("doc_id").collect()]
    assert sorted(got.doc_id) == sorted(ids)
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in zip(got.doc_id, got.held_out, strict=True))
    assert got.score.between(0, 1).all() and ((got.score >= cut) == (got.predicted == 1)).all()
    both = got.merge(table(spark, MIDDLE, "labels").toPandas(), on="doc_id")
    unseen = both[both.held_out]
    assert (unseen.predicted == unseen[label]).mean() >= 0.9


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(spark, docs_of, module):
    label = "quality" if module is quality else "toxic"
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (4, 1), (5, 0), (5, 0), (7, 1), (7, 0), (None, 1), (8, None), (9, 5), (99, 1)], f"doc_id long, {label} int"
    )
    docs = docs_of(*ODD)
    got = module.rate(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(d) for d, _ in ODD)
    assert all(0 <= r.score <= 1 for r in got) and all(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert module.rate(docs_of(), labels).count() == 0
    assert {r.score for r in module.rate(docs, labels.limit(0)).collect()} == {0.5}
    drawn = folds.sample_labelled(docs, labels, label, 100).collect()
    assert {r.y for r in drawn} <= {0, 1} and len(drawn) <= 4
    assert len(folds.sample_labelled(docs, labels, label, 2).collect()) <= 2


def test_keep_good_keeps_columns(spark, docs_of):
    docs = docs_of(*ODD)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(ODD)


def test_ftrl_learns_and_stays_sparse():
    rows = [(f"good plain words {i} here", 1) for i in range(200)] + [(f"bad %%% words {i} ###", 0) for i in range(200)]
    w = quality.fit(rows[::7] + rows[::3])
    assert quality.score(w, "plain words here") > 0.8 > 0.2 > quality.score(w, "%%% words ###")
    assert np.count_nonzero(w) < 2000


def test_pairs_of_equal_words_share_a_bucket():
    a, b = (set(quality.features(t)[0].tolist()) for t in ("x x x", "y y y"))
    assert len(a & b) == 1


def test_trees_fit_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) & (x[:, 1] > 0)).astype(float)
    raw = toxicity.Boosted().fit(x, y).raw(x)
    assert ((raw > 0) == (y > 0.5)).mean() > 0.97


def test_isotonic_rises_and_averages():
    xs, ys = toxicity.isotonic(np.array([1.0, 2.0, 3.0, 4.0, 4.0]), np.array([0, 1, 0, 1, 1]))
    assert xs == sorted(xs) and ys == sorted(ys)
    assert abs(np.interp(2.5, xs, ys) - 0.5) < 0.01


def test_disguised_insults_count():
    f = toxicity.features("you id1ot", frozenset(toxicity.INSULTS), frozenset())
    assert f[1] == 1 and f[8] == 1
    assert toxicity.features("", frozenset(), frozenset()) == [0.0] * len(toxicity.FEATURES)


def test_small_table_runs(spark):
    assert op3_quality(spark, SMALL).count() == op6_toxicity(spark, SMALL).count() == 200
