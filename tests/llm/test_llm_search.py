from __future__ import annotations

import math
import random

import numpy as np
from llm_data import LONG, MIDDLE, ODD, SMALL, docs_of, shipped  # noqa: F401
from tallyroom.llm import ann, decontaminate
from tallyroom.llm.queries import op1_decontaminate, op10_nearest, table


def test_wand_retrieves_what_full_scoring_retrieves():
    rng = random.Random(0)
    items = [(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randint(3, 70)))) for i in range(400)]
    index = decontaminate.Index(items)
    for _ in range(150):
        terms = rng.sample(range(len(index.terms)), min(60, len(index.terms)))
        score: dict = {}
        for t in terms:
            for part, share in zip(*index.postings(t)[:2], strict=True):
                score[part] = score.get(part, 0) + share
        for share in (0.05, 0.2, 0.5):
            got = index.retrieve(terms, share)
            assert got.keys() == {p for p, s in score.items() if s >= share - 1e-9}


def test_first_bound_loses_no_passage():
    rng = random.Random(5)
    items = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(30))) for i in range(200)]
    index = decontaminate.Index(items)
    for item, text in items[:60]:
        words = text.split()
        noise = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(200)]
        found = index.leaks(" ".join(noise[: rng.randint(0, 200)] + words + noise[100:]))
        assert item in {f[0] for f in found}


def test_query_finds_planted_passages_only(spark):
    items = {r.item_id: r.text for r in table(spark, MIDDLE, "benchmark").collect()}
    texts = {r.doc_id: r.text for r in table(spark, MIDDLE, "documents").collect()}
    want = {(d, i) for d, t in texts.items() for i, item in items.items() if item in t}
    got = {(r.doc_id, r.item_id) for r in op1_decontaminate(spark, MIDDLE).collect()}
    assert want and got == want


def test_leaks_in_other_case_and_marks(spark, docs_of):
    item = "What is the boiling point of water at the level of the sea? It is one hundred degrees on the scale of Celsius."
    bench = spark.createDataFrame([(7, item), (8, None), (None, item), (9, ""), (10, " ".join(f"u{i}" for i in range(300)))], "item_id long, text string")
    leaked = item.upper().replace("?", " --")
    rows = [*ODD, (30, f"{LONG} {leaked} {LONG}"), (31, "the water is of the sea and the level of the point is one"), (32, " ".join(f"u{i}" for i in range(300)))]
    docs = docs_of(*rows)
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect())
    assert got == [(30, 7), (32, 10)]
    kept = decontaminate.drop_leaky(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in rows if d not in (30, 32))
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.drop_leaky(docs_of(), bench).count() == 0


def test_items_without_latin_letters(spark, docs_of):
    items = {
        1: "Какая река протекает через весь город и впадает в море? Это широкая и спокойная Нева.",
        2: "Ποιο είναι το ψηλότερο βουνό της χώρας αυτής σήμερα; Είναι ο Όλυμπος στη Θεσσαλία.",
        3: "?! ... -- !",
    }
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = [(1, f"{LONG} {items[1]} {LONG}"), (2, f"{items[2].upper()} {LONG}"), (3, f"{LONG} {items[3]}"), (4, "Это река.")]
    docs = docs_of(*rows)
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()) == [(1, 1), (2, 2)]
    assert sorted(r.doc_id for r in decontaminate.drop_leaky(docs, bench).collect()) == [3, 4]
    assert sum(len(p.names) for p in decontaminate.indexes(bench)) == 2


def test_short_items(spark, docs_of):
    items = {1: "Capital of France? Paris.", 2: "Zugspitze?", 3: "法国的首都是哪个城市?巴黎。", 4: "日本の首都は?東京"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = [
        (1, f"{LONG} capital of France -- PARIS {LONG}"),
        (2, "no France capital of Paris or Paris capital of any France is meant here"),
        (3, "and then to the Zugspitze they went in one day"),
        (4, f"有人问{items[3]}他说。"),
        (5, f"{LONG} 質問:{items[4]}です {LONG}"),
        (6, "巴黎是一个很大的城市,法国人都知道。"),
        (7, "Capital of France? Paris."),
    ]
    docs = docs_of(*rows)
    got = sorted((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect())
    assert got == [(1, 1), (3, 2), (4, 3), (5, 4), (7, 1)]
    assert sorted(r.doc_id for r in decontaminate.drop_leaky(docs, bench).collect()) == [2, 6]


def test_many_small_indexes_find_the_same(spark):
    bench, docs = table(spark, SMALL, "benchmark"), table(spark, SMALL, "documents")
    parts = list(decontaminate.indexes(bench, 4_000))
    assert len(parts) > 1 and sum(len(p.names) for p in parts) == bench.count()
    found = {(d.doc_id, leak[0]) for d in docs.collect() for p in parts for leak in p.leaks(d.text)}
    assert found == {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}


def test_shares_do_not_depend_on_the_number_of_indexes(spark):
    bench = table(spark, SMALL, "benchmark")

    def shares(indexes):
        out = {}
        for index in indexes:
            terms = list(index.terms)
            for t in range(len(terms)):
                for number, share in zip(*index.postings(t)[:2], strict=True):
                    item = index.item_of[number]
                    out[index.names[item], number - index.item_of.index(item), terms[t]] = share
        return out

    many = list(decontaminate.indexes(bench, 4_000))
    one = shares(decontaminate.indexes(bench))
    assert len(many) > 1 and one and shares(many) == one


def exact(vectors, query):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids])
    d = np.sqrt(((x - np.array(vectors[query])) ** 2).sum(axis=1))
    d[ids == query] = np.inf
    order = np.lexsort((ids, d))[:10]
    return [(int(ids[i]), float(d[i])) for i in order if d[i] < np.inf]


def test_nearest_reaches_recall(spark):
    rows = table(spark, MIDDLE, "embeddings").collect()
    vectors = {r.vec_id: [float(v) for v in r.embedding] for r in rows}
    got: dict = {}
    for r in op10_nearest(spark, MIDDLE).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {i for i in vectors if i % 100 == 0}
    hits = total = 0
    for q, found in got.items():
        want = exact(vectors, q)
        assert len(found) == len(want) and found == sorted(found, key=lambda f: (f[1], f[0]))
        for v, score in found:
            assert abs(score - math.dist(vectors[v], vectors[q])) < 1e-12
        hits, total = hits + len({v for v, _ in found} & {v for v, _ in want}), total + len(want)
    assert hits / total >= 0.9


def test_nearest_with_a_small_sample(spark):
    """Lists, bounds and hypothesis tests at work: most vectors are outside the sample."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 24)) * 3
    x = centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 24))
    x[500:900] = x[500]  # equal vectors
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.search(frame, sample=600).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    vectors = dict(enumerate(x.tolist()))
    hits = sum(len(set(got[q]) & {v for v, _ in exact(vectors, q)}) for q in got)
    assert len(got) == 30 and all(len(v) == 10 for v in got.values()) and hits >= 0.9 * 300
    assert got[500] == list(range(501, 511)) and got[600] == list(range(500, 510))


def test_nearest_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (100, [0.0, 1.0], 2), (3, [1.0, 0.0], 3), (3, [1.0, 0.0], 3), (4, [nan, 1.0], 4), (5, [inf, 1.0], 5),
            (6, [0.0, 0.0], 6), (7, None, 7), (None, [1.0, 1.0], 8), (8, [1.0], 9), (9, [], 10), (10, [1.0, None], 11)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = [(r.query_id, r.rank, r.vec_id) for r in ann.search(frame).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 3), (0, 2, 100), (100, 1, 0), (100, 2, 3)]
    assert ann.search(frame.limit(0)).count() == 0


def test_nearest_through_lists_on_a_sample_smaller_than_the_table(spark):
    """Unclustered vectors, the hardest case: nothing but visited lists can have found these."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(6000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got: dict = {}
    for r in ann.search(df, sample=1500).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for i in range(0, 6000, 100):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        near = set(np.argsort(d)[:10].tolist())
        assert sorted(k for k, _, _ in got[i]) == list(range(1, 11))
        assert all(abs(s - d[v]) < 1e-12 for _, v, s in got[i])
        hits += len(near & {v for _, v, _ in got[i]})
    assert hits >= 0.9 * 600
