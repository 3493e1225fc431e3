from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from llm_data import ODD, SMALL, docs_of, shipped  # noqa: F401
from tallyroom.llm import simhash
from tallyroom.llm.components import connected
from tallyroom.llm.queries import op7_simhash
from tallyroom.llm.store import Scratch


def slow_fingerprint(text: str) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute(rows):
    """(doc_id, fingerprint) to component ids by comparing all pairs."""
    fp = np.array([f for _, f in rows], dtype=np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    ids = np.array([d for d, _ in rows])
    comp = ids.copy()
    while True:
        new = np.where(near, comp[None, :], ids.max() + 1).min(axis=1)
        if (new == comp).all():
            return dict(zip(ids.tolist(), comp.tolist(), strict=True))
        comp = new


@pytest.mark.parametrize("text", ["", "One two", "Ähm ONE two three\tfour\nfive one two three four", "a " * 700])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == slow_fingerprint(text)


def test_query_equals_all_pairs(spark):
    got = op7_simhash(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    assert all(int(r.fingerprint, 16) == slow_fingerprint(texts[r.doc_id]) for r in got)
    assert {r.doc_id: r.component_id for r in got} == brute([(r.doc_id, int(r.fingerprint, 16)) for r in got])


@pytest.mark.parametrize("bucket", [2, 256])
def test_links_connect_what_all_pairs_connect(spark, bucket):
    """Also when nearly all fingerprints fall into buckets too large to compare."""
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(25)}
    rows = [(i, f) for i, f in enumerate(sorted(prints))]
    signed = {f - (1 << 64) if f >> 63 else f: i for i, f in rows}
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    scratch = Scratch(spark, "test")
    star = connected(scratch, simhash.links(scratch, frame, bucket), "a", "b").collect()
    root = {signed[r.node]: r.root for r in star}
    want = brute(rows)
    for i, _ in rows:
        for j, _ in rows:
            same = i == j or (i in root and root.get(i) == root.get(j))
            assert same == (want[i] == want[j])


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    frame = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in connected(Scratch(spark, "test"), frame, "a", "b").collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_odd_rows(spark, docs_of):
    
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.near_duplicates(docs_of(*ODD)).collect())
    assert len(got) == len(ODD)
    zero = [g for g in got if g[1] == "0" * 16]
    assert [g[0] for g in zero] == ["1", "2", "3", "None"] and {g[2] for g in zero} == {"1"}
    assert simhash.near_duplicates(docs_of()).count() == 0


def test_keep_one(spark, docs_of):
    
    docs = docs_of(*ODD, (9, "same row"))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = sorted((str(r.doc_id), r.text) for r in kept.collect() if r.doc_id != 4)
    assert rows == sorted([("1", None), ("5", "same row"), ("5", "same id"), ("None", "no id here")], key=lambda r: (r[0], str(r[1]))) or rows == [
        ("1", ""), ("5", "same id"), ("5", "same row"), ("None", "no id here")
    ]
    assert simhash.keep_one(docs_of()).count() == 0
