from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import LONG, ODD, SMALL, docs_of, shipped  # noqa: F401
from tallyroom.llm import collocations
from tallyroom.llm.store import Scratch

FIELDS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute_counts(rows):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 6):
                for i in range(len(w) - size + 1):
                    f[lang, tuple(w[i : i + size])] += 1
    return f, n


def brute(rows, least, first):
    f, n = brute_counts(rows)
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    longer = Counter()
    for (lang, w), a in candidates.items():
        for i in range(len(w)):
            for j in range(i + 2, len(w) + 1):
                if j - i < len(w):
                    longer[lang, w[i:j]] = max(longer[lang, w[i:j]], a)
    made = {}
    for (lang, w), a in candidates.items():
        if longer[lang, w] >= a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        made.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, i, p.decode(), -a, l, r, n[lang], -s)
        for lang, found in made.items()
        for i, (s, a, p, l, r) in enumerate(sorted(found)[:first], 1)
    )


def result(docs, least, first=2000, bits=26):
    return sorted(tuple(r[c] for c in FIELDS) for r in collocations.collocations(docs, least, first, bits).collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", "é".encode(), b"dd"]), min_size=1, max_size=60), min_size=1, max_size=8))
def test_chunks_hold_every_phrase_once(pieces):
    joined = [b" ".join(p) for p in pieces]
    every, found = Counter(), Counter()
    for p in pieces:
        for size in range(1, 6):
            every.update(tuple(p[i : i + size]) for i in range(len(p) - size + 1))
    ends = Counter()
    for _, chunk, last in collocations._cut(joined):
        w = chunk.split(b" ")
        ends[last] += 1
        for i in range(len(w) - (0 if last else collocations.OVERLAP)):
            found.update(tuple(w[i : i + size]) for size in range(1, 6) if i + size <= len(w))
    assert found == every and ends[True] == len(pieces)


def test_equal_passages_are_cut_alike():
    rng = random.Random(3)
    passage = [b"w%d" % rng.randrange(1000) for _ in range(400)]
    a, b = ([*(b"x%d" % rng.randrange(9) for _ in range(50)), *passage] for _ in range(2))
    chunks = [{c for i, c, last in collocations._cut([b" ".join(a), b" ".join(b)]) if i == k and not last} for k in (0, 1)]
    assert len(chunks[0] & chunks[1]) > 10 and len(chunks[0] ^ chunks[1]) < 12


@pytest.mark.parametrize("bits", [26, 7])  # a bitmap that is nearly full lets too much through, which must not matter
def test_equals_brute_force(spark, bits):
    rng = random.Random(5)
    words = ["the", "of", "New", "York", "zwölf", "a", "b", "Ünion", "x-y", " "]
    rows = [
        ([None, "en", "de", "und"][i % 4], "".join(rng.choice(words) + rng.choice([" ", "\t", "  ", ". ", "\n", "\r"] + [" "] * 8) for _ in range(rng.randrange(60))))
        for i in range(300)
    ] + [("en", "one two three four five six seven " * 3)] * 40 + [("en", None), (None, ""), ("en", " .,; ")]
    df = spark.createDataFrame([(1, t, 2, l) for l, t in rows], "n int, text string, score int, lang string").repartition(5)
    for least, first in ((3, 2000), (20, 7)):
        assert result(df, least, first, bits) == brute(rows, least, first)


def test_odd_rows(spark, docs_of):
    rows = [*ODD, (6, LONG), (7, LONG), (8, "word " * 30_000), (9, "q" * 300_000), (10, "é ü. É Ü")]
    assert result(docs_of(*rows), 2) == brute([("en", t) for _, t in rows], 2, 2000)
    assert result(docs_of(), 1) == []


def test_products_beyond_64_bits(spark, monkeypatch):
    big = 3_000_000_000_000
    rows = [("en", "x", 1, 2 * big), ("en", "y", 1, 3 * big), ("en", "x y", 2, big)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 10**15 + 7)], "lang string, n long")
    monkeypatch.setattr(collocations, "phrases", lambda *_: (frequent, totals))
    made = result(spark.createDataFrame([("t", "en")], "text string, lang string"), 100)
    assert made == [("en", 1, "x y", big, 2 * big, 3 * big, 10**15 + 7, 1000 * big * (10**15 + 7) // (6 * big * big))]


def test_whole_table_and_map_side_counts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.collect()]
    f, n = brute_counts(rows)
    made, totals = collocations.phrases(docs, Scratch(spark, "test"), 20)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in made.collect()} == {k: v for k, v in f.items() if v >= 20}
    assert {r.lang: r.n for r in totals.collect()} == dict(n)
    assert result(docs, 20) == brute(rows, 20, 2000)
