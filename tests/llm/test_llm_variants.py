from __future__ import annotations

import re
import zlib
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from llm_data import LONG, ODD, SMALL, docs_of, shipped  # noqa: F401
from tallyroom.llm import variants


def brute_words(rows, least, count, spoiled):
    out = Counter()
    for d, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % spoiled == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= count}


def edit_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words, ratio):
    near = {w: [v for v in words if edit_one(v, w)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v.encode())) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= ratio * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def groups(spark, words, ratio=10):
    df = spark.createDataFrame([(n, w) for w, n in words.items()], "n long, word string")
    made = variants.group(df, ratio).select("word", "form", "root", "n", "n_near", "form_n")
    return sorted(map(tuple, made.collect()))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.text("abé", min_size=1, max_size=6), st.sampled_from([2, 3, 9, 30, 100, 1000]), max_size=60))
def test_neighbours_are_exact(spark, words):
    assert groups(spark, words, 3) == brute_groups(words, 3)


def test_chains_ties_and_long_words(spark):
    words = {
        "aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaabbb": 2000,  # a chain
        "bbbbbbb": 5, "bbbbbbc": 50, "bbbbbba": 50, "bbbbbbbÿ": 49,  # a tie, and one just too rare
        "x" * 50_000: 2, "x" * 50_001: 20, "x" * 25_000 + "y" + "x" * 25_000: 3, "\U0001f600\U0001f601z": 4, "\U0001f600z": 40,
    }
    assert groups(spark, words) == brute_groups(words, 10)
    assert dict((r[0], r[2]) for r in groups(spark, words))["aaaaaaaa"] == "aaaaabbb"
    assert groups(spark, {}) == []


def test_null_and_empty_words_take_no_part(spark):
    df = spark.createDataFrame([(None, 5, 1), ("", 5, 1), ("abc", 5, 1), ("abd", 50, 1)], "word string, n long, id int")
    assert sorted(r.word for r in variants.group(df).collect()) == ["abc", "abd"]


def test_words_of_odd_texts(spark, docs_of):
    rows = [
        *ODD,
        (7, "ThingÉngs THINGÉNGS thingéngs abcdefg1abcdefg xabcdefg-xabcdefg ×÷ÿĀabcdefg"),
        (8, " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}xyz" for i in range(3000))),
        (None, "q" * 300_000 + " " + "q" * 300_000),
        (9, LONG),
    ]
    made = {r.word: r.n for r in variants.occurrences(docs_of(*rows), 7, 2, 3).collect()}
    assert made == brute_words(rows, 7, 2, 3) and made["abcdefg"] >= 2
    assert variants.occurrences(docs_of()).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    words = {r.word: r.n for r in variants.occurrences(docs).collect()}
    assert words == brute_words([(r.doc_id, r.text) for r in docs.collect()], 7, 2, 31)
    assert groups(spark, words) == brute_groups(words, 10)
