from __future__ import annotations

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import LONG, ODD, docs_of, shipped  # noqa: F401
from tallyroom.llm import substring


def brute(rows, length):
    """{(doc_id, text): (n_words, n_removed, sha)} by comparing all windows."""
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first: dict = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - length + 1):
                k = tuple(w[i : i + length])
                first[k] = min(d, first.get(k, d))
    out = []
    for d, w in words:
        gone = set()
        if d is not None:
            for i in range(len(w) - length + 1):
                if first[tuple(w[i : i + length])] < d:
                    gone |= set(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(docs, length, shortest=2):
    found = substring.repeats(docs, length, shortest).collect()
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in found)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(2, 9))
def test_window_hashes_tell_windows_apart(values, length):
    v = substring.word_hashes([b"%d" % x for x in values])
    h = substring.window_hashes(v, length)
    windows = [tuple(values[i : i + length]) for i in range(len(values) - length + 1)]
    assert len(h) == len(windows) and len(set(h.tolist())) == len(set(windows))
    if len(v) >= length:
        assert substring.sliding_min(v, length).tolist() == [int(v[i : i + length].min()) for i in range(len(windows))]


def test_passages_copies_and_repeats(spark, docs_of):
    rows = [
        (10, "a b c d e f g h i j"),
        (11, "x a b c d e f y a b c d"),  # a passage of ten
        (12, "a b c d e f g h i j"),  # a copy
        (3, "the the the the the the the"),
        (4, "the the the the the"),
        (5, "z the the the the z the the the the"),
        (13, "x a b c"),
        (14, "a b c"),  # shorter than a window
        (15, "q a b c d"),
        (9, "c d e f y"),
    ]
    for length in (2, 4, 5):
        assert result(docs_of(*rows), length) == brute(rows, length)


def test_odd_rows(spark, docs_of):
    rows = [*ODD, (6, LONG), (None, LONG), (4, "w0x0 w1x1 w2x2 w3x3")]
    assert result(docs_of(*rows), 4) == brute(rows, 4)
    assert substring.repeats(docs_of(), 4).count() == 0


def test_covered():
    assert substring.covered(6, np.array([1, 2]), 2).tolist() == [False, True, True, True, False, False]


def test_lengths_double():
    assert substring.levels(50) == [13, 25, 50]
    assert substring.levels(50, 2) == [2, 4, 7, 13, 25, 50]
    assert substring.levels(5, 2) == [2, 3, 5]
    assert substring.levels(8) == [8] and substring.levels(1, 1) == [1]


def test_levels_narrow_the_candidates_and_stop_without_any(spark, docs_of, monkeypatch):
    counts: dict = {}
    write = substring.Scratch.write

    def counting(self, df, name):
        out = write(self, df, name)
        if name == "texts" or name.startswith("level_"):
            counts.setdefault(name.split("_")[0], []).append(out.count())
        return out

    monkeypatch.setattr(substring.Scratch, "write", counting)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i, n in enumerate((12, 13, 14, 24, 25, 26, 49, 50, 51, 80)):  # passages shared by two documents
        passage = " ".join(words[i * 30 : i * 30 + n])
        for d in (100 + i, 200 + i):
            rows.append((d, f"{' '.join(f'd{d}x{j}' for j in range(60))} {passage} {' '.join(f'e{d}x{j}' for j in range(60))}"))
    rows += [(300, " ".join(words[:50])), (301, "z " * 70), (302, "z " * 55)]
    want = brute(rows, 50)
    assert result(docs_of(*rows), 50, 10) == want and any(n for _, _, n, _ in want)
    alive = counts["texts"]
    assert len(counts["level"]) == 2 and alive[0] > alive[1] > 0
    assert result(docs_of(*rows), 50, 50) == want

    counts.clear()
    lone = [(i, f"{' '.join(f'e{i}x{j}' for j in range(60))} {' '.join(words[:5])}") for i in range(6)]
    assert result(docs_of(*lone), 50, 10) == brute(lone, 50)
    assert counts["texts"] == [0] and len(counts["level"]) == 1
