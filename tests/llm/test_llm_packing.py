"""Mixtures of packed windows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from llm_data import MIDDLE, docs_of, shipped  # noqa: F401
from pyspark.sql import functions as F
from tallyroom.llm import packing
from tallyroom.llm.queries import vocabulary
from tallyroom.llm.store import Scratch


def pieces(spark, rows, weights=None, length=4096, quantum=256):
    """Pieces of documents given as (source, number of ids), joined with their sources."""
    docs = spark.createDataFrame([(i, i, f"={s}", n) for i, (s, n) in enumerate(rows)], "row long, doc_id long, source string, n long")
    named = None if weights is None else {f"={s}": w for s, w in weights.items()}
    made = packing._pieces(Scratch(spark, "test"), docs, named, length, quantum).collect()
    by_row: dict = {}
    for p in made:
        by_row.setdefault(p.row, []).append(p)
    for i, (_, n) in enumerate(rows):  # every id in one piece
        at = 0
        for p in sorted(by_row[i], key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == n
    windows: dict = {}
    for p in sorted(made, key=lambda p: (p.sequence_id, p.offset)):
        w = windows.setdefault(p.sequence_id, [0, {}])
        assert p.offset == w[0]
        w[0] += p.length
        source = rows[p.row][0]
        w[1][source] = w[1].get(source, 0) + p.length
    total = sum(n for _, n in rows)
    assert sorted(windows) == list(range(-(-total // length)))
    assert all(windows[w][0] == length for w in range(total // length))
    return [windows[w][1] for w in sorted(windows)]


def deviations(windows, share, length):
    """Largest distance of one window's ids, and of all ids so far, from a source's share."""
    one = so_far = 0.0
    sums = dict.fromkeys(share, 0)
    for i, w in enumerate(windows, 1):
        for s, part in share.items():
            sums[s] += w.get(s, 0)
            one = max(one, abs(w.get(s, 0) - part * length))
            so_far = max(so_far, abs(sums[s] - part * length * i))
    return one, so_far


def split(rng, source, total):
    out = []
    while total > 0:
        n = min(total, rng.choice([1, 7, 90, 800, 9000]))
        out.append((source, n))
        total -= n
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {f"s{i:02d}": 12_000 for i in range(20)},
        {"a": 180_000, **{f"s{i}": 2_000 for i in range(10)}},
        {"a": 50_000, "b": 49_999, "c": 1, "d": 3, "e": 997},
        {"only": 10_000},
    ],
)
def test_every_window_has_the_mixture_of_the_whole(spark, sizes):
    rng = random.Random(4)
    rows = [r for s, n in sizes.items() for r in split(rng, s, n)]
    rng.shuffle(rows)
    windows = pieces(spark, rows)
    total = sum(sizes.values())
    # sources below one id a window share a queue
    share = {s: n / total for s, n in sizes.items() if n / total * 4096 >= 1}
    one, so_far = deviations(windows[: total // 4096], share, 4096)
    assert one <= 2 and so_far <= 2


def test_weights_hold_until_queues_run_dry(spark):
    rng = random.Random(9)
    sizes, weights = {"a": 60_000, "b": 9_000, "c": 30_000}, {"a": 1, "b": 2, "c": 1}
    rows = [r for s, n in sizes.items() for r in split(rng, s, n)]
    rng.shuffle(rows)
    windows = pieces(spark, rows, weights, 1000, 64)
    assert deviations(windows[:17], {"a": 0.25, "b": 0.5, "c": 0.25}, 1000)[0] <= 2  # b lasts for 18 windows
    later = windows[19:60]
    assert all(w.get("b", 0) == 0 and abs(w["a"] - 500) <= 2 and abs(w["c"] - 500) <= 2 for w in later)
    assert all(set(w) == {"a"} for w in windows[80:])
    with pytest.raises(ValueError):
        pieces(spark, rows, {"a": 0})


def test_more_sources_than_a_window_has_ids(spark):
    rows = [(f"s{i}", 1 + i % 3) for i in range(300)] + [("big", 5000)]
    windows = pieces(spark, rows, length=64, quantum=16)
    assert all(abs(w.get("big", 0) - 64 * 5000 / 5600) <= 2 for w in windows[:-1])


def test_windows_do_not_depend_on_how_they_are_grouped():
    rng = np.random.default_rng(1)
    q = packing.Queues([f"q{i}" for i in range(9)], rng.integers(1, 5000, 9).tolist(), rng.random(9).tolist(), 37)
    every = q.taken(np.arange(q.windows + 1))
    assert (np.diff(every, axis=0) >= 0).all() and (every[-1] == q.totals).all()
    assert (every == np.concatenate([q.taken(np.array([i])) for i in range(q.windows + 1)])).all()
    # the ids in due order, one by one
    order = sorted(((k + p) / w, i) for i, (t, w, p) in enumerate(zip(q.totals, q.weights, q.phases, strict=True)) for k in range(t))
    for i in range(q.windows + 1):
        first = order[: i * 37]
        assert every[i].tolist() == [sum(j == s for _, j in first) for s in range(9)]


def test_documents_of_twenty_sources(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    made = packing.pack(docs, vocabulary("word_bpe_49k.json")).join(docs.select("doc_id", "source"), "doc_id")
    sums = made.groupBy("sequence_id", "source").agg(F.sum("length").alias("n")).collect()
    total, of = sum(r.n for r in sums), {}
    for r in sums:
        of[r.source] = of.get(r.source, 0) + r.n
    last = max(r.sequence_id for r in sums)
    got = {(r.sequence_id, r.source): r.n for r in sums}
    worst = max(
        sum(abs(got.get((w, s), 0) / 4096 - n / total) for s, n in of.items()) / 2 for w in range(last)
    )
    assert worst < 0.006
    print(f"mixture off by at most {worst:.4f}")
