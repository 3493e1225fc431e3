from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import pytest
from llm_data import LONG, ODD, SMALL, docs_of, shipped  # noqa: F401
from pyspark.sql import functions as F
from tallyroom.llm import personal

BLANK = r"\x20\x09-\x0D"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TOKEN = rf"[^{BLANK}0-9@]*[0-9@][^{BLANK}]*"
EDGES = ".,;:!?\"'*$%&#<>[]{}|"


def valid(kind, m):
    d = [int(c) for c in m if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        worth = [x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d))]
        return 14 <= len(d) <= 19 and sum(worth) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base(text):
    return [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if valid(k, m[0])]


def fold(s):
    return "".join(c.lower() if c.isascii() else c for c in s)


def words(s):
    return [w for w in re.split(rf"[{BLANK}]+", fold(s)) if w]


def brute(rows):
    """[(doc_id, spans)] with the whole graph in dictionaries."""
    found, edges = [], set()
    for d, t in rows:
        t = t or ""
        hits = list(re.finditer(rf"(?<![^{BLANK}]){TOKEN}(?:\x20{TOKEN}){{0,6}}", t))
        ends = [0, *(m.end() for m in hits)]
        starts = [*(m.start() for m in hits), len(t)]
        mine = []
        for i, m in enumerate(hits):
            left = m[0].lstrip(EDGES)
            value = left.rstrip(EDGES)
            if len(value) > 64:
                continue
            start = m.end() - len(left)
            before, after = words(t[ends[i] : m.start()][-64:])[-2:], words(t[m.end() : starts[i + 1]][:64])[:1]
            mine.append((start, start + len(value), fold(value)))
            p = [("1", *before[-1:])] * bool(before) + [("2", *before)] * (len(before) == 2) + [("3", *before[-1:], *after)] * bool(before and after)
            edges |= {(x, fold(value)) for x in p}
        found.append((d, t, mine))
    seeds = {v: tuple(1000 * any(valid(k, m[0]) for m in re.finditer(p, v)) for k, p in PLAIN.items()) for _, v in edges}
    score, reached = dict(seeds), {}
    for _ in range(3):
        by = defaultdict(list)
        for p, v in edges:
            by[p].append(score[v])
        conf = {}
        for p, vs in by.items():
            c = [sum(v[k] for v in vs) // (len(vs) + 2) for k in range(4)]
            c = [x if x >= 600 and sum(v[k] == 1000 for v in vs) >= 3 else 0 for k, x in enumerate(c)]
            if any(c):
                conf[p] = c
        reached = {}
        for p, v in edges:
            if p in conf:
                reached[v] = [max(a, b) for a, b in zip(reached.get(v, seeds[v]), conf[p], strict=True)]
        score = {**seeds, **reached}
    new = {}
    for v, s in reached.items():
        if 600 <= max(s) < 1000 and ("@" in v or sum(c.isdigit() and c.isascii() for c in v) >= 5):
            new[v] = s.index(max(s))
    kinds = list(PLAIN)
    return [
        (str(d), ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(base(t) + [(a, 4 + new[v], b, f"like_{kinds[new[v]]}") for a, b, v in mine if v in new])))
        for d, t, mine in found
    ]


def result(docs):
    return sorted((str(r.doc_id), r.spans) for r in personal.report(docs).collect())


SAMPLES = [
    "mail a.b+c@x-y.co.uk. Then @x.y a@b a@b.c.d. a@b.c_d@e.f%g@h.i a@@b.c x@y..z",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 1.2.3 1.2.3.4567 é1.2.3.4é",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 41111111111111111111 1 2 3 378282246310005 30569309025904",
    "+1 (509) 555-6973 +1 12 +12345678901234567 +49-30-1234567. ++1 2345 678 901 +1(((( )))))2 34 56 78 90 1",
    "xé\U0001f600 +1 (509) 555-6973 \U0001f600a@b.cd",
]


def test_base_spans_of_odd_strings(spark, docs_of):
    rng = random.Random(1)
    alphabet = "aZ09.@@-_%+ ()1234é\n"
    rows = list(enumerate(SAMPLES + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(400)]))
    assert result(docs_of(*rows)) == sorted(brute(rows))
    made = {r.doc_id: r for r in personal.report(docs_of(*rows)).collect()}
    for d, t in rows:
        spans = sorted(base(t))
        assert made[d].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()
        assert [made[d][f"n_{k}"] for k in PLAIN] == [sum(s[3] == k for s in spans) for k in PLAIN]


def contexts(seed, n=12):
    rng = random.Random(seed)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    rows = []
    for i in range(n):
        rows += [
            f"Please call me at +1 ({num(3)}) {num(3)}-{num(4)} today or tomorrow.",
            f"His phone number is +49 {num(3)} {num(7)}, thanks.",
            f"my mail: u{num(4)}@host{i}.example.org for all",
            f"the year {num(4)} was number {num(2)} of {num(6)} things",
        ]
    rows += ["Please call me at 030/5551234 today", "His phone number is 0043-664-123456, thanks", "my mail: jane@localhost for all", "the year 123456 was"]
    return rows


def test_contexts_discover_unseen_identifiers(spark, docs_of):
    rows = list(enumerate(contexts(2)))
    found = dict(result(docs_of(*rows)))
    assert result(docs_of(*rows)) == sorted(brute(rows))
    n = len(rows)
    assert found[str(n - 4)] == "like_phone:18:29" and found[str(n - 3)].startswith("like_phone:20:")
    assert found[str(n - 2)] == "like_email:9:23" and found[str(n - 1)] == ""


def test_a_value_is_known_in_other_documents_and_copies_count_once(spark, docs_of):
    rows = list(enumerate([*contexts(3), "nothing around 030/5551234 here", *["of 777777 things"] * 40, *["call me at 777777 today"] * 40]))
    assert result(docs_of(*rows)) == sorted(brute(rows))
    assert dict(result(docs_of(*rows)))[str(len(contexts(3)))] == "like_phone:15:26"


def test_odd_rows(spark, docs_of):
    rows = [*ODD, (6, LONG), (7, "a@b.cd " * 3000), (None, "call +1 (509) 555-6973")]
    assert result(docs_of(*rows)) == sorted(brute(rows))
    assert result(docs_of()) == []


@pytest.mark.parametrize("piece", ["a", "1", "a.", "1.", "@", "+1", "a@", "1 ", "é", "eyJ", "漢", "a@b.c", "+", "!"])
def test_long_texts_take_linear_time(spark, docs_of, piece):
    text = piece * (400_000 // len(piece)) + " x @ y.z"
    made = personal.report(docs_of((1, text))).collect()
    assert made[0].doc_id == 1


def test_whole_table_without_python_workers(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert result(docs) == sorted(brute([(r.doc_id, r.text) for r in docs.collect()]))
    plan = personal.report(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_luhn(spark):
    rows = spark.createDataFrame([("4111 1111-1111 1111",), ("4111111111111112",), ("1" * 30,)], "m string")
    assert [r.ok for r in rows.select(personal._luhn(F.col("m")).alias("ok")).collect()] == [True, False, False]


def test_sql_knows_contexts_too():
    import duckdb
    import pandas as pd
    from tallyroom.llm.oracle import ORACLE

    rows = list(enumerate([*contexts(3), *SAMPLES, "nothing around 030/5551234 here", *["of 777777 things"] * 40]))
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    made = duckdb.sql(ORACLE["op13_personal"]).df()
    assert sorted((str(i), s) for i, s in zip(made.doc_id, made.spans, strict=True)) == sorted(brute(rows))
