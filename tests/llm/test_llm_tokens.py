from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from llm_data import ODD, SMALL, docs_of, shipped  # noqa: F401
from tallyroom.llm import packing, tokencount, tokenfile
from tallyroom.llm.queries import op4_packing, op5_token_files, op9_token_counts, table, vocabulary
from tallyroom.llm.store import Scratch
from tallyroom.llm.tokens import encoder


VOCABULARIES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def ids_of(name, text):
    return np.array([*encoder(vocabulary(name)).tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")


@pytest.mark.parametrize("name", VOCABULARIES)
def test_ids_equal_the_library(spark, name):
    code = encoder(vocabulary(name))
    assert code._merge is not None
    texts = [r.text for r in table(spark, SMALL, "documents").collect()]
    texts += ["", " ", "a", " a", "a ", "don't  stop\n\nit's", "x<|endoftext|>y", "日本 ¼ ﬁ é İ  z", "9 12 a1b2", "''s 's", "\x1cx\x85y"]
    for t in texts:
        assert code.ids(t).tolist() == code.tokenizer.encode(t, add_special_tokens=False).ids, t


PARTS = ["a", "b ", " ", "  ", "\n", "\t", "é", "'s", "12", "!!", "word", "<|endoftext|>", "\x1c", ". ", " ", "Q,"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12), st.randoms(use_true_random=False))
def test_edited_counts_equal_counting_anew(parts, rng):
    text = "".join(parts)
    library = encoder(vocabulary("byte_bpe_50k.json")).tokenizer
    tree = tokencount.Tree(text, tokencount.Counts(vocabulary("byte_bpe_50k.json")))
    assert tree.total == len(library.encode(text, add_special_tokens=False).ids)
    points = sorted(rng.randint(0, len(text)) for _ in range(2 * rng.randint(0, 3)))
    edits = [(a, b, "".join(rng.choices(PARTS, k=rng.randint(0, 2)))) for a, b in zip(points[::2], points[1::2], strict=True)]
    edits = list({e[0]: e for e in edits}.values())
    edited, at = "", 0
    for a, b, new in edits:
        edited, at = edited + text[at:a] + new, b
    edited += text[at:]
    assert tree.apply(edits) == len(edits)
    assert tree.total == len(library.encode(edited, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12), st.randoms(use_true_random=False))
def test_batches_of_edits_follow_one_another(parts, rng):
    text = "".join(parts)
    library = encoder(vocabulary("byte_bpe_50k.json")).tokenizer
    tree = tokencount.Tree(text, tokencount.Counts(vocabulary("byte_bpe_50k.json")))
    for _ in range(3):
        points = sorted(rng.randint(0, len(text)) for _ in range(2 * rng.randint(0, 3)))
        edits = {a: (a, b, "".join(rng.choices(PARTS, k=rng.randint(0, 3)))) for a, b in zip(points[::2], points[1::2], strict=True)}
        edited, at = "", 0
        for a, b, new in edits.values():
            edited, at = edited + text[at:a] + new, b
        text = edited + text[at:]
        assert tree.apply(list(edits.values())) == len(edits)
        assert tree.total == len(library.encode(text, add_special_tokens=False).ids)


def test_later_batches_encode_only_their_surroundings():
    tree = tokencount.Tree("word " * 10_000, tokencount.Counts(vocabulary("byte_bpe_50k.json")))
    for at in (25_000, 30_005, 5):
        tree.apply([(at, at + 4, "other one")])
    assert tree.encoded <= 12 and tree.total == 10_004


def test_edit_touches_only_its_surroundings():
    tree = tokencount.Tree("word " * 10_000, tokencount.Counts(vocabulary("byte_bpe_50k.json")))
    tree.apply([(25_000, 25_004, "other")])
    assert tree.encoded <= 4 and tree.total == 10_001


def test_masks_find_addresses_beside_marks_and_in_mails(spark, docs_of):
    texts = {
        1: ("server 10.0.0.12. Then", "server <ip>. Then"),
        2: ("10.0.0.1@host.com wrote", "<mail> wrote"),
        3: ("Done.10.0.0.1, 10.0.0.2...", "Done.<ip>, <ip>..."),
        4: ("v1.10.0.0.1 and 10.0.0.1.5 and 10.0.0.1234", None),
        5: ("10.0.0.1.me@a.b 10.0.0.1@host me@10.0.0.1.", "<mail> <ip>@host <mail>."),
    }
    masked = {}
    for r in docs_of(*((d, t) for d, (t, _) in texts.items())).withColumn("_text", F.col("text")).select("*", tokencount.masks().alias("e")).collect():
        assert len({e.start for e in r.e}) == len(r.e)
        made, at = "", 0
        for e in sorted(r.e):
            made, at = (made + r.text[at : e.start] + e.new, e.end) if e.start >= at else (made, at)
        masked[r.doc_id] = made + r.text[at:]
    assert masked == {d: f"{want or t}\n" for d, (t, want) in texts.items()}


def test_count_query_and_odd_rows(spark, docs_of):
    code = encoder(vocabulary("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    got = op9_token_counts(spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {d: len(code.ids(t)) for d, t in texts.items()}
    docs = docs_of(*ODD)
    edits = F.when(
        F.col("doc_id") == 5,
        F.array(
            F.struct(F.lit(0).alias("start"), F.lit(4).alias("end"), F.lit("no").alias("new")),
            F.struct(F.lit(2).alias("start"), F.lit(3).alias("end"), F.lit("x").alias("new")),
            F.struct(F.lit(500).alias("start"), F.lit(600).alias("end"), F.lit("x").alias("new")),
            F.struct(F.lit(5).alias("start"), F.lit(5).alias("end"), F.lit(None).cast("string").alias("new")),
        ),
    )
    rows = tokencount.count(docs, edits, vocabulary("byte_bpe_50k.json")).collect()
    assert len(rows) == len(ODD)
    assert all(r.n_edits == 1 for r in rows if r.doc_id == 5)
    assert all(r.n_tokens == r.n_tokens_edited for r in rows if r.doc_id != 5)
    assert tokencount.count(docs_of(), edits, vocabulary("byte_bpe_50k.json")).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=500))
def test_segments_round_trip(values):
    ids = np.array(values, dtype=np.uint32)
    assert (tokenfile.decode(tokenfile.encode(ids)) == ids).all()


def test_segments_are_small_and_patched():
    ids = np.full(128 * 50, 7, dtype=np.uint32)
    ids[::100] = 2**31
    assert len(tokenfile.encode(ids)) < 128 * 50 and (tokenfile.decode(tokenfile.encode(ids)) == ids).all()
    with pytest.raises(ValueError, match="token segment"):
        tokenfile.decode(b"nope" + bytes(40))


def test_token_files(spark):
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    got = {r.doc_id: r for r in op5_token_files(spark, SMALL).collect()}
    at = 0
    for d in sorted(texts):
        ids = ids_of("byte_bpe_50k.json", texts[d])
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_of_odd_rows(spark, docs_of):
    for rows in ([], ODD):
        path = f"{Scratch(spark, 'test').root}/ids"
        tokenfile.write(docs_of(*rows), path, vocabulary("byte_bpe_50k.json"))
        got = sorted(tokenfile.read(spark, path).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
        assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
        want = sorted(ids_of("byte_bpe_50k.json", t or "").tobytes() for _, t in rows)
        assert sorted(bytes(r.ids) for r in got) == want


def check_pieces(rows, pieces, length):
    """Every id in one piece, windows full and gapless."""
    place = sorted((p.sequence_id * length + p.offset, p.length) for p in pieces)
    assert [g for g, _ in place] == np.cumsum([0, *(n for _, n in place)])[:-1].tolist()
    assert all(p.offset + p.length <= length and p.length > 0 for p in pieces)
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    total = sum(len(i) for _, i in rows)
    assert sum(n for _, n in place) == total
    assert max((p.sequence_id for p in pieces), default=-1) + 1 == -(-total // length)


def test_packing_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    ids = {d: ids_of("word_bpe_49k.json", t) for d, t in texts.items()}
    got = op4_packing(spark, SMALL).collect()
    check_pieces(list(ids.items()), got, 4096)
    for p in got:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())


def test_packing_keeps_the_mixture(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["a"] * rng.randint(1, 60)), "x" if i % 3 else "y") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(docs, vocabulary("word_bpe_49k.json"), length=256, quantum=32).collect()
    source = {d: s for d, _, s in rows}
    total = sum(p.length for p in got)
    share = sum(p.length for p in got if source[p.doc_id] == "y") / total
    done = last = 0
    for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)):
        done += p.length
        last += p.length if source[p.doc_id] == "y" else 0
        assert abs(last - share * done) <= 2 * 32
    first = packing.pack(docs, vocabulary("word_bpe_49k.json"), {"x": 1, "y": 3}, 256, 32).where("sequence_id < 4").collect()
    assert 0.7 <= sum(p.length for p in first if source[p.doc_id] == "y") / 1024 <= 0.8


def test_packing_odd_rows(spark, docs_of):
    rows = [(d, ids_of("word_bpe_49k.json", t or "")) for d, t in ODD]
    got = packing.pack(docs_of(*ODD).withColumn("source", F.when(F.col("doc_id") > 3, F.col("source"))), vocabulary("word_bpe_49k.json"), length=64, quantum=16).collect()
    check_pieces(rows, got, 64)
    joined = {}
    for p in sorted(got, key=lambda p: p.start):
        joined.setdefault((p.doc_id, p.doc_tokens), []).append(bytes(p.ids))
    assert sum(len(b"".join(v)) for v in joined.values()) == 4 * sum(len(i) for _, i in rows)
    assert packing.pack(docs_of(), vocabulary("word_bpe_49k.json")).count() == 0
