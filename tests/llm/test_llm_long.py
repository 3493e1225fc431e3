"""Texts without a blank are read in linear time, with the same matches as the plain patterns."""

from __future__ import annotations

import random
import re
import time

import pytest
from llm_data import docs_of, shipped  # noqa: F401
from tallyroom.llm import tokencount, toxicity
from tallyroom.llm.secrets import found

MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
HIDDEN = re.compile(r"\S*[^\W\d_][@$!0-9*._-]{1,2}[^\W\d_]\S*")


def test_mails_are_those_of_the_plain_pattern(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choice("ab1.@@-_%+ é") for _ in range(rng.randrange(60)))) for i in range(500)]
    rule = tokencount.MASKS[0][0]
    made = {r.doc_id: r.spans for r in docs_of(*rows).select("doc_id", found(rule, 0, "text").alias("spans")).collect()}
    for i, t in rows:
        assert [(s.start, s.end) for s in made[i]] == [m.span() for m in re.finditer(MAIL, t)]


def test_hidden_words_are_those_of_the_plain_pattern():
    rng = random.Random(3)
    for _ in range(3000):
        t = "".join(rng.choice("ab1.@$-_ é漢\n\x1f *") for _ in range(rng.randrange(40)))
        marked = [x for x in t.split() if toxicity._HIDDEN.search(x)] if toxicity._HIDDEN.search(t) else []
        assert marked == HIDDEN.findall(t)


@pytest.mark.parametrize("run", ["a", "漢", "a1", "a.", "é-", "@", "a@b"])
def test_toxicity_features_of_a_million_characters(run):
    begin = time.time()
    toxicity.features(run * (1_000_000 // len(run)) + " x @ y", frozenset(["idiot"]), frozenset(["idio"]))
    assert time.time() - begin < 20


@pytest.mark.parametrize("run", ["a", "漢", "a.", "é-"])
def test_mails_in_a_million_characters(spark, docs_of, run):
    begin = time.time()
    rule = tokencount.MASKS[0][0]
    df = docs_of((1, run * (1_000_000 // len(run)) + " x @ y a@b.cd"))
    assert len(df.select(found(rule, 0, "text").alias("s")).first().s) == 1
    assert time.time() - begin < 60
