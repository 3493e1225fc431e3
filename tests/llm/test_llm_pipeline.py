from __future__ import annotations

import zlib
from llm_data import ODD, SMALL, docs_of, shipped  # noqa: F401
import corpus_pipeline
import numpy as np

from tallyroom.llm import quality, secrets
from tallyroom.llm.queries import table, vocabulary
from tallyroom.llm.tokens import encoder

import test_llm_secrets
import test_llm_simhash


def test_run_equals_brute_force(spark):
    """Each stage again without Spark, on what the one before has left."""
    rows = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    weights = quality.train(table(spark, SMALL, "documents"), table(spark, SMALL, "labels")).astype(np.float32)
    rows = {d: t for d, t in rows.items() if quality.score(weights.astype(float), t) >= 0.3}
    groups = test_llm_simhash.brute([(d, test_llm_simhash.slow_fingerprint(t)) for d, t in rows.items()])
    rows = {d: t for d, t in rows.items() if groups[d] == d}
    items = [r.text for r in table(spark, SMALL, "benchmark").collect()]
    rows = {d: t for d, t in rows.items() if not any(i in t for i in items)}
    for d, t in rows.items():
        made, at = "", 0
        for s, _, e, _ in test_llm_secrets.brute(t):
            made, at = made + (t[at:s] + secrets.MASK if s >= at else ""), max(at, e)
        rows[d] = made + t[at:] if at else t
    code = encoder(vocabulary("word_bpe_49k.json"))
    ids = {d: np.append(code.ids(t), 2).astype("<u4") for d, t in rows.items()}
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {p.doc_id for p in got} == set(ids) and 0 < len(ids) < 200
    assert sum(p.length for p in got) == sum(map(len, ids.values()))
    for p in got:
        assert p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(ids[p.doc_id][p.start : p.start + p.length].tobytes())


def test_stages_keep_columns_and_take_odd_rows(spark, docs_of):
    docs = docs_of(*ODD)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "packing":
            assert out.columns == docs.columns
        assert stage(spark, docs_of(), SMALL).count() == 0
        out.collect()


def test_entry_lists_every_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)
