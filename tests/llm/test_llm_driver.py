"""No table that grows with the corpus passes through the driver."""

from __future__ import annotations

import pytest
from llm_data import SMALL, docs_of, shipped  # noqa: F401
from tallyroom.llm import components, simhash, store
from tallyroom.llm.store import Scratch


@pytest.fixture
def written(monkeypatch):
    """Plans of all tables that are stored, by name."""
    plans, write = {}, Scratch.write

    def noted(self, df, name):
        out = write(self, df, name)
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        plans[name].append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(Scratch, "write", noted)
    return plans


def test_only_few_rows_are_broadcast(spark):
    left = spark.range(50)
    table = Scratch(spark, "test").write(spark.range(20), "t")
    plan = lambda most: left.join(store.unless_many(table, most), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(20) and "SortMergeJoin" in plan(19) and "Broadcast" not in plan(19)


def test_near_dedup_never_broadcasts_a_large_table(spark, monkeypatch, written):
    monkeypatch.setattr(store.unless_many, "__defaults__", (-1,))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = simhash.keep_one(docs)
    last = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in last and "BroadcastHashJoin" not in last
    joins = {name: [p for p in plans if "Join" in p] for name, plans in written.items()}
    for name in ("members", "wide", "links", "rooted", "labels", "kept"):
        assert joins[name], name
        assert not any("BroadcastHashJoin" in p or "BroadcastExchange" in p for p in joins[name]), name
    monkeypatch.undo()
    plain = simhash.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in plain.collect())


def test_components_are_the_same_merged(spark, monkeypatch):
    links = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, 30), (40, 30)], "a long, b long")
    found = lambda: {r.node: r.root for r in components.connected(Scratch(spark, "test"), links, "a", "b").collect()}
    plain = found()
    monkeypatch.setattr(store.unless_many, "__defaults__", (-1,))
    assert found() == plain == {i: 0 for i in range(10)} | {20: 20, 30: 20, 40: 20}
