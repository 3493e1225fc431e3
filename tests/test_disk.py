"""What loads leave on the disk, and how much of it they hold meanwhile."""

from __future__ import annotations

import os
import time

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyroom.functions import durable as store
from tallyroom.operators.checks import ValidationFailed
from tallyroom.plans import registry
from tallyroom.schemas import RAW, SALES_TRANSACTIONS
from tallyroom.streaming import incremental

NAMES = RAW["sales_transactions"].fieldNames()


@pytest.fixture
def parents(spark):
    return (
        spark.createDataFrame([("c1",), ("c2",)], "customer_id string"),
        spark.createDataFrame([("p1",)], "product_id string"),
    )


def _row(i, day="2020-01-05", price="10", **other):
    plain = {"transaction_id": i, "customer_id": "c1", "product_id": "p1", "order_date": day, "quantity": "1", "region": "West"}
    return plain | {"unit_price": price} | other


def _raw(spark, rows):
    return spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in rows], RAW["sales_transactions"])


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _left(spark, known, seconds=20):
    """Shuffle files besides the known ones; they are removed a moment after their query."""
    until = time.time() + seconds
    while (left := _shuffle_files(spark) - known) and time.time() < until:
        time.sleep(0.1)
    return left


def _tables(spark):
    top = store.shared_dir(spark).removeprefix("file://") + "/tallyroom"
    return {n for n in os.listdir(top) if n.startswith("table-")} if os.path.isdir(top) else set()


def test_queries_of_the_block_leave_no_shuffle_files(spark):
    before, known = spark.conf.get(store.FREE_SHUFFLES), _shuffle_files(spark)
    with store.freed_shuffles(spark):
        made = store.durable(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert not _left(spark, known) and made.count() == 7
    with pytest.raises(ZeroDivisionError), store.freed_shuffles(spark):
        _ = 1 // 0
    assert spark.conf.get(store.FREE_SHUFFLES) == before
    store.release(made)
    assert not os.path.exists(made._durable_path.removeprefix("file://"))


@pytest.mark.parametrize("load", [incremental.incremental_load, incremental.indexed_load])
def test_a_load_leaves_the_table_alone(spark, parents, tmp_path, load):
    path, tables, known = str(tmp_path / "sales_transactions"), _tables(spark), _shuffle_files(spark)
    # text and rows of a batch come from files, so that every shuffle is the load's own
    for k, rows in enumerate(([_row("a"), _row("b")], [_row("b", price="99"), _row("c", "2020-03-01")])):
        batch = _raw(spark, rows).withColumn("ingest_seq", F.monotonically_increasing_id())
        load(batch, *parents, path)
        assert _tables(spark) == tables, k
    assert not _left(spark, known)
    stored = spark.read.schema(SALES_TRANSACTIONS).parquet(path).collect()
    assert {r.transaction_id: r.net_revenue for r in stored} == {"a": 10.0, "b": 10.0, "c": 10.0}


def test_a_refused_batch_is_not_kept(spark, parents, tmp_path):
    tables = _tables(spark)
    batch = _raw(spark, [_row("a", region="Mars")]).withColumn("ingest_seq", F.lit(1))
    for load in (incremental.incremental_load, incremental.indexed_load):
        with pytest.raises(ValidationFailed):
            load(batch, *parents, str(tmp_path / "t"))
    assert _tables(spark) == tables


@pytest.mark.parametrize("name", ["indexed_load", "incremental_load"])
def test_delivered_batches_go_when_they_are_loaded(spark, name):
    tables = _tables(spark)
    assert registry.build(name, spark, SMALL).count() > 0
    assert _tables(spark) == tables


def test_a_stream_leaves_its_table_and_what_it_set_aside(spark, parents, tmp_path):
    """Of rows that share an id the first by content stays, missing-value tokens and NULLs before all texts."""
    rows = [
        _row("a", price="20"), _row("a", price="10"), _row("a", price="NA", quantity="5"),
        _row("b", price="9"), _row("b", price="10"), _row("b", "2020-02-01", "1"),
        _row("c", quantity="2", price="5"), _row("c", quantity="2.0", price="4"),
        _row("d", customer_id="NA"), _row("d", customer_id="c2"), _row("e", discount="x"), _row("e", discount="0.5"),
        _row("NA"), _row(None, "2020-05-01"),
    ]
    inbox, path = str(tmp_path / "inbox"), str(tmp_path / "sales_transactions")
    _raw(spark, rows).repartition(3).write.option("header", True).csv(inbox)
    tables, known = _tables(spark), _shuffle_files(spark)
    incremental.incremental_stream(spark, inbox, *parents, path, str(tmp_path / "progress")).awaitTermination()
    missing = lambda r: {n: None if r.get(n) in ("NA", None) else r[n] for n in NAMES}
    first: dict = {}
    for r in sorted(map(missing, rows), key=lambda r: [(r[n] is not None, r[n] or "") for n in NAMES]):
        first.setdefault(r["transaction_id"], r)
    want = {i: r["unit_price"] for i, r in first.items() if i and r["customer_id"] and r["unit_price"]}
    stored = {r.transaction_id: r.unit_price for r in spark.read.schema(SALES_TRANSACTIONS).parquet(path).collect()}
    assert stored == {i: float(p) for i, p in want.items()} and stored["b"] == 10.0 and "d" not in stored
    assert _tables(spark) == tables and not _left(spark, known)


@pytest.mark.parametrize("indexed", [False, True])
def test_texts_of_a_stream_travel_once(spark, parents, tmp_path, monkeypatch, indexed):
    given = []
    take = lambda rows, *a, order, **kw: given.append((rows.columns, list(order)))
    monkeypatch.setattr(incremental, "indexed_load" if indexed else "incremental_load", take)
    inbox = str(tmp_path / "inbox")
    _raw(spark, [_row("a")]).write.option("header", True).csv(inbox)
    incremental.incremental_stream(
        spark, inbox, *parents, str(tmp_path / "t"), str(tmp_path / "progress"), indexed=indexed
    ).awaitTermination()
    assert given == [(NAMES, NAMES)]


def test_other_formats_are_ordered_by_the_texts_as_they_came(spark, parents, tmp_path):
    inbox, path = str(tmp_path / "inbox"), str(tmp_path / "sales_transactions")
    _raw(spark, [_row("a", quantity="N/A"), _row("a", quantity="5")]).write.parquet(inbox)
    incremental.incremental_stream(
        spark, inbox, *parents, path, str(tmp_path / "progress"), file_format="parquet"
    ).awaitTermination()
    assert [r.quantity for r in spark.read.schema(SALES_TRANSACTIONS).parquet(path).collect()] == [5]


def test_the_inbox_holds_packed_files(spark, monkeypatch):
    seen = []

    class Ended:
        def awaitTermination(self):  # noqa: N802
            pass

    monkeypatch.setattr(registry.incremental, "incremental_stream", lambda s, inbox, *a, **kw: seen.append(inbox) or Ended())
    monkeypatch.setattr(registry.readers, "read_parquet_table", lambda *a: None)
    registry.build("incremental_stream", spark, SMALL)
    files = [n for n in os.listdir(seen[0].removeprefix("file://")) if n.startswith("part-")]
    assert files and all(n.endswith(".csv.gz") for n in files)
