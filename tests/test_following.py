"""Loads that look up an id index, and stored results that follow them month by month."""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_loading import FIRST, LATE, WANT, _raw, _rows, _stored, parents  # noqa: F401

from tallyroom.functions import bitmaps
from tallyroom.operators import kpi, region, rollups, timeseries
from tallyroom.schemas import RAW, SALES_TRANSACTIONS
from tallyroom.sinks import writers
from tallyroom.sources.readers import read_parquet_table
from tallyroom.sources.star import Star
from tallyroom.streaming import incremental
from tallyroom.streaming.id_index import IdIndex

D = dt.date


def ids(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "transaction_id string")


def held(index):
    return sorted(r.transaction_id for r in index.stored().collect())


# -- the index itself


def test_folders_double_and_nothing_is_lost(spark, tmp_path):
    index = IdIndex(spark, str(tmp_path / "ids"), keys_per_bucket=50, most_buckets=16)
    assert not index.exists()
    index.build(ids(spark))
    assert index.exists() and index.buckets == 1 and held(index) == []
    want: list[str] = []
    for n in range(6):
        new = [f"t{n}-{i}" for i in range(100)]
        index.add(ids(spark, *new), len(new))
        want += new
        assert held(index) == sorted(want)
    assert index.buckets == 16 and os.listdir(tmp_path / "ids" / "generations") == ["16"]
    index.compact()
    assert held(index) == sorted(want)
    files = list((tmp_path / "ids" / "generations" / "16").glob("bucket=*/*.parquet"))
    assert len(files) == len({f.parent for f in files})
    probe = ids(spark, "t0-1", "t5-99", "new", None)
    assert sorted(r.transaction_id for r in index.known(probe).collect()) == ["t0-1", "t5-99"]


def test_bytes_read_follow_the_batch_and_not_the_history(spark, tmp_path):
    def read(total):
        index = IdIndex(spark, str(tmp_path / f"ids{total}"), keys_per_bucket=2_000)
        index.build(spark.range(total).select(F.concat(F.lit("t-"), "id").alias("transaction_id")))
        batch = ids(spark, *[f"t-{i * 17}" for i in range(4)], "n-1", "n-2")
        assert index.known(batch).count() == 4 and index.stored(batch).count() < 6 * 1.2 * 2_000
        return sum(Path(f.removeprefix("file:")).stat().st_size for f in index.stored(batch).inputFiles())

    small, large = read(32_000), read(320_000)
    assert large < 1.3 * small


# -- loads


def test_late_repeated_and_moved_rows(spark, parents, tmp_path):  # noqa: F811
    path = str(tmp_path / "sales_transactions")
    load = lambda rows: incremental.indexed_load(_raw(spark, rows), *parents, path)
    assert load(FIRST) == incremental.Load(2, ((2020, 1), (2020, 2)))
    assert load(LATE) == incremental.Load(2, ((2020, 1), (2020, 3)))
    assert load(LATE) == incremental.Load(0, ())
    # a known id in another month, and a new id
    assert load(_rows(("b", "2020-07-05", "77"), ("e", "2020-07-05", "50"))).months == ((2020, 7),)
    assert _stored(spark, path) == {**WANT, "e": 50.0}
    assert not (tmp_path / "sales_transactions_pending").exists()


def test_an_index_is_made_for_a_table_that_has_none(spark, parents, tmp_path):  # noqa: F811
    path = str(tmp_path / "sales_transactions")
    incremental.incremental_load(_raw(spark, FIRST), *parents, path)
    assert incremental.indexed_load(_raw(spark, LATE), *parents, path).added == 2
    assert _stored(spark, path) == WANT


class Stop(Exception):
    pass


@pytest.mark.parametrize("where", ["before the table", "within the table", "after the table", "within the index", "after the index"])
def test_a_broken_load_is_finished_by_the_next(spark, parents, tmp_path, monkeypatch, where):  # noqa: F811
    path = str(tmp_path / "sales_transactions")
    incremental.indexed_load(_raw(spark, FIRST), *parents, path)
    write, add = incremental.write_partitioned, IdIndex.add

    def broken_write(df, *args, **kw):
        if where == "within the table":
            write(df.where("transaction_id = 'c'"), *args, **kw)
        if where in ("before the table", "within the table"):
            raise Stop
        write(df, *args, **kw)

    def broken_add(self, keys, count):
        if where == "within the index":
            self._write(keys.where("transaction_id = 'd'"), self.buckets, "append")
        if where == "after the index":
            add(self, keys, count)
        raise Stop

    with monkeypatch.context() as m, pytest.raises(Stop):
        m.setattr(incremental, "write_partitioned", broken_write)
        m.setattr(IdIndex, "add", broken_add)
        incremental.indexed_load(_raw(spark, LATE), *parents, path)
    seen: list[incremental.Load] = []
    incremental.indexed_load(_raw(spark, LATE), *parents, path, then=seen.append)
    assert _stored(spark, path) == WANT
    assert held(IdIndex(spark, f"{path}_ids")) == sorted(WANT)
    # whoever follows the table hears of the months of the broken load
    assert {(2020, 1), (2020, 3)} <= {m for s in seen for m in s.months}


def test_indexed_stream_with_malformed_records(spark, parents, tmp_path):  # noqa: F811
    inbox, path = tmp_path / "inbox", str(tmp_path / "sales_transactions")
    inbox.mkdir()
    names = RAW["sales_transactions"].fieldNames()
    line = lambda r: ",".join(str(r.get(n) or "") for n in names)
    quoted = line(FIRST[0]).replace("West", '"We""st, or so"', 1)

    def run(progress):
        incremental.incremental_stream(
            spark, str(inbox), *parents, path, str(tmp_path / progress), max_files=1, regions=None, indexed=True
        ).awaitTermination()

    (inbox / "1.csv").write_text("\n".join([",".join(names), quoted, line(FIRST[1]), line(FIRST[1]) + ",x", '"open,' + line(FIRST[0])]))
    run("progress")
    (inbox / "2.csv").write_text("\n".join([",".join(names), *map(line, LATE)]))
    run("progress")
    bad = spark.read.parquet(f"{path}_quarantine").collect()
    assert sorted((r.reason, r.file.rsplit("/", 1)[1]) for r in bad) == [("open quote", "1.csv"), ("surplus fields", "1.csv")]
    assert _stored(spark, path) == WANT
    assert spark.read.parquet(path).where("transaction_id = 'a'").first().region == 'We"st, or so'
    run("lost_progress")
    assert _stored(spark, path) == WANT and spark.read.parquet(f"{path}_quarantine").count() == 2


# -- distinct counts


def test_bitmaps_merge_into_exact_counts(spark, tmp_path):
    df = spark.range(120_000).select(
        (F.col("id") % 7).alias("g"),
        (F.col("id") % 3).alias("h"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 31 % 70_000).cast("string")).alias("k"),
    )
    numbers = bitmaps.KeyNumbers(spark, str(tmp_path / "numbers"), "k")
    assert numbers.add(df.where("g < 3")) > 0
    first = {r.k: r.number for r in numbers.table().collect()}
    numbers.add(df)
    assert numbers.add(df) == 0
    now = {r.k: r.number for r in numbers.table().collect()}
    assert sorted(now.values()) == list(range(1, len(now) + 1)) and now.items() >= first.items()
    cells = bitmaps.bitmap_cells(numbers.number(df), ["g", "h"], "number")
    assert cells.count() > 21  # more than one bitmap a group
    for keys in ([], ["g"], ["h"], ["g", "h"]):
        want = {tuple(r[k] for k in keys): r.n for r in df.groupBy(*keys).agg(F.countDistinct("k").alias("n")).collect()}
        assert {tuple(r[k] for k in keys): r.n for r in bitmaps.distinct_of(cells, keys, "n").collect()} == want


def test_only_bitmaps_are_shuffled(spark, tmp_path):
    made = bitmaps.bitmap_cells(spark.range(10).withColumnRenamed("id", "number"), [], "number")
    plan = made._jdf.queryExecution().executedPlan().toString()
    before_exchange = plan[plan.index("Exchange") :]
    assert "partial_bitmap_construct_agg" in before_exchange


# -- stored results


def same(a, b):
    key = lambda r: tuple(map(str, r))
    return sorted(map(tuple, a.collect()), key=key) == sorted(map(tuple, b.collect()), key=key)


def all_equal(made, txn, products):
    return (
        same(made.monthly_sales(), timeseries.monthly_sales(txn))
        and same(made.regional_summary(), region.regional_summary(txn, products))
        and same(made.kpi_totals(), kpi.kpi_totals(txn, products))
        and same(made.quarterly_revenue(), kpi.quarterly_revenue(txn))
    )


def test_reports_follow_touched_months_only(spark, tmp_path):
    star = Star(spark, SMALL)
    products = star.products()
    names = SALES_TRANSACTIONS.fieldNames()
    # some rows without customer, region or known product
    txn = star.loose_transactions().withColumn("region", F.when(F.col("quantity") % 5 > 0, F.concat(F.lit("R"), F.col("quantity") % 3)))
    txn = txn.withColumn("customer_id", F.when(F.col("quantity") % 23 > 0, F.col("customer_id"))).select(*names)
    late = "(year = 1997 AND month = 2 AND quantity < 20) OR (year = 1998 AND month = 1)"
    path = f"{tmp_path}/sales_transactions"
    writers.write_partitioned(txn.where(f"NOT ({late})"), path)
    table = lambda: read_parquet_table(spark, str(tmp_path), "sales_transactions")
    made = rollups.Rollups(spark, f"{tmp_path}/rollups")
    made.rebuild(table(), products)
    assert all_equal(made, table(), products)
    stamps = {f: f.stat().st_mtime_ns for f in Path(tmp_path, "rollups", "cells").rglob("*.parquet")}

    writers.write_partitioned(txn.where(late), path, mode="append")
    months = ((1997, 2), (1998, 1))
    plan = table().where(incremental.month_filter(months))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((year" in plan and "IN (199702,199801)" in plan
    # months that were not touched cannot be read any more: the refresh does not miss them
    for f in Path(path).rglob("*.parquet"):
        if f.parent.parent.name + f.parent.name not in ("year=1997month=2", "year=1998month=1"):
            f.write_bytes(b"")
            (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    for _ in range(2):
        made.refresh(table(), products, months)
        assert all_equal(made, txn, products)
    rewritten = {f.parent for f, t in stamps.items() if not f.exists() or f.stat().st_mtime_ns != t}
    assert {f"{p.parent.name}{p.name}" for p in rewritten} <= {"year=1997month=2", "year=1998month=1"}


def test_a_load_refreshes_what_follows_it(spark, parents, tmp_path):  # noqa: F811
    customers, _ = parents
    products = spark.createDataFrame([("p1", 4.0)], "product_id string, unit_cost double")
    path = f"{tmp_path}/sales_transactions"
    made = rollups.Rollups(spark, f"{tmp_path}/rollups")

    def follow(load):
        made.refresh(read_parquet_table(spark, str(tmp_path), "sales_transactions"), products, load.months)

    for rows in (FIRST, LATE, LATE):
        incremental.indexed_load(_raw(spark, rows), customers, products, path, then=follow)
    assert all_equal(made, read_parquet_table(spark, str(tmp_path), "sales_transactions"), products)
