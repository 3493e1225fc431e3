"""Sources, sinks, catalog, and incremental loads in batches and as a stream."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyroom.operators.checks import ValidationFailed
from tallyroom.schemas import RAW, SALES_TRANSACTIONS
from tallyroom.sinks import writers
from tallyroom.sources import catalog, readers
from tallyroom.sources.star import Star
from tallyroom.streaming import incremental

D = dt.date


@pytest.fixture
def parents(spark):
    return (
        spark.createDataFrame([("c1",), ("c2",)], "customer_id string"),
        spark.createDataFrame([("p1",)], "product_id string"),
    )


def _rows(*ids_and_days):
    return [
        {
            "transaction_id": i,
            "customer_id": "c1",
            "product_id": "p1",
            "order_date": day,
            "ship_date": day,
            "quantity": "1",
            "unit_price": price,
            "discount": "0",
            "region": "West",
        }
        for i, day, price in ids_and_days
    ]


def _raw(spark, rows):
    names = RAW["sales_transactions"].fieldNames()
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW["sales_transactions"])
    return df.withColumn("ingest_seq", F.monotonically_increasing_id())


FIRST = _rows(("a", "2020-01-05", "10"), ("b", "2020-02-05", "20"))
# repeats b with another price, adds a late row to January and a new month
LATE = _rows(("b", "2020-02-05", "99"), ("c", "2020-01-09", "30"), ("d", "2020-03-01", "40"))
WANT = {"a": 10.0, "b": 20.0, "c": 30.0, "d": 40.0}


def _stored(spark, path):
    rows = spark.read.schema(SALES_TRANSACTIONS).parquet(path).collect()
    assert len(rows) == len({r.transaction_id for r in rows})
    return {r.transaction_id: r.net_revenue for r in rows}


@pytest.mark.parametrize("only_touched", [False, True])
def test_late_batch(spark, parents, tmp_path, only_touched):
    path = str(tmp_path / "sales_transactions")
    added = [
        incremental.incremental_load(_raw(spark, rows), *parents, path, only_touched=only_touched)
        for rows in (FIRST, LATE, LATE)
    ]
    assert added == [2, 2, 0]
    assert _stored(spark, path) == WANT


def test_a_foreign_or_unreadable_target_is_an_error(spark, parents, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="another table"):
        incremental.incremental_load(_raw(spark, FIRST), *parents, str(tmp_path / "other"))
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="parquet|Parquet|FOOTER|footer"):
        incremental.incremental_load(_raw(spark, FIRST), *parents, str(broken))


def test_repeat_in_another_month_is_found_in_the_whole_table(spark, parents, tmp_path):
    path = str(tmp_path / "sales_transactions")
    incremental.incremental_load(_raw(spark, FIRST), *parents, path)
    moved = _raw(spark, _rows(("b", "2020-07-05", "77")))
    assert incremental.incremental_load(moved, *parents, path) == 0


def test_invalid_batch_is_refused(spark, parents, tmp_path):
    rows = [{**r, "region": "Mars"} for r in FIRST]
    with pytest.raises(ValidationFailed):
        incremental.incremental_load(_raw(spark, rows), *parents, str(tmp_path / "t"))
    assert not (tmp_path / "t").exists()


def test_stream_equals_batches_and_survives_replay(spark, parents, tmp_path):
    inbox, path = str(tmp_path / "inbox"), str(tmp_path / "sales_transactions")

    def run(progress):
        incremental.incremental_stream(
            spark, inbox, *parents, path, str(tmp_path / progress), max_files=1
        ).awaitTermination()

    for rows in (FIRST, LATE):
        _raw(spark, rows).drop("ingest_seq").coalesce(1).write.mode("append").option("header", True).csv(inbox)
        run("progress")
    assert _stored(spark, path) == WANT
    run("lost_progress")  # every file again
    assert _stored(spark, path) == WANT


def test_csv_keeps_file_order(spark, tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    header = ",".join(RAW["customers"].fieldNames())
    (folder / "part.csv").write_text(header + "\n" + "\n".join(f"{i},a,b,c,d,e,f,2020-01-01,g" for i in (3, 1, 2)))
    df = readers.read_raw(spark, str(tmp_path), "customers", ingest_order=True)
    assert [r.customer_id for r in df.orderBy("ingest_seq").collect()] == ["3", "1", "2"]
    assert set(dict(df.drop("ingest_seq").dtypes).values()) == {"string"}


def test_partitioned_layout_and_pruning(spark, tmp_path):
    path = str(tmp_path / "sales_transactions")
    txn = Star(spark, SMALL).transactions().select(*SALES_TRANSACTIONS.fieldNames())
    writers.write_partitioned(txn, path)
    back = readers.read_parquet_table(spark, str(tmp_path), "sales_transactions")
    assert back.count() == 6000 and back.schema.fieldNames() == SALES_TRANSACTIONS.fieldNames()
    one = catalog.scoped_filter(back, years=[1998])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "= 1998" in plan
    # replacing one month leaves the others alone
    month = back.where("year = 1998 AND month = 3").limit(5)
    writers.write_partitioned(spark.createDataFrame(month.collect(), SALES_TRANSACTIONS), path, touched_only=True)
    again = readers.read_parquet_table(spark, str(tmp_path), "sales_transactions")
    assert again.where("year = 1998 AND month = 3").count() == 5
    assert again.where("NOT (year = 1998 AND month = 3)").count() == txn.where("NOT (year = 1998 AND month = 3)").count()


def test_catalog_roundtrip(spark, tmp_path):
    star = Star(spark, SMALL)
    from tallyroom.plans.registry import _stored_star

    folder = _stored_star(star)
    db = f"sales_{uuid.uuid4().hex[:8]}"
    described = catalog.create_database(spark, db, str(tmp_path / "db"), "it's sales")
    assert "it's sales" in {r.info_value for r in described.collect()}
    columns = catalog.create_external_tables(spark, db, folder).collect()
    keys = {(r.table_name, r.column_name) for r in columns if r.is_partition}
    assert keys == {("sales_transactions", "year"), ("sales_transactions", "month")}
    assert all(r.comment for r in columns)
    assert spark.table(f"{db}.sales_transactions").count() == 0  # directories are not registered yet
    assert catalog.repair_partitions(spark, db).count() > 70
    assert spark.table(f"{db}.sales_transactions").count() == 6000
    stored = catalog.materialize(spark.table(f"{db}.customers").groupBy("region").count(), f"{db}.by_region", str(tmp_path / "m"))
    assert stored.count() == 5


def test_row_level_filter_without_grants_shows_nothing(spark, txn_of):
    t = txn_of({"order_date": D(2020, 1, 1)})
    grants = spark.createDataFrame([("ann", "West"), ("ann", "West"), ("bob", "East")], "user_name string, region string")
    assert catalog.row_level_filter(t, grants, "ann").count() == 1
    assert catalog.row_level_filter(t, grants, "eve").count() == 0
