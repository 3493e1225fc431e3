"""Work that must not grow faster than the tables: shuffles of the fact, texts read once, stored loads, buckets."""

from __future__ import annotations

import uuid

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyroom.functions.measures import by_customer_group
from tallyroom.operators import cleaning
from tallyroom.plans import registry
from tallyroom.sources import catalog
from tallyroom.sources.star import Star


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _above(plan, what):
    """The plan's lines above the first line that holds ``what``, nearest first."""
    lines = plan.splitlines()
    depth = lambda line: next(i for i, c in enumerate(line) if c.isalpha())
    at = next(i for i, line in enumerate(lines) if what in line)
    out, reach = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < reach:
            out.append(line)
            reach = depth(line)
    return out


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("table", ["transactions", "raw_transactions"])
def test_lines_are_shuffled_once_to_find_the_region(spark, no_broadcast, table):
    plan = _plan(getattr(Star(spark, SMALL), table)())
    above = _above(plan, "FileScan parquet [l_orderkey")
    assert sum("Exchange" in line for line in above) == 1


def test_texts_are_read_before_the_deduplication_shuffles_them(spark):
    star = Star(spark, SMALL)
    plan = _plan(cleaning.clean_transactions(star.raw_transactions(), star.customers(signup=False), star.products()))
    above = _above(plan, "Exchange hashpartitioning(transaction_id")
    assert not any("yyyy/M/d" in line for line in above) and "yyyy/M/d" in plan


def test_shapes_of_dates_and_numbers_refuse_nothing_that_is_read(spark):
    days = ["2020-1-5", "2020/1/05", "2020/01/05 ", "1/5/2020", "12/31/2020", "5 Jan 2020", "05 Jan 2020", "5 jan 2020", "not a date"]
    days += ["2021/13/45", "13/45/2021", "+12020/1/5", "-2020/1/5", "1/5/20", "20/1/5", "5 January 2020", "5  Jan 2020", "", " ", None]
    df = spark.createDataFrame([(d,) for d in days], "t string")
    free = [F.try_to_timestamp(F.trim("t"), F.lit(f)).cast("date") for f in cleaning.DATE_FORMATS]
    made = df.select(cleaning.day_of("t").cast("string"), F.coalesce(F.trim("t").try_cast("date"), *free).cast("string")).collect()
    assert all(a == b for a, b in made) and sum(a is not None for a, _ in made) >= 7
    numbers = ["1", "-1.5", "1e3", ".5", "5.", "1d", "2F", "0x1p3", "+7", "x", "much", "Infinity", "-inf", "NaN", "1e999", "", None]
    df = spark.createDataFrame([(x,) for x in numbers], "t string")
    x = F.trim("t").try_cast("double")
    made = df.select(cleaning.number_of("t"), F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)).collect()
    assert all(a == b for a, b in made) and sum(a is not None for a, _ in made) >= 6


def test_a_deduplication_by_texts_sees_the_texts(spark):
    names = ["transaction_id", "customer_id", "product_id", "order_date", "ship_date", "quantity", "unit_price", "discount", "region"]
    rows = [("t", "c", "p", "2020-01-05", None, "10", "1", "0", "West"), ("t", "c", "p", "2020-01-05", None, "9", "1", "0", "West")]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    parents = spark.createDataFrame([("c",)], "customer_id string"), spark.createDataFrame([("p",)], "product_id string")
    for order, want in ((["quantity"], 10), ([F.desc("quantity")], 9), ([F.col("quantity").cast("int")], 9)):
        assert [r.quantity for r in cleaning.clean_transactions(raw, *parents, order).collect()] == [want]


def test_loads_are_profiled_from_what_is_stored(spark):
    assert "lineitem" not in _plan(registry.build("profile_by_load", spark, SMALL))


@pytest.mark.parametrize("name", ["incremental_load", "indexed_load"])
def test_batches_are_delivered_once(spark, monkeypatch, name):
    plans = []

    def load(batch, *args, **kw):
        plans.append(_plan(batch))
        raise StopIteration

    monkeypatch.setattr(registry.incremental, name, load)
    with pytest.raises(StopIteration):
        registry.build(name, spark, SMALL)
    assert plans and "lineitem" not in plans[0]


def test_buckets_double_with_the_table(spark, tmp_path):
    star = Star(spark, SMALL)
    txn = star.transactions(region=False)
    rows = txn.count()
    made = [catalog.fitting_buckets(txn, "customer_id", 3, rows // n) for n in (1, 3, 4, 20)]
    assert [n for n, _ in made] == [3, 3, 6, 24]
    assert all(abs(skew - catalog.bucket_skew(txn, "customer_id", n)) < 1e-9 for n, skew in made)
    assert catalog.fitting_buckets(txn.where("false"), "customer_id", 3) == (3, 0.0)
    database = f"growth_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, database, f"{tmp_path}/db")
    names = registry.SALES_TRANSACTIONS.fieldNames()
    stored = star.transactions().select(*names)
    catalog.create_bucketed_tables(
        spark, database, str(tmp_path), registry._customers_contract(star), star.products(), stored, 3, rows_per_bucket=rows // 4
    )
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED `{database}`.sales_transactions").collect()}
    assert described["Num Buckets"] == "6"
    assert spark.table(f"{database}.sales_transactions").count() == rows


def test_a_row_filter_never_gathers_a_region_in_one_task(spark, no_broadcast):
    star = Star(spark, SMALL)
    grants = star._places().select(F.col("country").alias("user_name"), "region")
    seen = catalog.row_level_filter(star.transactions(), grants, "NATION_3")
    above = _above(_plan(seen), "FileScan parquet [l_orderkey")
    assert not any("hashpartitioning(region" in line for line in above)
    assert 0 < seen.count() < star.transactions().count()


# -- orders of customers' groups


@pytest.mark.parametrize("name", ["top_cities_by_region", "segment_overview"])
def test_ids_of_one_customer_are_counted_where_their_lines_met(spark, no_broadcast, name):
    plan = _plan(registry.build(name, spark, SMALL))
    above = _above(plan, "FileScan parquet [l_orderkey")
    shuffles = [line for line in above if "Exchange" in line]
    assert "l_orderkey" in shuffles[0] and not any("transaction_id" in line for line in shuffles)
    assert "customer_id" in shuffles[1]


@pytest.mark.parametrize("within", [[], ["order_key"]])
def test_orders_of_groups_on_odd_rows(spark, within):
    rows = [
        (1, "1-a", "c1", 1.0), (1, "1-a", "c1", 2.0), (1, "1-a", "c2", 4.0), (1, "1-b", "c1", 8.0), (2, "2-a", "c3", 16.0),
        (2, "2-a", "cx", 32.0), (2, "2-b", "cx", 64.0), (3, "3-a", None, 128.0), (3, "3-a", "c2", 256.0), (4, None, "c1", 512.0),
        (5, None, "c1", 1024.0), (5, None, "c3", 2048.0), (6, "6-a", "c4", None), (7, "7-a", "c5", 4096.0), (7, "7-a", "c1", 1.5),
        (8, None, "c6", 2.5),
    ]
    txn = spark.createDataFrame(rows, "order_key int, transaction_id string, customer_id string, net_revenue double")
    # c2 is listed twice in a group, c3 in two groups, c4 and c5 in a group without a name
    listed = [("c1", "A"), ("c2", "A"), ("c2", "A"), ("c3", "A"), ("c3", "B"), ("c4", None), ("c5", None), ("c6", "C"), (None, "A")]
    customers = spark.createDataFrame(listed, "customer_id string, segment string")
    plain = txn.join(customers, "customer_id").groupBy("segment").agg(
        F.sum(F.rint(F.col("net_revenue") * 100).cast("bigint")),
        F.countDistinct("customer_id"),
        F.countDistinct("transaction_id"),
    )
    made = by_customer_group(txn, customers, "segment", within=within).select("segment", "revenue", "customers", "orders")
    want = {r[0]: tuple(r)[1:] for r in plain.collect()}
    assert {r[0]: tuple(r)[1:] for r in made.collect()} == want
    assert want["A"][1:] == (3, 5) and want["C"][1:] == (1, 0)


def test_an_id_names_its_order(spark):
    star = Star(spark, SMALL)
    txn = star.transactions(region=False, order_key=True)
    assert txn.where(F.substring_index("transaction_id", "-", 1) != F.col("order_key").cast("string")).isEmpty()
    assert txn.drop("order_key").columns == star.transactions(region=False).columns
