"""Reports and audits that read the transactions once, and access rules where SQL users read."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyroom.functions.measures import by_customer_group, declare_unique
from tallyroom.operators import audits, checks, cleaning, customer
from tallyroom.plans.registry import build
from tallyroom.schemas import SALES_TRANSACTIONS
from tallyroom.sinks import writers
from tallyroom.sources import catalog
from tallyroom.sources.readers import read_parquet_table
from tallyroom.sources.star import Star

D = dt.date


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


# -- references


@pytest.fixture
def child(spark):
    rows = [("c1", 1, 5), ("c1", 2, 0), ("cx", 1, 1), (None, None, 7), ("cx", 9, None), ("c2", 2, 3)]
    return spark.createDataFrame(rows, "customer_id string, product_id int, quantity int")


@pytest.fixture
def both(spark):
    # parents that repeat a key or hold a NULL one
    return {
        "customer_id": spark.createDataFrame([("c1",), ("c1",), ("c2",), (None,)], "customer_id string"),
        "product_id": spark.createDataFrame([(1,), (2,), (2,)], "product_id int"),
    }


def test_references_and_conditions_in_one_pass(child, both):
    row = checks.reference_counts(child, both, {"low": F.col("quantity") < 2, "none": F.col("quantity").isNull()}).first()
    assert row.asDict() == {"orphans_customer_id": 3, "orphans_product_id": 2, "low": 2, "none": 1}
    assert checks.reference_counts(child.limit(0), both, {"low": F.col("quantity") < 2}).first().asDict() == {
        "orphans_customer_id": 0, "orphans_product_id": 0, "low": 0,
    }
    alone = {"product_id": both["product_id"]}
    assert checks.reference_counts(child, alone).first().asDict() == {"orphans_product_id": 2}
    for key, parent in both.items():
        want = checks.orphan_rows(child, key, parent).agg(F.sum("c")).first()[0]
        assert {r.column: r.orphans for r in checks.orphan_totals(child, both).collect()}[key] == want


@pytest.mark.parametrize("name", ["dq_scorecard", "dq_referential", "segment_overview", "top_cities_by_region", "ltv_by_segment"])
def test_the_fact_is_read_once(spark, name):
    assert _plan(build(name, spark, SMALL)).count("lineitem.parquet") == 1


def test_scorecard_shuffles_keys_that_are_combined_already(spark):
    star = Star(spark, SMALL)
    txn = star.transactions(region=False).select("customer_id", "product_id", "quantity", "discount", "order_date", "ship_date")
    lines = _plan(audits.dq_scorecard(star.customers(signup=False), star.products(), txn)).splitlines()
    at = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "grouping_id" in line)
    assert "partial_sum" in lines[at + 1] and "partial_count" in lines[at + 1]


def test_an_id_under_two_customers_counts_once_in_a_group(spark, txn_of):
    txn = txn_of(
        {"transaction_id": "t1", "customer_id": "c1", "net_revenue": 1.0},
        {"transaction_id": "t1", "customer_id": "c2", "net_revenue": 2.0},
        {"transaction_id": "t2", "customer_id": "c2", "net_revenue": 4.0},
        {"transaction_id": "t3", "customer_id": "c3", "net_revenue": 8.0},
        {"transaction_id": "t4", "customer_id": "cx", "net_revenue": 16.0},
    )
    customers = spark.createDataFrame([("c1", "A"), ("c2", "A"), ("c3", None)], "customer_id string, segment string")
    made = {r.segment: (r.revenue, r.customers, r.orders) for r in by_customer_group(txn, customers, "segment").collect()}
    assert made == {"A": (700, 2, 2), None: (800, 1, 1)}
    plain = {r.segment: r.orders for r in by_customer_group(declare_unique(txn), customers, "segment").collect()}
    assert plain == {"A": 3, None: 1}


def test_orders_of_a_segment_are_counted_on_request(spark):
    star = Star(spark, SMALL)
    txn, customers = star.transactions(region=False), star.customers(signup=False)
    without, counted = customer.ltv_by_segment(txn, customers), customer.ltv_by_segment(txn, customers, with_orders=True)
    assert set(counted.columns) - set(without.columns) == {"avg_orders"}
    assert sorted_rows(counted.drop("avg_orders")) == sorted_rows(without)
    assert "transaction_id" not in _plan(without).replace("l_", "")


def test_the_registered_segment_report_counts_orders(spark):
    made = {r.segment: (r.customers, r.avg_orders) for r in build("ltv_by_segment", spark, SMALL).collect()}
    star = Star(spark, SMALL)
    sold = star.transactions(region=False).join(star.customers(signup=False), "customer_id").groupBy("segment")
    want = sold.agg(F.countDistinct("customer_id").alias("c"), F.countDistinct("transaction_id").alias("o")).collect()
    assert {k: n for k, (n, _) in made.items()} == {r.segment: r.c for r in want}
    assert all(abs(made[r.segment][1] - r.o / r.c) <= 0.005 + 1e-9 for r in want)


# -- cleaning


def test_audit_of_the_writing_pass(spark, tmp_path):
    star = Star(spark, SMALL)
    raw = star.raw_transactions()
    customers, products = star.customers(signup=False).where("customer_id <> '3'"), star.products().where("product_id <> '7'")
    path = f"{tmp_path}/sales_transactions"
    made = cleaning.write_clean_transactions(raw, customers, products, path)
    audit = cleaning.cleaning_audit(star.raw_customers(), star.raw_products(), raw, customers, products)
    assert sorted_rows(made) == sorted_rows(audit.where("table_name = 'sales_transactions'"))
    counts = {r.step: r.rows for r in made.collect()}
    assert counts["final"] < counts["with_keys_and_date"] < counts["after_dedupe"] < counts["loaded"]
    assert counts["unknown_customer"] > 0 and counts["unknown_product"] > 0 and counts["bad_quantity"] > 0
    names = SALES_TRANSACTIONS.fieldNames()
    stored = read_parquet_table(spark, str(tmp_path), "sales_transactions")
    assert sorted_rows(stored.select(*names)) == sorted_rows(cleaning.clean_transactions(raw, customers, products).select(*names))


def test_audit_of_nothing(spark, tmp_path):
    star = Star(spark, SMALL)
    made = cleaning.write_clean_transactions(
        star.raw_transactions().where("transaction_id = 'none'"), star.customers(signup=False), star.products(), f"{tmp_path}/t"
    )
    assert {r.rows for r in made.collect()} == {0}


def test_counts_are_observed_behind_the_last_shuffle(spark):
    """A repeated shuffle stage would count its rows twice."""
    star = Star(spark, SMALL)
    linked = cleaning._linked(star.raw_transactions(), star.customers(signup=False), star.products(), ["ingest_seq"])
    spread = cleaning.derive_partitions(linked).hint("rebalance", F.col("year"), F.col("month"))
    plan = _plan(spread.observe("n", F.count(F.lit(1))).where(cleaning._sold()[2]))
    assert plan.index("CollectMetrics") < plan.index("REBALANCE_PARTITIONS_BY_COL")


# -- access and scope


def test_each_user_sees_the_rows_granted_to_it(spark, tmp_path, txn_of):
    db = f"secured_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, db, str(tmp_path / "db"))
    txn = txn_of(*({"order_date": D(2020, 1, i + 1), "region": r} for i, r in enumerate(("West", "East", "West", "South", None))))
    catalog.materialize(txn, f"{db}.sales", str(tmp_path / "sales"))
    grants = [("ann", "West"), ("ann", "West"), ("bob", "East"), ("bob", "South"), ("bob", None)]
    catalog.materialize(spark.createDataFrame(grants, "user_name string, region string"), f"{db}.grants", str(tmp_path / "grants"))
    view = catalog.create_secured_view(spark, f"{db}.my_sales", f"{db}.sales", f"{db}.grants")
    assert view.columns == txn.columns and view.count() == 0
    current = spark._jvm.org.apache.spark.sql.catalyst.CurrentUserContext.CURRENT_USER()
    try:
        for user, regions in (("ann", ["West", "West"]), ("bob", ["East", "South"]), ("eve", [])):
            current.set(user)
            assert sorted(r.region for r in spark.sql(f"SELECT * FROM {db}.my_sales").collect()) == regions
    finally:
        current.remove()


def test_a_date_range_lists_its_months_only(spark, tmp_path):
    path = str(tmp_path / "sales_transactions")
    writers.write_partitioned(Star(spark, SMALL).transactions().select(*SALES_TRANSACTIONS.fieldNames()), path)
    table = read_parquet_table(spark, str(tmp_path), "sales_transactions")
    scoped = catalog.scoped_filter(table, date_from="1997-11-20", date_to="1998-02-03")
    months = {(r.year, r.month) for r in scoped.select("year", "month").distinct().collect()}
    assert months == {(1997, 11), (1997, 12), (1998, 1), (1998, 2)}
    scan = next(
        p for p in _nodes(scoped._jdf.queryExecution().executedPlan()) if p.getClass().getSimpleName() == "FileSourceScanExec"
    )
    assert scan.selectedPartitions().partitionCount() == 4
    want = table.where("order_date BETWEEN '1997-11-20' AND '1998-02-03'")
    assert scoped.count() == want.count() > 0


def _nodes(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        plan = plan.inputPlan()
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))
