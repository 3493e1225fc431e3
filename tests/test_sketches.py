"""Sketches kept per load, exact quantiles by bracketing, and tables bucketed by customer."""

from __future__ import annotations

import random
import re
import uuid

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyroom.functions import sketches
from tallyroom.operators import checks, cleaning, customer
from tallyroom.schemas import CUSTOMERS, PRODUCTS, SALES_TRANSACTIONS
from tallyroom.sources import catalog
from tallyroom.sources.star import Star


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(4)


@pytest.mark.parametrize("prob", [0.0, 0.001, 0.5, 0.95, 0.999, 1.0])
def test_quantiles_are_exact(spark, prob):
    rng = random.Random(7)
    values = [rng.lognormvariate(0, 2) for _ in range(20_000)] + [5.0] * 7_000
    df = numbers(spark, [*values, None, float("nan")])
    assert sketches.exact_quantile(df, "x", prob) == pytest.approx(np.quantile(values, prob), rel=1e-12)


def test_small_and_empty_columns(spark):
    assert sketches.exact_quantile(numbers(spark, [None, float("nan")]), "x", 0.5) is None
    assert sketches.exact_quantile(numbers(spark, [3.0]), "x", 0.999) == 3.0
    assert sketches.exact_quantile(numbers(spark, [1.0, 2.0]), "x", 0.75) == 1.75
    assert sketches.exact_quantile(numbers(spark, [4.0] * 100), "x", 0.3) == 4.0


def test_a_sketch_that_misses_costs_time_and_not_the_result(spark):
    df = numbers(spark, [float(i) for i in range(5000)])
    wrong = sketches.sketch_of(numbers(spark, [float(-i) for i in range(5000)]), "x")
    assert sketches.exact_quantile(df, "x", 0.9, wrong) == pytest.approx(np.quantile(range(5000), 0.9))
    nothing = sketches.sketch_of(numbers(spark, [None]), "x")
    assert sketches.exact_quantile(df, "x", 0.9, nothing) == pytest.approx(np.quantile(range(5000), 0.9))


def test_only_values_in_the_bracket_are_put_in_order(spark, monkeypatch):
    seen = []
    real = sketches.order_globally
    monkeypatch.setattr(sketches, "order_globally", lambda df, *a, **k: (seen.append(df.count()), real(df, *a, **k))[1])
    df = spark.range(200_000).select(F.rand(3).alias("x"))
    sketches.exact_quantile(df, "x", 0.999)
    assert seen[0] < 200_000 * 2.5 * sketches.RANK_ERROR


def test_capping_by_merged_sketches_equals_capping(spark, tmp_path):
    df = spark.range(30_000).select("id", (F.rand(1) * F.rand(2) * 100).alias("unit_cost"), F.exp(F.randn(3)).alias("unit_price")).cache()
    kept = sketches.LoadSketches(spark, str(tmp_path / "s"))
    for i in range(3):
        kept.add(df.where(F.col("id") % 3 == i).drop("id"), f"day{i}")
    want = {r.id: (r.unit_cost, r.unit_price) for r in cleaning.cap_outliers(df).collect()}
    for made in (sketches.cap_outliers(df), sketches.cap_outliers(df, sketches=kept)):
        for r in made.collect():
            assert (r.unit_cost, r.unit_price) == pytest.approx(want[r.id], rel=1e-12)


def test_profiles_merge_and_loads_replace_themselves(spark, tmp_path):
    df = spark.range(50_000).select(
        (F.col("id") % 20_011).cast("string").alias("k"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("few"),
        F.to_date(F.lit("2020-01-01")).alias("day"),
        F.lit(None).cast("double").alias("none"),
    )
    kept = sketches.LoadSketches(spark, str(tmp_path / "s"))
    for i in (0, 1, 2, 1):  # a load that is added again counts once
        kept.add(df.where(F.pmod(F.hash("k"), F.lit(3)) == i), f"day{i}")
    exact = {r.column: r for r in checks.column_profile(df).collect()}
    made = kept.profile().collect()
    assert [r.column for r in made] == ["k", "few", "day", "none"]
    for r in made:
        e = exact[r.column]
        assert (r.dtype, r.null_count, r.null_pct) == (e.dtype, e.null_count, e.null_pct)
        assert abs(r.unique - e.unique) <= 0.05 * e.unique
    # the profile reads sketches: days that are gone do not matter
    assert "Range" not in _plan(kept.profile())


# -- bucketed tables


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    star = Star(spark, SMALL)
    path = tmp_path_factory.mktemp("bucketed")
    db = f"bucketed_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, db, str(path / "db"))
    txn = star.transactions().select(*SALES_TRANSACTIONS.fieldNames()).where("year < 1994")
    catalog.create_bucketed_tables(
        spark, db, str(path), star.customers().select(*CUSTOMERS.fieldNames()), star.products().select(*PRODUCTS.fieldNames()), txn, 3
    )
    return db, star, txn


@pytest.mark.parametrize("name", ["customer_ltv", "cohort_retention", "customer_totals"])
def test_nothing_by_customer_shuffles_the_transactions(spark, bucketed, name):
    db, star, txn = bucketed
    stored, customers = spark.table(f"{db}.sales_transactions"), spark.table(f"{db}.customers")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        run = getattr(customer, name)
        made = run(stored) if name == "customer_totals" else run(stored, customers)
        plan = _plan(made)
        assert not re.search(r"Exchange hashpartitioning\((customer_id|transaction_id)", plan)
        assert "Bucketed: true" in plan
        want = run(txn) if name == "customer_totals" else run(txn, star.customers())
        key = lambda r: tuple(map(str, r))
        assert sorted(map(key, made.collect())) == sorted(map(key, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_columns_have_statistics_and_months_are_folders(spark, bucketed):
    db, _, txn = bucketed
    described = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {db}.customers customer_id").collect()}
    assert int(described["distinct_count"]) > 0 and described["num_nulls"] == "0"
    one = spark.table(f"{db}.sales_transactions").where("year = 1993 AND month = 2")
    assert one.count() == txn.where("year = 1993 AND month = 2").count()
    assert "PartitionFilters: [isnotnull(year" in _plan(one)


def test_a_hot_customer_is_refused(spark, tmp_path):
    star = Star(spark, SMALL)
    txn = star.transactions().select(*SALES_TRANSACTIONS.fieldNames())
    hot = txn.withColumn("customer_id", F.when(F.col("quantity") % 3 == 0, F.lit("7")).otherwise(F.col("customer_id")))
    assert catalog.bucket_skew(txn, "customer_id", 16) < 4 < catalog.bucket_skew(hot, "customer_id", 16)
    with pytest.raises(ValueError, match="uneven"):
        catalog.create_bucketed_tables(spark, "none", str(tmp_path), star.customers(), star.products(), hot, 16)
