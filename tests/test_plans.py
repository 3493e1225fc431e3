"""Physical plans: what must not happen on large tables."""

from __future__ import annotations

import re

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tallyroom.plans.registry import QUERIES, build
from tallyroom.sources.star import Star


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    plan = _plan(build("dedupe_by_key", spark, SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name", ["top_products_by_category", "top_cities_by_region"])
def test_top_k_per_group_is_limited_before_the_shuffle(spark, name):
    assert re.search(r"WindowGroupLimit .*Partial", _plan(build(name, spark, SMALL)))


@pytest.mark.parametrize("name", ["risky_transactions", "top_products", "top_customers", "product_velocity"])
def test_top_k_is_no_full_sort(spark, name):
    plan = _plan(build(name, spark, SMALL))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["rfm_scores", "customer_ranking", "product_pareto", "customer_revenue_share"])
def test_rankings_do_not_gather_entities_in_one_task(spark, name):
    """Single-partition exchanges carry ranges (or one-row aggregates), never customer or product rows."""
    lines = _plan(build(name, spark, SMALL)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[i + 1], lines[i + 1]
            assert "customer_id" not in lines[i + 1].split("functions=")[0]


def test_no_cartesian_products_anywhere(spark):
    for name in ("dq_outliers", "regional_monthly_vs_average", "region_discount_vs_margin", "cap_outliers", "ltv_histogram"):
        plan = _plan(build(name, spark, SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_no_python_in_any_plan(spark):
    for name in ("rfm_scores_quantile", "transaction_summary", "cohort_grid", "clean_customers"):
        assert "Python" not in _plan(build(name, spark, SMALL)), name


def test_scans_read_only_needed_columns(spark):
    plan = _plan(build("yoy_revenue", spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    read = {c.split(":")[0] for s in schemas for c in s.split(",")}
    assert read == {"l_orderkey", "l_extendedprice", "l_discount", "o_orderkey", "o_orderdate"}


@pytest.mark.parametrize("name", ["profit_by_subcategory", "discount_buckets", "profit_matrix_bands", "kpi_alerts"])
def test_profit_reports_shuffle_groups_only(spark, name):
    """With a small product table every shuffle carries partial aggregates, no fact rows."""
    lines = _plan(build(name, spark, SMALL)).splitlines()
    shuffles = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert shuffles and all("partial_" in lines[i + 1] for i in shuffles)
    assert not any("product_id" in lines[i] for i in shuffles)


def test_hot_customer_gives_right_results(spark):
    """Two thirds of all transactions belong to one customer; shuffles instead of broadcasts."""
    from tallyroom.operators import customer, windows

    star = Star(spark, SMALL)
    hot = star.transactions(region=False).withColumn(
        "customer_id", F.when(F.length("transaction_id") % 3 > 0, F.lit("7")).otherwise(F.col("customer_id"))
    ).cache()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        gaps = windows.order_gaps(hot)
        customers = hot.select("customer_id").distinct().count()
        assert gaps.count() == hot.count() - customers
        from pyspark.sql import Window

        w = Window.partitionBy("customer_id").orderBy("order_date", "transaction_id")
        plain = hot.withColumn("d", F.datediff("order_date", F.lag("order_date").over(w)))
        assert gaps.agg(F.sum("days_since_last_order")).first()[0] == plain.agg(F.sum("d")).first()[0]
        ltv = customer.customer_features(hot)
        assert ltv.agg(F.sum("total_orders")).first()[0] == hot.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        hot.unpersist()


@pytest.mark.parametrize("name", ["kpi_totals", "clean_customers", "clean_transactions", "dq_scorecard", "order_gaps"])
def test_building_a_query_runs_no_job(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", name)
    build(name, spark, SMALL)
    jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
    sc.setJobGroup("", "")
    assert not jobs


def test_segment_and_city_reports_join_customers_one_to_one(spark):
    """Grouping per customer comes before the join, so no fact row is shuffled for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("segment_overview", "top_cities_by_region"):
            lines = _plan(build(name, spark, SMALL)).splitlines()
            joined = next(i for i, line in enumerate(lines) if "Join" in line and "customer_id" in line)
            assert any("Aggregate" in line and "customer_id" in line for line in lines[joined:])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "name", ["yoy_revenue", "kpi_year_cards", "yoy_same_month", "regional_yoy", "quarter_by_year", "region_growth_table"]
)
def test_year_over_year_reads_the_fact_once(spark, name):
    assert _plan(build(name, spark, SMALL)).count("lineitem.parquet") == 1
