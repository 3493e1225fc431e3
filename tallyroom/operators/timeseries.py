"""Monthly and quarterly series.  Windows here run over one row per month or quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tallyroom.functions.measures import discount_pct, join_dimension, key_count, measure
from tallyroom.functions.money import (
    cents,
    fine_sum,
    from_fine,
    growth_pct,
    month_label,
    pct_usd,
    per_usd,
    quarter_of,
    ratio,
    rounded,
    usd,
)
from tallyroom.operators.kpi import prior_year


def _months() -> WindowSpec:
    """Calendar order; only used on one row per month."""
    return Window.orderBy("year", "month")


def monthly_sales(txn: DataFrame) -> DataFrame:
    m = txn.groupBy("year", "month").agg(
        F.sum(cents("net_revenue")).alias("revenue"),
        key_count(txn).alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.count("quantity").alias("units_n"),
        F.sum(F.rint(F.col("discount") * 1_000_000).cast("bigint")).alias("disc"),
        F.count("discount").alias("disc_n"),
    )
    return monthly_report(m)


def monthly_report(m: DataFrame) -> DataFrame:
    """The report's columns from the measures of each month."""
    return m.select(
        "year",
        "month",
        month_label().alias("month_label"),
        usd("revenue").alias("monthly_revenue"),
        F.col("orders").alias("order_count"),
        F.col("customers").alias("unique_customers"),
        per_usd("revenue", "orders").alias("avg_order_value"),
        rounded(ratio("units", "units_n")).alias("avg_units_per_order"),
        discount_pct().alias("avg_discount_pct"),
    ).orderBy("year", "month")


def mom_growth(txn: DataFrame) -> DataFrame:
    """Month over the previous existing month."""
    m = measure(txn, ["year", "month"], "revenue").withColumn("prev", F.lag("revenue").over(_months()))
    return m.select(
        "year",
        "month",
        usd("revenue").alias("revenue"),
        usd("prev").alias("prev_month_revenue"),
        growth_pct("revenue", "prev").alias("mom_growth_pct"),
    ).orderBy("year", "month")


def yoy_same_month(txn: DataFrame) -> DataFrame:
    m = prior_year(measure(txn, ["year", "month"], "revenue"), ["month"], "revenue")
    return m.select(
        "year",
        "month",
        usd("revenue").alias("current_revenue"),
        usd("prior_revenue").alias("prior_year_revenue"),
        growth_pct("revenue", "prior_revenue").alias("yoy_same_month_growth_pct"),
    ).orderBy("year", "month")


def quarterly_ytd(txn: DataFrame) -> DataFrame:
    q = measure(txn, ["year", quarter_of().alias("quarter")], "revenue")
    ytd = Window.partitionBy("year").orderBy("quarter").rowsBetween(Window.unboundedPreceding, 0)
    return q.select(
        "year",
        "quarter",
        usd("revenue").alias("quarterly_revenue"),
        usd(F.sum("revenue").over(ytd)).alias("ytd_revenue"),
    ).orderBy("year", "quarter")


def monthly_revenue_simple(txn: DataFrame) -> DataFrame:
    """Revenue recomputed from price, quantity and discount, not rounded per row."""
    net = F.col("quantity") * F.col("unit_price") * (1 - F.col("discount"))
    return (
        txn.groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
        .agg(
            from_fine(fine_sum(net)).alias("net_revenue"),
            key_count(txn).alias("order_count"),
        )
        .orderBy("month")
    )


def monthly_profit_trend(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, profit, orders and margin per month; rows of unknown products add no profit."""
    joined = join_dimension(txn, products.select("product_id", "unit_cost"), "product_id", "left")
    m = measure(joined, ["year", "month"], "revenue", "profit", "orders")
    return m.select(
        month_label().alias("order_ym"),
        usd("revenue").alias("revenue"),
        usd("profit").alias("gross_profit"),
        "orders",
        pct_usd("profit", "revenue").alias("margin_pct"),
    ).orderBy("order_ym")


def quarter_by_year(txn: DataFrame) -> DataFrame:
    q = measure(txn, ["year", quarter_of().alias("quarter")], "revenue")
    return (
        prior_year(q, ["quarter"], "revenue")
        .select(
            "year",
            "quarter",
            usd("revenue").alias("revenue"),
            usd("prior_revenue").alias("prior_year_revenue"),
            growth_pct("revenue", "prior_revenue").alias("yoy_growth_pct"),
        )
        .orderBy("year", "quarter")
    )
