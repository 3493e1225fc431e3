"""Profit and margin by category, sub-category, month and discount."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.measures import discount_pct, measure, profit_cells, with_products
from tallyroom.functions.money import band, discount_bucket, pct_usd, per_usd, profit_cents, rounded, usd


def profit_by_category(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = measure(
        with_products(txn, products, "category"),
        ["category"],
        "orders",
        "revenue",
        "profit",
        "priced",
        "disc",
        "disc_n",
    )
    return m.select(
        "category",
        F.col("orders").alias("order_count"),
        usd("revenue").alias("total_revenue"),
        usd("profit").alias("gross_profit"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
        discount_pct().alias("avg_discount_pct"),
        per_usd("revenue", "priced").alias("avg_order_value"),
    ).orderBy(F.desc("gross_margin_pct"), "category")


def profit_by_subcategory(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = profit_cells(txn, products, dims=["category", "sub_category"])
    # one row per sub-category: a window without partitions is small
    return m.select(
        "category",
        "sub_category",
        usd("revenue").alias("revenue"),
        usd("profit").alias("gross_profit"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
        F.rank().over(Window.orderBy(F.desc("revenue"))).cast("bigint").alias("revenue_rank"),
    ).orderBy("revenue_rank", "category", "sub_category")


def monthly_margin_by_category(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = profit_cells(txn, products, ["year", "month"], ["category"])
    return m.select(
        "year",
        "month",
        "category",
        usd("revenue").alias("revenue"),
        usd("profit").alias("gross_profit"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
    ).orderBy("year", "month", "category")


def risky_transactions(
    txn: DataFrame, products: DataFrame, min_discount: float = 0.20, worst: int | None = 100
) -> DataFrame:
    """Heavily discounted transactions sold at a loss, the ``worst`` first (all with None)."""
    rows = with_products(txn.where(F.col("discount") >= min_discount), products, "product_name", "category")
    losing = rows.withColumn("profit", profit_cents()).where("profit < 0")
    ordered = losing.orderBy("profit", "transaction_id")
    if worst is not None:
        ordered = ordered.limit(worst)
    return ordered.select(
        "transaction_id",
        "order_date",
        "product_name",
        "category",
        "quantity",
        rounded(F.col("unit_price")).alias("unit_price"),
        rounded(F.col("discount") * 100, 1).alias("discount_pct"),
        rounded(F.col("net_revenue")).alias("net_revenue"),
        usd("profit").alias("gross_profit"),
        pct_usd("profit", rounded(F.col("net_revenue")) * 100).alias("margin_pct"),
    )


def margin_bands(txn: DataFrame, products: DataFrame, low: float = 15.0, high: float = 25.0) -> DataFrame:
    """Category margins with their traffic-light band."""
    m = profit_cells(txn, products, dims=["category"])
    return m.select(
        "category",
        usd("revenue").alias("revenue"),
        pct_usd("profit", "revenue").alias("margin_pct"),
        band(pct_usd("profit", "revenue"), low, high).alias("margin_band"),
    ).orderBy(F.desc("margin_pct"), "category")


def discount_margin_by_category(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = profit_cells(txn.withColumn("discount_bucket", discount_bucket()), products, ["discount_bucket"], ["category"])
    return m.select(
        "discount_bucket",
        "category",
        discount_pct().alias("avg_discount_pct"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
        F.col("lines").alias("order_count"),
    ).orderBy("category", "avg_discount_pct")


def category_share(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = profit_cells(txn, products, dims=["category"])
    whole = F.sum("revenue").over(Window.partitionBy())
    return m.select(
        "category",
        usd("revenue").alias("revenue"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
        pct_usd("revenue", whole).alias("revenue_share_pct"),
    ).orderBy(F.desc("revenue"), "category")


def category_margin(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = profit_cells(txn, products, dims=["category"])
    return m.select(
        "category",
        usd("revenue").alias("revenue"),
        usd("profit").alias("gross_profit"),
        pct_usd("profit", "revenue").alias("margin_pct"),
    ).orderBy(F.desc("margin_pct"), "category")


def discount_distribution(txn: DataFrame) -> DataFrame:
    """Share of transactions per discount value."""
    m = txn.groupBy("discount").agg(F.count(F.lit(1)).alias("transactions"))
    # one row per discount value: a window without partitions is small
    whole = F.sum("transactions").over(Window.partitionBy())
    return (
        m.withColumn("whole", whole)
        .where(F.col("discount").isNotNull())
        .select(
            "discount",
            "transactions",
            rounded(F.try_divide(F.col("transactions") * F.lit(100.0), F.col("whole").cast("double"))).alias("pct_of_transactions"),
        )
        .orderBy("discount")
    )


def discount_margin(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = profit_cells(txn, products, ["discount"], how="left").where(F.col("discount").isNotNull())
    return m.select(
        "discount", pct_usd("profit", "revenue").alias("margin_pct")
    ).orderBy("discount")
