"""Product rankings, concentration and velocity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.measures import discount_pct, measure
from tallyroom.functions.money import band, pct_usd, rounded, usd
from tallyroom.functions.ordering import order_globally


def product_sales(txn: DataFrame, products: DataFrame, *dims: str, orders: bool = False) -> DataFrame:
    """Measures (money in cents) of every product sold: aggregated first, then joined one to one."""
    names = ["revenue", "units", "disc", "disc_n"] + (["orders"] if orders else [])
    return (
        measure(txn, ["product_id"], *names)
        .join(products.select("product_id", "unit_cost", *dims), "product_id")
        .withColumn("profit", F.col("revenue") - F.col("unit_cost").cast("decimal(18,6)") * F.col("units") * 100)
    )


def top_products(txn: DataFrame, products: DataFrame, top: int = 20) -> DataFrame:
    """The ``top`` products by revenue.

    Taking the top rows first gives the same ranks as ranking everything: a rank
    depends only on the rows above it.
    """
    dims = ("product_name", "category", "sub_category", "brand")
    best = product_sales(txn, products, *dims, orders=True).orderBy(F.desc("revenue"), "product_id").limit(top)
    return best.select(
        "product_id",
        *dims,
        "orders",
        F.col("units").alias("units_sold"),
        usd("revenue").alias("total_revenue"),
        usd("profit").alias("gross_profit"),
        pct_usd("profit", "revenue").alias("margin_pct"),
        discount_pct().alias("avg_discount_pct"),
        F.rank().over(Window.orderBy(F.desc("revenue"))).cast("bigint").alias("revenue_rank"),
    ).orderBy("revenue_rank", "product_id")


def top_products_by_category(txn: DataFrame, products: DataFrame, top: int = 5) -> DataFrame:
    sold = product_sales(txn, products, "product_name", "category", "brand")
    best = Window.partitionBy("category").orderBy(F.desc("revenue"), "product_id")
    return (
        sold.withColumn("cat_rank", F.row_number().over(best))
        .where(F.col("cat_rank") <= top)
        .select(
            "category",
            F.col("cat_rank").cast("bigint").alias("cat_rank"),
            "product_id",
            "product_name",
            "brand",
            usd("revenue").alias("revenue"),
            usd("profit").alias("gross_profit"),
        )
        .orderBy("category", "cat_rank")
    )


def product_pareto(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Every product with its rank and the share of revenue reached with it."""
    sold = product_sales(txn, products, "product_name", "category").select(
        "product_id", "product_name", "category", "revenue"
    )
    ranked = order_globally(
        sold, "revenue", "product_id", rank="rank", amount="revenue", running="upto", total="whole"
    )
    return ranked.select(
        "rank",
        "product_id",
        "product_name",
        "category",
        usd("revenue").alias("revenue"),
        usd("upto").alias("cumulative_revenue"),
        pct_usd("upto", "whole").alias("cumulative_pct"),
    ).orderBy("rank", "product_id")


def product_velocity(
    txn: DataFrame, products: DataFrame, months: int = 12, exact: bool = False, top: int | None = 30
) -> DataFrame:
    """Units per month over the last ``months`` months.

    Read literally the window starts ``months`` before the latest year's highest
    month number of any year, and includes both ends (13 buckets for 12);
    ``exact`` counts back from the latest month and takes exactly ``months``.
    """
    newest = F.max("year") * 12 + (F.max_by("month", F.col("year") * 12 + F.col("month")) if exact else F.max("month"))
    since = txn.agg((newest - (months - 1 if exact else months)).alias("m")).scalar()
    # month m of year y counts y*12+m, so the year test is implied; it lets the scan prune partitions
    recent = txn.where(F.col("year") >= F.floor((since - 1) / 12)).where(F.col("year") * 12 + F.col("month") >= since)
    monthly = recent.groupBy("product_id", "year", "month").agg(F.sum(F.col("quantity").cast("bigint")).alias("units"))
    totals = monthly.groupBy("product_id").agg(
        F.sum("units").alias("units_last_12_months"),
        rounded(F.avg("units")).alias("avg_monthly_units"),
        F.max("units").alias("peak_monthly_units"),
        F.count(F.lit(1)).alias("months_with_sales"),
    )
    out = totals.join(products.select("product_id", "product_name", "category"), "product_id").select(
        "product_id",
        "product_name",
        "category",
        "units_last_12_months",
        "avg_monthly_units",
        "peak_monthly_units",
        "months_with_sales",
    ).orderBy(F.desc("units_last_12_months"), "product_id")
    return out if top is None else out.limit(top)


def top10_products_table(
    txn: DataFrame, products: DataFrame, top: int = 10, low: float = 15.0, high: float = 25.0
) -> DataFrame:
    return top_products(txn, products, top).select(
        "revenue_rank",
        "product_name",
        "category",
        "total_revenue",
        "gross_profit",
        "margin_pct",
        band("margin_pct", low, high).alias("margin_band"),
        "orders",
    )


def drill_category_product(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, units and margin at every level category > sub-category > product.

    ``level`` is 0 for the product, then 1 sub-category, 2 category.  Sales are
    added up per product first; the roll-up expands those rows only.
    """
    keys = ["category", "sub_category", "product_id"]
    sold = product_sales(txn, products, "category", "sub_category")
    sets = [[F.col(k) for k in keys[:n]] for n in (3, 2, 1)]
    rolled = sold.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        *[F.sum(c).alias(c) for c in ("revenue", "units", "profit")], F.grouping_id().alias("g")
    )
    level = F.when(F.col("g") == 0, 0).when(F.col("g") == 1, 1).otherwise(2)
    return rolled.select(
        level.alias("level"),
        *keys,
        usd("revenue").alias("revenue"),
        "units",
        pct_usd("profit", "revenue").alias("margin_pct"),
    ).orderBy("level", F.desc("revenue"), *keys)
