"""Regional summaries, shares, growth, pivots and the drill-down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.measures import by_customer_group, discount_pct, measure, profit_cells, with_products
from tallyroom.functions.money import (
    band,
    cents,
    growth_pct,
    month_label,
    pct_usd,
    per_usd,
    ratio,
    rounded,
    usd,
)
from tallyroom.operators.kpi import cagr, prior_year


def _whole(c: str) -> Column:
    """Total of a column over all rows; only used on one row per region (and month)."""
    return F.sum(c).over(Window.partitionBy())


def regional_summary(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = measure(
        with_products(txn, products),
        ["region"],
        "orders",
        "customers",
        "revenue",
        "profit",
        "disc",
        "disc_n",
    )
    return regional_report(m)


def regional_report(m: DataFrame) -> DataFrame:
    """The report's columns from the measures of each region."""
    return m.select(
        "region",
        F.col("orders").alias("order_count"),
        F.col("customers").alias("unique_customers"),
        usd("revenue").alias("total_revenue"),
        per_usd("revenue", "orders").alias("avg_order_value"),
        per_usd("revenue", "customers").alias("revenue_per_customer"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
        discount_pct().alias("avg_discount_pct"),
        pct_usd("revenue", _whole("revenue")).alias("revenue_share_pct"),
    ).orderBy(F.desc("total_revenue"), "region")


def regional_yoy(txn: DataFrame) -> DataFrame:
    m = prior_year(measure(txn, ["region", "year"], "revenue"), ["region"], "revenue")
    return m.select(
        "region",
        "year",
        usd("revenue").alias("revenue"),
        usd("prior_revenue").alias("prior_year_revenue"),
        growth_pct("revenue", "prior_revenue").alias("yoy_growth_pct"),
    ).orderBy("region", "year")


def region_years(txn: DataFrame) -> DataFrame:
    """Revenue, orders and customers per region and year, with revenue growth over the year before."""
    m = measure(txn, ["region", "year"], "revenue", "orders", "customers")
    return prior_year(m, ["region"], "revenue").select(
        "region",
        "year",
        usd("revenue").alias("revenue"),
        "orders",
        "customers",
        growth_pct("revenue", "prior_revenue").alias("yoy_growth_pct"),
    ).orderBy("region", "year")


def top_cities_by_region(
    txn: DataFrame, customers: DataFrame, top: int = 5, within: Sequence[str] = ()
) -> DataFrame:
    """Best cities of each region, where region and city are the customer's.

    Sales are added up per customer first, so the join is one to one. ``within`` as in ``by_customer_group``.
    """
    m = by_customer_group(txn, customers, "region", "city", within=within)
    best = Window.partitionBy("region").orderBy(F.desc("revenue"), "city")
    return (
        m.withColumn("city_rank", F.row_number().over(best))
        .where(F.col("city_rank") <= top)
        .select("region", F.col("city_rank").cast("bigint").alias("city_rank"), "city", usd("revenue").alias("revenue"), "orders")
        .orderBy("region", "city_rank")
    )


def regional_monthly(txn: DataFrame) -> DataFrame:
    m = measure(txn, ["region", "year", "month"], "revenue", "orders")
    return m.select(
        "region", "year", "month", usd("revenue").alias("monthly_revenue"), "orders"
    ).orderBy("region", "year", "month")


def market_share_by_year(txn: DataFrame) -> DataFrame:
    m = measure(txn, ["region", "year"], "revenue")
    total = F.sum("revenue").over(Window.partitionBy("year"))
    return m.select(
        "region",
        "year",
        usd("revenue").alias("revenue"),
        pct_usd("revenue", total).alias("market_share_pct"),
    ).orderBy("year", F.desc("revenue"), "region")


def market_share_by_month(txn: DataFrame) -> DataFrame:
    m = measure(txn, ["region", "year", "month"], "revenue")
    total = F.sum("revenue").over(Window.partitionBy("year", "month"))
    return m.select(
        month_label().alias("month_label"),
        "region",
        usd("revenue").alias("revenue"),
        pct_usd("revenue", total).alias("market_share_pct"),
    ).orderBy("month_label", F.desc("revenue"), "region")


def regional_monthly_vs_average(txn: DataFrame) -> DataFrame:
    """Monthly revenue per region beside the mean over all regions and months."""
    m = measure(txn, ["region", "year", "month"], "revenue")
    mean = rounded(_whole("revenue").cast("double") / F.lit(100.0) / F.count(F.lit(1)).over(Window.partitionBy()))
    return m.select(
        "region",
        month_label().alias("month_label"),
        usd("revenue").alias("monthly_revenue"),
        mean.alias("overall_monthly_average"),
    ).orderBy("region", "month_label")


def profit_matrix(txn: DataFrame, products: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Gross margin percent, regions by categories.

    Without ``categories`` the columns are those of the product table, found by
    a query of their own.  With them, a category that is not listed is an error,
    never a column that is silently missing.
    """
    if categories is None:
        found = products.select("category").where(F.col("category").isNotNull()).distinct().orderBy("category")
        categories = [r.category for r in found.collect()]
    cells = profit_cells(txn, products, ["region"], ["category"])
    return (
        cells.withColumn("category", _listed("category", categories))
        .withColumn("margin_pct", pct_usd("profit", "revenue"))
        .groupBy("region")
        .pivot("category", list(categories))
        .agg(F.max("margin_pct"))
        .orderBy("region")
    )


def _listed(column: str, values: Sequence) -> Column:
    """The column; a value that is neither NULL nor listed raises an error."""
    c = F.col(column)
    text = F.concat(F.lit(f"{column} not listed: "), c.cast("string"))
    return F.when(c.isNull() | c.isin(*values), c).otherwise(F.raise_error(text).cast("string").cast(_kind(values)))


def _kind(values: Sequence) -> str:
    return "int" if values and isinstance(values[0], int) else "string"


def profit_matrix_bands(txn: DataFrame, products: DataFrame, low: float = 10.0, high: float = 20.0) -> DataFrame:
    """The matrix in long form with its traffic-light bands."""
    cells = profit_cells(txn, products, ["region"], ["category"])
    margin = pct_usd("profit", "revenue")
    return cells.select(
        "region", "category", margin.alias("margin_pct"), band(margin, low, high).alias("margin_band")
    ).orderBy("region", "category")


def region_discount_vs_margin(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Discount, margin and revenue per region with the overall averages as reference lines."""
    m = profit_cells(txn, products, ["region"])
    overall = {c: _whole(c) for c in ("disc", "disc_n", "profit", "revenue")}
    mean_discount = rounded(
        F.try_divide(overall["disc"].cast("double") / F.lit(1_000_000.0), overall["disc_n"].cast("double")) * 100
    )
    return m.select(
        "region",
        discount_pct().alias("avg_discount_pct"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
        usd("revenue").alias("revenue"),
        mean_discount.alias("overall_discount_pct"),
        pct_usd(overall["profit"], overall["revenue"]).alias("overall_margin_pct"),
    ).orderBy("region")


def region_growth_table(txn: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Revenue per year as columns, CAGR, the last year's growth and the yearly series (JSON text).

    Without ``years`` there is a column for every year that occurs, found by a
    query of its own.  With them, a year that is not listed is an error.
    """
    if years is None:
        found = txn.select("year").where(F.col("year").isNotNull()).distinct().orderBy("year")
        years = [r.year for r in found.collect()]  # one row per calendar year
    yearly = measure(txn, ["region", "year"], "revenue").withColumn("year", _listed("year", years))
    by_year = [usd(F.max(F.when(F.col("year") == y, F.col("revenue")))).alias(f"revenue_{y}") for y in years]
    wide = yearly.groupBy("region").agg(
        *by_year,
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.min_by("revenue", "year").alias("first_revenue"),
        F.max_by("revenue", "year").alias("last_revenue"),
        # one element per calendar year
        F.array_sort(F.collect_list(F.struct("year", "revenue"))).alias("series"),
    ).withColumn("n_years", F.col("last_year") - F.col("first_year"))
    before_last = F.filter("series", lambda s: s["year"] == F.col("last_year") - 1)
    wide = wide.withColumn("previous", F.get(before_last, F.lit(0))["revenue"])
    points = F.transform("series", lambda s: F.concat(s["year"].cast("string"), F.lit(":"), s["revenue"].cast("string")))
    return wide.select(
        "region",
        *[f"revenue_{y}" for y in years],
        cagr("first_revenue", "last_revenue", "n_years").alias("cagr_pct"),
        growth_pct("last_revenue", "previous").alias("last_yoy_growth_pct"),
        F.array_join(points, ",").alias("yearly_cents"),
    ).orderBy(F.desc("cagr_pct"), "region")


def region_cards(txn: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """Six cards per region: revenue, orders, revenue per customer, ship days, share and last YoY."""
    days = F.datediff("ship_date", "order_date")
    yearly = txn.groupBy("region", "year").agg(
        F.sum(cents("net_revenue")).alias("revenue"),
        F.sum(days.cast("bigint")).alias("days"),
        F.count(days).alias("days_n"),
    )
    m = (
        prior_year(yearly, ["region"], "revenue")
        .groupBy("region")
        .agg(
            *[F.sum(c).alias(c) for c in ("revenue", "days", "days_n")],
            F.max_by(growth_pct("revenue", "prior_revenue"), "year").alias("yoy_growth_pct"),
        )
        .withColumn("whole", _whole("revenue"))
    )
    counts = measure(txn, ["region"], "orders", "customers")
    out = m.join(counts, "region").select(
        "region",
        usd("revenue").alias("revenue"),
        "orders",
        per_usd("revenue", "customers").alias("revenue_per_customer"),
        rounded(ratio("days", "days_n")).alias("avg_days_to_ship"),
        pct_usd("revenue", "whole").alias("market_share_pct"),
        "yoy_growth_pct",
    )
    if regions is not None:
        out = out.where(F.col("region").isin(*regions))
    return out.orderBy("region")


def drill_region_city_customer(
    txn: DataFrame, customers: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Revenue and lines at every level month > region > city > customer.

    ``level`` is 0 for the customer, then 1 city, 2 region, 3 month.  The fact is
    combined per month and customer first; the roll-up expands those rows only.
    """
    rows = txn
    if year is not None:
        rows = rows.where(F.col("year") == year)
    if month is not None:
        rows = rows.where(F.col("month") == month)
    per_customer = measure(rows, ["year", "month", "customer_id"], "revenue", "lines")
    located = per_customer.join(customers.select("customer_id", "region", "city"), "customer_id").withColumn(
        "month_label", month_label()
    )
    keys = ["month_label", "region", "city", "customer_id"]
    sets = [[F.col(k) for k in keys[:n]] for n in (4, 3, 2, 1)]
    rolled = located.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines"), F.grouping_id().alias("g")
    )
    level = F.when(F.col("g") == 0, 0).when(F.col("g") == 1, 1).when(F.col("g") == 3, 2).otherwise(3)
    return rolled.select(
        level.alias("level"), *keys, usd("revenue").alias("revenue"), F.col("lines").alias("transactions")
    )


def region_overview(txn: DataFrame) -> DataFrame:
    m = measure(txn, ["region"], "revenue", "orders", "customers")
    return m.select(
        "region",
        usd("revenue").alias("revenue"),
        "orders",
        "customers",
        per_usd("revenue", "orders").alias("aov"),
    ).orderBy(F.desc("revenue"), "region")


def yearly_by_region(txn: DataFrame) -> DataFrame:
    m = measure(txn, ["year", "region"], "revenue")
    return m.select("year", "region", usd("revenue").alias("revenue")).orderBy("year", "region")
