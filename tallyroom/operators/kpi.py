"""Headline figures: totals, growth, shipping, discounts, alerts and concentration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.measures import discount_pct, key_count, measure, profit_cells, with_products
from tallyroom.functions.money import (
    cents,
    discount_bucket,
    growth_pct,
    micros,
    pct,
    pct_usd,
    per_usd,
    profit_fine,
    profit_sum,
    quarter_of,
    ratio,
    rounded,
    usd,
)
from tallyroom.functions.ordering import order_globally


def prior_year(df: DataFrame, on: list[str], *values: str) -> DataFrame:
    """Add ``prior_<value>``: the value of the year before, NULL when that very year is missing.

    ``df`` is an aggregate with one row per year and ``on``.  A look at the row
    before replaces the self-join on ``year - 1``, which would read the fact twice;
    testing that row's year keeps the join's meaning.  NULL keys never match.
    """
    w = Window.partitionBy(*on).orderBy("year")
    follows = F.lag("year").over(w) == F.col("year") - 1
    for c in on:
        follows = follows & F.col(c).isNotNull()
    return df.withColumns({f"prior_{v}": F.when(follows, F.lag(v).over(w)) for v in values})


def kpi_totals(txn: DataFrame, products: DataFrame) -> DataFrame:
    m = measure(
        with_products(txn, products), [], "revenue", "profit", "orders", "customers", "disc", "disc_n"
    )
    return totals_report(m)


def totals_report(m: DataFrame) -> DataFrame:
    """The report's columns from the measures of all rows."""
    return m.select(
        usd("revenue").alias("total_revenue"),
        usd("profit").alias("total_gross_profit"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
        per_usd("revenue", "orders").alias("avg_order_value"),
        discount_pct().alias("avg_discount_pct"),
    )


def quarterly_revenue(txn: DataFrame) -> DataFrame:
    return quarterly_report(measure(txn, ["year", quarter_of().alias("quarter")], "revenue", "orders", "customers"))


def quarterly_report(m: DataFrame) -> DataFrame:
    """The report's columns from the measures of each quarter."""
    return m.select(
        "year",
        "quarter",
        usd("revenue").alias("quarterly_revenue"),
        F.col("orders").alias("order_count"),
        F.col("customers").alias("unique_customers"),
    ).orderBy("year", "quarter")


def yoy_revenue(txn: DataFrame) -> DataFrame:
    yearly = prior_year(measure(txn, ["year"], "revenue"), [], "revenue")
    return yearly.select(
        "year",
        usd("revenue").alias("revenue"),
        usd("prior_revenue").alias("prev_year_revenue"),
        growth_pct("revenue", "prior_revenue").alias("yoy_growth_pct"),
    ).orderBy("year")


def days_to_ship(txn: DataFrame) -> DataFrame:
    days = F.datediff("ship_date", "order_date")
    return (
        txn.groupBy("region")
        .agg(
            rounded(F.avg(days)).alias("avg_days_to_ship"),
            F.min(days).alias("min_days_to_ship"),
            F.max(days).alias("max_days_to_ship"),
        )
        .orderBy("avg_days_to_ship", "region")
    )


def discount_buckets(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Per discount band; bands come in the order of their smallest discount."""
    m = (
        with_products(txn, products)
        .groupBy(discount_bucket().alias("discount_bucket"))
        .agg(
            F.sum(cents("net_revenue")).alias("revenue"),
            profit_sum().alias("profit"),
            F.count(F.lit(1)).alias("lines"),
            F.count("net_revenue").alias("priced"),
            F.min("discount").alias("from"),
        )
    )
    return m.orderBy("from").select(
        "discount_bucket",
        F.col("lines").alias("order_count"),
        usd("revenue").alias("total_revenue"),
        per_usd("revenue", "priced").alias("avg_order_value"),
        usd("profit").alias("total_gross_profit"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
    )


def kpi_year_cards(txn: DataFrame, products: DataFrame, as_of: str | None = None) -> DataFrame:
    """The six executive cards per calendar year, each beside its prior-year value.

    With ``as_of`` (a day, for an unfinished year) every year counts up to the same
    month and day only, so that like is compared with like.
    """
    if as_of is not None:
        last = F.date_format(F.lit(as_of).cast("date"), "MM-dd")
        txn = txn.where(F.date_format("order_date", "MM-dd") <= last)
    m = measure(with_products(txn, products), ["year"], "revenue", "profit", "orders", "customers")
    both = prior_year(m, [], "revenue", "profit", "orders", "customers")
    return both.select(
        "year",
        usd("revenue").alias("total_revenue"),
        usd("prior_revenue").alias("prior_total_revenue"),
        pct_usd("profit", "revenue").alias("gross_margin_pct"),
        pct_usd("prior_profit", "prior_revenue").alias("prior_gross_margin_pct"),
        F.col("orders").alias("total_orders"),
        F.col("prior_orders").alias("prior_total_orders"),
        per_usd("revenue", "orders").alias("avg_order_value"),
        per_usd("prior_revenue", "prior_orders").alias("prior_avg_order_value"),
        F.col("customers").alias("unique_customers"),
        F.col("prior_customers").alias("prior_unique_customers"),
        growth_pct("revenue", "prior_revenue").alias("yoy_growth_pct"),
    ).orderBy("year")


def kpi_alerts(
    txn: DataFrame,
    products: DataFrame,
    min_margin_pct: float = 10.0,
    max_ship_days: float = 7.0,
    max_discount_pct: float = 20.0,
) -> DataFrame:
    """Threshold flags per region: low margin, slow shipping, heavy discounting.

    One pass over the fact serves all three alerts.
    """
    days = F.datediff("ship_date", "order_date")
    m = with_products(txn, products).groupBy("region").agg(
        F.sum(cents("net_revenue")).alias("revenue"),
        profit_sum().alias("profit"),
        F.sum(micros("discount")).alias("disc"),
        F.count("discount").alias("disc_n"),
        F.sum(days.cast("bigint")).alias("days"),
        F.count(days).alias("days_n"),
    )
    region = m.select(
        "region",
        pct_usd("profit", "revenue").alias("margin"),
        rounded(ratio("days", "days_n")).alias("ship"),
        discount_pct().alias("discount"),
    )

    def alert(metric: str, value: str, limit: float, below: bool) -> Column:
        hit = F.col(value) < limit if below else F.col(value) > limit
        return F.struct(
            F.lit(metric).alias("metric"),
            F.col(value).alias("value"),
            F.lit(float(limit)).alias("threshold"),
            F.coalesce(hit, F.lit(False)).alias("alert"),
        )

    alerts = F.array(
        alert("gross_margin_pct", "margin", min_margin_pct, True),
        alert("avg_days_to_ship", "ship", max_ship_days, False),
        alert("avg_discount_pct", "discount", max_discount_pct, False),
    )
    return region.select("region", F.inline(alerts)).orderBy("metric", "region")


def qoq_revenue(txn: DataFrame) -> DataFrame:
    """Quarter over the previous existing quarter."""
    q = measure(txn, ["year", quarter_of().alias("quarter")], "revenue")
    # one row per calendar quarter: a window without partitions is small
    prev = F.lag("revenue").over(Window.orderBy("year", "quarter"))
    return (
        q.withColumn("prev", prev)
        .select(
            "year",
            "quarter",
            usd("revenue").alias("revenue"),
            usd("prev").alias("prev_quarter_revenue"),
            growth_pct("revenue", "prev").alias("qoq_growth_pct"),
        )
        .orderBy("year", "quarter")
    )


def cagr(first: str, last: str, years: str) -> Column:
    """Compound annual growth in percent between two cent amounts ``years`` apart."""
    growth = F.pow(ratio(usd(last), usd(first)), F.try_divide(F.lit(1.0), F.col(years).cast("double")))
    usable = (F.col(years) > 0) & (F.col(first) > 0) & (F.col(last) >= 0)
    return F.when(usable, rounded((growth - 1) * 100))


def region_year_ends(txn: DataFrame) -> DataFrame:
    """Per region the revenue (cents) of its first and last year."""
    yearly = measure(txn, ["region", "year"], "revenue")
    return yearly.groupBy("region").agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.min_by("revenue", "year").alias("first_revenue"),
        F.max_by("revenue", "year").alias("last_revenue"),
    ).withColumn("n_years", F.col("last_year") - F.col("first_year"))


def cagr_by_region(txn: DataFrame) -> DataFrame:
    return region_year_ends(txn).select(
        "region",
        "first_year",
        "last_year",
        usd("first_revenue").alias("first_revenue"),
        usd("last_revenue").alias("last_revenue"),
        cagr("first_revenue", "last_revenue", "n_years").alias("cagr_pct"),
    ).orderBy(F.desc("cagr_pct"), "region")


def predicted_ltv(txn: DataFrame, lifespan_years: float = 3.0) -> DataFrame:
    """AOV x orders per year x expected lifespan, per customer.

    The observed time counts from first to last order, at least one year.
    """
    c = txn.groupBy("customer_id").agg(
        F.sum(cents("net_revenue")).alias("revenue"),
        key_count(txn).alias("orders"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("span"),
    )
    aov = ratio(usd("revenue"), "orders")
    per_year = F.col("orders").cast("double") / F.greatest(F.col("span") / F.lit(365.25), F.lit(1.0))
    return c.select(
        "customer_id",
        rounded(aov).alias("avg_order_value"),
        rounded(per_year, 4).alias("orders_per_year"),
        rounded(aov * per_year * F.lit(float(lifespan_years))).alias("predicted_ltv"),
    )


def fourth_quarter_share(txn: DataFrame) -> DataFrame:
    m = txn.groupBy("year").agg(
        F.sum(cents("net_revenue")).alias("revenue"),
        F.coalesce(F.sum(F.when(F.col("month") >= 10, cents("net_revenue"))), F.lit(0)).alias("q4"),
    )
    return m.select(
        "year",
        usd("revenue").alias("annual_revenue"),
        usd("q4").alias("q4_revenue"),
        pct_usd("q4", "revenue").alias("q4_share_pct"),
    ).orderBy("year")


def top_customer_share(txn: DataFrame, top_pct: float = 20.0) -> DataFrame:
    """Revenue share of the best ``top_pct`` percent of customers (at least one)."""
    ltv = measure(txn, ["customer_id"], "revenue")
    ranked = order_globally(ltv, "revenue", "customer_id", row_number="rn", n="n")
    top = F.col("rn") <= F.greatest(F.ceil(F.col("n") * F.lit(top_pct / 100.0)), F.lit(1))
    m = ranked.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count(F.when(top, 1)).alias("top_customers"),
        F.sum("revenue").alias("revenue"),
        F.sum(F.when(top, F.col("revenue"))).alias("top_revenue"),
    )
    return m.select(
        "customers",
        "top_customers",
        usd("revenue").alias("total_revenue"),
        usd("top_revenue").alias("top_revenue"),
        pct_usd("top_revenue", "revenue").alias("top_share_pct"),
    )


def negative_margin_share(txn: DataFrame, products: DataFrame, discount_limit: float = 0.20) -> DataFrame:
    """Share of loss-making transactions, above and up to a discount limit."""
    rows = with_products(txn, products)
    m = rows.groupBy(F.coalesce(F.col("discount") > discount_limit, F.lit(False)).alias("high_discount")).agg(
        F.count(F.lit(1)).alias("transactions"), F.count(F.when(profit_fine() < 0, 1)).alias("negative")
    )
    return m.select(
        "high_discount",
        "transactions",
        F.col("negative").alias("negative_margin_transactions"),
        pct("negative", "transactions").alias("negative_margin_pct"),
    ).orderBy("high_discount")


def revenue_overview(txn: DataFrame) -> DataFrame:
    """Revenue, orders, customers, order value and discount without the product join."""
    m = measure(txn, [], "revenue", "orders", "customers", "disc", "disc_n")
    return m.select(
        usd("revenue").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
        per_usd("revenue", "orders").alias("avg_order_value"),
        discount_pct().alias("avg_discount_pct"),
    )
