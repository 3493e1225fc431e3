"""The summary report: long-form tables per subject and one nested document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions.measures import measure
from tallyroom.functions.money import cents, micros, pct_usd, per_usd, profit_cents, profit_sum, ratio, rounded, usd
from tallyroom.functions.ordering import exact_quantiles


def _row(metric: str, value: Column, key: Column | str = "", text: Column | None = None) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        (F.lit(key) if isinstance(key, str) else key).alias("key"),
        value.cast("double").alias("value"),
        (text if text is not None else F.lit(None)).cast("string").alias("text"),
    )


def customer_summary(customers: DataFrame) -> DataFrame:
    """Count, segment and region distribution, signup range: ``(metric, key, value, text)``."""
    sets = [[], [F.col("segment")], [F.col("region")]]
    m = customers.groupingSets(sets, F.col("segment"), F.col("region")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("signup_date").alias("lo"),
        F.max("signup_date").alias("hi"),
        F.grouping_id().alias("g"),
    )
    day = F.lit(None).cast("double")
    rows = (
        F.when(
            F.col("g") == 3,
            F.array(
                _row("total_customers", F.col("n")),
                _row("signup_date_min", day, text=F.col("lo")),
                _row("signup_date_max", day, text=F.col("hi")),
            ),
        )
        .when(F.col("g") == 1, F.array(_row("segment_distribution", F.col("n"), F.col("segment"))))
        .otherwise(F.array(_row("region_distribution", F.col("n"), F.col("region"))))
    )
    # a NULL segment or region is not a value of the distribution
    return m.select(F.inline(rows)).where(F.col("key").isNotNull())


def product_summary(products: DataFrame) -> DataFrame:
    """Counts, mean margin per category and price statistics: ``(metric, key, value, text)``."""
    cells = products.groupingSets([[], [F.col("category")]], F.col("category")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(micros("margin_pct")).alias("margin"),
        F.count("margin_pct").alias("margin_n"),
        F.min("unit_price").alias("lo"),
        F.max("unit_price").alias("hi"),
        F.sum(cents("unit_price")).alias("price"),
        F.count("unit_price").alias("price_n"),
        F.grouping_id().alias("g"),
    )
    median = exact_quantiles(products, "unit_price", [0.5]).scalar()
    whole = F.array(
        _row("total_products", F.col("n")),
        _row("price_min", F.col("lo")),
        _row("price_max", F.col("hi")),
        _row("price_mean", per_usd("price", "price_n")),
        _row("price_median", rounded(F.col("median"))),
    )
    mean_margin = rounded(ratio(F.col("margin").cast("double") / F.lit(1_000_000.0), "margin_n"))
    per_category = F.array(
        _row("category_counts", F.col("n"), F.col("category")),
        _row("avg_margin_pct_by_category", mean_margin, F.col("category")),
    )
    return (
        cells.withColumn("median", median)
        .select(F.inline(F.when(F.col("g") == 1, whole).otherwise(per_category)))
        .where(F.col("key").isNotNull())
    )


def enrich_transactions(txn: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Every transaction with product and customer attributes, profit and month key."""
    joined = txn.join(
        products.select("product_id", "category", "sub_category", "unit_cost", "brand"), "product_id", "left"
    ).join(customers.select("customer_id", "segment", "city"), "customer_id", "left")
    profit = profit_cents()
    return joined.withColumns(
        {"gross_profit": usd(profit), "order_ym": F.date_format("order_date", "yyyy-MM")}
    )


_SUMS = ("n", "revenue", "priced", "profit", "disc", "disc_n")


def _totals() -> list[Column]:
    return [*[F.sum(c).alias(c) for c in _SUMS], F.min("lo").alias("lo"), F.max("hi").alias("hi")]


def _cells(txn: DataFrame, products: DataFrame) -> DataFrame:
    """Additive totals per year, region and category."""
    joined = txn.join(products.select("product_id", "category", "unit_cost"), "product_id", "left")
    return joined.groupBy("year", "region", "category").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(cents("net_revenue")).alias("revenue"),
        F.count("net_revenue").alias("priced"),
        profit_sum().alias("profit"),
        F.sum(micros("discount")).alias("disc"),
        F.count("discount").alias("disc_n"),
        F.min("order_date").alias("lo"),
        F.max("order_date").alias("hi"),
    )


_BREAKDOWNS = {
    "revenue_by_year": "year",
    "revenue_by_region": "region",
    "revenue_by_category": "category",
}


def transaction_summary(
    txn: DataFrame, customers: DataFrame, products: DataFrame, top: int = 5
) -> DataFrame:
    """Totals, breakdowns and best products: ``(metric, key, value, text)``.

    Three passes over a few columns of the fact each: the cells all totals are
    added up from, revenue per product, and revenue per customer.
    """
    dims = list(_BREAKDOWNS.values())
    small = _cells(txn, products)
    sets = [[], *[[F.col(d)] for d in dims]]
    m = small.groupingSets(sets, *[F.col(d) for d in dims]).agg(*_totals(), F.grouping_id().alias("g"))
    nothing = F.lit(None).cast("double")
    rows = F.array(
        _row("total_transactions", F.col("n")),
        _row("order_date_min", nothing, text=F.col("lo")),
        _row("order_date_max", nothing, text=F.col("hi")),
        _row("total_revenue", usd("revenue")),
        _row("total_gross_profit", usd("profit")),
        _row("gross_margin_pct", F.coalesce(pct_usd("profit", "revenue"), F.lit(0.0))),
        _row("avg_line_revenue", per_usd("revenue", "priced")),
        _row("avg_discount_rate", rounded(ratio(F.col("disc").cast("double") / F.lit(1_000_000.0), "disc_n"), 4)),
    )
    whole = (1 << len(dims)) - 1
    picked = F.when(F.col("g") == whole, rows)
    for i, (metric, dim) in enumerate(_BREAKDOWNS.items()):
        only = whole ^ (1 << (len(dims) - 1 - i))
        picked = picked.when(
            F.col("g") == only, F.array(_row(metric, usd("revenue"), F.col(dim).cast("string")))
        )
    best = (
        measure(txn, ["product_id"], "revenue")
        .where(F.col("product_id").isNotNull())
        .orderBy(F.desc("revenue"), "product_id")
        .limit(top)
    )
    top_rows = best.select(F.inline(F.array(_row(f"top_{top}_products_by_revenue", usd("revenue"), F.col("product_id")))))
    by_segment = (
        measure(txn, ["customer_id"], "revenue")
        .join(customers.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(F.sum("revenue").alias("revenue"))
        .select(F.inline(F.array(_row("revenue_by_segment", usd("revenue"), F.col("segment")))))
    )
    # a missing region, category or segment is not a value of its breakdown
    return (
        m.select(F.inline(picked)).unionByName(by_segment).where(F.col("key").isNotNull()).unionByName(top_rows)
    )


def _nest(long: DataFrame, name: str) -> Column:
    """A long-form table as one map ``metric -> {key -> value or text}``; a few dozen rows."""
    value = F.coalesce(F.col("text"), F.col("value").cast("string"))
    inner = long.groupBy("metric").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", value.alias("value"))))).alias("entries")
    )
    return inner.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", F.map_entries("entries").alias("e"))))).alias("m")
    ).select(F.transform_values("m", lambda _, e: F.map_from_entries(e)).alias(name)).scalar()


def summary_report(
    txn: DataFrame, customers: DataFrame, products: DataFrame, rfm: DataFrame | None = None, as_of: str | None = None
) -> DataFrame:
    """The whole report as one row of nested maps, ready for ``write_summary_json``.

    Only finished metric rows are gathered: distributions over categories, regions,
    segments, years and the top products.
    """
    made = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    cols = {
        "customers": _nest(customer_summary(customers), "customers"),
        "products": _nest(product_summary(products), "products"),
        "transactions": _nest(transaction_summary(txn, customers, products), "transactions"),
    }
    if rfm is not None:
        counts = rfm.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("c"))
        cols["rfm_segments"] = counts.agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("rfm_segment", "c"))))
        ).scalar()
    return txn.sparkSession.range(1).select(
        made.cast("string").alias("generated_at"), *[c.alias(n) for n, c in cols.items()]
    )


REPORT = (
    "generated_at string, customers map<string,map<string,string>>, products map<string,map<string,string>>, "
    "transactions map<string,map<string,string>>, rfm_segments map<string,bigint>"
)


def report_rows(report: DataFrame) -> DataFrame:
    """A report, made or read back, as ``(section, metric, key, value, text)``: numbers as value, the rest as text."""
    parts = [report.select(F.lit("generated_at").alias("section"), F.lit("").alias("metric"), F.lit("").alias("key"), F.col("generated_at").alias("v"))]
    for name in ("customers", "products", "transactions"):
        outer = report.select(F.explode(name).alias("metric", "entries"))
        parts.append(outer.select(F.lit(name).alias("section"), "metric", F.explode("entries").alias("key", "v")))
    if "rfm_segments" in report.columns:
        counts = report.select(F.explode("rfm_segments").alias("key", "c"))
        parts.append(counts.select(F.lit("rfm_segments").alias("section"), F.lit("").alias("metric"), "key", F.col("c").cast("string").alias("v")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    number = F.col("v").try_cast("double")
    return rows.select("section", "metric", "key", number.alias("value"), F.when(number.isNull(), F.col("v")).alias("text"))
