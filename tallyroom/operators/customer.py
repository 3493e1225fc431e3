"""Customer lifetime value, RFM segments, cohorts and the customer dashboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.durable import durable
from tallyroom.functions.measures import by_customer_group, key_count, measure
from tallyroom.functions.money import (
    cents,
    fine_sum,
    from_fine,
    month_index,
    month_label,
    pct,
    pct_usd,
    per_usd,
    ratio,
    rounded,
    usd,
)
from tallyroom.functions.ordering import exact_quantiles, ntile, order_globally
from tallyroom.schemas import RFM_ACTIONS


def customer_totals(txn: DataFrame) -> DataFrame:
    """One row per buying customer: revenue in cents, lines, orders, first and last order."""
    return txn.groupBy("customer_id").agg(
        F.sum(cents("net_revenue")).alias("revenue"),
        F.count("net_revenue").alias("priced"),
        key_count(txn).alias("orders"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
    )


def _lifespan() -> Column:
    return F.datediff("last_order", "first_order")


def customer_ltv(txn: DataFrame, customers: DataFrame) -> DataFrame:
    """Lifetime value with customer attributes; the fact is combined before the join."""
    joined = customer_totals(txn).join(customers, "customer_id")
    return joined.select(
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "segment",
        "region",
        "city",
        "signup_date",
        F.col("orders").alias("total_orders"),
        usd("revenue").alias("lifetime_value"),
        per_usd("revenue", "priced").alias("avg_order_value"),
        F.col("first_order").alias("first_order_date"),
        F.col("last_order").alias("last_order_date"),
        _lifespan().alias("customer_lifespan_days"),
    ).orderBy(F.desc("lifetime_value"), "customer_id")


def ltv_by_segment(txn: DataFrame, customers: DataFrame, with_orders: bool = False) -> DataFrame:
    """Revenue and value per customer of each segment.

    ``with_orders`` adds ``avg_orders``: unless the transaction id is declared unique it shuffles every id.
    """
    counted = ("orders",) if with_orders else ()
    per_customer = measure(txn, ["customer_id"], "revenue", "priced", *counted)
    m = (
        per_customer.join(customers.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            *[F.sum(c).alias(c) for c in ("revenue", "priced", *counted)],
        )
    )
    # one row per segment: a window without partitions is small
    whole = F.sum("revenue").over(Window.partitionBy())
    return m.select(
        "segment",
        "customers",
        usd("revenue").alias("segment_revenue"),
        per_usd("revenue", "priced").alias("avg_order_value"),
        per_usd("revenue", "customers").alias("avg_ltv"),
        *([rounded(ratio("orders", "customers")).alias("avg_orders")] if with_orders else []),
        pct_usd("revenue", whole).alias("revenue_share_pct"),
    ).orderBy(F.desc("segment_revenue"), "segment")


def rfm_label() -> Column:
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal Customers")
        .when((r >= 4) & (f <= 2), "Recent Customers")
        .when((r <= 2) & (f >= 4) & (m >= 4), "At Risk")
        .when((r <= 2) & (f <= 2), "Lost")
        .otherwise("Potential Loyalists")
    )


def rfm_base(txn: DataFrame) -> DataFrame:
    """Stored per-customer recency, frequency and monetary values (and the order span).

    Recency counts from the newest order of the whole table.
    """
    totals = durable(customer_totals(txn))
    newest = totals.agg(F.max("last_order")).scalar()
    return totals.select(
        "customer_id",
        F.datediff(newest, "last_order").alias("recency_days"),
        F.col("orders").alias("frequency"),
        F.col("revenue").alias("monetary"),
        _lifespan().alias("lifespan_days"),
        "first_order",
        "last_order",
    )


def _positions(base: DataFrame, best_last: bool, ranges: int | None) -> DataFrame:
    """Row numbers ``rn_r``, ``rn_f``, ``rn_m`` and the count ``n``; ties go by customer_id.

    ``best_last`` numbers the worst customer 1, so that high tiles are good.
    """
    out = base
    for value, name, descending in (
        ("recency_days", "rn_r", best_last),
        ("frequency", "rn_f", not best_last),
        ("monetary", "rn_m", not best_last),
    ):
        out = order_globally(
            out,
            value,
            "customer_id",
            descending=descending,
            row_number=name,
            n="n" if value == "recency_days" else None,
            ranges=ranges,
        )
    return out


def _scored(scored: DataFrame, customers: DataFrame | None) -> DataFrame:
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    out = scored.withColumns({"rfm_total": total, "rfm_segment": rfm_label()})
    dims: list[str] = []
    if customers is not None:
        out = out.join(customers.select("customer_id", "segment", "region"), "customer_id")
        dims = ["segment", "region"]
    return out.select(
        "customer_id",
        *dims,
        "recency_days",
        "frequency",
        usd("monetary").alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        "rfm_total",
        "rfm_segment",
    )


def _tiles(placed: DataFrame) -> DataFrame:
    return placed.withColumns({f"{x}_score": ntile(5, f"rn_{x}", "n") for x in ("r", "f", "m")})


def rfm_scores(txn: DataFrame, customers: DataFrame, ranges: int | None = None) -> DataFrame:
    """RFM quintiles as the KPI definitions have them: 5 is the best score."""
    placed = _positions(rfm_base(txn), best_last=True, ranges=ranges)
    return _scored(_tiles(placed), customers)


def rfm_scores_sql(txn: DataFrame, customers: DataFrame, ranges: int | None = None) -> DataFrame:
    """RFM quintiles with the query's literal direction: tile 1 is the best, labels unchanged."""
    placed = _positions(rfm_base(txn), best_last=False, ranges=ranges)
    return _scored(_tiles(placed), customers)


def rfm_scores_quantile(txn: DataFrame, ranges: int | None = None) -> DataFrame:
    """RFM by interpolated quantile edges, right-closed; 5 is the best.

    Recency keeps equal values together.  Frequency and monetary cut the row
    numbers 1..n, whose quantile edges are known: ``1 + p * (n - 1)``.
    """
    base = rfm_base(txn)
    fifths = [0.2, 0.4, 0.6, 0.8]
    # recency is a day count, so the exact percentile keeps at most one counter per calendar day
    edges = base.agg(F.percentile("recency_days", F.array(*[F.lit(p) for p in fifths])).alias("e"))
    placed = order_globally(base, "frequency", "customer_id", descending=False, row_number="rn_f", n="n", ranges=ranges)
    placed = order_globally(
        placed, "monetary", "customer_id", descending=False, row_number="rn_m", ranges=ranges
    )
    placed = placed.withColumn("edges", edges.scalar())

    def above(x: Column, cuts: Sequence[Column]) -> Column:
        passed = F.lit(0)
        for c in cuts:
            passed = passed + (x > c).cast("int")
        return passed

    days = above(F.col("recency_days"), [F.get("edges", F.lit(i)) for i in range(4)])
    cuts = [F.lit(1) + F.lit(p) * (F.col("n") - 1) for p in fifths]
    return _scored(
        placed.withColumns(
            {
                "r_score": (F.lit(5) - days).cast("bigint"),
                "f_score": (above(F.col("rn_f"), cuts) + 1).cast("bigint"),
                "m_score": (above(F.col("rn_m"), cuts) + 1).cast("bigint"),
            }
        ),
        None,
    )


def _active_months(txn: DataFrame) -> DataFrame:
    return txn.select("customer_id", "year", "month").distinct()


def cohort_retention(txn: DataFrame, customers: DataFrame) -> DataFrame:
    """Share of each signup month's customers who bought in each month."""
    cohorts = customers.select("customer_id", F.date_format("signup_date", "yyyy-MM").alias("cohort_month"))
    sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    active = (
        _active_months(txn)
        .join(cohorts, "customer_id")
        .groupBy("cohort_month", "year", "month")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    return (
        active.join(sizes, "cohort_month")
        .select(
            "cohort_month",
            month_label().alias("txn_month"),
            "cohort_size",
            "active_customers",
            pct("active_customers", "cohort_size").alias("retention_pct"),
        )
        .orderBy("cohort_month", "txn_month")
    )


def cohort_grid(txn: DataFrame, customers: DataFrame, months: int = 12) -> DataFrame:
    """Retention percent per signup month and months since signup, ``m0 .. m<months>``."""
    cohorts = customers.select(
        "customer_id",
        F.date_format("signup_date", "yyyy-MM").alias("cohort_month"),
        (F.year("signup_date") * 12 + F.month("signup_date")).alias("joined"),
    )
    sizes = cohorts.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    active = (
        _active_months(txn)
        .join(cohorts, "customer_id")
        .withColumn("age", month_index() - F.col("joined"))
        .where(F.col("age").between(0, months))
        .groupBy("cohort_month")
        .agg(*[F.count(F.when(F.col("age") == a, 1)).alias(f"a{a}") for a in range(months + 1)])
    )
    return (
        sizes.join(active, "cohort_month", "left")
        .select(
            "cohort_month",
            "cohort_size",
            *[pct(F.coalesce(F.col(f"a{a}"), F.lit(0)), "cohort_size").alias(f"m{a}") for a in range(months + 1)],
        )
        .orderBy("cohort_month")
    )


def new_vs_returning(txn: DataFrame) -> DataFrame:
    """Customers per month: first-ever buyers and those who bought in an earlier month."""
    active = _active_months(txn)
    # after the distinct a customer has one row per calendar month at most
    first = F.min(month_index()).over(Window.partitionBy("customer_id"))
    m = (
        active.withColumn("is_new", month_index() == first)
        .groupBy("year", "month")
        .agg(
            F.count(F.when(F.col("is_new"), 1)).alias("new_customers"),
            F.count(F.when(~F.col("is_new"), 1)).alias("returning_customers"),
        )
    )
    return m.select(
        month_label().alias("month_label"),
        "new_customers",
        "returning_customers",
        rounded(ratio("new_customers", "returning_customers"), 4).alias("new_to_returning"),
    ).orderBy("month_label")


def rfm_segment_summary(rfm: DataFrame) -> DataFrame:
    """Size, value and recommended action per RFM segment."""
    m = rfm.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(cents("monetary")).alias("revenue"),
        F.sum("frequency").alias("orders"),
        F.sum(F.col("recency_days").cast("bigint")).alias("days"),
    )
    action = F.lit(None).cast("string")
    for label, text in RFM_ACTIONS.items():
        action = F.when(F.col("rfm_segment") == label, text).otherwise(action)
    # at most six rows: a window without partitions is small
    return m.select(
        "rfm_segment",
        F.col("customers").alias("customer_count"),
        pct("customers", F.sum("customers").over(Window.partitionBy())).alias("pct_of_base"),
        per_usd("revenue", "customers").alias("avg_ltv"),
        rounded(ratio("orders", "customers")).alias("avg_orders"),
        rounded(ratio("days", "customers")).alias("avg_recency_days"),
        action.alias("action_recommended"),
    ).orderBy(F.desc("customer_count"), "rfm_segment")


def rfm_bubbles(rfm: DataFrame) -> DataFrame:
    m = rfm.groupBy("r_score", "f_score", "rfm_segment").agg(
        F.count(F.lit(1)).alias("customer_count"), F.sum(cents("monetary")).alias("revenue")
    )
    return m.select(
        "r_score",
        "f_score",
        "rfm_segment",
        "customer_count",
        per_usd("revenue", "customer_count").alias("avg_monetary"),
    ).orderBy("r_score", "f_score", "rfm_segment")


def ltv_histogram(txn: DataFrame, customers: DataFrame, bins: int = 20) -> DataFrame:
    """Customers per equal-width LTV bin and segment, with the overall median and 90th percentile."""
    ltv = durable(
        measure(txn, ["customer_id"], "revenue").join(customers.select("customer_id", "segment"), "customer_id")
    )
    span = ltv.agg(F.struct(F.min("revenue").alias("lo"), F.max("revenue").alias("hi"))).scalar()
    marks = exact_quantiles(ltv, "revenue", [0.5, 0.9]).select(F.struct("q0", "q1")).scalar()
    placed = ltv.withColumn("span", span).withColumn(
        "bin",
        F.when(F.col("span.lo") == F.col("span.hi"), 1).otherwise(
            F.least(
                F.width_bucket(
                    F.col("revenue").cast("double"),
                    F.col("span.lo").cast("double"),
                    F.col("span.hi").cast("double"),
                    F.lit(bins),
                ),
                F.lit(bins),
            )
        ),
    )
    m = placed.groupBy("segment", "bin").agg(
        F.count(F.lit(1)).alias("customers"), F.first("span").alias("span")
    )
    width = (F.col("span.hi") - F.col("span.lo")) / F.lit(float(bins))
    return m.withColumn("marks", marks).select(
        "segment",
        F.col("bin").cast("bigint").alias("bin"),
        rounded((F.col("span.lo") + width * (F.col("bin") - 1)) / 100, 4).alias("bin_from"),
        rounded((F.col("span.lo") + width * F.col("bin")) / 100, 4).alias("bin_to"),
        F.col("customers").alias("customer_count"),
        rounded(F.col("marks.q0") / 100).alias("median_ltv"),
        rounded(F.col("marks.q1") / 100).alias("p90_ltv"),
    ).orderBy("segment", "bin")


def top_customers(txn: DataFrame, customers: DataFrame, top: int = 20) -> DataFrame:
    """The best customers by lifetime value; ranked after the cut, on ``top`` rows."""
    best = (
        customer_totals(txn)
        .join(customers, "customer_id")
        .orderBy(F.desc("revenue"), "customer_id")
        .limit(top)
    )
    place = F.row_number().over(Window.orderBy(F.desc("revenue"), "customer_id"))
    return best.select(
        place.cast("bigint").alias("rank"),
        "customer_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "segment",
        "region",
        usd("revenue").alias("lifetime_value"),
        "orders",
        "first_order",
        "last_order",
        _lifespan().alias("days_active"),
        per_usd("revenue", "orders").alias("avg_order_value"),
    ).orderBy("rank")


def customer_geography(txn: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = measure(txn, ["customer_id"], "revenue")
    return (
        per_customer.join(customers.select("customer_id", "region", "country", "city"), "customer_id")
        .groupBy("city", "region", "country")
        .agg(F.count(F.lit(1)).alias("customers"), usd(F.sum("revenue")).alias("revenue"))
        .orderBy(F.desc("revenue"), "city")
    )


def customer_cards(txn: DataFrame, ranges: int | None = None) -> DataFrame:
    """Six figures over all buying customers; days between orders need a second order."""
    base = rfm_base(txn)
    scored = _tiles(_positions(base, best_last=True, ranges=ranges)).withColumn("rfm_segment", rfm_label())
    # millionths, so that the mean does not depend on the order of addition
    gap = F.when(F.col("frequency") > 1, F.col("lifespan_days") / (F.col("frequency") - 1))
    m = scored.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("monetary").alias("revenue"),
        F.sum("frequency").alias("orders"),
        F.count(F.when(F.col("rfm_segment") == "Champions", 1)).alias("champions"),
        F.count(F.when(F.col("rfm_segment") == "At Risk", 1)).alias("at_risk"),
        F.sum(F.rint(gap * 1_000_000).cast("bigint")).alias("gap"),
        F.count(gap).alias("gap_n"),
    )
    return m.select(
        F.col("customers").alias("total_customers"),
        per_usd("revenue", "customers").alias("avg_ltv"),
        "champions",
        "at_risk",
        rounded(ratio("orders", "customers")).alias("avg_orders_per_customer"),
        rounded(ratio(F.col("gap").cast("double") / F.lit(1_000_000.0), "gap_n")).alias("avg_days_between_orders"),
    )


def customer_revenue_share(txn: DataFrame) -> DataFrame:
    """Every customer's recomputed revenue, rank and share of the total."""
    net = F.col("quantity") * F.col("unit_price") * (1 - F.col("discount"))
    ltv = txn.groupBy("customer_id").agg(fine_sum(net).alias("revenue"))
    ranked = order_globally(ltv, "revenue", "customer_id", rank="ltv_rank", amount="revenue", total="whole")
    return ranked.select(
        "customer_id",
        from_fine("revenue").alias("lifetime_value"),
        "ltv_rank",
        from_fine("whole").alias("total_revenue"),
        rounded(ratio(from_fine("revenue"), from_fine("whole")) * 100, 6).alias("revenue_share_pct"),
    ).orderBy("ltv_rank", "customer_id")


def customer_features(txn: DataFrame) -> DataFrame:
    return customer_totals(txn).select(
        "customer_id",
        usd("revenue").alias("lifetime_value"),
        F.col("orders").alias("total_orders"),
        "first_order",
        "last_order",
        _lifespan().alias("lifespan_days"),
        per_usd("revenue", "orders").alias("avg_order_value"),
    )


def segment_overview(txn: DataFrame, customers: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Revenue, customers, orders and revenue per customer of each segment.

    Sales are added up per customer first, so the join is one to one. ``within`` as in ``by_customer_group``.
    """
    m = by_customer_group(txn, customers, "segment", within=within)
    whole = F.sum("revenue").over(Window.partitionBy())
    return m.select(
        "segment",
        usd("revenue").alias("revenue"),
        "customers",
        "orders",
        per_usd("revenue", "customers").alias("ltv"),
        pct_usd("revenue", whole).alias("rev_pct"),
    ).orderBy("segment")
