"""Running totals, moving averages, rankings and order gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tallyroom.functions.measures import measure
from tallyroom.functions.money import pct_usd, rounded, usd
from tallyroom.functions.ordering import ntile, order_globally, percent_rank


def _months() -> WindowSpec:
    """Calendar order; only used on one row per month."""
    return Window.orderBy("year", "month")


def running_totals(txn: DataFrame) -> DataFrame:
    m = measure(txn, ["year", "month"], "revenue")
    upto = _months().rowsBetween(Window.unboundedPreceding, 0)
    ytd = Window.partitionBy("year").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return m.select(
        "year",
        "month",
        usd("revenue").alias("revenue"),
        usd(F.sum("revenue").over(upto)).alias("running_total"),
        usd(F.sum("revenue").over(ytd)).alias("ytd_running_total"),
    ).orderBy("year", "month")


def moving_average_3m(txn: DataFrame, months: int = 3) -> DataFrame:
    m = measure(txn, ["year", "month"], "revenue")
    recent = _months().rowsBetween(1 - months, 0)
    mean = usd(F.sum("revenue").over(recent)) / F.count("revenue").over(recent)
    return m.select(
        "year", "month", usd("revenue").alias("revenue"), rounded(mean).alias("revenue_3mo_avg")
    ).orderBy("year", "month")


def customer_ranking(txn: DataFrame, ranges: int | None = None) -> DataFrame:
    """Five rankings of all customers by lifetime value."""
    ltv = measure(txn, ["customer_id"], "revenue")
    placed = order_globally(
        ltv,
        "revenue",
        "customer_id",
        rank="rank",
        dense_rank="dense_rank",
        row_number="row_num",
        n="n",
        ranges=ranges,
    )
    return placed.select(
        "customer_id",
        usd("revenue").alias("lifetime_value"),
        "rank",
        "dense_rank",
        "row_num",
        rounded(percent_rank("rank", "n") * 100).alias("percentile_rank"),
        ntile(10, "row_num", "n").alias("decile"),
    ).orderBy("rank", "customer_id")


def period_contribution(txn: DataFrame) -> DataFrame:
    m = measure(txn, ["year", "month", "region"], "revenue")
    month = F.sum("revenue").over(Window.partitionBy("year", "month"))
    year = F.sum("revenue").over(Window.partitionBy("year"))
    return m.select(
        "year",
        "month",
        "region",
        usd("revenue").alias("revenue"),
        pct_usd("revenue", month).alias("pct_of_month"),
        pct_usd("revenue", year).alias("pct_of_year"),
    ).orderBy("year", "month", F.desc("revenue"), "region")


def order_gaps(txn: DataFrame, with_next: bool = False, limit: int | None = None) -> DataFrame:
    """Days between consecutive transactions of a customer, first transactions left out.

    A window over a customer's transactions would put a very large customer in
    one task.  Only dates matter, so neighbours are found among the customer's
    distinct order days (at most one row per calendar day); within a day the
    transaction with the lowest id looks back to the previous day and the one
    with the highest id looks ahead, all others have neighbours on the day itself.
    Rows are sorted only for a ``limit``; sorting the whole fact table serves no report.
    """
    per_day = txn.groupBy("customer_id", "order_date").agg(
        F.min("transaction_id").alias("first_id"), F.max("transaction_id").alias("last_id")
    )
    days = Window.partitionBy("customer_id").orderBy("order_date")
    per_day = per_day.withColumn("day_before", F.lag("order_date").over(days))
    if with_next:
        per_day = per_day.withColumn("day_after", F.lead("order_date").over(days))
    rows = txn.select("customer_id", "order_date", "transaction_id", "net_revenue").join(
        per_day, ["customer_id", "order_date"]
    )
    opens_day = F.col("transaction_id") == F.col("first_id")
    before = F.when(opens_day, F.col("day_before")).otherwise(F.col("order_date"))
    kept = rows.withColumn("prev_order_date", before).where(F.col("prev_order_date").isNotNull())
    extra = []
    if with_next:
        closes_day = F.col("transaction_id") == F.col("last_id")
        extra = [F.when(closes_day, F.col("day_after")).otherwise(F.col("order_date")).alias("next_order_date")]
    if limit is not None:
        kept = kept.orderBy("customer_id", "order_date", "transaction_id").limit(limit)
    return kept.select(
        "customer_id",
        "order_date",
        "prev_order_date",
        *extra,
        F.datediff("order_date", "prev_order_date").alias("days_since_last_order"),
        "net_revenue",
    )


def first_last_purchase(txn: DataFrame, limit: int | None = None) -> DataFrame:
    """Date and value of each customer's first and last transaction.

    An aggregate with a map-side combine instead of a full-frame window and a
    DISTINCT: a customer is one row per input partition before the shuffle.
    """
    at = F.struct("order_date", "transaction_id")
    out = (
        txn.groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_purchase_date"),
            F.max("order_date").alias("last_purchase_date"),
            F.min_by("net_revenue", at).alias("first_order_value"),
            F.max_by("net_revenue", at).alias("last_order_value"),
        )
        .orderBy("customer_id")
    )
    return out if limit is None else out.limit(limit)


def revenue_ntiles(txn: DataFrame) -> DataFrame:
    m = measure(txn, ["year", "month", "region"], "revenue")
    best = Window.orderBy(F.desc("revenue"), "year", "month", "region")
    return m.select(
        "year",
        "month",
        "region",
        usd("revenue").alias("revenue"),
        F.ntile(4).over(best).cast("bigint").alias("quartile"),
        F.ntile(10).over(best).cast("bigint").alias("decile"),
    ).orderBy("year", "month", "region")
