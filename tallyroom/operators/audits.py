"""SQL-style audits: row counts, NULL counts, duplicates, orphans, domains and the scorecard.

Checks over the same table share one scan.  NULLs are ignored by the range and
domain audits here, as comparison with NULL is in SQL; ``checks`` has the
stricter reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.functions.money import cents, ratio, rounded, usd
from tallyroom.operators.checks import orphan_rows, orphan_totals, reference_counts
from tallyroom.schemas import EMAIL_PATTERN, REGIONS, SEGMENTS

NULL_AUDIT = {
    "customers": ("customer_id", "email", "region", "signup_date", "segment"),
    "products": ("product_id", "unit_price", "unit_cost", "category"),
    "sales_transactions": (
        "transaction_id",
        "customer_id",
        "product_id",
        "order_date",
        "net_revenue",
        "quantity",
    ),
}


def _count(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``(check_name, violations)`` rows of one table from one aggregate."""
    rows = [F.struct(F.lit(n).alias("check_name"), c.alias("violations")) for n, c in checks.items()]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def row_counts(customers: DataFrame, products: DataFrame, txn: DataFrame) -> DataFrame:
    named = {"customers": customers, "products": products, "sales_transactions": txn}
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
            for n, df in named.items()
        ]
    )


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row, ``null_<column>`` for each column."""
    return df.agg(*[_count(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def orphan_count(txn: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    return orphan_rows(txn, key, parent).agg(F.coalesce(F.sum("c"), F.lit(0)).alias(name))


def invalid_values(df: DataFrame, column: str, valid: Sequence[str], name: str) -> DataFrame:
    return df.where(~F.col(column).isin(*valid)).select(F.col(column).alias(name)).distinct()


def invalid_discounts(txn: DataFrame) -> DataFrame:
    d = F.col("discount")
    return txn.agg(_count((d < 0) | (d > 1)).alias("invalid_discount_count"))


def invalid_quantities(txn: DataFrame) -> DataFrame:
    return txn.agg(_count(F.col("quantity") < 1).alias("invalid_quantity_count"))


def ship_before_order(txn: DataFrame) -> DataFrame:
    return txn.agg(_count(F.col("ship_date") < F.col("order_date")).alias("ship_before_order_count"))


def partition_coverage(txn: DataFrame) -> DataFrame:
    return txn.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count")).orderBy("year", "month")


def dq_completeness(customers: DataFrame, products: DataFrame, txn: DataFrame) -> DataFrame:
    named = [
        ("customers", customers, "customer_id"),
        ("products", products, "product_id"),
        ("sales_transactions", txn, "transaction_id"),
    ]
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count"), F.count(key).alias("non_null_pk")).select(
                F.lit(n).alias("table_name"),
                "row_count",
                "non_null_pk",
                (F.col("row_count") - F.col("non_null_pk")).alias("null_pk_count"),
            )
            for n, df, key in named
        ]
    )


def dq_uniqueness(customers: DataFrame, products: DataFrame, txn: DataFrame) -> DataFrame:
    named = [
        ("customers", customers, "customer_id"),
        ("products", products, "product_id"),
        ("transactions", txn, "transaction_id"),
    ]
    return _union(
        [
            duplicate_keys(df, key).select(
                F.lit(n).alias("table_name"), F.col(key).alias("pk_value"), F.col("cnt").alias("occurrences")
            )
            for n, df, key in named
        ]
    )


def dq_validity(products: DataFrame, txn: DataFrame, margin_floor: float = -50) -> DataFrame:
    """Numeric ranges: one scan of products, one of transactions."""
    p = {
        "products.unit_price <= 0": _count(F.col("unit_price") <= 0),
        "products.unit_cost <= 0": _count(F.col("unit_cost") <= 0),
        f"products.margin_pct < {margin_floor:g}": _count(F.col("margin_pct") < margin_floor),
    }
    t = {
        "transactions.quantity < 1": _count(F.col("quantity") < 1),
        "transactions.discount < 0": _count(F.col("discount") < 0),
        "transactions.discount > 1": _count(F.col("discount") > 1),
        "transactions.unit_price <= 0": _count(F.col("unit_price") <= 0),
        "transactions.net_revenue < 0": _count(F.col("net_revenue") < 0),
    }
    return _violations(products, p).unionByName(_violations(txn, t))


def dq_temporal(customers: DataFrame, txn: DataFrame, as_of: str | None = None) -> DataFrame:
    """Date order and dates in the future; ``as_of`` replaces today for repeatable runs."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    t = {
        "ship_date < order_date": _count(F.col("ship_date") < F.col("order_date")),
        "order_date > today": _count(F.col("order_date") > today),
        "ship_date > today": _count(F.col("ship_date") > today),
    }
    c = {"signup_date in future": _count(F.col("signup_date") > today)}
    return _violations(txn, t).unionByName(_violations(customers, c))


def dq_domain(
    customers: DataFrame,
    txn: DataFrame,
    regions: Sequence[str] = REGIONS,
    segments: Sequence[str] = SEGMENTS,
) -> DataFrame:
    t = {"invalid region (transactions)": _count(~F.col("region").isin(*regions))}
    c = {
        "invalid region (customers)": _count(~F.col("region").isin(*regions)),
        "invalid segment": _count(~F.col("segment").isin(*segments)),
    }
    return _violations(txn, t).unionByName(_violations(customers, c))


def dq_referential(customers: DataFrame, products: DataFrame, txn: DataFrame) -> DataFrame:
    labels = F.when(F.col("column") == "customer_id", "orphan customer_id in transactions").otherwise(
        "orphan product_id in transactions"
    )
    totals = orphan_totals(txn, {"customer_id": customers, "product_id": products})
    return totals.select(labels.alias("check_name"), F.col("orphans").alias("violations"))


def dq_outliers(txn: DataFrame, threshold: float = 4.0) -> DataFrame:
    """Transactions whose revenue lies more than ``threshold`` deviations from the mean.

    Mean and deviation come from exact sums of cents and squared cents, so that no
    row comes and goes with the shuffle order; they are one scalar row, read by
    every task.  NULL or zero deviation (fewer than two distinct values) yields no rows.
    """
    x = cents("net_revenue").cast("decimal(19,0)")
    sums = txn.agg(
        F.count("net_revenue").cast("decimal(12,0)").alias("n"),
        F.sum(x.cast("decimal(12,0)")).alias("s"),
        F.sum((x * x).cast("decimal(24,0)")).alias("q"),
    )
    spread = (F.col("n") * F.col("q") - F.col("s") * F.col("s")).cast("double")
    pairs = (F.col("n") * (F.col("n") - 1)).cast("double")
    stats = sums.select(
        F.struct(
            ratio(usd("s"), "n").alias("mean"), (F.sqrt(F.try_divide(spread, pairs)) / F.lit(100.0)).alias("dev")
        )
    ).scalar()
    z = F.try_divide(F.col("net_revenue") - stats["mean"], stats["dev"])
    return (
        txn.select("transaction_id", "order_date", "net_revenue", z.alias("z"))
        .where(F.abs("z") > threshold)
        .select("transaction_id", "order_date", "net_revenue", rounded(F.col("z")).alias("z_score"))
        .orderBy(F.desc("z_score"), "transaction_id")
    )


def dq_freshness(txn: DataFrame, partitions: int = 6) -> DataFrame:
    """Latest order day and row count of the newest ``partitions`` months."""
    return (
        txn.groupBy("year", "month")
        .agg(F.max("order_date").alias("latest_order_date"), F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("year"), F.desc("month"))
        .limit(partitions)
    )


def dq_email_format(customers: DataFrame, pattern: str = EMAIL_PATTERN, limit: int | None = None) -> DataFrame:
    """Customers whose address does not match; all of them unless a display ``limit`` is given."""
    bad = customers.where(~F.col("email").rlike(pattern)).select("customer_id", "email")
    return bad if limit is None else bad.orderBy("customer_id").limit(limit)


def dq_scorecard(customers: DataFrame, products: DataFrame, txn: DataFrame) -> DataFrame:
    """Every check's violations; the transactions are read once for all of theirs."""
    duplicates = duplicate_keys(customers, "customer_id").agg(F.count(F.lit(1)).alias("violations"))
    conditions = {
        "DQ-03: Invalid quantity": F.col("quantity") < 1,
        "DQ-03: Invalid discount": (F.col("discount") < 0) | (F.col("discount") > 1),
        "DQ-04: Ship before order": F.col("ship_date") < F.col("order_date"),
    }
    found = reference_counts(txn, {"customer_id": customers, "product_id": products}, conditions)
    named = {
        **{n: n for n in conditions},
        "DQ-06: Orphan customer FK": "orphans_customer_id",
        "DQ-06: Orphan product FK": "orphans_product_id",
    }
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"`{c}`").alias("violations")) for n, c in named.items()])
    return (
        duplicates.select(F.lit("DQ-02: Duplicate PKs").alias("check_name"), "violations")
        .unionByName(found.select(F.inline(rows)))
        .withColumn("status", F.when(F.col("violations") == 0, "PASS").otherwise("FAIL"))
        .orderBy(F.desc("status"), "check_name")
    )


def integrity_summary(customers: DataFrame, products: DataFrame, txn: DataFrame) -> DataFrame:
    """Duplicates, orphans and bad ship dates of the whole data set, in one row."""

    def repeats(df: DataFrame, key: str) -> Column:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
        return per_key.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0))).scalar()

    of = lambda key: F.coalesce(F.sum(F.when(F.col("column") == key, F.col("orphans"))), F.lit(0))
    orphans = (
        orphan_totals(txn, {"customer_id": customers, "product_id": products})
        .agg(F.struct(of("customer_id").alias("customers"), of("product_id").alias("products")))
        .scalar()
    )
    bad_ship = ship_before_order(txn)
    return bad_ship.select(
        repeats(customers, "customer_id").alias("duplicate_customers"),
        repeats(products, "product_id").alias("duplicate_products"),
        repeats(txn, "transaction_id").alias("duplicate_transactions"),
        orphans["customers"].alias("orphan_customers"),
        orphans["products"].alias("orphan_products"),
        F.col("ship_before_order_count").alias("bad_ship_dates"),
    )
