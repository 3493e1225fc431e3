"""Named aggregate measures shared by every report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.money import cents, micros, profit_sum, ratio, rounded

_UNIQUE = "tallyroom.unique"


def declare_unique(df: DataFrame, column: str = "transaction_id") -> DataFrame:
    """Mark a key as unique, in the column's metadata, once the uniqueness check has passed.

    Reports then count rows instead of distinct keys, which spares the shuffle of
    every key.  The mark survives filters and projections.  The joins of this
    library keep it only if the dimension's key is declared unique as well; before
    a join or union of your own that may repeat rows, call ``forget_unique``.
    """
    return df.withMetadata(column, {**df.schema[column].metadata, _UNIQUE: True})


def forget_unique(df: DataFrame, column: str = "transaction_id") -> DataFrame:
    kept = {k: v for k, v in df.schema[column].metadata.items() if k != _UNIQUE}
    return df.withMetadata(column, kept)


def join_dimension(txn: DataFrame, dimension: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join that may repeat rows unless the dimension's key is declared unique."""
    marked = "transaction_id" in txn.columns and txn.schema["transaction_id"].metadata.get(_UNIQUE)
    if marked and not dimension.schema[key].metadata.get(_UNIQUE):
        txn = forget_unique(txn)
    return txn.join(dimension, key, how)


def key_count(df: DataFrame, column: str = "transaction_id") -> Column:
    """Distinct keys of a group: a plain count where the key is declared unique."""
    if df.schema[column].metadata.get(_UNIQUE):
        return F.count(column)
    return F.countDistinct(column)


_MEASURES = {
    "revenue": lambda: F.sum(cents("net_revenue")),
    "profit": lambda: profit_sum(),
    "units": lambda: F.sum(F.col("quantity").cast("bigint")),
    "lines": lambda: F.count(F.lit(1)),
    "priced": lambda: F.count("net_revenue"),
    "disc": lambda: F.sum(micros("discount")),
    "disc_n": lambda: F.count("discount"),
    "customers": lambda: F.countDistinct("customer_id"),
}

# Measures that can be added up again after a partial grouping.
ADDITIVE = ("revenue", "profit", "units", "lines", "priced", "disc", "disc_n")


def measure(df: DataFrame, keys: Sequence[str | Column], *names: str) -> DataFrame:
    """Group by ``keys`` (none: one row) and compute the named measures, money in cents."""
    made = [(key_count(df) if n == "orders" else _MEASURES[n]()).alias(n) for n in names]
    return df.groupBy(*keys).agg(*made)


def by_customer_group(txn: DataFrame, customers: DataFrame, *keys: str, within: Sequence[str] = ()) -> DataFrame:
    """Revenue, customers and orders per ``keys`` of the customer.

    Where the transaction id is declared unique, revenue and orders are added up per customer before the
    join. Otherwise an id may occur under several customers of a group and still counts once in it. Only such
    ids are carried on; those of one customer are counted where they meet, and numbers per customer go to the join.
    ``within`` names columns that the id determines: rows that lie together by them meet without a shuffle.
    """
    located = customers.select("customer_id", *keys)
    if not txn.schema["transaction_id"].metadata.get(_UNIQUE):
        sold = measure(txn.where(F.col("customer_id").isNotNull()), [*within, "transaction_id", "customer_id"], "revenue")
        shared = F.count(F.lit(1)).over(Window.partitionBy(*within, "transaction_id")) > 1
        per_customer = (
            sold.select("customer_id", "transaction_id", "revenue", shared.alias("shared"))
            .groupBy("customer_id", F.when(F.col("shared"), F.col("transaction_id")).alias("shared_id"))
            .agg(
                F.sum("revenue").alias("revenue"),
                F.count(F.when(~F.col("shared"), F.col("transaction_id"))).alias("own_ids"),
            )
        )
        # a customer listed twice in a group sells twice, as in a plain join, but its ids count once
        places = located.groupBy("customer_id", *keys).agg(F.count(F.lit(1)).alias("copies"))
        return (
            per_customer.join(places, "customer_id")
            .groupBy(*keys)
            .agg(
                F.sum(F.col("revenue") * F.col("copies")).alias("revenue"),
                F.countDistinct("customer_id").alias("customers"),
                (F.sum("own_ids") + F.countDistinct("shared_id")).alias("orders"),
            )
        )
    names = ("revenue", "orders")
    return (
        measure(txn, ["customer_id"], *names)
        .join(located, "customer_id")
        .groupBy(*keys)
        .agg(*[F.sum(n).alias(n) for n in names], F.count("customer_id").alias("customers"))
    )


def discount_pct(digits: int = 2) -> Column:
    """Average discount in percent from the ``disc`` and ``disc_n`` measures."""
    mean = ratio(F.col("disc").cast("double") / F.lit(1_000_000.0), "disc_n")
    return rounded(mean * 100, digits)


def with_products(txn: DataFrame, products: DataFrame, *dims: str) -> DataFrame:
    """Inner join to products.

    No broadcast hint: Catalyst and AQE broadcast the dimension when its measured
    size allows it and otherwise use a sort-merge join with skew splitting.
    """
    return join_dimension(txn, products.select("product_id", "unit_cost", *dims), "product_id")


def profit_cells(
    txn: DataFrame,
    products: DataFrame,
    by: Sequence[str] = (),
    dims: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Additive measures per ``by`` (transaction columns) and ``dims`` (product columns).

    Rows meet their product first and are then combined map-side into few groups.
    With a product table small enough to broadcast no fact row is shuffled; with a
    larger one each is shuffled once, and AQE splits a hot product.  Grouping per
    product beforehand would shuffle nearly every row as soon as ``by`` is fine.
    With ``how="left"`` sales of unknown products keep their revenue, without profit.
    """
    joined = join_dimension(txn, products.select("product_id", "unit_cost", *dims), "product_id", how)
    return measure(joined, [*by, *dims], *ADDITIVE)
