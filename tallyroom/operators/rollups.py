"""Stored partial results per month, from which reports are made without reading the transactions.

A cell holds the additive measures of one (year, month, region, product known or not) and 32,768 customers,
and the bitmap of the customers that bought. Whatever is coarser is made of cells: sums add up,
bitmaps merge. After a load only the months it touched are computed again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.functions.bitmaps import KeyNumbers, bucket, distinct_of, members
from tallyroom.functions.money import cents, fine_cents, micros, profit_fine, quarter_of
from tallyroom.operators import kpi, region, timeseries
from tallyroom.sinks.writers import write_partitioned
from tallyroom.streaming.incremental import month_filter

SCHEMA = (
    "region string, known boolean, bucket bigint, revenue bigint, profit_fine bigint, orders bigint, units bigint, "
    "units_n bigint, disc bigint, disc_n bigint, members binary, year int, month int"
)
_SUMS = ("revenue", "profit_fine", "orders", "units", "units_n", "disc", "disc_n")


def cells(numbered: DataFrame, products: DataFrame) -> DataFrame:
    """Cells of transactions with ``customer_number``; transaction ids are unique, as loads keep them.

    Rows meet their product and are then combined map-side into few groups: what is shuffled are sums and
    bitmaps, no ids.
    """
    priced = products.select("product_id", "unit_cost", F.lit(True).alias("known"))
    joined = numbered.join(priced, "product_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return joined.groupBy("region", "known", bucket("customer_number").alias("bucket"), "year", "month").agg(
        F.sum(cents("net_revenue")).alias("revenue"),
        F.sum(profit_fine()).alias("profit_fine"),
        F.count("transaction_id").alias("orders"),
        F.sum(F.col("quantity").cast("bigint")).alias("units"),
        F.count("quantity").alias("units_n"),
        F.sum(micros("discount")).alias("disc"),
        F.count("discount").alias("disc_n"),
        members("customer_number").alias("members"),
    )


class Rollups:
    """Cells and customer numbers below ``path``; one writer at a time.

    The profit in a cell uses the product costs of the day it was computed; after a change of
    products ``rebuild`` is due.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.customers = KeyNumbers(spark, f"{self.path}/customer_numbers", "customer_id")

    def _store(self, txn: DataFrame, products: DataFrame, touched_only: bool) -> None:
        self.customers.add(txn)
        names = ("transaction_id", "product_id", "customer_id", "net_revenue", "quantity", "discount", "region", "year", "month")
        made = cells(self.customers.number(txn.select(*names), "customer_number"), products)
        write_partitioned(made, f"{self.path}/cells", touched_only=touched_only)

    def rebuild(self, txn: DataFrame, products: DataFrame) -> None:
        """All months anew; numbers that customers have stay."""
        self._store(txn, products, touched_only=False)

    def refresh(self, txn: DataFrame, products: DataFrame, months: Iterable[tuple[int, int]]) -> None:
        """The given months anew, from those months of ``txn`` alone; running it again changes nothing."""
        months = list(months)
        if months:
            self._store(txn.where(month_filter(months)), products, touched_only=True)

    def stored(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/cells")

    def measures(self, keys: list[str | Column], known_only: bool = False) -> DataFrame:
        """``(keys, revenue, profit, orders, customers, units, units_n, disc, disc_n)`` in the units of the reports.

        ``known_only`` leaves out sales of unknown products, as reports that join products do.
        """
        found = self.stored().where("known") if known_only else self.stored()
        added = found.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in _SUMS))
        added = added.withColumn("profit", fine_cents(F.col("profit_fine")))
        counted = distinct_of(found.where("bucket is not null"), keys, "customers")
        names = [c for c in counted.columns if c != "customers"]
        both = [F.col(f"a.{c}").eqNullSafe(F.col(f"c.{c}")) for c in names] or [F.lit(True)]
        return (
            added.alias("a")
            .join(counted.alias("c"), both, "left")  # one row per group on either side
            .select("a.*", F.coalesce("c.customers", F.lit(0).cast("bigint")).alias("customers"))
        )

    # the reports, with the columns of their namesakes

    def monthly_sales(self) -> DataFrame:
        return timeseries.monthly_report(self.measures(["year", "month"]))

    def regional_summary(self) -> DataFrame:
        return region.regional_report(self.measures(["region"], known_only=True))

    def kpi_totals(self) -> DataFrame:
        return kpi.totals_report(self.measures([], known_only=True))

    def quarterly_revenue(self) -> DataFrame:
        return kpi.quarterly_report(self.measures(["year", quarter_of().alias("quarter")]))
