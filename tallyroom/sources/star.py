"""Retail tables (customers, products, sales_transactions) derived from wholesale tables.

Each table is built from the joins its requested columns need, so a report that
never looks at the region does not pay for the join that finds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ORDER_SIGNUP = "1995-01-01"


def _percent() -> Column:
    """Discount in whole percent: three times the wholesale discount."""
    return F.rint(F.col("l_discount") * 100).cast("bigint") * 3


def _net_cents() -> Column:
    """Discounted line price in whole cents, half up, in integer arithmetic."""
    hundredths = F.rint(F.col("l_extendedprice") * 100).cast("bigint") * (100 - _percent())
    return F.floor((hundredths + 50) / 100)


def _text_number(c: str) -> Column:
    """Two-decimal text of a number, as a raw file would hold it."""
    return F.col(c).cast("decimal(18,2)").cast("string")


#: Declared, so that no query starts with a job that looks into the files.
WHOLESALE = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


class Star:
    """The wholesale tables of one folder, seen as the three retail tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(WHOLESALE[name]).parquet(f"{self.folder}/{name}.parquet")

    def _places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            "n_nationkey", F.col("r_name").alias("region"), F.col("n_name").alias("country")
        )

    def _with_region(self, orders: DataFrame) -> DataFrame:
        """Add the buyer's region, one lookup at a time, before the orders meet their lines.

        Every right side is a plain table, whose size Catalyst knows; the size of
        tables joined beforehand would be estimated as a product.  Customers too
        many to broadcast then shuffle the orders once more, never the lines.
        """
        return (
            orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .withColumnRenamed("r_name", "region")
        )

    def customers(self, signup: bool = True) -> DataFrame:
        """Customers; without ``signup`` the pass over the orders is left out."""
        number = F.expr("substring(c_name, 10)")
        local_part = F.concat(F.lit("customer."), number)
        out = (
            self.table("customer")
            .join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("c_custkey").cast("string").alias("customer_id"),
                F.lit("Customer").alias("first_name"),
                number.alias("last_name"),
                F.when(F.col("c_custkey") % 97 == 0, local_part)
                .otherwise(F.concat(local_part, F.lit("@example.com")))
                .alias("email"),
                "region",
                F.lit("Synthetic").alias("country"),
                F.col("country").alias("city"),
                F.col("c_mktsegment").alias("segment"),
            )
        )
        if not signup:
            return out
        first_order = (
            self.table("orders")
            .groupBy(F.col("o_custkey").cast("string").alias("customer_id"))
            .agg(F.min(F.col("o_orderdate").cast("date")).alias("first_order"))
        )
        return (
            out.join(first_order, "customer_id", "left")
            .withColumn(
                "signup_date",
                F.coalesce("first_order", F.lit(NO_ORDER_SIGNUP).cast("date")),
            )
            .drop("first_order")
        )

    def products(self) -> DataFrame:
        cost_rate = (F.lit(0.60) + F.lit(0.05) * (F.col("p_size") % 5)).cast("decimal(4,2)")
        price, cost = F.col("unit_price"), F.col("unit_cost")
        return (
            self.table("part")
            .select(
                F.col("p_partkey").cast("string").alias("product_id"),
                F.col("p_name").alias("product_name"),
                F.col("p_type").alias("category"),
                F.concat_ws("-", "p_type", (F.col("p_size") % 5).cast("string")).alias("sub_category"),
                F.round(F.col("p_retailprice").cast("decimal(18,2)") * cost_rate, 2)
                .cast("double")
                .alias("unit_cost"),
                F.col("p_retailprice").alias("unit_price"),
                F.col("p_brand").alias("brand"),
            )
            .withColumn(
                "margin_pct",
                F.round(
                    (F.try_divide(price - cost, price) * 100).cast("decimal(28,10)"), 2
                ).cast("double"),
            )
        )

    def transactions(self, region: bool = True, order_key: bool = False) -> DataFrame:
        """Transactions; without ``region`` the customer join is left out.

        ``order_key`` adds the order's number. Transaction ids begin with it, so an id occurs in one order only.
        """
        order_date = F.col("o_orderdate").cast("date")
        orders = self.table("orders")
        joined = self.table("lineitem").join(
            self._with_region(orders) if region else orders, F.col("l_orderkey") == F.col("o_orderkey")
        )
        cols = [
            F.concat_ws(
                "-",
                F.col("l_orderkey").cast("string"),
                F.col("l_linenumber").cast("string"),
                F.col("l_partkey").cast("string"),
                F.col("l_suppkey").cast("string"),
                F.col("l_quantity").cast("int").cast("string"),
            ).alias("transaction_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
            order_date.alias("order_date"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            (_percent() / F.lit(100.0)).alias("discount"),
            (_net_cents() / F.lit(100.0)).alias("net_revenue"),
        ]
        if region:
            cols.append(F.col("region"))
        if order_key:
            cols.append(F.col("l_orderkey").alias("order_key"))
        return joined.select(
            *cols, F.year(order_date).alias("year"), F.month(order_date).alias("month")
        )

    def loose_transactions(self) -> DataFrame:
        """Transactions of which some name a customer or a product that does not exist."""
        units, customer, product = F.col("quantity"), F.col("customer_id"), F.col("product_id")
        return self.transactions(region=False).withColumns(
            {
                "customer_id": F.when(units % 17 == 0, F.concat(F.lit("C"), customer)).otherwise(customer),
                "product_id": F.when(units % 19 == 0, F.concat(F.lit("P"), product)).otherwise(product),
            }
        )

    def offers(self) -> DataFrame:
        """Products as their suppliers list them: one row per product and supplier, so products repeat."""
        return self.table("lineitem").select(F.col("l_partkey").cast("string").alias("product_id"), "l_suppkey").distinct()

    def register_views(self, prefix: str = "") -> dict[str, DataFrame]:
        """Temporary views of the three retail tables, for SQL users."""
        made = {
            "customers": self.customers(),
            "products": self.products(),
            "sales_transactions": self.transactions(),
        }
        for name, df in made.items():
            df.createOrReplaceTempView(prefix + name)
        return made

    # Raw, uncleaned text tables: the same facts as files would deliver them.

    def raw_customers(self) -> DataFrame:
        """One text record per order, so customers repeat; ``ingest_seq`` is the arrival order."""
        return (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("o_custkey").cast("string").alias("customer_id"),
                F.lit("Customer").alias("first_name"),
                F.expr("substring(c_name, 10)").alias("last_name"),
                F.when(F.col("c_custkey") % 13 == 0, F.lit("NA"))
                .when(
                    F.col("c_acctbal") >= 0,
                    F.concat(F.lit(" Customer."), F.expr("substring(c_name, 10)"), F.lit("@Example.COM ")),
                ).alias("email"),
                F.concat(F.lit(" "), F.lower("region"), F.lit(" ")).alias("region"),
                F.lit("Synthetic").alias("country"),
                F.col("country").alias("city"),
                F.when(F.col("o_orderpriority") == "5-LOW", F.lit("2021-13-45"))
                .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyy/MM/dd"))
                .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
                .alias("signup_date"),
                F.concat(F.lit(" "), F.col("c_mktsegment")).alias("segment"),
                F.col("o_orderkey").alias("ingest_seq"),
            )
        )

    def raw_products(self) -> DataFrame:
        """Text products: some without a name, some priced zero or with unreadable cost."""
        size = F.col("p_size")
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("product_id"),
            F.when(F.col("p_brand") != "Brand#2", F.col("p_name")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.concat_ws("-", "p_type", (size % 5).cast("string")).alias("sub_category"),
            F.when(size == 1, F.lit("n/a"))
            .when(size == 3, F.lit("NaN"))
            .otherwise((F.col("p_retailprice") * 0.7).cast("decimal(18,2)").cast("string"))
            .alias("unit_cost"),
            F.when(size == 2, F.lit("0"))
            .when(size == 4, F.lit("NaN"))
            .when(size == 5, F.lit("about 900"))
            .otherwise(_text_number("p_retailprice"))
            .alias("unit_price"),
            F.col("p_brand").alias("brand"),
            F.col("p_partkey").alias("ingest_seq"),
        )

    def raw_transactions(self) -> DataFrame:
        """Text transactions with repeated keys, odd quantities, discounts and dates."""
        order_day = F.date_format("o_orderdate", "yyyy-MM-dd")
        unit_price = F.round((F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(28,10)"), 2)
        odd_discount = F.col("l_discount").cast("decimal(4,2)") * 15 - F.lit(0.1).cast("decimal(4,2)")
        units = (F.col("l_quantity").cast("int") - 3).cast("string")
        orders = self._with_region(self.table("orders"))
        return (
            self.table("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
                    "transaction_id"
                ),
                F.col("o_custkey").cast("string").alias("customer_id"),
                F.col("l_partkey").cast("string").alias("product_id"),
                F.when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date"))
                .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format("o_orderdate", "yyyy/MM/dd"))
                .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "MM/dd/yyyy"))
                .otherwise(order_day)
                .alias("order_date"),
                F.when(F.col("l_returnflag") != "N", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("ship_date"),
                F.when(F.col("l_tax") == 0.07, F.lit("x"))
                .when(F.col("l_tax") == 0.06, F.concat(units, F.lit(".0")))
                .when(F.col("l_tax") == 0.05, F.concat(units, F.lit(".5")))
                .when(F.col("l_tax") == 0.04, F.lit("N/A"))
                .otherwise(units)
                .alias("quantity"),
                unit_price.cast("string").alias("unit_price"),
                F.when(F.col("l_tax") == 0.01, F.lit("NaN"))
                .when(F.col("l_tax") == 0.02, F.lit("much"))
                .when(F.col("l_linestatus") == "F", odd_discount.cast("string"))
                .alias("discount"),
                "region",
                F.year("o_orderdate").cast("string").alias("year"),
                F.month("o_orderdate").cast("string").alias("month"),
                # arrival order, a total order over the source rows
                F.struct("l_partkey", "l_suppkey", F.col("l_quantity").cast("int")).alias("ingest_seq"),
            )
        )
