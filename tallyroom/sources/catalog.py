"""Database, external tables, partition repair, stored reports and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.schemas import PARTITIONS, TABLES


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(
    spark: SparkSession, name: str, location: str, comment: str = "Sales reporting tables"
) -> DataFrame:
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT {_literal(comment)} LOCATION {_literal(location)}"
    )
    return spark.sql(f"DESCRIBE DATABASE `{name}`")


def create_external_tables(spark: SparkSession, database: str, folder: str) -> DataFrame:
    """Register the three tables over existing Parquet folders; one row per column."""
    for table, schema in TABLES.items():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()} COMMENT {_literal(f.metadata['comment'])}" for f in schema
        )
        keys = PARTITIONS[table]
        partitioned = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.{table} ({columns}) USING parquet {partitioned} "
            f"LOCATION {_literal(f'{folder}/{table}')}"
        )
    described = [
        spark.createDataFrame(
            [
                (t, c.name, c.dataType, c.description, c.isPartition)
                for c in spark.catalog.listColumns(f"{database}.{t}")
            ],
            "table_name string, column_name string, data_type string, comment string, is_partition boolean",
        )
        for t in TABLES
    ]
    out = described[0]
    for d in described[1:]:
        out = out.unionByName(d)
    return out


def bucket_skew(df: DataFrame, key: str, buckets: int) -> float:
    """Rows of the fullest bucket over the mean; each key is one row per task before it is dealt out."""
    number = F.pmod(F.hash(key), F.lit(buckets))  # the hash that buckets and hash partitions use
    sizes = df.groupBy(number.alias("b")).agg(F.count(F.lit(1)).alias("c"))
    fullest, rows = sizes.agg(F.max("c"), F.sum("c")).first()
    return 0.0 if not rows else fullest * buckets / rows


#: Rows that a bucket holds on average before the buckets double, and how often they may double.
ROWS_PER_BUCKET, MOST_DOUBLINGS = 2_000_000, 12


def fitting_buckets(df: DataFrame, key: str, fewest: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[int, float]:
    """``fewest``, doubled until a bucket holds at most ``rows_per_bucket`` rows on average, and the skew there.

    One pass: rows are counted by the largest number of buckets, of which every smaller one is a divisor.
    """
    numbers = [fewest << i for i in range(MOST_DOUBLINGS + 1)]
    fine = df.groupBy(F.pmod(F.hash(key), F.lit(numbers[-1])).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    sizes = fine.select(F.explode(F.array(*map(F.lit, numbers))).alias("n"), "b", "c").groupBy("n", F.col("b") % F.col("n")).agg(F.sum("c").alias("c"))
    found = sizes.groupBy("n").agg(F.max("c").alias("fullest"), F.sum("c").alias("rows")).orderBy("n").collect()
    if not found:
        return fewest, 0.0
    best = next((r for r in found if r["rows"] <= r.n * rows_per_bucket), found[-1])
    return best.n, best.fullest * best.n / best["rows"]


def create_bucketed_tables(
    spark: SparkSession,
    database: str,
    folder: str,
    customers: DataFrame,
    products: DataFrame,
    txn: DataFrame,
    buckets: int,
    most_skew: float = 4.0,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """The three tables with customers and transactions bucketed and sorted by customer, and column statistics.

    Whatever is grouped or joined by customer then needs no shuffle of the transactions, again and again. A
    bucket is read by one task, so a customer with a large share of all rows would make one task as
    large: where the fullest bucket holds more than ``most_skew`` times the mean, the table is refused
    (``create_external_tables`` is the layout for it). ``buckets`` is the least number: it doubles until a bucket
    holds at most ``rows_per_bucket`` rows on average, so a task does not grow with the table. Months stay folders;
    each has at most as many files as there are buckets.
    """
    buckets, skew = fitting_buckets(txn.where(F.col("customer_id").isNotNull()), "customer_id", buckets, rows_per_bucket)
    if skew > most_skew:
        raise ValueError(f"a bucket would hold {skew:.1f} times the mean: too uneven for {buckets} buckets by customer_id")
    for name, df in (("customers", customers), ("products", products), ("sales_transactions", txn)):
        writer = df.write
        if name != "products":
            writer = df.repartition(buckets, "customer_id").write.bucketBy(buckets, "customer_id").sortBy("customer_id")
        if PARTITIONS[name]:
            writer = writer.partitionBy(*PARTITIONS[name])
        writer.mode("overwrite").format("parquet").option("path", f"{folder}/{name}").saveAsTable(f"`{database}`.{name}")
        spark.sql(f"ANALYZE TABLE `{database}`.{name} COMPUTE STATISTICS FOR ALL COLUMNS")


def repair_partitions(spark: SparkSession, database: str, table: str = "sales_transactions") -> DataFrame:
    """Register directories that appeared since the table was created; lists what is known."""
    spark.sql(f"MSCK REPAIR TABLE `{database}`.{table}")
    return spark.sql(f"SHOW PARTITIONS `{database}`.{table}")


def materialize(df: DataFrame, table: str, path: str | None = None) -> DataFrame:
    """Store a report as a table (create table as select) and read it back."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def row_level_filter(
    df: DataFrame, entitlements: DataFrame, user: str, column: str = "region"
) -> DataFrame:
    """Rows of the regions the entitlement table (``user_name``, ``column``) grants to ``user``.

    The regions of one user are few and broadcast; a shuffle by region would put each region's rows into one task.
    """
    granted = entitlements.where(F.col("user_name") == user).select(column).distinct()
    return df.join(F.broadcast(granted), column, "left_semi")


def create_secured_view(
    spark: SparkSession, view: str, table: str, entitlements: str, column: str = "region", user_column: str = "user_name"
) -> DataFrame:
    """A catalog view of ``table`` that shows each reader the rows its own name is granted.

    The reader is ``session_user()``, taken when the view is read, so no query can name another; a user
    without a grant sees nothing. Readers get the right to the view alone. Several grants of one region show
    a row once.
    """
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table} AS t WHERE EXISTS ("
        f"SELECT 1 FROM {entitlements} AS g WHERE g.`{column}` = t.`{column}` AND g.`{user_column}` = session_user())"
    )
    return spark.table(view)


def scoped_filter(
    txn: DataFrame,
    *,
    products: DataFrame | None = None,
    customers: DataFrame | None = None,
    rfm: DataFrame | None = None,
    years: Iterable[int] | None = None,
    regions: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    segments: Sequence[str] | None = None,
    rfm_segments: Sequence[str] | None = None,
    signup_year: int | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
) -> DataFrame:
    """The dashboards' common filters; everything left out means "all".

    Partition columns are filtered first so the scan is pruned, and dimension
    filters become semi joins that keep the fact's columns as they are.
    """
    out = txn
    if years is not None:
        out = out.where(F.col("year").isin(*years))
    bounds: list[Column] = []
    month = F.col("year") * 12 + F.col("month")  # on partition columns: exactly the months of the range are listed
    if date_from is not None:
        day = F.lit(date_from).cast("date")
        bounds += [month >= F.year(day) * 12 + F.month(day), F.col("order_date") >= day]
    if date_to is not None:
        day = F.lit(date_to).cast("date")
        bounds += [month <= F.year(day) * 12 + F.month(day), F.col("order_date") <= day]
    for b in bounds:
        out = out.where(b)
    if regions is not None:
        out = out.where(F.col("region").isin(*regions))
    if categories is not None:
        keep = products.where(F.col("category").isin(*categories)).select("product_id")
        out = out.join(keep, "product_id", "left_semi")
    if segments is not None or signup_year is not None:
        keep = customers
        if segments is not None:
            keep = keep.where(F.col("segment").isin(*segments))
        if signup_year is not None:
            keep = keep.where(F.year("signup_date") == signup_year)
        out = out.join(keep.select("customer_id"), "customer_id", "left_semi")
    if rfm_segments is not None:
        keep = rfm.where(F.col("rfm_segment").isin(*rfm_segments)).select("customer_id")
        out = out.join(keep, "customer_id", "left_semi")
    return out
