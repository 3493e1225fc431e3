"""Every operator as a query over the wholesale tables of one folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.functions import sketches
from tallyroom.functions.durable import durable, freed_shuffles, release, scratch_path
from tallyroom.operators import (
    audits,
    checks,
    cleaning,
    customer,
    kpi,
    product,
    profit,
    region,
    rollups,
    summary,
    timeseries,
    windows,
)
from tallyroom.schemas import CUSTOMERS, PRODUCTS, SALES_TRANSACTIONS
from tallyroom.sinks import writers
from tallyroom.sources import catalog, readers
from tallyroom.sources.star import Star
from tallyroom.streaming import incremental
from tallyroom.streaming.id_index import IdIndex

# The wholesale data's own domains; one region and two segments are left out on
# purpose so that the domain checks have something to report.
ALLOWED_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
ALLOWED_SEGMENTS = ("BUILDING", "HOUSEHOLD", "MACHINERY")
CLEAN_REGIONS = ("Africa", "Asia", "Middle East")
AS_OF = "2000-01-01"

Q = Callable[[Star], DataFrame]


def _customers_contract(s: Star) -> DataFrame:
    return s.customers().select(*CUSTOMERS.fieldNames())


def _stored_star(s: Star) -> str:
    """The three tables written in their curated layout; returns the folder."""
    folder = scratch_path(s.spark, "curated")
    writers.write_parquet_table(_customers_contract(s), f"{folder}/customers")
    writers.write_parquet_table(s.products().select(*PRODUCTS.fieldNames()), f"{folder}/products")
    writers.write_partitioned(
        s.transactions().select(*SALES_TRANSACTIONS.fieldNames()), f"{folder}/sales_transactions"
    )
    return folder


def _registered(s: Star) -> str:
    """A database with the three external tables over freshly written folders."""
    folder = _stored_star(s)
    database = f"tallyroom_{uuid.uuid4().hex[:12]}"
    catalog.create_database(s.spark, database, f"{folder}/db")
    catalog.create_external_tables(s.spark, database, folder)
    catalog.repair_partitions(s.spark, database)
    return database


def _read_raw_csv(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "raw")
    _customers_contract(s).write.option("header", True).csv(f"{folder}/customers")
    return readers.read_raw(s.spark, folder, "customers")


def _raw_lines(s: Star) -> DataFrame:
    """Products as lines of a CSV file without header: quoted, broken over lines, cut short and with a field too many."""
    n = F.col("p_partkey") % 5
    name = (
        F.when(n == 0, F.concat(F.lit('"'), "p_name", F.lit(' 5"", '), "p_brand", F.lit('"')))
        .when(n == 1, F.concat(F.lit('"'), "p_name", F.lit('\nsecond ""line"""')))
        .otherwise(F.col("p_name"))
    )
    head = F.concat_ws(",", F.col("p_partkey").cast("string"), name, F.concat(F.lit('"'), "p_type", F.lit(', etc"')))
    tail = F.concat_ws(",", F.lit("S"), F.lit("1.50"), F.col("p_size").cast("string"), "p_brand")
    full = F.concat_ws(",", head, tail)
    return s.table("part").select(F.when(n == 2, head).when(n == 3, F.concat(full, F.lit(",more"))).otherwise(full).alias("value"))


def _read_raw_csv_quoted(s: Star) -> DataFrame:
    """What is read of the lines above, and what is set aside with its reason."""
    folder = scratch_path(s.spark, "raw")
    _raw_lines(s).write.text(f"{folder}/products")
    good, bad = readers.split_raw(s.spark, folder, "products", multi_line=True, header=False)
    columns = ("product_id", "product_name", "category", "unit_price", "brand")
    nothing = [F.lit(None).cast("string").alias(c) for c in columns[1:]]
    return good.select(*columns, F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select(F.col("first_field").alias("product_id"), *nothing, "reason")
    )


def _read_parquet_table(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "curated")
    writers.write_parquet_table(_customers_contract(s), f"{folder}/customers")
    return readers.read_parquet_table(s.spark, folder, "customers")


def _source_views(s: Star) -> DataFrame:
    prefix = f"v{uuid.uuid4().hex[:8]}_"
    s.register_views(prefix)
    return s.spark.sql(
        f"SELECT c.segment, p.category, count(*) AS transactions "
        f"FROM {prefix}sales_transactions t JOIN {prefix}customers c USING (customer_id) "
        f"JOIN {prefix}products p USING (product_id) GROUP BY c.segment, p.category"
    )


def _write_parquet_table(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "curated")
    writers.write_parquet_table(s.products().select(*PRODUCTS.fieldNames()), f"{folder}/products")
    return readers.read_parquet_table(s.spark, folder, "products")


def _write_partitioned(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "curated")
    writers.write_partitioned(
        s.transactions().select(*SALES_TRANSACTIONS.fieldNames()), f"{folder}/sales_transactions"
    )
    return readers.read_parquet_table(s.spark, folder, "sales_transactions")


def _write_summary_json(s: Star) -> DataFrame:
    path = scratch_path(s.spark, "summary")
    writers.write_summary_json(_summary_report(s), path)
    return summary.report_rows(s.spark.read.schema(summary.REPORT).json(path))


def _clean_customers(s: Star) -> DataFrame:
    return cleaning.clean_customers(
        s.raw_customers(), regions=CLEAN_REGIONS, segments=ALLOWED_SEGMENTS, default_segment="BUILDING"
    )


def _clean_keys(s: Star) -> tuple[DataFrame, DataFrame]:
    """Cleaned customers, and the products that cleaning keeps, without their prices."""
    return _clean_customers(s), cleaning.kept_products(s.raw_products())


def _incremental_load(s: Star) -> DataFrame:
    """Two daily batches (shipped and open lines), the second delivered twice."""
    folder = scratch_path(s.spark, "incremental")
    path = f"{folder}/sales_transactions"
    customers, products = s.customers(signup=False), s.products()
    with freed_shuffles(s.spark):
        raw = durable(s.raw_transactions().withColumn("transaction_id", F.concat_ws("-", "transaction_id", "product_id")))
    shipped = raw.where(F.col("ship_date").isNotNull())
    for batch in (shipped, raw, raw):
        incremental.incremental_load(batch, customers, products, path, regions=None)
    release(raw)
    return readers.read_parquet_table(s.spark, folder, "sales_transactions")


def _indexed_load(s: Star) -> DataFrame:
    """The same batches as ``incremental_load``, looked up in the id index."""
    folder = scratch_path(s.spark, "indexed")
    path = f"{folder}/sales_transactions"
    customers, products = s.customers(signup=False), s.products()
    with freed_shuffles(s.spark):
        raw = durable(s.raw_transactions().withColumn("transaction_id", F.concat_ws("-", "transaction_id", "product_id")))
    shipped = raw.where(F.col("ship_date").isNotNull())
    ids = IdIndex(s.spark, f"{folder}/ids", keys_per_bucket=10_000)  # so that folders double on small tables
    for batch in (shipped, raw, raw):
        incremental.indexed_load(batch, customers, products, path, regions=None, index=ids)
    release(raw)
    return readers.read_parquet_table(s.spark, folder, "sales_transactions")


def _rollups(s: Star) -> rollups.Rollups:
    """Reports that followed a table through two writes: all but the late lines, then those, in their months only."""
    folder = scratch_path(s.spark, "rollups")
    table = f"{folder}/sales_transactions"
    txn, products = s.transactions().select(*SALES_TRANSACTIONS.fieldNames()), s.products()
    late = (F.col("month") == 7) & (F.col("quantity") > 40)
    writers.write_partitioned(txn.where(~late), table)
    made = rollups.Rollups(s.spark, f"{folder}/rollups")
    made.rebuild(readers.read_parquet_table(s.spark, folder, "sales_transactions"), products)
    writers.write_partitioned(txn.where(late), table, mode="append")
    now = readers.read_parquet_table(s.spark, folder, "sales_transactions")
    months = [(r.year, r.month) for r in now.where("month = 7").select("year", "month").distinct().collect()]
    made.refresh(now, products, months)
    return made


def _incremental_stream(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "stream")
    raw = s.raw_transactions().drop("ingest_seq")
    with freed_shuffles(s.spark):
        raw.write.option("header", True).option("compression", "gzip").csv(f"{folder}/inbox")
    customers, products = s.customers(signup=False), s.products()
    for _ in range(2):  # the second run finds no new file
        incremental.incremental_stream(
            s.spark,
            f"{folder}/inbox",
            customers,
            products,
            f"{folder}/sales_transactions",
            f"{folder}/progress",
            regions=None,
        ).awaitTermination()
    return readers.read_parquet_table(s.spark, folder, "sales_transactions")


def _create_database(s: Star) -> DataFrame:
    database = f"tallyroom_{uuid.uuid4().hex[:12]}"
    location = scratch_path(s.spark, "database")
    catalog.create_database(s.spark, database, location)
    return catalog.materialize(
        region.region_overview(s.transactions()), f"{database}.region_overview", f"{location}/region_overview"
    )


def _create_external_tables(s: Star) -> DataFrame:
    database = _registered(s)
    return audits.row_counts(*[s.spark.table(f"{database}.{t}") for t in ("customers", "products", "sales_transactions")])


def _repair_partitions(s: Star) -> DataFrame:
    return catalog.repair_partitions(s.spark, _registered(s))


def _materialize(s: Star) -> DataFrame:
    name = f"monthly_sales_{uuid.uuid4().hex[:12]}"
    return catalog.materialize(timeseries.monthly_sales(s.transactions(region=False)), name, scratch_path(s.spark, name))


def _row_level_filter(s: Star) -> DataFrame:
    entitlements = s._places().select(F.col("country").alias("user_name"), "region")
    seen = catalog.row_level_filter(s.transactions(), entitlements, "NATION_3")
    return region.regional_monthly(seen)


def _scoped_filter(s: Star) -> DataFrame:
    customers = s.customers()
    txn = s.transactions()
    scoped = catalog.scoped_filter(
        txn,
        products=s.products(),
        customers=customers,
        rfm=customer.rfm_scores(txn, customers),
        years=(1998, 1999, 2000),
        regions=("ASIA", "EUROPE"),
        categories=("PROMO", "SMALL", "LARGE"),
        segments=("BUILDING", "FURNITURE", "MACHINERY"),
        rfm_segments=("Champions", "Loyal Customers", "Lost"),
        signup_year=1995,
        date_from="1998-03-01",
        date_to="2000-10-31",
    )
    return region.regional_monthly(scoped)


def _dedupe_by_key(s: Star) -> DataFrame:
    return cleaning.dedupe_by_key(s.raw_transactions(), "transaction_id", ["ingest_seq"]).select(
        "transaction_id", "product_id", "quantity"
    )


def _drop_missing(s: Star) -> DataFrame:
    return cleaning.drop_missing(s.raw_customers(), ["customer_id", "email"]).select(
        F.col("ingest_seq").alias("order_key"), "customer_id", "email"
    )


def _coerce_dates(s: Star) -> DataFrame:
    return cleaning.coerce_dates(s.raw_transactions(), ["order_date"], ["ship_date"]).select(
        "transaction_id", "product_id", "order_date", "ship_date"
    )


def _coerced(s: Star) -> DataFrame:
    return cleaning.coerce_numbers(s.raw_transactions(), ["unit_price", "discount"], ["quantity"])


def _coerce_numbers(s: Star) -> DataFrame:
    return _coerced(s).select("transaction_id", "product_id", "unit_price", "discount", "quantity")


def _standardise_region(s: Star) -> DataFrame:
    return cleaning.standardise_region(s.raw_customers(), CLEAN_REGIONS).select(
        F.col("ingest_seq").alias("order_key"), "region"
    )


def _standardise_segment(s: Star) -> DataFrame:
    return cleaning.standardise_segment(s.raw_customers(), ALLOWED_SEGMENTS, "BUILDING").select(
        F.col("ingest_seq").alias("order_key"), "segment"
    )


def _normalise_email(s: Star) -> DataFrame:
    return cleaning.normalise_email(s.raw_customers()).select(F.col("ingest_seq").alias("order_key"), "email")


def _priced_products(s: Star) -> DataFrame:
    return cleaning.drop_bad_prices(cleaning.coerce_numbers(s.raw_products(), ["unit_cost", "unit_price"]))


def _shown(products: DataFrame) -> DataFrame:
    """Capped amounts to six digits: interpolation differs between engines in the last bit."""
    return products.withColumns({c: F.round(c, 6) for c in ("unit_cost", "unit_price")})


def _drop_orphans(s: Star) -> DataFrame:
    return cleaning.drop_orphans(s.loose_transactions(), s.customers(signup=False), s.products()).select(
        "transaction_id", "customer_id", "product_id"
    )


def _cleaning_audit(s: Star) -> DataFrame:
    customers, products = _clean_keys(s)
    return cleaning.cleaning_audit(
        s.raw_customers(),
        s.raw_products(),
        s.raw_transactions(),
        customers,
        products,
        regions=CLEAN_REGIONS,
        segments=ALLOWED_SEGMENTS,
    )


def _clean_transactions(s: Star) -> DataFrame:
    return cleaning.clean_transactions(s.raw_transactions(), *_clean_keys(s)).select(
        *[c for c in SALES_TRANSACTIONS.fieldNames()]
    )


def _clean_and_audit(s: Star) -> DataFrame:
    return cleaning.write_clean_transactions(
        s.raw_transactions(), *_clean_keys(s), f"{scratch_path(s.spark, 'cleaned')}/sales_transactions"
    )


def _written_clean_transactions(s: Star) -> DataFrame:
    folder = scratch_path(s.spark, "cleaned")
    cleaning.write_clean_transactions(s.raw_transactions(), *_clean_keys(s), f"{folder}/sales_transactions")
    return readers.read_parquet_table(s.spark, folder, "sales_transactions")


def _bucketed(s: Star) -> tuple[DataFrame, DataFrame]:
    """Transactions and customers of tables bucketed by customer."""
    folder = scratch_path(s.spark, "bucketed")
    database = f"tallyroom_{uuid.uuid4().hex[:12]}"
    catalog.create_database(s.spark, database, f"{folder}/db")
    txn = s.transactions().select(*SALES_TRANSACTIONS.fieldNames())
    products = s.products().select(*PRODUCTS.fieldNames())
    catalog.create_bucketed_tables(s.spark, database, folder, _customers_contract(s), products, txn, 3)
    return s.spark.table(f"{database}.sales_transactions"), s.spark.table(f"{database}.customers")


def _cap_by_sketch(s: Star) -> DataFrame:
    """Prices capped by the sketches of two loads."""
    priced = _priced_products(s)
    kept = sketches.LoadSketches(s.spark, scratch_path(s.spark, "sketches"))
    amounts = priced.select("unit_cost", "unit_price")
    kept.add(amounts.where("unit_price < 1000"), "first")
    kept.add(amounts.where("unit_price >= 1000"), "second")
    return _shown(sketches.cap_outliers(priced, sketches=kept)).select("product_id", "unit_cost", "unit_price")


def _profile_by_load(s: Star) -> DataFrame:
    """Profile merged from one sketch a year, beside the exact counts of distinct values."""
    path = scratch_path(s.spark, "loads")
    s.transactions().select(*SALES_TRANSACTIONS.fieldNames()).write.partitionBy("year").parquet(path)  # a load is a folder
    txn = s.spark.read.schema(SALES_TRANSACTIONS).parquet(path)
    kept = sketches.LoadSketches(s.spark, scratch_path(s.spark, "sketches"))
    for r in txn.select("year").distinct().collect():
        kept.add(txn.where(F.col("year") == r.year), str(r.year))
    exact = checks.column_profile(txn).select("column", F.col("unique").alias("exact"))
    # six standard errors
    close = F.abs(F.col("unique") - F.col("exact")) <= F.col("exact") * 6 * 1.04 / 2 ** (sketches.HLL_LG_K / 2)
    return kept.profile().join(exact, "column").select("column", "dtype", "null_count", "null_pct", close.alias("close"))


def _secured_view(s: Star) -> DataFrame:
    """What the session's own user may see of a stored table: two regions, one of them granted twice."""
    database = _registered(s)
    grants = s.table("region").where("r_name IN ('ASIA', 'EUROPE')").select(F.session_user().alias("user_name"), F.col("r_name").alias("region"))
    others = s.table("region").select(F.lit("somebody else").alias("user_name"), F.col("r_name").alias("region"))
    catalog.materialize(
        grants.union(grants.where("region = 'ASIA'")).union(others), f"{database}.grants", scratch_path(s.spark, "grants")
    )
    view = catalog.create_secured_view(
        s.spark, f"{database}.my_transactions", f"{database}.sales_transactions", f"{database}.grants"
    )
    return region.regional_monthly(view)


def _validation_gate(s: Star) -> DataFrame:
    results = checks.validation_results(
        s.customers(), s.products(), s.transactions(), ALLOWED_REGIONS, ALLOWED_SEGMENTS
    )
    return checks.validation_gate(results, raise_on_failure=False)


def _summary_report(s: Star) -> DataFrame:
    txn, customers = s.transactions(), s.customers()
    rfm = customer.rfm_scores(txn, customers)
    return summary.summary_report(txn, customers, s.products(), rfm, as_of=AS_OF)


def _column_profile(s: Star) -> DataFrame:
    tables = {
        "customers": _customers_contract(s),
        "products": s.products().select(*PRODUCTS.fieldNames()),
        "sales_transactions": s.transactions().select(*SALES_TRANSACTIONS.fieldNames()),
    }
    parts = [checks.column_profile(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


QUERIES: dict[str, Q] = {
    # sources, sinks, catalog
    "read_raw_csv": _read_raw_csv,
    "read_raw_csv_quoted": _read_raw_csv_quoted,
    "read_parquet_table": _read_parquet_table,
    "source_views": _source_views,
    "write_parquet_table": _write_parquet_table,
    "write_partitioned": _write_partitioned,
    "write_summary_json": _write_summary_json,
    "incremental_load": _incremental_load,
    "indexed_load": _indexed_load,
    "create_database": _create_database,
    "create_external_tables": _create_external_tables,
    "repair_partitions": _repair_partitions,
    "materialize": _materialize,
    "rollup_monthly_sales": lambda s: _rollups(s).monthly_sales(),
    "rollup_regional_summary": lambda s: _rollups(s).regional_summary(),
    "rollup_kpi_totals": lambda s: _rollups(s).kpi_totals(),
    "rollup_quarterly_revenue": lambda s: _rollups(s).quarterly_revenue(),
    "row_level_filter": _row_level_filter,
    "bucketed_customer_ltv": lambda s: customer.customer_ltv(*_bucketed(s)),
    "bucketed_cohort_retention": lambda s: customer.cohort_retention(*_bucketed(s)),
    "bucketed_rfm_scores": lambda s: customer.rfm_scores(*_bucketed(s)),
    "secured_view": _secured_view,
    "scoped_filter": _scoped_filter,
    # cleaning
    "dedupe_by_key": _dedupe_by_key,
    "drop_missing": _drop_missing,
    "coerce_dates": _coerce_dates,
    "coerce_numbers": _coerce_numbers,
    "standardise_region": _standardise_region,
    "standardise_segment": _standardise_segment,
    "normalise_email": _normalise_email,
    "drop_bad_prices": lambda s: _priced_products(s).select("product_id", "unit_cost", "unit_price"),
    "cap_outliers": lambda s: _shown(cleaning.cap_outliers(_priced_products(s))).select(
        "product_id", "unit_cost", "unit_price"
    ),
    "cap_outliers_by_sketch": _cap_by_sketch,
    "derive_margin_pct": lambda s: cleaning.derive_margin_pct(s.products().drop("margin_pct")).select(
        "product_id", "margin_pct"
    ),
    "drop_orphans": _drop_orphans,
    "filter_positive_quantity": lambda s: cleaning.filter_positive_quantity(_coerced(s)).select(
        "transaction_id", "product_id", "quantity"
    ),
    "clip_discount": lambda s: cleaning.clip_discount(_coerced(s)).select("transaction_id", "product_id", "discount"),
    "fix_ship_date": lambda s: cleaning.fix_ship_date(s.transactions(region=False)).select(
        "transaction_id", "order_date", "ship_date"
    ),
    "derive_net_revenue": lambda s: cleaning.derive_net_revenue(s.transactions(region=False).drop("net_revenue")).select(
        "transaction_id", "net_revenue"
    ),
    "derive_partitions": lambda s: cleaning.derive_partitions(s.transactions(region=False).drop("year", "month")).select(
        "transaction_id", "year", "month"
    ),
    "clean_customers": _clean_customers,
    "clean_products": lambda s: _shown(cleaning.clean_products(s.raw_products())),
    "clean_transactions": _clean_transactions,
    "cleaning_audit": _cleaning_audit,
    "clean_and_audit": _clean_and_audit,
    "written_clean_transactions": _written_clean_transactions,
    # audits
    "row_counts": lambda s: audits.row_counts(s.customers(signup=False), s.products(), s.transactions(region=False)),
    "null_audit_customers": lambda s: audits.null_audit(s.customers(), audits.NULL_AUDIT["customers"]),
    "null_audit_products": lambda s: audits.null_audit(s.products(), audits.NULL_AUDIT["products"]),
    "null_audit_transactions": lambda s: audits.null_audit(
        s.transactions(region=False), audits.NULL_AUDIT["sales_transactions"]
    ),
    # raw tables repeat their keys, the curated ones do not
    "duplicate_keys_customers": lambda s: audits.duplicate_keys(s.raw_customers(), "customer_id"),
    "duplicate_keys_products": lambda s: audits.duplicate_keys(s.offers(), "product_id"),
    "duplicate_keys_transactions": lambda s: audits.duplicate_keys(s.raw_transactions(), "transaction_id"),
    "orphan_customers": lambda s: audits.orphan_count(
        s.loose_transactions(),
        s.customers(signup=False),
        "customer_id",
        "orphan_customer_count",
    ),
    "orphan_products": lambda s: audits.orphan_count(
        s.loose_transactions(),
        s.products(),
        "product_id",
        "orphan_product_count",
    ),
    "invalid_regions": lambda s: audits.invalid_values(s.transactions(), "region", ALLOWED_REGIONS, "invalid_region"),
    "invalid_segments": lambda s: audits.invalid_values(
        s.customers(signup=False), "segment", ALLOWED_SEGMENTS, "invalid_segment"
    ),
    "invalid_discounts": lambda s: audits.invalid_discounts(_coerced(s)),
    "invalid_quantities": lambda s: audits.invalid_quantities(_coerced(s)),
    "ship_before_order": lambda s: audits.ship_before_order(s.transactions(region=False)),
    "partition_coverage": lambda s: audits.partition_coverage(s.transactions(region=False)),
    "dq_completeness": lambda s: audits.dq_completeness(
        s.customers(signup=False), s.products(), s.transactions(region=False)
    ),
    "dq_uniqueness": lambda s: audits.dq_uniqueness(s.raw_customers(), s.products(), s.raw_transactions()),
    "dq_validity": lambda s: audits.dq_validity(s.products(), s.transactions(region=False)),
    "dq_temporal": lambda s: audits.dq_temporal(s.customers(), s.transactions(region=False), AS_OF),
    "dq_domain": lambda s: audits.dq_domain(
        s.customers(signup=False), s.transactions(), ALLOWED_REGIONS, ALLOWED_SEGMENTS
    ),
    "dq_referential": lambda s: audits.dq_referential(
        s.customers(signup=False), s.products(), s.transactions(region=False)
    ),
    "dq_outliers": lambda s: audits.dq_outliers(s.transactions(region=False), 2.0),
    "dq_freshness": lambda s: audits.dq_freshness(s.transactions(region=False)),
    "dq_email_format": lambda s: audits.dq_email_format(s.customers(signup=False)),
    "dq_scorecard": lambda s: audits.dq_scorecard(
        s.customers(signup=False), s.products(), s.transactions(region=False)
    ),
    # check library
    "check_not_empty": lambda s: checks.check_not_empty(s.transactions(region=False), "transactions"),
    "check_no_nulls": lambda s: checks.check_no_nulls(
        s.raw_transactions(), "transactions", ["customer_id", "ship_date", "discount", "net_revenue"], 0.4
    ),
    "check_unique": lambda s: checks.check_unique(s.raw_transactions(), "transactions", "transaction_id"),
    "check_domain": lambda s: checks.check_domain(s.customers(signup=False), "customers", "region", ALLOWED_REGIONS),
    "check_range": lambda s: checks.check_range(s.raw_transactions(), "transactions", "quantity", 1, 40),
    "check_referential": lambda s: checks.check_referential(
        s.loose_transactions(),
        "transactions",
        "customer_id",
        s.customers(signup=False),
        "customers",
    ),
    "check_date_order": lambda s: checks.check_date_order(
        s.transactions(region=False), "transactions", "order_date", "ship_date"
    ),
    "check_stat": lambda s: checks.check_stat(s.transactions(region=False), "transactions", "quantity", 1.0, 4.0),
    "validate_customers": lambda s: checks.validate_customers(s.customers(), ALLOWED_REGIONS, ALLOWED_SEGMENTS),
    "validate_products": lambda s: checks.validate_products(s.products()),
    "validate_transactions": lambda s: checks.validate_transactions(
        s.transactions(), s.customers(signup=False), s.products(), ALLOWED_REGIONS
    ),
    "validation_gate": _validation_gate,
    "column_profile": _column_profile,
    "profile_by_load": _profile_by_load,
    # headline figures
    "kpi_totals": lambda s: kpi.kpi_totals(s.transactions(region=False), s.products()),
    "quarterly_revenue": lambda s: kpi.quarterly_revenue(s.transactions(region=False)),
    "yoy_revenue": lambda s: kpi.yoy_revenue(s.transactions(region=False)),
    "days_to_ship": lambda s: kpi.days_to_ship(s.transactions()),
    "discount_buckets": lambda s: kpi.discount_buckets(s.transactions(region=False), s.products()),
    "kpi_year_cards": lambda s: kpi.kpi_year_cards(s.transactions(region=False), s.products()),
    "kpi_year_cards_same_period": lambda s: kpi.kpi_year_cards(
        s.transactions(region=False), s.products(), as_of="2000-06-30"
    ),
    "kpi_alerts": lambda s: kpi.kpi_alerts(cleaning.fix_ship_date(s.transactions()), s.products()),
    "qoq_revenue": lambda s: kpi.qoq_revenue(s.transactions(region=False)),
    "cagr_by_region": lambda s: kpi.cagr_by_region(s.transactions()),
    "predicted_ltv": lambda s: kpi.predicted_ltv(s.transactions(region=False)),
    "fourth_quarter_share": lambda s: kpi.fourth_quarter_share(s.transactions(region=False)),
    "top_customer_share": lambda s: kpi.top_customer_share(s.transactions(region=False)),
    "negative_margin_share": lambda s: kpi.negative_margin_share(s.transactions(region=False), s.products()),
    # time series
    "monthly_sales": lambda s: timeseries.monthly_sales(s.transactions(region=False)),
    "mom_growth": lambda s: timeseries.mom_growth(s.transactions(region=False)),
    "yoy_same_month": lambda s: timeseries.yoy_same_month(s.transactions(region=False)),
    "quarterly_ytd": lambda s: timeseries.quarterly_ytd(s.transactions(region=False)),
    "monthly_revenue_simple": lambda s: timeseries.monthly_revenue_simple(s.transactions(region=False)),
    "monthly_profit_trend": lambda s: timeseries.monthly_profit_trend(s.transactions(region=False), s.products()),
    "quarter_by_year": lambda s: timeseries.quarter_by_year(s.transactions(region=False)),
    # profitability
    "profit_by_category": lambda s: profit.profit_by_category(s.transactions(region=False), s.products()),
    "profit_by_subcategory": lambda s: profit.profit_by_subcategory(s.transactions(region=False), s.products()),
    "monthly_margin_by_category": lambda s: profit.monthly_margin_by_category(
        s.transactions(region=False), s.products()
    ),
    "risky_transactions": lambda s: profit.risky_transactions(s.transactions(region=False), s.products()),
    "margin_bands": lambda s: profit.margin_bands(s.transactions(region=False), s.products()),
    "discount_margin_by_category": lambda s: profit.discount_margin_by_category(
        s.transactions(region=False), s.products()
    ),
    "category_share": lambda s: profit.category_share(s.transactions(region=False), s.products()),
    # regions
    "regional_summary": lambda s: region.regional_summary(s.transactions(), s.products()),
    "regional_yoy": lambda s: region.regional_yoy(s.transactions()),
    "region_years": lambda s: region.region_years(s.transactions()),
    "top_cities_by_region": lambda s: region.top_cities_by_region(
        s.transactions(region=False, order_key=True), s.customers(signup=False), within=["order_key"]
    ),
    "regional_monthly": lambda s: region.regional_monthly(s.transactions()),
    "market_share_by_year": lambda s: region.market_share_by_year(s.transactions()),
    "market_share_by_month": lambda s: region.market_share_by_month(s.transactions()),
    "regional_monthly_vs_average": lambda s: region.regional_monthly_vs_average(s.transactions()),
    "profit_matrix": lambda s: region.profit_matrix(s.transactions(), s.products()),
    "profit_matrix_bands": lambda s: region.profit_matrix_bands(s.transactions(), s.products()),
    "region_discount_vs_margin": lambda s: region.region_discount_vs_margin(s.transactions(), s.products()),
    "region_growth_table": lambda s: region.region_growth_table(s.transactions()),
    "region_cards": lambda s: region.region_cards(s.transactions()),
    "drill_region_city_customer": lambda s: region.drill_region_city_customer(
        s.transactions(region=False), s.customers(signup=False)
    ),
    # customers
    "customer_ltv": lambda s: customer.customer_ltv(s.transactions(region=False), s.customers()),
    "ltv_by_segment": lambda s: customer.ltv_by_segment(
        s.transactions(region=False), s.customers(signup=False), with_orders=True
    ),
    "rfm_scores": lambda s: customer.rfm_scores(s.transactions(region=False), s.customers(signup=False)),
    "rfm_scores_sql": lambda s: customer.rfm_scores_sql(s.transactions(region=False), s.customers(signup=False)),
    "rfm_scores_quantile": lambda s: customer.rfm_scores_quantile(s.transactions(region=False)),
    "cohort_retention": lambda s: customer.cohort_retention(s.transactions(region=False), s.customers()),
    "cohort_grid": lambda s: customer.cohort_grid(s.transactions(region=False), s.customers()),
    "new_vs_returning": lambda s: customer.new_vs_returning(s.transactions(region=False)),
    "rfm_segment_summary": lambda s: customer.rfm_segment_summary(
        customer.rfm_scores(s.transactions(region=False), s.customers(signup=False))
    ),
    "rfm_bubbles": lambda s: customer.rfm_bubbles(
        customer.rfm_scores(s.transactions(region=False), s.customers(signup=False))
    ),
    "ltv_histogram": lambda s: customer.ltv_histogram(s.transactions(region=False), s.customers(signup=False)),
    "top_customers": lambda s: customer.top_customers(s.transactions(region=False), s.customers(signup=False)),
    "customer_geography": lambda s: customer.customer_geography(
        s.transactions(region=False), s.customers(signup=False)
    ),
    "customer_cards": lambda s: customer.customer_cards(s.transactions(region=False)),
    "customer_revenue_share": lambda s: customer.customer_revenue_share(s.transactions(region=False)),
    "customer_features": lambda s: customer.customer_features(s.transactions(region=False)),
    # products
    "top_products": lambda s: product.top_products(s.transactions(region=False), s.products()),
    "top_products_by_category": lambda s: product.top_products_by_category(s.transactions(region=False), s.products()),
    "product_pareto": lambda s: product.product_pareto(s.transactions(region=False), s.products()),
    "drill_category_product": lambda s: product.drill_category_product(s.transactions(region=False), s.products()),
    "product_velocity": lambda s: product.product_velocity(s.transactions(region=False), s.products()),
    "top10_products_table": lambda s: product.top10_products_table(s.transactions(region=False), s.products()),
    # windows
    "running_totals": lambda s: windows.running_totals(s.transactions(region=False)),
    "moving_average_3m": lambda s: windows.moving_average_3m(s.transactions(region=False)),
    "customer_ranking": lambda s: windows.customer_ranking(s.transactions(region=False)),
    "period_contribution": lambda s: windows.period_contribution(s.transactions()),
    "order_gaps": lambda s: windows.order_gaps(s.transactions(region=False)),
    "first_last_purchase": lambda s: windows.first_last_purchase(s.transactions(region=False)),
    "revenue_ntiles": lambda s: windows.revenue_ntiles(s.transactions()),
    # summaries
    "customer_summary": lambda s: summary.customer_summary(s.customers()),
    "product_summary": lambda s: summary.product_summary(s.products()),
    "transaction_summary": lambda s: summary.transaction_summary(
        s.transactions(), s.customers(signup=False), s.products()
    ),
    "enrich_transactions": lambda s: summary.enrich_transactions(
        s.transactions(), s.customers(signup=False), s.products()
    ),
    "summary_report": lambda s: summary.report_rows(_summary_report(s)),
    "revenue_overview": lambda s: kpi.revenue_overview(s.transactions(region=False)),
    "region_overview": lambda s: region.region_overview(s.transactions()),
    "category_margin": lambda s: profit.category_margin(s.transactions(region=False), s.products()),
    "segment_overview": lambda s: customer.segment_overview(
        s.transactions(region=False, order_key=True), s.customers(signup=False), within=["order_key"]
    ),
    "discount_distribution": lambda s: profit.discount_distribution(s.transactions(region=False)),
    "discount_margin": lambda s: profit.discount_margin(s.transactions(region=False), s.products()),
    "yearly_by_region": lambda s: region.yearly_by_region(s.transactions()),
    "integrity_summary": lambda s: audits.integrity_summary(
        s.customers(signup=False), s.products(), s.transactions(region=False)
    ),
    # streaming
    "incremental_stream": _incremental_stream,
}


def build(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES[name](Star(spark, folder))
