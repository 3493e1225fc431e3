"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from tallyroom.functions.durable import clear_scratch
from tallyroom.plans.registry import build

HEADLINE = (
    "kpi_totals",
    "quarterly_revenue",
    "yoy_revenue",
    "days_to_ship",
    "discount_buckets",
    "monthly_sales",
    "mom_growth",
    "yoy_same_month",
    "profit_by_category",
    "profit_by_subcategory",
    "monthly_margin_by_category",
    "risky_transactions",
    "regional_summary",
    "regional_yoy",
    "top_cities_by_region",
    "market_share_by_year",
    "customer_ltv",
    "ltv_by_segment",
    "rfm_scores",
    "cohort_retention",
    "top_products",
    "top_products_by_category",
    "product_pareto",
    "product_velocity",
    "customer_ranking",
    "period_contribution",
    "order_gaps",
    "first_last_purchase",
    "dq_validity",
    "dq_scorecard",
    "clean_customers",
    "clean_transactions",
    "validate_transactions",
    "transaction_summary",
    "write_partitioned",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallyroom-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyroom-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    build("kpi_totals", spark, folder).write.format("noop").mode("overwrite").save()  # start-up and JIT
    seconds = {}
    for name in names:
        start = time.perf_counter()
        build(name, spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
