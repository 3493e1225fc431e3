from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]
# Python workers started by Spark find the package the same way
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), *filter(None, [os.environ.get("PYTHONPATH")])])

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallyroom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tallyroom-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def txn_of(spark):
    """Transactions from short tuples; every other column gets a plain default."""
    from tallyroom.schemas import SALES_TRANSACTIONS

    defaults = {
        "transaction_id": None,
        "customer_id": "c1",
        "product_id": "p1",
        "order_date": None,
        "ship_date": None,
        "quantity": 1,
        "unit_price": 10.0,
        "discount": 0.0,
        "net_revenue": 10.0,
        "region": "West",
        "year": None,
        "month": None,
    }

    def make(*rows: dict):
        out = []
        for i, r in enumerate(rows):
            full = {**defaults, "transaction_id": f"t{i:04d}", **r}
            if full["order_date"] is not None:
                full["year"], full["month"] = full["order_date"].year, full["order_date"].month
            out.append(tuple(full[f] for f in SALES_TRANSACTIONS.fieldNames()))
        return spark.createDataFrame(out, SALES_TRANSACTIONS)

    return make


@pytest.fixture
def product_of(spark):
    def make(*rows: tuple):
        return spark.createDataFrame(
            rows, "product_id string, product_name string, category string, unit_cost double, unit_price double"
        )

    return make
