"""Every registered query equals its independent SQL on the small wholesale tables."""

from __future__ import annotations

import pytest
from compare import difference, duck
from conftest import SMALL

import __spark_entry__ as entry_point

from tallyroom.plans.oracle import ORACLE as SQL  # noqa: E402
from tallyroom.plans.registry import QUERIES as NAMES  # noqa: E402
from tallyroom.plans.registry import _summary_report  # noqa: E402
from tallyroom.sinks import writers  # noqa: E402
from tallyroom.sources.star import Star  # noqa: E402

QUERIES = {name: entry_point.queries()[name] for name in NAMES}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql_or_is_named_here():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(entry_point.oracle_sql())


def test_entry(spark):
    row = entry_point.entry(spark).collect()
    assert len(row) == 1 and row[0].total_orders == 6000


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SMALL), con, SQL[name]) is None


def test_summary_report_agrees_with_its_parts(spark):
    row = _summary_report(Star(spark, SMALL)).first()
    totals = QUERIES["kpi_totals"](spark, SMALL).first()
    assert float(row.transactions["total_revenue"][""]) == totals.total_revenue
    assert float(row.transactions["gross_margin_pct"][""]) == totals.gross_margin_pct
    segments = {r.rfm_segment: r.customer_count for r in QUERIES["rfm_segment_summary"](spark, SMALL).collect()}
    assert row.rfm_segments == segments
    assert row.generated_at == "2000-01-01"


def test_summary_json_is_one_document(spark, tmp_path):
    import json

    writers.write_summary_json(_summary_report(Star(spark, SMALL)), str(tmp_path / "report"))
    lines = spark.read.text(str(tmp_path / "report")).collect()
    assert len(lines) == 1
    doc = json.loads(lines[0].value)
    assert set(doc) == {"generated_at", "customers", "products", "transactions", "rfm_segments"}
    assert len(doc["transactions"]["top_5_products_by_revenue"]) == 5
