"""Report semantics on tiny tables: gaps, ties, zero revenue, single rows, optional parameters."""

from __future__ import annotations

import datetime as dt

import pytest

from tallyroom.operators import customer, kpi, product, profit, region, summary, timeseries, windows

D = dt.date


@pytest.fixture
def gap_months(txn_of):
    return txn_of(
        {"order_date": D(2020, 1, 5), "net_revenue": 100.0},
        {"order_date": D(2020, 3, 5), "net_revenue": 150.0},
        {"order_date": D(2021, 3, 5), "net_revenue": 300.0},
    )


def test_mom_takes_the_previous_existing_month(gap_months):
    assert [r.mom_growth_pct for r in timeseries.mom_growth(gap_months).collect()] == [None, 50.0, 100.0]


def test_yoy_same_month_needs_the_very_month(gap_months):
    assert [r.yoy_same_month_growth_pct for r in timeseries.yoy_same_month(gap_months).collect()] == [None, None, 100.0]


def test_yoy_skips_a_missing_year(txn_of):
    t = txn_of({"order_date": D(2018, 1, 1)}, {"order_date": D(2020, 1, 1)}, {"order_date": D(2021, 1, 1)})
    assert [r.prev_year_revenue for r in kpi.yoy_revenue(t).collect()] == [None, None, 10.0]


def test_zero_revenue_gives_null_ratios(txn_of, product_of):
    t = txn_of({"order_date": D(2020, 1, 1), "net_revenue": 0.0, "discount": 1.0})
    p = product_of(("p1", "n", "c", 4.0, 10.0))
    row = kpi.kpi_totals(t, p).first()
    assert row.gross_margin_pct is None and row.total_gross_profit == -4.0 and row.avg_order_value == 0.0
    assert profit.category_share(t, p).first().revenue_share_pct is None


def test_empty_tables(txn_of, product_of):
    t = txn_of({"order_date": D(2020, 1, 1)}).limit(0)
    p = product_of(("p1", "n", "c", 4.0, 10.0))
    assert kpi.kpi_totals(t, p).first().total_orders == 0
    assert timeseries.monthly_sales(t).count() == 0
    assert windows.customer_ranking(t).count() == 0


def test_single_customer_ranks(txn_of):
    row = windows.customer_ranking(txn_of({"order_date": D(2020, 1, 1)})).first()
    assert (row.rank, row.row_num, row.percentile_rank, row.decile) == (1, 1, 0.0, 1)


def test_rfm_directions(spark, txn_of):
    """Ten customers, c9 newest, most frequent and best spending."""
    rows = []
    for i in range(10):
        rows += [{"customer_id": f"c{i}", "order_date": D(2020, 1 + i, 1), "net_revenue": 10.0 * (i + 1)}] * (i + 1)
    rows = [{**r, "transaction_id": f"t{j}"} for j, r in enumerate(rows)]
    t = txn_of(*rows)
    c = spark.createDataFrame([(f"c{i}", "s", "West") for i in range(10)], "customer_id string, segment string, region string")
    best = {r.customer_id: r for r in customer.rfm_scores(t, c, ranges=4).collect()}
    literal = {r.customer_id: r for r in customer.rfm_scores_sql(t, c, ranges=4).collect()}
    cut = {r.customer_id: r for r in customer.rfm_scores_quantile(t, ranges=4).collect()}
    assert best["c9"].rfm_total == 15 and best["c9"].rfm_segment == "Champions"
    assert best["c0"].rfm_total == 3 and best["c0"].rfm_segment == "Lost"
    assert literal["c9"].rfm_total == 3 and literal["c0"].rfm_total == 15
    assert cut["c9"].rfm_total == 15 and cut["c0"].rfm_total == 3


def test_order_gaps_with_next_and_limit(txn_of):
    t = txn_of(
        {"order_date": D(2020, 1, 1)},
        {"order_date": D(2020, 1, 1)},
        {"order_date": D(2020, 1, 4)},
        {"order_date": D(2020, 1, 9), "customer_id": "c2"},
    )
    rows = windows.order_gaps(t, with_next=True).orderBy("order_date").collect()
    assert [(r.prev_order_date, r.next_order_date, r.days_since_last_order) for r in rows] == [
        (D(2020, 1, 1), D(2020, 1, 4), 0),
        (D(2020, 1, 1), None, 3),
    ]
    assert windows.order_gaps(t, limit=1).count() == 1
    assert windows.first_last_purchase(t, limit=1).first().customer_id == "c1"


def test_velocity_window_literal_and_exact(txn_of, product_of):
    months = [D(2019, 12, 1), D(2020, 1, 1), D(2020, 2, 1), D(2021, 1, 1)]
    t = txn_of(*[{"order_date": d} for d in months])
    p = product_of(("p1", "n", "c", 4.0, 10.0))
    # literal: newest year 2021 with the highest month of any year (12) -> starts 2020-12
    assert product.product_velocity(t, p).first().months_with_sales == 1
    # exact: the twelve months up to 2021-01
    assert product.product_velocity(t, p, exact=True).first().units_last_12_months == 2


def test_risky_transactions_without_cut(txn_of, product_of):
    rows = [{"order_date": D(2020, 1, 1), "discount": 0.3, "net_revenue": 1.0}] * 120
    t = txn_of(*[{**r, "transaction_id": f"t{i}"} for i, r in enumerate(rows)])
    p = product_of(("p1", "n", "c", 4.0, 10.0))
    assert profit.risky_transactions(t, p).count() == 100
    assert profit.risky_transactions(t, p, worst=None).count() == 120


def test_shares_add_up_and_retention_is_bounded(spark):
    from conftest import SMALL

    from tallyroom.plans.registry import build

    shares = [r.revenue_share_pct for r in build("regional_summary", spark, SMALL).collect()]
    assert sum(shares) == pytest.approx(100, abs=0.05)
    assert all(0 < r.retention_pct <= 100 for r in build("cohort_retention", spark, SMALL).collect())
    run = build("running_totals", spark, SMALL).collect()
    assert run[-1].running_total == build("kpi_totals", spark, SMALL).first().total_revenue


def test_region_cards_filter_and_growth(txn_of):
    t = txn_of(
        {"order_date": D(2020, 1, 1), "ship_date": D(2020, 1, 3), "net_revenue": 100.0},
        {"order_date": D(2022, 1, 1), "net_revenue": 121.0},
        {"order_date": D(2022, 1, 1), "region": "Midwest"},
    )
    cards = region.region_cards(t, ["West"]).collect()
    assert len(cards) == 1 and cards[0].avg_days_to_ship == 2.0 and cards[0].yoy_growth_pct is None
    growth = {r.region: r.cagr_pct for r in kpi.cagr_by_region(t).collect()}
    assert growth == {"West": 10.0, "Midwest": None}


def test_predicted_ltv_uses_the_lifespan(txn_of):
    t = txn_of({"order_date": D(2020, 1, 1), "net_revenue": 50.0})
    assert kpi.predicted_ltv(t, lifespan_years=4).first().predicted_ltv == 200.0


def test_summary_ignores_missing_keys(spark):
    c = spark.createDataFrame(
        [("1", None, "West", D(2020, 1, 1)), ("2", "A", None, D(2020, 1, 2))],
        "customer_id string, segment string, region string, signup_date date",
    )
    got = {(r.metric, r.key): (r.value, r.text) for r in summary.customer_summary(c).collect()}
    assert got["total_customers", ""] == (2.0, None)
    assert got["signup_date_max", ""] == (None, "2020-01-02")
    assert got["segment_distribution", "A"] == (1.0, None) and ("segment_distribution", None) not in got


def test_histogram_with_one_value(spark, txn_of):
    c = spark.createDataFrame([("c1", "s")], "customer_id string, segment string")
    row = customer.ltv_histogram(txn_of({"order_date": D(2020, 1, 1)}), c).first()
    assert (row.bin, row.customer_count, row.median_ltv) == (1, 1, 10.0)


def test_declared_unique_keys_are_counted_without_a_shuffle(spark):
    from conftest import SMALL

    from tallyroom.functions.measures import declare_unique
    from tallyroom.sources.star import Star

    star = Star(spark, SMALL)
    txn, products = star.transactions(), star.products()
    marked = declare_unique(txn)
    for report in (region.regional_monthly, timeseries.monthly_sales, customer.customer_features):
        assert sorted(report(marked).collect()) == sorted(report(txn).collect())
    plain = region.regional_summary(marked, products)
    assert sorted(plain.collect()) == sorted(region.regional_summary(txn, products).collect())
    products = declare_unique(products, "product_id")
    assert "transaction_id" not in kpi.kpi_totals(marked, products)._jdf.queryExecution().executedPlan().toString().split("Exchange")[1]


def test_a_repeated_dimension_key_counts_no_order_twice(spark, txn_of, product_of):
    from tallyroom.functions.measures import declare_unique

    txn = declare_unique(txn_of(*[{"product_id": "a", "order_date": D(2020, 1, 1)}] * 3))
    products = product_of(("a", "A", "x", 1.0, 2.0), ("a", "A again", "x", 1.0, 2.0))
    assert kpi.kpi_totals(txn, products).first().total_orders == 3
    assert timeseries.monthly_profit_trend(txn, products).first().orders == 3


def test_same_period_cards(txn_of, product_of):
    rows = [(2019, 3, 10.0), (2019, 9, 90.0), (2020, 3, 20.0)]
    txn = txn_of(*[{"order_date": D(y, m, 1), "net_revenue": v, "product_id": "a"} for y, m, v in rows])
    cards = kpi.kpi_year_cards(txn, product_of(("a", "A", "x", 1.0, 2.0)), as_of="2020-06-30").collect()
    assert [(r.year, r.total_revenue, r.yoy_growth_pct) for r in cards] == [(2019, 10.0, None), (2020, 20.0, 100.0)]


def test_wide_reports_have_every_column_or_refuse(spark, txn_of, product_of):
    from tallyroom.operators import region

    txn = txn_of(
        {"product_id": "a", "order_date": dt.date(2020, 1, 1)},
        {"product_id": "b", "order_date": dt.date(2031, 1, 1)},
    )
    products = product_of(("a", "A", "old", 1.0, 2.0), ("b", "B", "brand new", 1.0, 2.0))
    assert set(region.profit_matrix(txn, products).columns) == {"region", "old", "brand new"}
    assert {"revenue_2020", "revenue_2031"} <= set(region.region_growth_table(txn).columns)
    with pytest.raises(Exception, match="category not listed: brand new"):
        region.profit_matrix(txn, products, ["old"]).collect()
    with pytest.raises(Exception, match="year not listed: 2031"):
        region.region_growth_table(txn, [2020]).collect()


def test_orders_shared_by_customers_of_a_group_count_once(spark, txn_of):
    from tallyroom.functions.measures import declare_unique
    from tallyroom.operators import customer, region

    who = spark.createDataFrame(
        [("a", "West", "X", "S"), ("b", "West", "X", "S"), ("c", "West", "Y", None)],
        "customer_id string, region string, city string, segment string",
    )
    rows = [("a", "t1"), ("a", "t1"), ("a", "t2"), ("b", "t1"), ("b", "t3"), ("c", "t1")]
    txn = txn_of(*[{"customer_id": c, "transaction_id": t} for c, t in rows])
    assert {r.city: (r.orders, r.revenue) for r in region.top_cities_by_region(txn, who).collect()} == {"X": (3, 50.0), "Y": (1, 10.0)}
    got = {r.segment: (r.orders, r.customers) for r in customer.segment_overview(txn, who).collect()}
    assert got == {"S": (3, 2), None: (1, 1)}
    unique = declare_unique(txn_of(*[{"customer_id": c} for c, _ in rows]))
    assert {r.segment: r.orders for r in customer.segment_overview(unique, who).collect()} == {"S": 5, None: 1}
