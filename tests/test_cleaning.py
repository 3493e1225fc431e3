"""Cleaning rules on hand-made dirty rows."""

from __future__ import annotations

import datetime as dt

import pytest

from tallyroom.operators import cleaning
from tallyroom.schemas import RAW

D = dt.date


def _raw(spark, table, rows):
    names = RAW[table].fieldNames()
    data = [tuple(r.get(n) for n in names) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names) + ", ingest_seq int")


@pytest.fixture
def dirty_customers(spark):
    base = {"first_name": "A", "last_name": "B", "signup_date": "2021-03-04", "region": "West", "segment": "Corporate"}
    return _raw(
        spark,
        "customers",
        [
            {**base, "customer_id": "1", "email": " First@Example.COM "},
            {**base, "customer_id": "1", "email": "second@example.com"},
            {**base, "customer_id": None, "email": "x@example.com"},
            {**base, "customer_id": "2", "email": None},
            {**base, "customer_id": "3", "email": "c@d.com", "signup_date": "2021-13-45"},
            {**base, "customer_id": "4", "email": "c@d.com", "region": " west "},
            {**base, "customer_id": "5", "email": "c@d.com", "region": "Atlantis"},
            {**base, "customer_id": "6", "email": "c@d.com", "region": None},
            {**base, "customer_id": "7", "email": "c@d.com", "segment": "Wholesale"},
            {**base, "customer_id": "8", "email": "c@d.com", "segment": " Home Office "},
        ],
    )


def test_clean_customers(dirty_customers):
    out = {r.customer_id: r for r in cleaning.clean_customers(dirty_customers).collect()}
    assert set(out) == {"1", "4", "5", "6", "7", "8"}
    assert out["1"].email == "first@example.com"
    assert out["1"].signup_date == D(2021, 3, 4)
    assert {k: out[k].region for k in "456"} == {"4": "West", "5": "Unknown", "6": "Unknown"}
    assert out["7"].segment == "Consumer" and out["8"].segment == "Home Office"


def test_clean_customers_twice_changes_nothing(spark, dirty_customers):
    once = cleaning.clean_customers(dirty_customers)
    again = cleaning.clean_customers(
        once.withColumn("signup_date", once.signup_date.cast("string")), order=["customer_id"]
    )
    regions = {r.customer_id: r.region for r in again.collect()}
    assert regions == {r.customer_id: r.region for r in once.collect()}


def test_clean_products(spark):
    ok = {"product_name": "n", "category": "c", "unit_cost": "5", "unit_price": "10"}
    rows = [{**ok, "product_id": f"p{i}"} for i in range(8)]
    rows += [
        {**ok, "product_id": "p0", "unit_price": "99"},
        {**ok, "product_id": "noname", "product_name": None},
        {**ok, "product_id": "text", "unit_price": "abc"},
        {**ok, "product_id": "zero", "unit_price": "0"},
        {**ok, "product_id": "negative", "unit_cost": "-1"},
        {**ok, "product_id": "huge", "unit_price": "10000"},
    ]
    out = {r.product_id: r for r in cleaning.clean_products(_raw(spark, "products", rows)).collect()}
    assert set(out) == {f"p{i}" for i in range(8)} | {"huge"}
    assert out["p0"].unit_price == 10.0 and out["p0"].margin_pct == 50.0
    # nine prices, linear interpolation at 0.999 of the way
    assert out["huge"].unit_price == pytest.approx(10 + (10000 - 10) * (0.999 * 8 - 7))


@pytest.fixture
def parents(spark):
    return (
        spark.createDataFrame([("c1",)], "customer_id string"),
        spark.createDataFrame([("p1",)], "product_id string"),
    )


def test_clean_transactions(spark, parents):
    ok = {
        "customer_id": "c1",
        "product_id": "p1",
        "order_date": "2020-05-06",
        "ship_date": "2020-05-08",
        "quantity": "2",
        "unit_price": "10.5",
        "discount": "0.1",
        "region": "West",
    }
    cases = {
        "ok": {},
        "q0": {"quantity": "0"},
        "q-1": {"quantity": "-1"},
        "qx": {"quantity": "x"},
        "low": {"discount": "-0.1"},
        "high": {"discount": "1.5"},
        "none": {"discount": None},
        "early": {"ship_date": "2020-05-01"},
        "noship": {"ship_date": None},
        "badship": {"ship_date": "soon"},
        "orphan_c": {"customer_id": "zz"},
        "orphan_p": {"product_id": "zz"},
        "null_c": {"customer_id": None},
        "bad_date": {"order_date": "2020-02-31"},
    }
    rows = [{**ok, **change, "transaction_id": name} for name, change in cases.items()]
    rows.append({**ok, "transaction_id": "ok", "quantity": "9"})
    # the first row of a key decides, even when it is dropped later
    rows += [{**ok, "transaction_id": "first_bad", "quantity": "x"}, {**ok, "transaction_id": "first_bad"}]
    out = {r.transaction_id: r for r in cleaning.clean_transactions(_raw(spark, "sales_transactions", rows), *parents).collect()}
    assert set(out) == {"ok", "low", "high", "none", "early", "noship", "badship"}
    assert out["ok"].quantity == 2 and out["ok"].net_revenue == 18.9
    assert (out["ok"].year, out["ok"].month) == (2020, 5)
    assert [out[k].discount for k in ("low", "high", "none")] == [0.0, 1.0, 0.0]
    assert out["high"].net_revenue == 0.0
    assert out["early"].ship_date == D(2020, 5, 6)
    assert out["noship"].ship_date is None and out["badship"].ship_date is None


def test_cleaning_audit_counts(spark, dirty_customers, parents):
    customers = cleaning.clean_customers(dirty_customers)
    p = _raw(spark, "products", [{"product_id": "p1", "product_name": "n", "unit_cost": "1", "unit_price": "2"}])
    t = _raw(
        spark,
        "sales_transactions",
        [
            {"transaction_id": "a", "customer_id": "1", "product_id": "p1", "order_date": "2020-01-02", "ship_date": "2020-01-01", "quantity": "1", "unit_price": "2"},
            {"transaction_id": "b", "customer_id": "no", "product_id": "p1", "order_date": "2020-01-02", "quantity": "1", "unit_price": "2"},
            {"transaction_id": "b", "customer_id": "1", "product_id": "p1", "order_date": "2020-01-02", "quantity": "1", "unit_price": "2"},
        ],
    )
    rows = cleaning.cleaning_audit(dirty_customers, p, t, customers, cleaning.clean_products(p)).collect()
    got = {(r.table_name, r.step): r.rows for r in rows}
    assert got["customers", "loaded"] == 10 and got["customers", "after_dedupe"] == 9
    assert got["customers", "bad_signup_date"] == 1 and got["customers", "region_replaced"] == 2
    assert got["customers", "segment_replaced"] == 1 and got["customers", "final"] == 6
    assert got["sales_transactions", "after_dedupe"] == 2
    assert got["sales_transactions", "unknown_customer"] == 1
    assert got["sales_transactions", "ship_date_fixed"] == 1 and got["sales_transactions", "final"] == 1


def test_rounding_is_half_up_on_the_decimal_form(spark):
    from pyspark.sql import functions as F

    from tallyroom.functions.money import rounded

    df = spark.createDataFrame([(0.285,), (1.005,), (2.675,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(rounded(F.col("x"))).collect()] == [0.29, 1.01, 2.68, -2.5]
    assert df.select(rounded(F.col("x"), 0)).collect()[3][0] == -3.0


@pytest.mark.parametrize(
    ("text", "number", "whole"),
    [("3", 3.0, 3), (" 3.0 ", 3.0, 3), ("2.5", 2.5, None), ("1e2", 100.0, 100), ("-4.00", -4.0, -4), ("NaN", None, None),
     ("Infinity", None, None), ("x", None, None), ("", None, None), (None, None, None), ("99999999999", 99999999999.0, None)],
)
def test_numbers(spark, text, number, whole):
    df = spark.createDataFrame([(text, text)], "a string, b string")
    row = cleaning.coerce_numbers(df, ["a"], ["b"]).first()
    assert (row.a, row.b) == (number, whole)


@pytest.mark.parametrize(
    ("text", "day"),
    [("2020-01-05", D(2020, 1, 5)), ("2020/01/05", D(2020, 1, 5)), ("2020/1/5", D(2020, 1, 5)), ("01/25/2020", D(2020, 1, 25)),
     ("5 Jan 2020", D(2020, 1, 5)), ("2020-01-05 13:00:00", D(2020, 1, 5)), ("2021-13-45", None), ("soon", None), (None, None)],
)
def test_dates(spark, text, day):
    assert cleaning.coerce_dates(spark.createDataFrame([(text,)], "d string"), [], ["d"]).first().d == day


def test_missing_tokens_and_nan(spark):
    tokens = ["NaN", "NA", "N/A", "null", "nan", "", "n/a", "None"]
    marked = cleaning.mark_missing(spark.createDataFrame([(t, 1) for t in [*tokens, "NAN", " NA"]], "a string, b int"))
    assert [r.a for r in marked.collect()] == [None] * len(tokens) + ["NAN", " NA"]
    nan = float("nan")
    prices = spark.createDataFrame([(nan, 1.0), (1.0, nan), (2.0, 1.0)], "unit_price double, unit_cost double")
    assert [r.unit_price for r in cleaning.drop_bad_prices(prices).collect()] == [2.0]
    discounts = spark.createDataFrame([(nan,), (None,), (1.5,), (0.2,)], "discount double")
    assert [r.discount for r in cleaning.clip_discount(discounts).collect()] == [0.0, 0.0, 1.0, 0.2]


def test_tokens_through_the_transaction_rules(spark):
    base = {"customer_id": "c", "product_id": "p", "order_date": "2020/01/05", "unit_price": "10", "quantity": "3.0", "discount": "NaN"}
    raw = _raw(
        spark,
        "sales_transactions",
        [{**base, "transaction_id": "a"}, {**base, "transaction_id": "b", "quantity": "2.5"},
         {**base, "transaction_id": "c", "unit_price": "NaN"}, {**base, "transaction_id": "d", "customer_id": "NA"}],
    )
    rows = cleaning.clean_transaction_rows(cleaning.mark_missing(raw)).collect()
    assert [(r.transaction_id, r.quantity, r.discount, r.net_revenue, r.order_date) for r in rows] == [
        ("a", 3, 0.0, 30.0, D(2020, 1, 5))
    ]


def test_capped_costs_keep_their_digits_up_to_the_profit(spark, txn_of):
    """Four-decimal costs from the cap: the profit is that of decimal arithmetic."""
    from decimal import Decimal

    from tallyroom.operators import kpi

    raw = _raw(
        spark,
        "products",
        [{"product_id": f"p{i}", "product_name": "n", "category": "c", "unit_cost": c, "unit_price": "20"} for i, c in enumerate(["12.3456", "10", "11.25"])],
    )
    products = cleaning.clean_products(raw, cap_quantile=0.9)
    cost = {r.product_id: Decimal(repr(r.unit_cost)) for r in products.collect()}
    assert abs(cost["p0"] - Decimal("12.12648")) < Decimal("1e-9")  # 11.25 + 0.8 * (12.3456 - 11.25)
    rows = [{"product_id": f"p{i % 3}", "quantity": 10 + i, "net_revenue": 100.0 + i, "order_date": D(2020, 1, 1)} for i in range(9)]
    exact = sum(Decimal(str(r["net_revenue"])) - round(cost[r["product_id"]] * r["quantity"], 4) for r in rows)
    got = kpi.kpi_totals(txn_of(*rows), products).first().total_gross_profit
    assert abs(Decimal(repr(got)) - exact) < Decimal("0.0001")
