"""Check library: NULL policies, missing columns, suites and the gate."""

from __future__ import annotations

import pytest

from tallyroom.operators import audits, checks


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [("a", "West", "5"), ("a", "Mars", "x"), (None, None, None), ("b", "West", "50")],
        "k string, region string, q string",
    )


def _row(d):
    rows = d.collect()
    assert len(rows) == 1
    return rows[0]


def test_unique_counts_null_keys(df):
    r = _row(checks.check_unique(df, "t", "k"))
    assert (r.passed, r.violations, r.details) == (False, 2, "duplicates=2")


def test_domain_null_policy(df):
    assert _row(checks.check_domain(df, "t", "region", ["West"])).violations == 2
    assert _row(checks.check_domain(df, "t", "region", ["West"], nulls="ignore")).violations == 1
    assert audits.invalid_values(df, "region", ["West"], "bad").count() == 1


def test_range_null_policy_and_text(df):
    assert _row(checks.check_range(df, "t", "q", 1, 10)).violations == 3
    r = _row(checks.check_range(df, "t", "q", 1, 10, nulls="ignore"))
    assert r.violations == 1 and r.check_name == "t.q: range [1, 10]"


def test_nulls_threshold_and_missing_column(df):
    got = {r.check_name: r for r in checks.check_no_nulls(df, "t", ["k", "zz"], 0.3).collect()}
    assert got["t.k: null rate ≤ 30%"].passed
    assert got["t.k: null rate ≤ 30%"].details == "null_rate=25.0000%"
    assert not got["t.zz: column exists"].passed
    assert not _row(checks.check_range(df, "t", "zz", 1)).passed


def test_not_empty(df):
    assert _row(checks.check_not_empty(df, "t")).passed
    assert not _row(checks.check_not_empty(df.limit(0), "t")).passed


def test_referential_counts_null_as_orphan(spark, df):
    parent = spark.createDataFrame([("a",)], "k string")
    assert _row(checks.check_referential(df, "t", "k", parent, "p")).violations == 2


def test_stat(spark, df):
    r = _row(checks.check_stat(df, "t", "q", 1.0, 30.0))
    assert r.passed and r.details == "mean=27.5000"


def test_gate(spark, df):
    results = checks.check_unique(df, "t", "k").unionByName(checks.check_not_empty(df, "t"))
    with pytest.raises(checks.ValidationFailed, match="1/2 checks passed, 1 FAILED"):
        checks.validation_gate(results)
    assert checks.validation_gate(results, raise_on_failure=False).count() == 2
    good = checks.check_not_empty(df, "t")
    assert checks.validation_gate(good).first().summary == "1/1 checks passed"


def test_profile_exact_and_approximate(df):
    exact = {r.column: (r.null_count, r.unique) for r in checks.column_profile(df).collect()}
    assert exact == {"k": (1, 2), "region": (1, 2), "q": (1, 3)}
    approx = {r.column: (r.null_count, r.unique) for r in checks.column_profile(df, approximate=True).collect()}
    assert approx == exact


def test_outliers_need_a_deviation(txn_of):
    import datetime as dt

    day = dt.date(2020, 1, 1)
    assert audits.dq_outliers(txn_of({"order_date": day})).count() == 0
    many = [{"order_date": day, "net_revenue": 10.0 + i % 2} for i in range(50)]
    found = audits.dq_outliers(txn_of(*many, {"order_date": day, "net_revenue": 500.0})).collect()
    assert [r.net_revenue for r in found] == [500.0] and found[0].z_score > 4


def test_email_dot_is_literal(spark):
    df = spark.createDataFrame([("1", "a@bxcom"), ("2", "a@b.com"), ("3", "A@b.com")], "customer_id string, email string")
    assert sorted(r.customer_id for r in audits.dq_email_format(df).collect()) == ["1", "3"]
