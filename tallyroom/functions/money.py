"""Money, ratio and calendar expressions; the rounding rules live here and nowhere else.

Revenue columns are DOUBLE at rest with at most two decimals.  Adding doubles in
shuffle order is not reproducible, and DECIMAL sums cost about three times as
much as integer ones, so amounts are added as whole cents in a BIGINT: exact,
order-independent, inside whole-stage codegen.  One group may total up to 9.2e16
currency units; beyond that an ANSI session raises instead of wrapping.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_TYPE = "decimal(28,10)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cents(c: str | Column) -> Column:
    """Amount in whole cents."""
    return F.rint(_col(c) * 100).cast("bigint")


def fine_sum(amount: Column) -> Column:
    """Exact sum of unrounded amounts, in 1/10000 units and with a 38-digit total."""
    return F.sum(F.rint(amount * 10_000).cast("bigint").cast("decimal(18,0)"))


def from_fine(total: str | Column) -> Column:
    return _col(total).cast("double") / F.lit(10_000.0)


def micros(c: str | Column) -> Column:
    """Rate (a discount, for example) in whole millionths."""
    return F.rint(_col(c) * 1_000_000).cast("bigint")


def usd(c: str | Column) -> Column:
    """Cents back to a DOUBLE amount."""
    return _col(c).cast("double") / F.lit(100.0)


def rounded(c: Column, digits: int = 2) -> Column:
    """Half-up rounding on the decimal form of a double, so that engines agree on ties."""
    return F.round(c.cast(RATIO_TYPE), digits).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """Double division; a zero or NULL denominator gives NULL."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    return rounded(ratio(num, den) * 100, digits)


def pct_usd(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """Percentage of two cent amounts."""
    return rounded(ratio(usd(num), usd(den)) * 100, digits)


def growth_pct(cur: str | Column, prev: str | Column, digits: int = 2) -> Column:
    """``(cur - prev) / prev * 100`` of two cent amounts."""
    return pct_usd(_col(cur) - _col(prev), prev, digits)


def per_usd(amount: str | Column, count: str | Column, digits: int = 2) -> Column:
    """Cents spread over a count, as a rounded amount."""
    return rounded(ratio(usd(amount), count), digits)


def profit_fine() -> Column:
    """Gross profit of one transaction row that has its product's ``unit_cost``, in 1/10000 units.

    The row's cost is rounded, never the unit cost: a capped or averaged unit cost
    has more than two decimals.
    """
    return cents("net_revenue") * 100 - F.rint(F.col("unit_cost") * F.col("quantity") * 10_000).cast("bigint")


def fine_cents(fine: Column) -> Column:
    """1/10000 units as exact (decimal) cents."""
    return fine.cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def profit_cents() -> Column:
    """Exact gross profit of one row, in cents."""
    return fine_cents(profit_fine())


def profit_sum() -> Column:
    """Exact gross profit of a group, in cents; up to 9.2e14 currency units a group."""
    return fine_cents(F.sum(profit_fine()))


def month_start() -> Column:
    return F.make_date("year", "month", F.lit(1))


def month_label() -> Column:
    return F.date_format(month_start(), "yyyy-MM")


def quarter_of() -> Column:
    return F.ceil(F.col("month") / F.lit(3)).cast("int")


def month_index() -> Column:
    """Months since year zero; differences are whole months."""
    return F.col("year") * 12 + F.col("month")


def discount_bucket() -> Column:
    """The five discount bands of the discount report."""
    d = F.col("discount")
    return (
        F.when(d == 0, "0% — No discount")
        .when(d <= 0.05, "1–5%")
        .when(d <= 0.10, "6–10%")
        .when(d <= 0.20, "11–20%")
        .otherwise("> 20%")
    )


def band(c: str | Column, low: float, high: float) -> Column:
    """red below ``low``, green above ``high``, amber between."""
    x = _col(c)
    return F.when(x > high, "green").when(x >= low, "amber").when(x < low, "red")
