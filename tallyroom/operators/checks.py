"""Reusable validation checks, the table suites and the publishing gate.

Every check becomes one ``(check_name, passed, violations, details)`` row.  All
row-wise checks of a table are evaluated in a single aggregate; uniqueness and
references, which need a shuffle of their own, group the key before anything
else so a hot key is one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.schemas import REGIONS, SEGMENTS

RESULT = "check_name string, passed boolean, violations bigint, details string"


class ValidationFailed(RuntimeError):
    """Raised by the gate; carries the failed rows' names."""


@dataclass(frozen=True)
class Check:
    """A row-wise check: an aggregate for violations and one for the detail text."""

    name: str
    violations: Column
    details: Column


def _count(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _text(x: Column, type_: str) -> Column:
    return x.cast(type_).cast("string")


def not_empty(table: str) -> Check:
    rows = F.count(F.lit(1))
    return Check(
        f"{table}: not empty",
        F.when(rows == 0, 1).otherwise(0),
        F.concat(F.lit("rows="), rows.cast("string")),
    )


def no_nulls(table: str, column: str, threshold: float = 0.0) -> Check:
    """Share of NULLs at most ``threshold``; an empty table passes."""
    nulls, rows = _count(F.col(column).isNull()), F.count(F.lit(1))
    rate = F.coalesce(F.try_divide(nulls.cast("double"), rows.cast("double")), F.lit(0.0))
    return Check(
        f"{table}.{column}: null rate ≤ {threshold:.0%}",
        F.when(rate > threshold, nulls).otherwise(0),
        F.concat(F.lit("null_rate="), _text(rate * 100, "decimal(9,4)"), F.lit("%")),
    )


def in_domain(table: str, column: str, valid: Sequence[str], nulls: str = "violation") -> Check:
    """Values outside ``valid``; NULL is a violation or, as SQL has it, ignored."""
    bad = ~F.col(column).isin(*valid)
    n = _count(F.coalesce(bad, F.lit(nulls == "violation")))
    return Check(f"{table}.{column}: domain valid", n, F.concat(F.lit("invalid_count="), n.cast("string")))


def in_range(
    table: str,
    column: str,
    low: float | None = None,
    high: float | None = None,
    nulls: str = "violation",
) -> Check:
    """Values outside [low, high]; NULL and unreadable numbers are violations or ignored."""
    x = F.expr(f"try_cast({column} AS double)")
    bad = F.lit(False)
    if low is not None:
        bad = bad | (x < low)
    if high is not None:
        bad = bad | (x > high)
    n = _count(F.coalesce(F.when(x.isNull(), nulls == "violation").otherwise(bad), F.lit(False)))
    return Check(
        f"{table}.{column}: range [{low}, {high}]", n, F.concat(F.lit("violations="), n.cast("string"))
    )


def date_order(table: str, earlier: str, later: str) -> Check:
    n = _count(F.col(later) < F.col(earlier))
    return Check(f"{table}: {earlier} ≤ {later}", n, F.concat(F.lit("violations="), n.cast("string")))


def mean_within(table: str, column: str, low: float, high: float) -> Check:
    x = F.expr(f"try_cast({column} AS double)")
    # millionths as integers: the mean does not depend on the order of addition
    mean = F.try_divide(
        F.sum(F.rint(x * 1_000_000).cast("bigint").cast("decimal(18,0)")).cast("double") / F.lit(1_000_000.0),
        F.count(x).cast("double"),
    )
    return Check(
        f"{table}.{column}: mean in [{low:.2f}, {high:.2f}]",
        F.when(mean.between(low, high), 0).otherwise(1),
        F.concat(F.lit("mean="), F.coalesce(_text(mean, "decimal(18,4)"), F.lit("nan"))),
    )


def missing_column(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([(name, False, 1, "column missing")], RESULT)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Evaluate row-wise checks in one pass over the table."""
    results = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            (c.violations == 0).alias("passed"),
            c.violations.cast("bigint").alias("violations"),
            c.details.alias("details"),
        )
        for c in checks
    ]
    return df.agg(F.array(*results).alias("r")).select(F.inline("r"))


def _one(df: DataFrame, name: str, violations: Column, label: str) -> DataFrame:
    n = F.coalesce(violations, F.lit(0)).cast("bigint")
    return df.agg(n.alias("n")).select(
        F.lit(name).alias("check_name"),
        (F.col("n") == 0).alias("passed"),
        F.col("n").alias("violations"),
        F.concat(F.lit(f"{label}="), F.col("n").cast("string")).alias("details"),
    )


def check_not_empty(df: DataFrame, table: str) -> DataFrame:
    return run_checks(df, [not_empty(table)])


def check_no_nulls(df: DataFrame, table: str, columns: Sequence[str], threshold: float = 0.0) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    out = run_checks(df, [no_nulls(table, c, threshold) for c in present]) if present else None
    for c in columns:
        if c not in present:
            row = missing_column(df.sparkSession, f"{table}.{c}: column exists")
            out = row if out is None else out.unionByName(row)
    return out


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Rows beyond one per distinct non-NULL key (so NULL keys count as duplicates)."""
    per_key = df.groupBy(column).agg(F.count(F.lit(1)).alias("c"))
    return _one(per_key, f"{table}.{column}: unique", F.sum("c") - F.count(column), "duplicates")


def check_domain(
    df: DataFrame, table: str, column: str, valid: Sequence[str], nulls: str = "violation"
) -> DataFrame:
    if column not in df.columns:
        return missing_column(df.sparkSession, f"{table}.{column}: domain valid")
    return run_checks(df, [in_domain(table, column, valid, nulls)])


def check_range(
    df: DataFrame,
    table: str,
    column: str,
    low: float | None = None,
    high: float | None = None,
    nulls: str = "violation",
) -> DataFrame:
    if column not in df.columns:
        return missing_column(df.sparkSession, f"{table}.{column}: range valid")
    return run_checks(df, [in_range(table, column, low, high, nulls)])


def orphan_rows(child: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Per missing parent key (NULL included): ``(column, c)`` with the number of child rows."""
    per_key = child.groupBy(column).agg(F.count(F.lit(1)).alias("c"))
    return per_key.join(parent.select(column), column, "left_anti")


def reference_counts(child: DataFrame, parents: dict[str, DataFrame], also: dict[str, Column] | None = None) -> DataFrame:
    """One row: ``orphans_<column>`` per reference and the number of rows that meet each condition of ``also``.

    One pass over the table: rows are grouped by each key in turn (grouping sets), combined map-side,
    and only different keys meet their parents. A NULL key is an orphan; a hot one is a row per input partition.
    """
    also = also or {}
    keys = list(parents)
    whole = (1 << len(keys)) - 1
    of = {k: whole ^ (1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)}
    flags = [F.when(cond, 1).otherwise(0).cast("bigint").alias(f"_also_{i}") for i, cond in enumerate(also.values())]
    # conditions belong to each row once: only the first key's groups keep their sums
    grouped = (
        child.select(*keys, *flags)
        .groupingSets([[F.col(k)] for k in keys], *keys)
        .agg(
            F.grouping_id().alias("_set"),
            F.count(F.lit(1)).alias("_c"),
            *[F.sum(f"_also_{i}").alias(f"_also_{i}") for i in range(len(also))],
        )
    )
    for k, parent in parents.items():
        grouped = grouped.join(parent.select(k).distinct().withColumn(f"_has_{k}", F.lit(True)), k, "left")
    zero = F.lit(0).cast("bigint")
    return grouped.agg(
        *[
            F.coalesce(F.sum(F.when((F.col("_set") == of[k]) & F.col(f"_has_{k}").isNull(), F.col("_c"))), zero).alias(f"orphans_{k}")
            for k in keys
        ],
        *[
            F.coalesce(F.sum(F.when(F.col("_set") == of[keys[0]], F.col(f"_also_{i}"))), zero).alias(name)
            for i, name in enumerate(also)
        ],
    )


def orphan_totals(child: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """``(column, orphans)`` for several references of one table, in one pass over it."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"orphans_{c}").alias("orphans")) for c in parents])
    return reference_counts(child, parents).select(F.inline(pairs))


def check_references(child: DataFrame, child_table: str, parents: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``check_referential`` for several columns, ``{column: (parent, its name)}``, in one pass."""
    names = F.create_map(
        *[F.lit(x) for c, (_, p) in parents.items() for x in (c, f"{child_table}.{c} → {p}: referential integrity")]
    )
    n = F.col("orphans").cast("bigint")
    return orphan_totals(child, {c: p for c, (p, _) in parents.items()}).select(
        names[F.col("column")].alias("check_name"),
        (n == 0).alias("passed"),
        n.alias("violations"),
        F.concat(F.lit("orphan_rows="), n.cast("string")).alias("details"),
    )


def check_referential(
    child: DataFrame, child_table: str, column: str, parent: DataFrame, parent_table: str
) -> DataFrame:
    name = f"{child_table}.{column} → {parent_table}: referential integrity"
    return _one(orphan_rows(child, column, parent), name, F.sum("c"), "orphan_rows")


def check_date_order(df: DataFrame, table: str, earlier: str, later: str) -> DataFrame:
    return run_checks(df, [date_order(table, earlier, later)])


def check_stat(df: DataFrame, table: str, column: str, low: float, high: float) -> DataFrame:
    if column not in df.columns:
        return missing_column(df.sparkSession, f"{table}.{column}: stat check")
    return run_checks(df, [mean_within(table, column, low, high)])


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate_customers(
    df: DataFrame, regions: Sequence[str] = REGIONS, segments: Sequence[str] = SEGMENTS
) -> DataFrame:
    t = "customers"
    row_wise = [not_empty(t)]
    row_wise += [no_nulls(t, c) for c in ("customer_id", "email", "region", "signup_date")]
    row_wise += [in_domain(t, "region", regions), in_domain(t, "segment", segments)]
    return _union([run_checks(df, row_wise), check_unique(df, t, "customer_id")])


def validate_products(df: DataFrame, margin_low: float = -10.0, margin_high: float = 99.0) -> DataFrame:
    t = "products"
    row_wise = [not_empty(t)]
    row_wise += [no_nulls(t, c) for c in ("product_id", "product_name", "category", "unit_price", "unit_cost")]
    row_wise += [
        in_range(t, "unit_price", 0.01),
        in_range(t, "unit_cost", 0.01),
        in_range(t, "margin_pct", margin_low, margin_high),
    ]
    return _union([run_checks(df, row_wise), check_unique(df, t, "product_id")])


def validate_transactions(
    df: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    regions: Sequence[str] = REGIONS,
    discount_mean: tuple[float, float] = (0.0, 0.25),
    quantity_mean: tuple[float, float] = (1.0, 4.0),
) -> DataFrame:
    t = "transactions"
    required = ("transaction_id", "customer_id", "product_id", "order_date", "quantity", "unit_price")
    row_wise = [not_empty(t)]
    row_wise += [no_nulls(t, c) for c in required]
    row_wise += [
        in_range(t, "quantity", 1),
        in_range(t, "unit_price", 0.01),
        in_range(t, "discount", 0.0, 1.0),
        in_range(t, "net_revenue", 0.0),
        in_domain(t, "region", regions),
        date_order(t, "order_date", "ship_date"),
        mean_within(t, "discount", *discount_mean),
        mean_within(t, "quantity", *quantity_mean),
    ]
    return _union(
        [
            run_checks(df, row_wise),
            check_unique(df, t, "transaction_id"),
            check_references(
                df, t, {"customer_id": (customers, "customers"), "product_id": (products, "products")}
            ),
        ]
    )


def validation_results(
    customers: DataFrame,
    products: DataFrame,
    txn: DataFrame,
    regions: Sequence[str] = REGIONS,
    segments: Sequence[str] = SEGMENTS,
) -> DataFrame:
    """The three suites together."""
    return _union(
        [
            validate_customers(customers, regions, segments),
            validate_products(products),
            validate_transactions(txn, customers, products, regions),
        ]
    )


def validation_gate(results: DataFrame, raise_on_failure: bool = True) -> DataFrame:
    """Stop the pipeline on a failed check; returns ``(check_name, passed, details, summary)``.

    Only the result rows, a few dozen whatever the data size, reach the driver.
    """
    rows = results.select("check_name", "passed", "details").collect()
    failed = [r for r in rows if not r.passed]
    summary = f"{len(rows) - len(failed)}/{len(rows)} checks passed"
    if failed:
        summary += f", {len(failed)} FAILED"
    if failed and raise_on_failure:
        raise ValidationFailed(summary + ": " + "; ".join(f"{r.check_name} ({r.details})" for r in failed))
    return results.sparkSession.createDataFrame(
        [(r.check_name, r.passed, r.details, summary) for r in rows],
        "check_name string, passed boolean, details string, summary string",
    )


def column_profile(df: DataFrame, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Per column: type, NULLs and distinct values.

    The table is read once: its cells become (column, value) rows that are counted
    map-side, so each distinct value is shuffled once per task.  Values are told
    apart by their text.  ``approximate`` shuffles sketches only.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields if not isinstance(f.dataType, T.StructType)}

    def pack(name: str, rows: Column, nulls: Column, unique: Column) -> Column:
        share = F.coalesce(F.try_divide(nulls.cast("double"), rows.cast("double")), F.lit(0.0))
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(types[name]).alias("dtype"),
            nulls.cast("bigint").alias("null_count"),
            F.round((share * 100).cast("decimal(28,10)"), 2).cast("double").alias("null_pct"),
            unique.cast("bigint").alias("unique"),
        )

    if approximate:
        rows = F.count(F.lit(1))
        return df.agg(
            F.array(
                *[pack(c, rows, _count(F.col(c).isNull()), F.approx_count_distinct(c, rsd)) for c in types]
            ).alias("r")
        ).select(F.inline("r"))
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in types])
    per_value = df.select(F.inline(cells)).groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    found = per_value.groupBy("c").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"), F.count("v").alias("unique")
    )
    # one row per column, those of an empty table included
    listed = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(types)], "i int, c string")
    filled = listed.join(found, "c", "left").fillna(0, ["rows", "nulls", "unique"])
    packed = F.lit(None)
    for c in types:
        packed = F.when(F.col("c") == c, pack(c, F.col("rows"), F.col("nulls"), F.col("unique"))).otherwise(packed)
    return filled.orderBy("i").select(packed.alias("r")).select("r.*")
