"""Ranks, tiles, running totals and exact quantiles over a whole table, without one-task sorts.

``OVER (ORDER BY ...)`` with no PARTITION BY sends every row to one task.  Here
the table is range-partitioned by (value, key), so a value shared by a third of
the rows is cut along its keys like any other stretch, and written with the
number of its range.  Writing freezes the ranges: every later step, a repeated
one included, sees the same numbers.  Windows then run inside the ranges, and a
table with one row per range carries the offsets from range to range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.functions.durable import durable


def _ranged(df: DataFrame, ranges: int | None) -> DataFrame:
    """``df`` with ``_range``, ascending along (_v, _k); Spark samples the cut points in every partition.

    Without ``ranges`` there are as many as the session has shuffle partitions,
    fewer where AQE joins small ones.
    """
    keys = ("_v", "_k")
    cut = df.repartitionByRange(*keys) if ranges is None else df.repartitionByRange(ranges, *keys)
    return durable(cut.withColumn("_range", F.spark_partition_id()))


def _offsets(df: DataFrame, amount: str | None, ranked: bool) -> DataFrame:
    """One row per range: rows, distinct values and amounts before it, rank of its first value."""
    add = F.sum(amount) if amount else F.lit(0)
    rows = F.count(F.lit(1))
    # At most ``ranges`` rows after the grouping, so the windows without partitions are small.
    w = Window.orderBy("_range")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    zero = F.lit(0)
    shared = [
        F.coalesce(F.sum("rows").over(before), zero).alias("_rows_before"),
        F.coalesce(F.sum("amount").over(before), zero).alias("_amount_before"),
        F.sum("rows").over(whole).alias("_n"),
        F.sum("amount").over(whole).alias("_total"),
    ]
    if not ranked:
        return df.groupBy("_range").agg(rows.alias("rows"), add.alias("amount")).select("_range", *shared)
    per_range = (
        df.groupBy("_range", "_v")
        .agg(rows.alias("c"), add.alias("s"))
        .groupBy("_range")
        .agg(
            F.sum("c").alias("rows"),
            F.count(F.lit(1)).alias("values"),
            F.min("_v").alias("_lo"),
            F.max("_v").alias("hi"),
            F.max_by("c", "_v").alias("hi_rows"),
            F.sum("s").alias("amount"),
        )
    )
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    return (
        per_range.select("*", *shared)
        .withColumn("tied", F.coalesce(F.col("_lo") == F.lag("hi").over(w), F.lit(False)))
        .withColumn("hi_start", F.col("_rows_before") + F.col("rows") - F.col("hi_rows") + 1)
        .withColumn("anchor", F.when(~(F.col("tied") & (F.col("_lo") == F.col("hi"))), F.col("hi_start")))
        .select(
            "_range",
            "_lo",
            "_rows_before",
            "_amount_before",
            "_n",
            "_total",
            F.when(F.col("tied"), F.last("anchor", ignorenulls=True).over(before))
            .otherwise(F.col("_rows_before") + 1)
            .alias("_lo_rank"),
            (
                F.coalesce(F.sum("values").over(before), zero)
                - F.sum(F.col("tied").cast("int")).over(so_far)
            ).alias("_values_before"),
        )
    )


def order_globally(
    df: DataFrame,
    value: str,
    key: str,
    *,
    descending: bool = True,
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    amount: str | None = None,
    running: str | None = None,
    total: str | None = None,
    n: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add whole-table ordering columns; each keyword names the output column.

    ``value`` is numeric and not NULL, ``key`` identifies the row and breaks ties
    in ascending order.  ``running`` is the sum of the ``amount`` column up to and
    including the row, ``total`` its grand total and ``n`` the row count.
    The table is written once in ranges; offsets and result then read it once each.
    """
    kept = df.columns
    v = -F.col(value) if descending else F.col(value)
    extra = {"_v": v, "_k": F.col(key)}
    stored = _ranged(df.withColumns(extra), ranges)
    # one row per range
    joined = stored.join(_offsets(stored, amount, bool(rank or dense_rank)), "_range")
    within = Window.partitionBy("_range").orderBy("_v", "_k")
    by_value = Window.partitionBy("_range").orderBy("_v")
    out: dict[str, Column] = {}
    if row_number:
        out[row_number] = (F.col("_rows_before") + F.row_number().over(within)).cast("bigint")
    if rank:
        out[rank] = (
            F.when(F.col("_v") == F.col("_lo"), F.col("_lo_rank"))
            .otherwise(F.col("_rows_before") + F.rank().over(by_value))
            .cast("bigint")
        )
    if dense_rank:
        out[dense_rank] = (F.col("_values_before") + F.dense_rank().over(by_value)).cast("bigint")
    if running:
        upto = within.rowsBetween(Window.unboundedPreceding, 0)
        out[running] = F.col("_amount_before") + F.sum(amount).over(upto)
    if n:
        out[n] = F.col("_n").cast("bigint")
    if total:
        out[total] = F.col("_total")
    return joined.withColumns(out).select(*kept, *out)


def ntile(tiles: int, row_number: str | Column, n: str | Column) -> Column:
    """NTILE from a row number and the row count; the first ``n mod tiles`` tiles get one more."""
    rn = F.col(row_number) if isinstance(row_number, str) else row_number
    cnt = F.col(n) if isinstance(n, str) else n
    size = F.floor(cnt / F.lit(tiles))
    larger = cnt % F.lit(tiles)
    head = larger * (size + 1)
    return (
        F.when(rn <= head, F.ceil(rn / (size + 1)))
        .otherwise(larger + F.ceil(F.try_divide(rn - head, size)))
        .cast("bigint")
    )


def percent_rank(rank: str, n: str) -> Column:
    return F.coalesce(F.try_divide((F.col(rank) - 1).cast("double"), (F.col(n) - 1).cast("double")), F.lit(0.0))


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], *, ranges: int | None = None) -> DataFrame:
    """One row ``q0, q1, ...``: linearly interpolated quantiles of a numeric column.

    Equal values are counted first, then the counts are accumulated in value
    order, so neither one task nor the driver ever holds all the values.
    """
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    ladder = order_globally(
        counted, "x", "x", descending=False, amount="c", running="upto", total="n", ranges=ranges
    )
    out = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("n") - 1)
        below = F.floor(at)
        lo = F.min(F.when(F.col("upto") > below, F.col("x")))
        hi = F.min(F.when(F.col("upto") > F.least(below + 1, F.col("n") - 1), F.col("x")))
        part = F.max(at - below)
        # from the nearer end, so that equal neighbours give exactly their value
        from_lo, from_hi = lo + (hi - lo) * part, hi - (hi - lo) * (1 - part)
        out.append(F.when(part < 0.5, from_lo).otherwise(from_hi).alias(f"q{i}"))
    return ladder.agg(*out)
