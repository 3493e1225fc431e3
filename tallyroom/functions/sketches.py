"""Mergeable sketches kept per load: quantiles (KLL) and distinct values (HLL), and exact quantiles by bracketing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.functions.money import rounded
from tallyroom.functions.ordering import order_globally

#: Size of the quantile sketches, and how far their ranks may be off: three times the 99 % bound for that size.
KLL_K = 4000
RANK_ERROR = 3 * 2.296 / KLL_K**0.9021
#: Logarithm of the registers of the distinct sketches; their standard error is about 1.04 / 2**(LG_K / 2), 0.8 %.
HLL_LG_K = 14


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _amount(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


class LoadSketches:
    """Sketches of a table's columns, one row per load and column, stored below ``path``.

    A load is read once, when it is added; adding it again replaces its rows. What is known of the whole
    table is merged from the rows, whatever the table's size.
    """

    SCHEMA = "position int, column string, dtype string, rows bigint, nulls bigint, kll binary, hll binary, load string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, df: DataFrame, load: str) -> None:
        """Sketch the columns of one load in a single pass; map-side sketches are all that is shuffled."""
        fields = [f for f in df.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
        parts = []
        for i, f in enumerate(fields):
            kll = F.kll_sketch_agg_double(_amount(f.name), F.lit(KLL_K)) if _numeric(f.dataType) else F.lit(None).cast("binary")
            parts.append(
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(f.name).alias("column"),
                    F.lit(f.dataType.simpleString()).alias("dtype"),
                    F.count(F.lit(1)).alias("rows"),
                    (F.count(F.lit(1)) - F.count(f.name)).alias("nulls"),
                    kll.alias("kll"),
                    F.hll_sketch_agg(F.col(f.name).cast("string"), HLL_LG_K).alias("hll"),
                )
            )
        rows = df.agg(F.array(*parts).alias("r")).select(F.inline("r"))
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/load={load}")

    def stored(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def profile(self) -> DataFrame:
        """``(column, dtype, null_count, null_pct, unique)`` over all loads; ``unique`` is estimated."""
        merged = self.stored().groupBy("position", "column", "dtype").agg(
            F.sum("rows").alias("rows"),
            F.sum("nulls").alias("null_count"),
            F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("unique"),
        )
        share = F.try_divide(F.col("null_count").cast("double"), F.col("rows")) * 100
        return merged.orderBy("position").select("column", "dtype", "null_count", rounded(share).alias("null_pct"), "unique")

    def quantiles(self, column: str) -> DataFrame:
        """One row with the merged quantile sketch of a column, as ``kll``."""
        return self.stored().where(F.col("column") == column).agg(F.kll_merge_agg_double("kll").alias("kll"))


def sketch_of(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.kll_sketch_agg_double(_amount(column), F.lit(KLL_K)).alias("kll"))


def exact_quantile(df: DataFrame, column: str, prob: float, sketch: DataFrame | None = None) -> float | None:
    """The exact, linearly interpolated quantile of a numeric column; NULL and NaN take no part, without values None.

    A sketch (that of ``df`` itself, or merged from its loads) brackets the quantile. One pass counts the rows below
    and inside the bracket, and only values inside are put in order. If the sketch missed, which
    the counts show, everything is the bracket. A handful of numbers come to the driver.
    """
    values = df.select(_amount(column).alias("x")).where("x is not null")
    edge = lambda p: F.kll_sketch_get_quantile_double("kll", F.lit(float(p)))
    kll = sketch if sketch is not None else sketch_of(df, column)
    low, high = None, None
    some = kll.where("kll is not null").where(F.kll_sketch_get_n_double("kll") > 0)
    found = some.select(edge(max(0.0, prob - RANK_ERROR)).alias("lo"), edge(min(1.0, prob + RANK_ERROR)).alias("hi")).first()
    if found is not None:
        low = found.lo if prob > RANK_ERROR else None
        high = found.hi if prob < 1 - RANK_ERROR else None
    for lo, hi in ((low, high), (None, None)):
        under = F.lit(False) if lo is None else F.col("x") < lo
        over = F.lit(False) if hi is None else F.col("x") > hi
        n, below, inside = values.agg(F.count(F.lit(1)), F.count_if(under), F.count_if(~under & ~over)).first()
        if n == 0:
            return None
        at = prob * (n - 1)
        first = int(at)
        second = min(first + 1, n - 1)
        if below <= first and second < below + inside:
            break
    counted = values.where(~under & ~over).groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    ladder = order_globally(counted, "x", "x", descending=False, amount="c", running="upto")
    reach = F.col("upto") + F.lit(below)
    a, b = ladder.agg(
        F.min(F.when(reach > first, F.col("x"))), F.min(F.when(reach > second, F.col("x")))
    ).first()
    part = at - first
    # from the nearer end, so that equal neighbours give exactly their value
    return a + (b - a) * part if part < 0.5 else b - (b - a) * (1 - part)


def cap_outliers(
    df: DataFrame,
    columns: Sequence[str] = ("unit_cost", "unit_price"),
    quantile: float = 0.999,
    sketches: LoadSketches | None = None,
) -> DataFrame:
    """Cut each column at its exact upper quantile, found by bracketing; ``df`` is not stored.

    ``sketches`` of the loads that make up ``df`` spare the pass that sketches it.
    """
    out = df
    for c in columns:
        cap = exact_quantile(df, c, quantile, None if sketches is None else sketches.quantiles(c))
        if cap is not None:
            out = out.withColumn(c, F.when(F.col(c) > cap, F.lit(cap)).otherwise(F.col(c)))
    return out
