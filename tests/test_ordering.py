"""Whole-table ordering equals plain windows, whatever the ties and the number of ranges."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyroom.functions.ordering import exact_quantiles, ntile, order_globally, percent_rank


def _values(kind: str, n: int) -> list[int]:
    rng = random.Random(7)
    if kind == "distinct":
        return rng.sample(range(10 * n), n)
    if kind == "three":
        return [rng.choice([1, 5, 9]) for _ in range(n)]
    if kind == "one":
        return [4] * n
    if kind == "third":  # a third of all rows share one value
        return [50 if i % 3 == 0 else rng.randrange(100) for i in range(n)]
    return [rng.randrange(max(n // 3, 1)) for _ in range(n)]


CASES = [(k, 300) for k in ("distinct", "three", "one", "third", "mixed")] + [("three", 1), ("mixed", 7)]


@pytest.mark.parametrize("kind,n", CASES)
@pytest.mark.parametrize("ranges", [2, 40])
@pytest.mark.parametrize("descending", [True, False])
def test_equals_plain_windows(spark, kind, n, ranges, descending):
    rows = [(f"k{i:05d}", v, v * 3 + 1) for i, v in enumerate(_values(kind, n))]
    df = spark.createDataFrame(rows, "k string, v bigint, a bigint").repartition(5)
    got = order_globally(
        df,
        "v",
        "k",
        descending=descending,
        row_number="rn",
        rank="rk",
        dense_rank="dr",
        amount="a",
        running="upto",
        total="whole",
        n="n",
        ranges=ranges,
    ).select("*", ntile(5, "rn", "n").alias("t5"), percent_rank("rk", "n").alias("pr"))
    by = F.desc("v") if descending else F.asc("v")
    full, ties = Window.orderBy(by, "k"), Window.orderBy(by)
    want = df.select(
        "*",
        F.row_number().over(full).alias("rn"),
        F.rank().over(ties).alias("rk"),
        F.dense_rank().over(ties).alias("dr"),
        F.sum("a").over(full.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("a").over(Window.partitionBy()).alias("whole"),
        F.count("k").over(Window.partitionBy()).alias("n"),
        F.ntile(5).over(full).alias("t5"),
        F.percent_rank().over(ties).alias("pr"),
    )
    key = lambda r: r.k
    got = got.select(*want.columns)
    assert [tuple(r) for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(want.collect(), key=key)]


def test_hot_value_is_cut_into_ranges(spark):
    """Rows that share one value still spread over many ranges."""
    from tallyroom.functions.ordering import _ranged

    df = spark.range(4000).select(F.lit(1).alias("_v"), F.col("id").alias("_k"))
    sizes = [r["count"] for r in _ranged(df, 32).groupBy("_range").count().collect()]
    assert len(sizes) > 24 and max(sizes) < 4000 / 3


def test_empty(spark):
    df = spark.createDataFrame([], "k string, v bigint")
    assert order_globally(df, "v", "k", row_number="rn", rank="rk").count() == 0


@pytest.mark.parametrize("n,tiles", [(1003, 5), (7, 10), (1, 5), (100, 10), (4, 5)])
def test_ntile_formula(spark, n, tiles):
    df = spark.range(1, n + 1).select("id", F.lit(n).alias("n"))
    want = F.ntile(tiles).over(Window.orderBy("id"))
    rows = df.select(ntile(tiles, "id", "n").alias("a"), want.alias("b")).collect()
    assert all(r.a == r.b for r in rows)


@pytest.mark.parametrize("kind,n", CASES)
def test_quantiles_interpolate_linearly(spark, kind, n):
    vals = _values(kind, n)
    probs = [0.0, 0.2, 0.5, 0.9, 0.999, 1.0]
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "x double")
    got = exact_quantiles(df, "x", probs, ranges=16).first()
    assert np.allclose(list(got), np.quantile(vals, probs), rtol=1e-12)
