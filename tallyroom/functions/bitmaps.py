"""Exact distinct counts that can be merged: bitmaps over dense numbers of a key.

A stored dictionary gives every value of a key a number. Numbers of a group become bitmaps, one per
32,768 numbers, which are combined map-side and shuffled as bitmaps instead of keys, kept in tables, and
merged later into any coarser group without looking at the keys again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.functions.durable import durable
from tallyroom.functions.ordering import order_globally


class KeyNumbers:
    """Numbers 1, 2, 3, ... of a text key's values, stored at ``path``; a value keeps its number for good.

    One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.key = spark, path, key

    def table(self) -> DataFrame:
        """``(key, number)``."""
        schema = f"`{self.key}` string, number bigint"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return self.spark.createDataFrame([], schema)
            raise

    def add(self, df: DataFrame) -> int:
        """Number the values of ``df`` that have none yet, in key order after the largest; returns how many."""
        known = self.table()
        values = df.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        new = durable(values.join(known, self.key, "left_anti").withColumn("equal", F.lit(0)))
        count = new.count()
        if count:
            top = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
            numbered = order_globally(new, "equal", self.key, descending=False, row_number="row")
            numbered.select(self.key, (F.col("row") + top).alias("number")).write.mode("append").parquet(self.path)
        return count

    def number(self, df: DataFrame, name: str = "number") -> DataFrame:
        """``df`` with the number of its key; NULL for NULL keys and values without one."""
        numbers = self.table().select(self.key, F.col("number").alias(name))
        return df.join(numbers, self.key, "left")


def bucket(number: str) -> Column:
    return F.bitmap_bucket_number(number)


def members(number: str) -> Column:
    """Aggregate: the bitmap of a group that has one ``bucket``; NULL numbers are not in it."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(number))


def bitmap_cells(df: DataFrame, keys: Sequence[str | Column], number: str) -> DataFrame:
    """``(keys, bucket, members)``: one bitmap per group and 32,768 numbers."""
    return df.where(F.col(number).isNotNull()).groupBy(*keys, bucket(number).alias("bucket")).agg(members(number).alias("members"))


def distinct_of(cells: DataFrame, keys: Sequence[str | Column], name: str) -> DataFrame:
    """``(keys, name)``: distinct numbers of the groups that ``keys`` make of finer cells."""
    merged = cells.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("members").alias("members"))
    plain = [c for c in merged.columns if c not in ("bucket", "members")]
    return merged.groupBy(*plain).agg(F.sum(F.bitmap_count("members")).alias(name))
