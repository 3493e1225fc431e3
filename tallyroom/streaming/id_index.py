"""Index of the keys that a table holds, so that a load looks up its own keys and not the table.

Keys are stored by a hash of the key in as many folders as keep each small: their number doubles as the
table grows. A lookup reads the folders of its own keys only, so its cost follows the batch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.functions.durable import remove

#: Keys a folder holds on average before the folders double, and the most folders there may be.
KEYS_PER_BUCKET, MOST_BUCKETS = 500_000, 16_384


class IdIndex:
    """Keys of one table below ``path``; one writer at a time.

    ``generations/<number of buckets>`` holds the keys, ``state`` how many there are; a generation is taken only if its
    writing ended. Changing the number writes a new generation from the old one and then removes it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str = "transaction_id",
        *,
        keys_per_bucket: int = KEYS_PER_BUCKET,
        most_buckets: int = MOST_BUCKETS,
    ) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.keys_per_bucket, self.most_buckets = keys_per_bucket, most_buckets

    # -- what is stored

    def _state(self) -> tuple[int, int] | None:
        """(buckets, keys), or None before the first build."""
        try:
            row = self.spark.read.schema("buckets int, keys long").json(f"{self.path}/state").first()
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return None if row is None or row.buckets is None else (row.buckets, row["keys"])

    def _write_state(self, buckets: int, keys: int) -> None:
        made = self.spark.createDataFrame([(buckets, keys)], "buckets int, keys long")
        made.coalesce(1).write.mode("overwrite").json(f"{self.path}/state")

    def _folder(self, buckets: int) -> str:
        return f"{self.path}/generations/{buckets}"

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(buckets)).cast("int")

    def exists(self) -> bool:
        return self._state() is not None

    @property
    def buckets(self) -> int:
        state = self._state()
        return 0 if state is None else state[0]

    def _fitting(self, keys: int) -> int:
        wanted = max(1, math.ceil(keys / self.keys_per_bucket))
        return min(self.most_buckets, 1 << (wanted - 1).bit_length())

    def _write(self, keys: DataFrame, buckets: int, mode: str) -> None:
        (
            keys.select(self.key, self._bucket(buckets).alias("bucket"))
            .hint("rebalance", F.col("bucket"))
            .write.mode(mode)
            .partitionBy("bucket")
            .parquet(self._folder(buckets))
        )

    # -- use

    def build(self, table: DataFrame) -> None:
        """Start anew from the table's keys: the one time that they are all read."""
        remove(self.spark, self.path)
        keys = table.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        total = keys.count()
        buckets = self._fitting(total)
        self._write(keys, buckets, "overwrite")
        self._write_state(buckets, total)

    def stored(self, buckets_of: DataFrame | None = None) -> DataFrame:
        """The stored keys, of those folders only that keys of ``buckets_of`` could be in.

        What comes to the driver are folder numbers, at most ``most_buckets`` of them.
        """
        buckets = self.buckets
        folder = self._folder(buckets)
        names = _subfolders(self.spark, folder)
        if buckets_of is not None:
            wanted = {f"bucket={r.b}" for r in buckets_of.select(self._bucket(buckets).alias("b")).distinct().collect()}
            names = [n for n in names if n in wanted]
        schema = f"`{self.key}` string, bucket int"
        if not names:
            return self.spark.createDataFrame([], schema).select(self.key)
        reader = self.spark.read.schema(schema).option("basePath", folder)
        return reader.parquet(*(f"{folder}/{n}" for n in names)).select(self.key)

    def known(self, keys: DataFrame) -> DataFrame:
        """Those of ``keys`` that the table holds."""
        return self.stored(keys).join(keys.select(self.key), self.key, "left_semi")

    def add(self, keys: DataFrame, count: int) -> None:
        """Append ``count`` keys that are not stored yet; the folders double when they have become too full."""
        buckets, total = self._state() or (1, 0)
        self._write(keys, buckets, "append")
        self._write_state(buckets, total + count)
        fitting = self._fitting(total + count)
        if fitting > buckets:
            self._regroup(fitting)

    def _regroup(self, buckets: int) -> None:
        """Write all keys into ``buckets`` folders, which also gathers the small files of many loads."""
        old, total = self._state() or (1, 0)
        keys = self.spark.read.schema(f"`{self.key}` string, bucket int").parquet(self._folder(old)).select(self.key)
        self._write(keys, buckets, "overwrite")
        self._write_state(buckets, total)
        if old != buckets:
            remove(self.spark, self._folder(old))

    def compact(self) -> None:
        """One file a folder again after many small loads: a new generation with twice the folders, and back."""
        buckets = self.buckets
        self._regroup(2 * buckets)
        self._regroup(buckets)


def _subfolders(spark: SparkSession, path: str) -> Sequence[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return []
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()]
