"""Intermediate tables in the folder that driver and executors share, and small input helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.functions.durable import shared_dir


#: Most rows of a stored table that a join may broadcast.
FEW = 100_000


class Scratch:
    """Parquet tables of one operator run below ``spark.checkpoint.dir``.

    A written table cuts the lineage: a lost executor costs the running stage, never the steps before
    it. ``drop`` removes a table as soon as its last reader has itself been written; what the returned
    lazy result still reads stays until ``clean`` is called.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:03d}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            self._delete(t._scratch_path)  # type: ignore[attr-defined]

    def clean(self) -> None:
        self._delete(self.root)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def unless_many(table: DataFrame, most: int = FEW) -> DataFrame:
    """A stored table as the right side of a join: with more than ``most`` rows it is merged, never broadcast.

    What is broadcast passes through the driver as a hash table, several times as large as the files by
    whose size Spark decides. The rows are counted from the files' footers.
    """
    return table.hint("merge") if table.count() > most else table


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces, so that a worker holds few texts as Python objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
