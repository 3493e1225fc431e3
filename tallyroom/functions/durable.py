"""Intermediate tables as Parquet, in the folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's switch for removing a query's shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Only a session that runs in one process on one machine (``local[n]``) may leave
    it unset; it gets a temporary folder.  Any cluster without one is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tallyroom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/tallyroom/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries of the block leave no shuffle files: each one's go when it ends.

    Otherwise they stay until the driver's garbage collector happens to find the query.
    For steps that read each table they make from files; a DataFrame that runs twice in
    the block would shuffle twice.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def durable(df: DataFrame) -> DataFrame:
    """Write the table and read it again: computed once, pruned by column, safe from lost executors.

    This runs a job.  The files stay until ``release`` or ``clear_scratch``, since the
    result may be read at any later time.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._durable_path = path  # type: ignore[attr-defined]
    return out


def release(*tables: DataFrame) -> None:
    """Remove tables that ``durable`` returned, when their last reader has ended."""
    for t in tables:
        remove(t.sparkSession, t._durable_path)  # type: ignore[attr-defined]


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables below the shared folder; call it when their readers are done."""
    remove(spark, f"{shared_dir(spark).rstrip('/')}/tallyroom")
