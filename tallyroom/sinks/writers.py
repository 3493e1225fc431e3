"""Parquet tables (plain and year/month-partitioned) and the JSON report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    keys: Sequence[str] = ("year", "month"),
    *,
    mode: str = "overwrite",
    touched_only: bool = False,
) -> None:
    """Hive layout, one folder per key combination.

    The rebalance hint gathers each folder's rows into few files and lets AQE
    split a folder that is larger than the advisory partition size, so a month
    with a third of all rows is still written by many tasks.  ``touched_only``
    replaces just the folders present in ``df`` instead of the whole tree.
    """
    spread = df.hint("rebalance", *[F.col(k) for k in keys])
    (
        spread.write.mode(mode)
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "dynamic" if touched_only else "static")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_summary_json(report: DataFrame, path: str) -> None:
    """One nested JSON document; ``report`` is the one-row summary report."""
    report.coalesce(1).write.mode("overwrite").json(path)
