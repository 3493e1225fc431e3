"""A corpus from raw documents to packed training sequences.

``STAGES`` are functions of (spark, docs, sf_dir). Each stage's result is written and read again before
the next one, so a stage starts from files and never repeats the work of those before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyroom.llm import decontaminate, quality, secrets, simhash
from tallyroom.llm.queries import packed, ship, table
from tallyroom.llm.store import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Unlabelled rows are judged by their text like any other."""
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    ship(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontaminate.drop_leaky(docs, table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; all documents stay."""
    return secrets.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, as ``op4_packing`` returns them."""
    ship(spark)
    return packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_masking", secret_masking),
    ("packing", packing),
]

#: Training a model and tokenising cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table of ``sf_dir``; no documents give no pieces."""
    ship(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    written: DataFrame | None = None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if written is not None:
            scratch.drop(written)
        written = docs
    return docs
