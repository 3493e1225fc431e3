"""One registered query per operator: production parameters, whole tables, full results."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    collocations,
    decontaminate,
    packing,
    personal,
    quality,
    secrets,
    simhash,
    substring,
    tokencount,
    tokenfile,
    toxicity,
    variants,
)
from .store import Scratch

ROOT = Path(__file__).resolve().parents[2]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; the same on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark, 'tokenfile').root}/ids"
    tokenfile.write(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"))
    return tokenfile.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokencount.count(docs, tokencount.masks(), vocabulary("byte_bpe_50k.json"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(variants.occurrences(table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.report(table(spark, sf_dir, "documents"))


_OPERATORS = (
    op1_decontaminate,
    op2_secrets,
    op3_quality,
    op4_packing,
    op5_token_files,
    op6_toxicity,
    op7_simhash,
    op8_substring_dedup,
    op9_token_counts,
    op10_nearest,
    op11_variants,
    op12_collocations,
    op13_personal,
)


def ship(spark: SparkSession) -> None:
    """Python workers must find this package: send it unless their search path has it already."""
    sc = spark.sparkContext
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if str(ROOT) in (str(Path(p).resolve()) for p in places if p) or getattr(sc, "_tallyroom_sent", False):
        return
    made = shutil.make_archive(f"{tempfile.mkdtemp()}/tallyroom", "zip", ROOT, "tallyroom")
    sc.addPyFile(made)
    sc._tallyroom_sent = True


def run(operator: Callable[[SparkSession, str], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return operator(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: partial(run, f) for f in _OPERATORS}
