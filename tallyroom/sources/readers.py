"""Readers for raw CSV and curated Parquet, always with the declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.functions.durable import scratch_path
from tallyroom.operators.cleaning import mark_missing
from tallyroom.schemas import RAW, TABLES

#: Holds the text of a record whose fields are not as many as the columns; NULL in every other row.
RECORD = "_corrupt_record"
#: Fields as RFC 4180 has them: a quote inside quotes is doubled. Records are read with all their columns, since
#: a pruned parser counts only the fields that it was asked for and would let malformed records pass.
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": RECORD,
    "columnPruning": "false",
}
OPEN_QUOTE, SURPLUS = "open quote", "surplus fields"


def raw_schema(table: str) -> T.StructType:
    return T.StructType([*RAW[table].fields, T.StructField(RECORD, T.StringType())])


def record_fault(table: str) -> Column:
    """Why a record cannot be read, or NULL.

    A record that ends too early is read, its missing fields being NULL. One with fields to spare may have
    lost a quote anywhere, so its columns cannot be trusted; nor can those of a record with an unpaired quote,
    such as either half of a record that a line break inside quotes cut in two.
    """
    columns = RAW[table].fieldNames()
    record = F.col(RECORD)
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    outside = F.regexp_replace(record, '"[^"]*+"', "")
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    short = (fields < len(columns)) & F.col(columns[-1]).isNull()
    return F.when(quotes % 2 == 1, OPEN_QUOTE).when(record.isNotNull() & ~short, SURPLUS)


def _records(spark: SparkSession, folder: str, table: str, multi_line: bool, header: bool) -> DataFrame:
    reader = spark.read.schema(raw_schema(table)).options(**CSV_OPTIONS)
    return (
        reader.option("header", header)
        .option("enforceSchema", not header)
        .option("multiLine", multi_line)
        .csv(f"{folder}/{table}")
    )


def readable(records: DataFrame, table: str) -> DataFrame:
    """The records without fault as text columns; missing-value tokens are NULL."""
    kept = [c for c in records.columns if c != RECORD]
    return records.where(record_fault(table).isNull()).select(*kept).transform(mark_missing)


def quarantined(records: DataFrame, table: str) -> DataFrame:
    """``(file, first_field, record, reason)`` of the records with a fault."""
    return records.withColumn("reason", record_fault(table)).where("reason is not null").select(
        F.col("_metadata.file_path").alias("file"),
        F.col(records.columns[0]).alias("first_field"),
        F.col(RECORD).alias("record"),
        "reason",
    )


def read_raw(
    spark: SparkSession,
    folder: str,
    table: str,
    ingest_order: bool = False,
    *,
    multi_line: bool = False,
    header: bool = True,
) -> DataFrame:
    """CSV files under ``folder/table`` as text columns, nothing inferred; missing-value tokens are NULL.

    Quoted fields may hold commas and doubled quotes, with ``multi_line`` also line breaks; such files are
    not split, so a task reads a whole file. Without it a record with a line break is two, whose unpaired
    quotes set them aside unless its fields happen to be as many as the columns, so files that may hold
    line breaks need ``multi_line``. Records that cannot be read are left out here and come back
    from ``read_quarantine``. With ``header`` each file's first line must name the columns.
    ``ingest_order`` adds ``ingest_seq`` (file, block, row), the order the rows have in the
    files, which "first row wins" rules need.
    """
    records = _records(spark, folder, table, multi_line, header)
    if ingest_order:
        seq = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        records = records.select("*", seq.alias("ingest_seq"))
    return readable(records, table)


def read_quarantine(
    spark: SparkSession, folder: str, table: str, *, multi_line: bool = False, header: bool = True
) -> DataFrame:
    """``(file, first_field, record, reason)`` of the records that ``read_raw`` leaves out."""
    return quarantined(_records(spark, folder, table, multi_line, header), table)


def split_raw(
    spark: SparkSession, folder: str, table: str, *, multi_line: bool = False, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``read_raw`` with its order and ``read_quarantine`` of one pass over the files.

    The parsed records are stored, good and bad in folders of their own, so cleaning and audit, which read
    the table several times, find columns instead of text to parse.
    """
    records = _records(spark, folder, table, multi_line, header)
    columns = RAW[table].fieldNames()
    path = scratch_path(spark, f"records-{table}")
    records.select(
        *columns,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("ingest_seq"),
        F.col(RECORD).alias("record"),
        record_fault(table).alias("reason"),
        record_fault(table).isNotNull().alias("bad"),
    ).write.partitionBy("bad").parquet(path)
    seq = "struct<file:string,block:bigint,row:bigint>"
    texts = ", ".join(f"`{c}` string" for c in columns)
    stored = spark.read.schema(f"{texts}, ingest_seq {seq}, record string, reason string, bad boolean").parquet(path)
    good = stored.where("not bad").select(*columns, "ingest_seq").transform(mark_missing)
    bad = stored.where("bad").select(
        F.col("ingest_seq.file").alias("file"), F.col(columns[0]).alias("first_field"), "record", "reason"
    )
    return good, bad


def read_parquet_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A Parquet file or Hive-partitioned folder with the contract's schema."""
    return spark.read.schema(TABLES[table]).parquet(f"{folder}/{table}")
