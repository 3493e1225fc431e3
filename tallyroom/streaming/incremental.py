"""Daily loads: clean, validate and add only what is new."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyroom.functions.durable import durable, freed_shuffles, release, remove
from tallyroom.operators import checks
from tallyroom.operators.cleaning import clean_transactions
from tallyroom.schemas import RAW, REGIONS, SALES_TRANSACTIONS
from tallyroom.sinks.writers import write_partitioned
from tallyroom.sources.readers import CSV_OPTIONS, RECORD, raw_schema, readable, record_fault
from tallyroom.streaming.id_index import IdIndex

#: Called with what a load has stored.
AfterLoad = Callable[["Load"], None]

# What Spark reports for a folder that is not there yet, or that holds no data file yet.
NOTHING_STORED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or None before the first load; anything else at ``path`` is an error."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in NOTHING_STORED:
            return None
        raise
    missing = set(SALES_TRANSACTIONS.fieldNames()) - set(found.columns)
    if missing:
        raise ValueError(f"{path} holds another table: no {', '.join(sorted(missing))}")
    return spark.read.schema(SALES_TRANSACTIONS).parquet(path)


@dataclass(frozen=True)
class Load:
    """What one load stored: rows, and the (year, month) they fell into."""

    added: int
    months: tuple[tuple[int, int], ...]


def month_filter(months: Iterable[tuple[int, int]]) -> Column:
    """True in the given months; on partition columns it prunes folders."""
    return (F.col("year") * 100 + F.col("month")).isin(*sorted(y * 100 + m for y, m in months))


def _months(rows: DataFrame) -> tuple[tuple[int, int], ...]:
    """At most one pair per calendar month."""
    return tuple(sorted((r.year, r.month) for r in rows.select("year", "month").distinct().collect()))


def _valid_batch(
    raw: DataFrame, customers: DataFrame, products: DataFrame, order: Sequence[str], regions: Sequence[str] | None
) -> DataFrame:
    """The cleaned batch, stored; whoever asks for it releases it."""
    batch = durable(clean_transactions(raw, customers, products, order))
    suite = checks.run_checks(
        batch,
        [
            *[checks.no_nulls("transactions", c) for c in ("transaction_id", "customer_id", "product_id", "order_date")],
            checks.in_range("transactions", "quantity", 1),
            checks.in_range("transactions", "discount", 0.0, 1.0),
            checks.in_range("transactions", "net_revenue", 0.0),
            checks.date_order("transactions", "order_date", "ship_date"),
            *([checks.in_domain("transactions", "region", regions)] if regions is not None else []),
        ],
    ).unionByName(checks.check_unique(batch, "transactions", "transaction_id"))
    try:
        checks.validation_gate(suite)
    except checks.ValidationFailed:
        release(batch)
        raise
    return batch


def incremental_load(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    path: str,
    *,
    order: Sequence[str] = ("ingest_seq",),
    regions: Sequence[str] | None = REGIONS,
    only_touched: bool = False,
) -> int:
    """Clean and validate one raw batch, then append the transactions not stored yet.

    Stored rows win over repeated ids, so running a batch again, after a failure
    for instance, adds nothing twice; older data is never rewritten.  The batch's
    ids are looked up in the whole table, one column of it; with ``only_touched``
    just in the months the batch covers, which suffices when a repeated id keeps
    its order month.  ``indexed_load`` needs neither.  Returns the number of rows added.
    """
    with freed_shuffles(raw.sparkSession):
        fresh = _valid_batch(raw, customers, products, order, regions)
        stored = _existing(raw.sparkSession, path)
        if stored is not None:
            batch = fresh
            if only_touched:
                stored = stored.where(month_filter(_months(batch)))
            # one column of the stored table is scanned; AQE broadcasts the batch's ids if they measure small
            repeats = stored.select("transaction_id").join(batch.select("transaction_id"), "transaction_id", "left_semi")
            fresh = durable(batch.join(repeats, "transaction_id", "left_anti"))
            release(batch)
        added = fresh.count()
        if added:
            names = SALES_TRANSACTIONS.fieldNames()
            write_partitioned(fresh.select(*names), path, mode="append")
        release(fresh)
    return added


def _recover(index: IdIndex, path: str, pending: str, then: AfterLoad | None) -> None:
    """Finish a load that was interrupted: index the ids of its list that did reach the table.

    Only the months of that list are read. What did not reach the table stays unknown, so the next
    run of the same batch adds it.
    """
    spark = index.spark
    try:
        listed = spark.read.schema("transaction_id string, year int, month int").parquet(pending)
    except AnalysisException as e:
        if e.getCondition() in NOTHING_STORED:
            return
        raise
    stored = _existing(spark, path)
    months = _months(listed)
    if stored is not None and months:
        arrived = stored.where(month_filter(months)).select("transaction_id").join(listed, "transaction_id", "left_semi")
        with freed_shuffles(spark):
            missing = durable(arrived.join(index.known(arrived), "transaction_id", "left_anti").distinct())
            index.add(missing, missing.count())
            release(missing)
        if then is not None:
            then(Load(0, months))
    remove(spark, pending)


def indexed_load(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    path: str,
    *,
    order: Sequence[str] = ("ingest_seq",),
    regions: Sequence[str] | None = REGIONS,
    index: IdIndex | None = None,
    then: AfterLoad | None = None,
) -> Load:
    """``incremental_load`` whose cost follows the batch: ids are looked up in an index beside the table.

    The index (``<path>_ids`` unless given) is built from the table when there is none. The ids about to be
    stored are listed in ``<path>_pending`` first; if a load breaks off anywhere, the next one finds the
    list, reads the table's months it names and completes the index, so rows are neither lost nor
    doubled. ``then`` is called with what was stored before the list is removed, so it is called again
    after an interruption: reports that follow the table belong there. One load at a time.
    """
    spark = raw.sparkSession
    ids = index or IdIndex(spark, f"{path.rstrip('/')}_ids")
    pending = f"{path.rstrip('/')}_pending"
    if not ids.exists():
        stored = _existing(spark, path)
        with freed_shuffles(spark):
            ids.build(stored if stored is not None else spark.createDataFrame([], SALES_TRANSACTIONS))
    _recover(ids, path, pending, then)
    with freed_shuffles(spark):
        batch = _valid_batch(raw, customers, products, order, regions)
        fresh = durable(batch.join(ids.known(batch.select("transaction_id")), "transaction_id", "left_anti"))
        release(batch)
        fresh.select("transaction_id", "year", "month").write.mode("overwrite").parquet(pending)
        done = Load(fresh.count(), _months(fresh))
        if done.added:
            write_partitioned(fresh.select(*SALES_TRANSACTIONS.fieldNames()), path, mode="append")
            ids.add(fresh, done.added)
        release(fresh)
    if then is not None:
        then(done)
    remove(spark, pending)
    return done


def _set_aside(batch: DataFrame, batch_id: int, folder: str) -> None:
    """Keep the malformed records of one micro-batch; running the batch again replaces them."""
    bad = batch.withColumn("reason", record_fault("sales_transactions")).where("reason is not null")
    bad.select("file", F.col(RECORD).alias("record"), "reason").write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def incremental_stream(
    spark: SparkSession,
    source: str,
    customers: DataFrame,
    products: DataFrame,
    path: str,
    checkpoint: str,
    *,
    file_format: str = "csv",
    regions: Sequence[str] | None = REGIONS,
    max_files: int | None = None,
    only_touched: bool = False,
    indexed: bool = False,
    then: AfterLoad | None = None,
    multi_line: bool = False,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Load every file not seen before, then stop; start it again for the next files.

    Late rows need no watermark: they are added to their own month.  A replayed
    batch finds its ids stored and adds nothing.  ``only_touched`` is the choice
    that ``incremental_load`` documents; ``indexed`` takes ``indexed_load`` with ``then``.
    CSV records are read as ``readers.read_raw`` reads them; malformed ones go to
    ``quarantine`` (``<path>_quarantine`` unless given) with their file and the reason.
    """
    is_csv = file_format == "csv"
    if is_csv:
        reader = spark.readStream.schema(raw_schema("sales_transactions")).options(**CSV_OPTIONS)
        reader = reader.option("header", True).option("multiLine", multi_line)
    else:
        reader = spark.readStream.schema(RAW["sales_transactions"])
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.format(file_format).load(source)
    if is_csv:
        files = files.select("*", F.col("_metadata.file_path").alias("file"))
    aside = quarantine or f"{path.rstrip('/')}_quarantine"

    def load(batch: DataFrame, batch_id: int) -> None:
        # within a batch the first row by content wins
        if not is_csv:
            add(batch.withColumn("ingest_seq", F.struct(*batch.columns)), ["ingest_seq"])
            return
        with freed_shuffles(batch.sparkSession):
            parsed = durable(batch)  # parsed once, read for both sides
            _set_aside(parsed, batch_id, aside)
            rows = readable(parsed, "sales_transactions").drop("file")
        # missing-value tokens are NULL already, so the texts themselves are the order and travel once
        add(rows, rows.columns)
        release(parsed)

    def add(rows: DataFrame, order: Sequence[str]) -> None:
        if indexed:
            indexed_load(rows, customers, products, path, order=order, regions=regions, then=then)
        else:
            incremental_load(rows, customers, products, path, order=order, regions=regions, only_touched=only_touched)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
