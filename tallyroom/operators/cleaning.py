"""Cleaning rules.  Each rule is ``rule(df, ...) -> df`` and chains with ``df.transform``."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyroom.functions.durable import durable
from tallyroom.functions.money import rounded
from tallyroom.functions.ordering import exact_quantiles
from tallyroom.schemas import DEFAULT_SEGMENT, REGIONS, SALES_TRANSACTIONS, SEGMENTS, UNKNOWN_REGION

TRANSACTION_REQUIRED = ("transaction_id", "customer_id", "product_id", "order_date", "unit_price", "quantity")


def dedupe_by_key(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """Keep each key's first row by ``order`` (one NULL key counts as a key too).

    The rank filter is applied map-side before the shuffle (WindowGroupLimit), so
    a key repeated over a third of the table moves one row per input partition.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


#: What stands for "no value" in delivered text files: the tokens pandas reads as missing (fixed values).
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
#: Date texts that are read besides ISO dates and timestamps.
DATE_FORMATS = ("yyyy/M/d", "M/d/yyyy", "d MMM yyyy")
#: What every text of a format looks like: others are not tried, since a failing try costs an exception each.
DATE_SHAPES = {
    "yyyy/M/d": "^[+-]?[0-9]{4,}/[0-9]+/[0-9]+$",
    "M/d/yyyy": "^[0-9]+/[0-9]+/[+-]?[0-9]{4,}$",
    "d MMM yyyy": "^[0-9]+ [^ ]+ [+-]?[0-9]{4,}$",
}


def mark_missing(df: DataFrame) -> DataFrame:
    """Missing-value tokens in text columns become NULL."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(*MISSING), F.col(c)) for c in texts})


def day_of(c: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A text as DATE, by ISO first and then by ``formats`` in turn; unreadable gives NULL."""
    texts = F.trim(F.col(c).cast("string"))
    others = [_tried(texts, f) for f in formats]
    return F.coalesce(texts.try_cast("date"), *others)


def _tried(texts: Column, f: str) -> Column:
    day = F.try_to_timestamp(texts, F.lit(f)).cast("date")
    return F.when(texts.rlike(DATE_SHAPES[f]), day) if f in DATE_SHAPES else day


def number_of(c: str) -> Column:
    """A text as DOUBLE; unreadable, NaN and infinite give NULL."""
    texts = F.trim(F.col(c).cast("string"))
    x = F.when(texts.rlike("[0-9]"), texts.try_cast("double"))  # a failing cast costs an exception
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def whole_of(c: str) -> Column:
    """A text as INT: ``3`` and ``3.0`` are three, ``2.5`` and what is unreadable give NULL."""
    x = number_of(c)
    return F.when((x == F.floor(x)) & (F.abs(x) < 2**31), x.try_cast("int"))


def coerce_dates(
    df: DataFrame,
    required: Sequence[str] = (),
    optional: Sequence[str] = (),
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Text to DATE, unreadable to NULL; rows without a ``required`` date are dropped."""
    out = df.withColumns({c: day_of(c, formats) for c in (*required, *optional)})
    return out.dropna(subset=list(required)) if required else out


def coerce_numbers(df: DataFrame, doubles: Sequence[str] = (), integers: Sequence[str] = ()) -> DataFrame:
    """Text to number; unreadable, NaN, infinite and, for ``integers``, fractional values become NULL."""
    return df.withColumns({c: number_of(c) for c in doubles} | {c: whole_of(c) for c in integers})


def standardise_region(df: DataFrame, valid: Sequence[str] = REGIONS, column: str = "region") -> DataFrame:
    """Trim and capitalise words; anything else, NULL included, becomes ``Unknown``.

    ``initcap`` starts a word after white space only, which is enough for region names.
    """
    name = F.initcap(F.trim(column))
    return df.withColumn(column, F.when(name.isin(*valid), name).otherwise(UNKNOWN_REGION))


def standardise_segment(
    df: DataFrame, valid: Sequence[str] = SEGMENTS, default: str = DEFAULT_SEGMENT, column: str = "segment"
) -> DataFrame:
    name = F.trim(column)
    return df.withColumn(column, F.when(name.isin(*valid), name).otherwise(default))


def normalise_email(df: DataFrame, column: str = "email") -> DataFrame:
    return df.withColumn(column, F.trim(F.lower(column)))


def drop_bad_prices(df: DataFrame) -> DataFrame:
    """Rows whose price and cost are both present and positive; NaN is neither."""
    return df.where(_positive("unit_price") & _positive("unit_cost"))


def _positive(c: str) -> Column:
    return (F.col(c) > 0) & ~F.isnan(c)


def cap_outliers(
    df: DataFrame, columns: Sequence[str] = ("unit_cost", "unit_price"), quantile: float = 0.999
) -> DataFrame:
    """Cut each column at its exact upper quantile (linear interpolation).

    The table is stored first: it is read once per column and once for the result.
    """
    df = durable(df)
    caps = {c: exact_quantiles(df, c, [quantile]).scalar() for c in columns}
    return df.withColumns({c: F.when(F.col(c) > cap, cap).otherwise(F.col(c)) for c, cap in caps.items()})


def derive_margin_pct(df: DataFrame) -> DataFrame:
    price, cost = F.col("unit_price"), F.col("unit_cost")
    return df.withColumn("margin_pct", rounded(F.try_divide(price - cost, price) * 100))


def drop_orphans(txn: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Transactions whose customer and product both exist; keys are never collected."""
    known = txn.join(products.select("product_id"), "product_id", "left_semi")
    return known.join(customers.select("customer_id"), "customer_id", "left_semi").select(*txn.columns)


def filter_positive_quantity(df: DataFrame) -> DataFrame:
    return df.where(F.col("quantity") > 0)


def clip_discount(df: DataFrame) -> DataFrame:
    """Into 0 to 1; a missing discount, NaN included, is none."""
    d = F.col("discount")
    return df.withColumn(
        "discount", F.when(d.isNull() | F.isnan(d) | (d < 0), 0.0).when(d > 1, 1.0).otherwise(d)
    )


def fix_ship_date(df: DataFrame) -> DataFrame:
    """A shipment before its order moves to the order day; a missing one stays missing."""
    early = F.col("ship_date") < F.col("order_date")
    return df.withColumn("ship_date", F.when(early, F.col("order_date")).otherwise(F.col("ship_date")))


def derive_net_revenue(df: DataFrame) -> DataFrame:
    net = F.col("unit_price") * F.col("quantity") * (1 - F.col("discount"))
    return df.withColumn("net_revenue", rounded(net))


def derive_partitions(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})


def clean_customers(
    raw: DataFrame,
    order: Sequence[str | Column] = ("ingest_seq",),
    regions: Sequence[str] = REGIONS,
    segments: Sequence[str] = SEGMENTS,
    default_segment: str = DEFAULT_SEGMENT,
) -> DataFrame:
    return (
        raw.transform(mark_missing)
        .transform(dedupe_by_key, "customer_id", order)
        .transform(drop_missing, ["customer_id", "email"])
        .transform(coerce_dates, ["signup_date"])
        .transform(standardise_region, regions)
        .transform(standardise_segment, segments, default_segment)
        .transform(normalise_email)
        .drop("ingest_seq")
    )


def kept_products(raw: DataFrame, order: Sequence[str | Column] = ("ingest_seq",)) -> DataFrame:
    """The products that cleaning keeps, prices not capped yet: capping never changes a key."""
    return (
        raw.transform(mark_missing)
        .transform(dedupe_by_key, "product_id", order)
        .transform(drop_missing, ["product_id", "product_name"])
        .transform(coerce_numbers, ["unit_cost", "unit_price"])
        .transform(drop_bad_prices)
    )


def clean_products(
    raw: DataFrame, order: Sequence[str | Column] = ("ingest_seq",), cap_quantile: float = 0.999
) -> DataFrame:
    return (
        kept_products(raw, order)
        .transform(cap_outliers, ("unit_cost", "unit_price"), cap_quantile)
        .transform(derive_margin_pct)
        .drop("ingest_seq")
    )


def read_transaction_values(raw: DataFrame) -> DataFrame:
    """Texts of raw transactions as values; no row is dropped."""
    return raw.transform(coerce_numbers, ["unit_price", "discount"], ["quantity"]).transform(
        coerce_dates, (), ["order_date", "ship_date"]
    )


def _sellable(txn: DataFrame) -> DataFrame:
    return txn.transform(drop_missing, TRANSACTION_REQUIRED).transform(filter_positive_quantity)


def _finished(txn: DataFrame) -> DataFrame:
    return (
        txn.transform(clip_discount)
        .transform(fix_ship_date)
        .transform(derive_net_revenue)
        .transform(derive_partitions)
    )


def clean_transaction_rows(raw: DataFrame) -> DataFrame:
    """The row-by-row transaction rules: no shuffle, no state."""
    return raw.transform(read_transaction_values).transform(_sellable).transform(_finished)


def clean_transactions(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    order: Sequence[str | Column] = ("ingest_seq",),
) -> DataFrame:
    """Deduplicate, apply the row rules, keep rows with known keys.

    The first row of a key wins even if a later rule drops it, so the
    deduplication has to come before the rules that drop.  Columns are derived
    behind the last shuffle.
    """
    return (
        _first_rows(raw, order)
        .drop(*[f"{name}_unreadable" for name in _READ])
        .transform(_sellable)
        .transform(drop_orphans, customers, products)
        .transform(_finished)
        .drop("ingest_seq")
    )


#: Columns of a raw transaction that are read from text, and how.
_READ = {"unit_price": number_of, "discount": number_of, "quantity": whole_of, "order_date": day_of, "ship_date": day_of}


def _first_rows(raw: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Deduplicated transactions, values read, with a flag ``<column>_unreadable`` beside each; no other row is dropped.

    Texts are read before the shuffle of the deduplication, once and into narrower rows, unless its order
    may depend on them.
    """

    def read(df: DataFrame) -> DataFrame:
        flags = {f"{name}_unreadable": _unreadable(name, of(name)) for name, of in _READ.items()}
        return df.withColumns(flags | {name: of(name) for name, of in _READ.items()})

    texts = mark_missing(raw)
    if all(isinstance(o, str) and o not in _READ for o in order):
        return dedupe_by_key(read(texts), "transaction_id", order)
    return read(dedupe_by_key(texts, "transaction_id", order))


def _audit(table: str, steps: DataFrame) -> DataFrame:
    """(step, rows) counts of one table as rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("step"), F.col(c).cast("bigint").alias("rows")) for c in steps.columns])
    return steps.select(F.lit(table).alias("table_name"), F.inline(pairs))


def _count(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def _linked(
    raw: DataFrame, customers: DataFrame, products: DataFrame, order: Sequence[str | Column]
) -> DataFrame:
    """Deduplicated transactions, none dropped yet: values read, what was unreadable, which parents exist."""
    return (
        _first_rows(raw, order)
        .select("transaction_id", "customer_id", "product_id", "region", *[f"{name}_unreadable" for name in _READ], *_READ)
        .join(customers.select("customer_id", F.lit(True).alias("has_customer")), "customer_id", "left")
        .join(products.select("product_id", F.lit(True).alias("has_product")), "product_id", "left")
    )


def _sold() -> tuple[Column, Column, Column]:
    """Rows of ``_linked`` that are complete, that also have both parents, and that are kept."""
    complete = F.lit(True)
    for name in TRANSACTION_REQUIRED:
        complete = complete & F.col(name).isNotNull()
    known = complete & F.col("has_customer").isNotNull() & F.col("has_product").isNotNull()
    return complete, known, known & (F.col("quantity") > 0)


def _transaction_counts() -> list[Column]:
    complete, known, sold = _sold()
    return [
        F.count(F.lit(1)).alias("after_dedupe"),
        *[_count(F.col(f"{name}_unreadable")).alias(f"unreadable_{name}") for name in _READ],
        _count(complete).alias("with_keys_and_date"),
        _count(complete & F.col("has_customer").isNull()).alias("unknown_customer"),
        _count(complete & F.col("has_product").isNull()).alias("unknown_product"),
        _count(known & ~(F.col("quantity") > 0)).alias("bad_quantity"),
        _count(sold & (F.col("ship_date") < F.col("order_date"))).alias("ship_date_fixed"),
        _count(sold).alias("final"),
    ]


def write_clean_transactions(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    path: str,
    order: Sequence[str | Column] = ("ingest_seq",),
) -> DataFrame:
    """Store what ``clean_transactions`` makes, by year and month, and return the audit of that very pass.

    ``(table_name, step, rows)`` as ``cleaning_audit`` has it for the transactions. The counts are
    observed in the tasks that write, behind the last shuffle: such a task counts once however often it or a stage before it is
    repeated. Rows to be dropped travel that far with their flags. ``loaded`` alone is a
    count of the input, for which Parquet reads footers only. Customer and product ids are unique.
    """
    seen = Observation(f"cleaning-{uuid.uuid4().hex}")
    spread = _linked(raw, customers, products, order).transform(derive_partitions).hint("rebalance", F.col("year"), F.col("month"))
    kept = (
        spread.observe(seen, *_transaction_counts())
        .where(_sold()[2])
        .transform(clip_discount)
        .transform(fix_ship_date)
        .transform(derive_net_revenue)
        .select(*SALES_TRANSACTIONS.fieldNames())
    )
    kept.write.mode("overwrite").option("compression", "snappy").partitionBy("year", "month").parquet(path)
    counts = seen.get
    names = ["after_dedupe", *(f"unreadable_{n}" for n in _READ), "with_keys_and_date", "unknown_customer", "unknown_product"]
    names += ["bad_quantity", "ship_date_fixed", "final"]
    rows = [("loaded", raw.count()), *((n, counts.get(n, 0)) for n in names)]
    return raw.sparkSession.createDataFrame(
        [("sales_transactions", n, c) for n, c in rows], "table_name string, step string, rows bigint"
    )


def cleaning_audit(
    raw_customers: DataFrame,
    raw_products: DataFrame,
    raw_transactions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    regions: Sequence[str] = REGIONS,
    segments: Sequence[str] = SEGMENTS,
    cap_quantile: float = 0.999,
    quarantined: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Rows loaded, removed, changed and unreadable per cleaning step, as ``(table_name, step, rows)``.

    ``customers`` and ``products`` need their keys only.  Each table is counted
    as loaded once and deduplicated once; all later steps are counted in that
    one pass.  ``unreadable_...`` are texts that are there but no value.
    """
    loaded = {
        "customers": raw_customers.agg(F.count(F.lit(1)).alias("loaded")),
        "products": raw_products.agg(F.count(F.lit(1)).alias("loaded")),
        "sales_transactions": raw_transactions.agg(F.count(F.lit(1)).alias("loaded")),
    }

    c = dedupe_by_key(mark_missing(raw_customers), "customer_id", ["ingest_seq"])
    keyed = F.col("customer_id").isNotNull() & F.col("email").isNotNull()
    day = day_of("signup_date")
    kept = keyed & day.isNotNull()
    region_ok = F.coalesce(F.initcap(F.trim("region")).isin(*regions), F.lit(False))
    segment_ok = F.coalesce(F.trim("segment").isin(*segments), F.lit(False))
    customer_steps = c.agg(
        F.count(F.lit(1)).alias("after_dedupe"),
        _count(keyed).alias("with_keys"),
        _count(keyed & day.isNull()).alias("bad_signup_date"),
        _count(kept & ~region_ok).alias("region_replaced"),
        _count(kept & ~segment_ok).alias("segment_replaced"),
        _count(kept).alias("final"),
    )

    amounts = ("unit_cost", "unit_price")
    p = dedupe_by_key(mark_missing(raw_products), "product_id", ["ingest_seq"])
    p = durable(
        p.withColumns({f"{c}_unreadable": _unreadable(c, number_of(c)) for c in amounts}).transform(coerce_numbers, amounts)
    )
    priced = drop_bad_prices(drop_missing(p, ["product_id", "product_name"]))
    caps = {col: exact_quantiles(priced, col, [cap_quantile]).scalar() for col in amounts}
    named = F.col("product_id").isNotNull() & F.col("product_name").isNotNull()
    good = named & F.coalesce(_positive("unit_price") & _positive("unit_cost"), F.lit(False))
    product_steps = p.select(
        named.alias("named"),
        good.alias("good"),
        *[f"{c}_unreadable" for c in amounts],
        *[(good & (F.col(col) > cap)).alias(f"{col}_over") for col, cap in caps.items()],
    ).agg(
        F.count(F.lit(1)).alias("after_dedupe"),
        *[_count(F.col(f"{c}_unreadable")).alias(f"unreadable_{c}") for c in amounts],
        _count(F.col("named")).alias("with_keys"),
        _count(F.col("named") & ~F.col("good")).alias("bad_price"),
        _count(F.col("unit_cost_over")).alias("unit_cost_capped"),
        _count(F.col("unit_price_over")).alias("unit_price_capped"),
        _count(F.col("good")).alias("final"),
    )

    linked = _linked(raw_transactions, customers, products, ["ingest_seq"])
    transaction_steps = linked.agg(*_transaction_counts())
    parts = [_audit(name, df) for name, df in loaded.items()]
    parts += [
        _audit(name, df.agg(F.count(F.lit(1)).alias("quarantined"))) for name, df in (quarantined or {}).items()
    ]
    parts += [
        _audit("customers", customer_steps),
        _audit("products", product_steps),
        _audit("sales_transactions", transaction_steps),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _unreadable(c: str, value: Column) -> Column:
    return F.col(c).isNotNull() & value.isNull()
