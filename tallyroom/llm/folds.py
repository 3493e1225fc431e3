"""Which labelled rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import text_or_empty

FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, modulo five, is zero.

    A null id is hashed as an empty text, whose crc32 is zero: held out.
    """
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """At most ``bound`` training rows ``(text, label)`` with their whole texts, in an order of their own.

    Drawn by a hash of the id, so the same rows come whatever the partitioning. Labels other than 0
    and 1, null ids and ids with contradictory labels are left out; a repeated label row counts once.
    The drawn ids are at most ``bound`` rows, which is why they may be broadcast; a repeated document
    id contributes its smallest text.
    """
    drawn = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(label).alias("y"), F.max(label).alias("_other"))
        .where("y = _other")
        .select("doc_id", F.col("y").cast("int").alias("y"), F.xxhash64("doc_id").alias("_draw"))
        .orderBy("_draw", "doc_id")
        .limit(bound)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return (
        texts.join(F.broadcast(drawn), "doc_id")
        .groupBy("doc_id", "y", "_draw")
        .agg(F.min("text").alias("text"))
        .select("text", "y", "_draw")
    )
