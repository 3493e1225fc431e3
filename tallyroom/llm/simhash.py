"""SimHash near-duplicates, linked by multi-index hashing.

The 64 bits are cut into two 32-bit segments. Fingerprints that differ in at most four bits differ in
at most two bits of the high segment or in at most one bit of the low one, so both sides list a small
Hamming ball around each segment: radius one around the high segment (balls of radius one meet when
the centres are at most two bits apart), and the low segment itself plus every copy with one set bit
cleared (of two values one bit apart, one is the other with a bit cleared). Equal list entries are the
table matches; complete distances are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected
from .store import Scratch, fresh, sliced, text_or_empty, unless_many

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: Largest bucket whose pairs are compared one by one; larger ones are linked through Hamming balls.
BUCKET = 256

_SPREAD = np.array([sum(((v >> i) & 1) << (8 * i) for i in range(8)) for v in range(256)], dtype=np.uint64)
_BIT = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit integer; 0 without words."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six ASCII space characters
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    stops = (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]) - 1
    starts = np.concatenate(([0], ends))[: len(stops)]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)),
        dtype=np.uint64,
        count=len(stops),
    )
    ones = np.zeros(64, dtype=np.int64)
    octets = h.view(np.uint8).reshape(-1, 8)
    for a in range(0, len(h), 255):  # eight counters of one byte in a word: at most 255 additions
        lanes = _SPREAD[octets[a : a + 255]].sum(axis=0, dtype=np.uint64)
        ones += lanes.view(np.uint8)
    return int(_BIT[ones * 2 > len(h)].sum(dtype=np.uint64).view(np.int64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        made = [fingerprint(t) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array(made, pa.int64())], ["doc_id", "text_hash", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, fp)``, one row per document row; null text counts as empty."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long"), text.cast("binary").alias("text"), F.xxhash64(text).alias("text_hash")
    ).mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


def _ball_keys(fp: DataFrame) -> DataFrame:
    """``(key, fp)``: the list entries of both segments; bit 32 of the key tells the segments apart."""
    masks = F.array(*(F.lit(1 << i) for i in range(32))).cast("array<bigint>")
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    tag = F.lit(1 << 32)
    return fp.withColumns({"hi": high, "lo": low}).select(
        F.explode(
            F.concat(
                F.array(F.col("hi"), F.col("lo") + tag),
                F.transform(masks, lambda m: F.col("hi").bitwiseXOR(m)),
                F.transform(
                    F.filter(masks, lambda m: F.col("lo").bitwiseAND(m) != 0),
                    lambda m: F.col("lo").bitwiseXOR(m) + tag,
                ),
            )
        ).alias("key"),
        "fp",
    )


def _forest(values: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links inside one bucket."""
    x = values.view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= MAX_BITS
    left, out = np.ones(len(x), dtype=bool), []
    for s in range(len(x)):
        if not left[s]:
            continue
        left[s], stack = False, [s]
        while stack:
            i = stack.pop()
            found = np.nonzero(near[i] & left)[0]
            left[found] = False
            out += [(int(values[i]), int(values[j])) for j in found]
            stack += found.tolist()
    return out


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [link for v in b.column(0).to_pylist() for link in _forest(np.array(v, dtype=np.int64))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in got], pa.int64()) for k in (0, 1)], ["a", "b"]
        )


def links(scratch: Scratch, fp: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints that connect exactly what distance <= 4 connects.

    A bucket of up to ``bucket`` fingerprints gives a spanning forest of its links, so a group of near
    copies costs as many rows as it has members. The members of larger buckets are never compared in
    pairs: each lists its complete Hamming ball of radius two over all 64 bits. Two fingerprints share
    an entry if and only if they differ in at most four bits, so linking all that share an entry to
    its smallest member is exact.
    """
    keys = _ball_keys(fp)
    busy = scratch.write(
        keys.groupBy("key")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1"),
        "buckets",
    )
    two = busy.where(f"n = 2 and bit_count(a ^ b) <= {MAX_BITS}").select("a", "b")
    # most buckets hold one fingerprint or two: what is left is often small enough to be broadcast
    crowded = scratch.write(busy.where("n > 2").select("key", "n"), "crowded")
    members = scratch.write(keys.join(unless_many(crowded), "key"), "members")
    few = (
        members.where(F.col("n") <= bucket)
        .groupBy("key")
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
        .mapInArrow(_bucket_links, "a long, b long")
    )
    balls = [0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i in range(64) for j in range(i))]
    signed = F.array(*(F.lit(m - (1 << 64) if m >> 63 else m) for m in balls)).cast("array<bigint>")
    hubs = (
        members.where(F.col("n") > bucket)
        .select("fp")
        .distinct()
        .select(F.explode(F.transform(signed, lambda m: F.col("fp").bitwiseXOR(m))).alias("hub"), "fp")
    )
    met = scratch.write(hubs.groupBy("hub").agg(F.count("*").alias("n"), F.min("fp").alias("a")).where("n > 1"), "hubs")
    many = hubs.join(unless_many(met).select("hub", "a"), "hub").where("fp <> a").select("a", F.col("fp").alias("b"))
    out = scratch.write(two.unionByName(few).unionByName(many).distinct(), "pairs")
    scratch.drop(busy, crowded, members, met)
    return out


def _components(docs: DataFrame, bucket: int) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)``, one row per row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.write(fingerprints(docs), "fingerprints")
    distinct = scratch.write(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    pairs = links(scratch, distinct.select("fp"), bucket)
    star = scratch.write(connected(scratch, pairs, "a", "b"), "star")
    rooted = scratch.write(
        distinct.join(unless_many(star).withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    smallest = scratch.write(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    label = scratch.write(rooted.join(unless_many(smallest), "root").select("fp", "root", "component_id"), "labels")
    scratch.drop(distinct, pairs, star, rooted, smallest)
    return marked.join(unless_many(label), "fp")


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    Texts are lower-cased (A-Z), cut at ASCII white space and hashed as 4-word shingles, repeats
    included. Null, empty and blank texts have fingerprint zero and are linked like any other. Rows
    with the same doc_id stay separate rows. A null doc_id is never the smallest of a group with
    other ids; a group of nulls alone has a null component. No documents give no rows. Other columns
    are ignored.
    """
    return _components(docs, bucket).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id, in all its columns.

    Of several rows with that id the one with the smallest text hash stays, of equal rows any one.
    Groups without any id keep one row. Null, empty and blank texts form one group.
    """
    scratch = Scratch(docs.sparkSession, "keep")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    kept = scratch.write(
        _components(docs, bucket).groupBy("root").agg(F.min(order).alias("k")).select(
            F.col("k.doc_id").alias("_kept_id"), F.col("k.text_hash").alias("_kept_hash")
        ),
        "kept",
    )
    text_hash, row = fresh(docs, "text_hash"), fresh(docs, "row_")
    hashed = docs.withColumn(text_hash, F.xxhash64(text_or_empty()))
    same = hashed["doc_id"].cast("long").eqNullSafe(kept["_kept_id"]) & (hashed[text_hash] == kept["_kept_hash"])
    once = Window.partitionBy("doc_id", text_hash).orderBy(F.lit(0))
    return (
        hashed.join(unless_many(kept), same, "left_semi")
        .withColumn(row, F.row_number().over(once))
        .where(F.col(row) == 1)
        .select(*docs.columns)
    )
