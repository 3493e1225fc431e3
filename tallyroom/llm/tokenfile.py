"""Token ids as binary segments of patched frame-of-reference blocks.

A segment holds whole documents. Its ids are cut into blocks of 128. Each block stores its minimum,
the differences to it at the width that nine in ten of them fit (the lower bits of the others too),
and a list of exceptions with the bits that did not fit. ``block starts`` index the packed bytes, so a
block can be read alone. Segments are rows of Parquet files: Spark's commit protocol makes a lost or
repeated task harmless and any store that Spark writes to will do.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import sliced, text_or_empty
from .tokens import encoder

BLOCK = 128
SEGMENT = 1 << 18
END = 2
#: Of the sorted differences of a block, the one whose width is taken: the 90th percentile.
_RANK = int(0.9 * (BLOCK - 1))
_MAGIC = b"PFR1"


def _bits(v: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(v.astype(np.float64) + 1)).astype(np.uint8)


def _pack(low: np.ndarray, width: int) -> np.ndarray:
    """(128, m) values of ``width`` bits to (m, 2 * width) words."""
    out = np.zeros((2 * width, low.shape[1]), dtype=np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[word] |= low[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= low[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    words = np.ascontiguousarray(words.T)
    out, mask = np.zeros((BLOCK, words.shape[1]), dtype=np.uint64), np.uint64((1 << width) - 1)
    for i in range(BLOCK if width else 0):
        word, shift = divmod(i * width, 64)
        v = words[word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (words[word + 1] << np.uint64(64 - shift))
        out[i] = v & mask
    return np.ascontiguousarray(out.T)


def encode(ids: np.ndarray) -> bytes:
    """A segment's bytes from unsigned 32-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.empty(blocks * BLOCK, dtype=np.uint64)
    padded[:n] = ids
    padded[n:] = ids[-1] if n else 0
    padded = padded.reshape(blocks, BLOCK)
    base = padded.min(axis=1, initial=np.iinfo(np.uint32).max) if blocks else np.zeros(0, np.uint64)
    delta = padded - base[:, None]
    width = _bits(np.partition(delta, _RANK, axis=1)[:, _RANK]) if blocks else np.zeros(0, np.uint8)
    high = delta >> width[:, None].astype(np.uint64)
    at_block, at = np.nonzero(high)
    starts = np.concatenate(([0], np.cumsum(width.astype(np.int64) * (BLOCK // 8))))
    packed = np.zeros(int(starts[-1]), dtype=np.uint8)
    for w in np.unique(width):
        if w:
            rows = np.nonzero(width == w)[0]
            words = _pack(np.ascontiguousarray((delta[rows] & np.uint64((1 << int(w)) - 1)).T), int(w))
            place = starts[rows][:, None] + np.arange(int(w) * (BLOCK // 8))
            packed[place] = words.astype("<u8").view(np.uint8).reshape(len(rows), -1)
    return b"".join(
        (
            _MAGIC,
            struct.pack("<QII", n, blocks, len(at)),
            base.astype("<u4").tobytes(),
            width.tobytes(),
            starts[:-1].astype("<u4").tobytes(),
            np.bincount(at_block, minlength=blocks).astype(np.uint8).tobytes(),
            at.astype(np.uint8).tobytes(),
            high[at_block, at].astype("<u4").tobytes(),
            packed.tobytes(),
        )
    )


def decode(data: bytes) -> np.ndarray:
    """The ids of a segment; the inverse of ``encode``."""
    if data[:4] != _MAGIC:
        raise ValueError("not a token segment")
    n, blocks, exceptions = struct.unpack_from("<QII", data, 4)
    at = 20

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, dtype=kind, count=count, offset=at)
        at += out.nbytes
        return out

    base, width, starts = take("<u4", blocks), take("u1", blocks), take("<u4", blocks)
    per_block, place, high = take("u1", blocks), take("u1", exceptions), take("<u4", exceptions)
    packed = np.frombuffer(data, dtype=np.uint8, offset=at)
    delta = np.zeros((blocks, BLOCK), dtype=np.uint64)
    for w in np.unique(width):
        if w:
            rows = np.nonzero(width == w)[0]
            got = packed[starts[rows].astype(np.int64)[:, None] + np.arange(int(w) * (BLOCK // 8))]
            delta[rows] = _unpack(np.ascontiguousarray(got).view("<u8"), int(w))
    rows = np.repeat(np.arange(blocks), per_block)
    delta[rows, place] |= high.astype(np.uint64) << width[rows].astype(np.uint64)
    return (delta + base[:, None].astype(np.uint64)).reshape(-1)[:n].astype(np.uint32)


_SEGMENTS = "shard int, segment int, first long, doc_ids array<long>, counts array<long>, n_ids long, payload binary"


def _write_segments(path: str, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    code, tail = encoder(path), np.array([end], dtype="<u4").tobytes()
    shard, segment, first = TaskContext.get().partitionId(), 0, 0
    docs, counts, held, size = [], [], [], 0

    def flush() -> pa.RecordBatch:
        nonlocal segment, first, docs, counts, held, size
        ids = np.frombuffer(b"".join(held), dtype="<u4")
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([segment], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())),
                pa.array([len(ids)], pa.int64()),
                pa.array([encode(ids)], pa.binary()),
            ],
            [f.split()[0] for f in _SEGMENTS.split(", ")],
        )
        segment, first = segment + 1, first + len(ids)
        docs, counts, held, size = [], [], [], 0
        return out

    for b in sliced(batches):
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids = code.packed(text) + tail
            docs.append(doc)
            counts.append(len(ids) // 4)
            held.append(ids)
            size += len(ids) // 4
            if size >= SEGMENT:
                yield flush()
    if docs:
        yield flush()
    code.rest()


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END) -> None:
    """Writes the ids of all documents, each followed by ``end``, in ascending doc_id order.

    Null text counts as empty: the end id alone. Rows without doc_id come first; rows that repeat an
    id stay separate, in an order given by their texts. Texts are sorted into ranges before they are
    encoded, so the ids themselves are never shuffled; a repeated id is spread over several ranges.
    """
    text = text_or_empty()
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("_tie"),
        F.spark_partition_id().alias("_from"),
    )
    order = ["doc_id", "_tie", "_from"]
    ranged = plain.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(partial(_write_segments, tokenizer, end), _SEGMENTS).write.parquet(path)


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for base, first, docs, counts, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
            ids = decode(payload).astype("<u4")
            ends = np.cumsum(counts)
            starts = ends - counts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, pa.int64()),
                    pa.array(starts + base + first, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([ids[a:z].tobytes() for a, z in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()),
                ],
                ["doc_id", "start", "n_tokens", "ids"],
            )


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from written files; ids are little-endian unsigned 32-bit bytes.

    ``start`` counts all ids of documents before; only one total per shard is summed up for it.
    """
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (
        segments.groupBy("shard")
        .agg(F.sum("n_ids").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    # one row per range that was written, so it may be broadcast; the payloads are then never shuffled
    return (
        segments.join(F.broadcast(shards), "shard")
        .select("base", "first", "doc_ids", "counts", "payload")
        .mapInArrow(_read_segments, "doc_id long, start long, n_tokens long, ids binary")
    )
