"""Exact substring deduplication by level-wise doubling of repeated word windows.

Lengths double from level to level and end at the full length (13, 25 and 50 words; an odd length is
made of two windows that share a word). Of each full window only the window of the level's length with
the smallest hash takes part, so equal full windows bring the same representative and one window in
twenty to fourteen is listed. Only full windows whose representative occurs in another document go on
to the next level, until none is left or the full length is reached, where a 128-bit hash decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch, sliced, text_or_empty

LENGTH = 50
#: No level looks at windows of fewer words: shorter ones are repeated by chance.
SHORTEST = 10

# Odd multipliers, five modulo eight, so that no power below 2**8 comes close to one modulo 2**64.
_BASE = (6364136223846793005, 2862933555777941757)


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), dtype=np.uint64, count=len(words))


def window_hashes(values: np.ndarray, length: int, base: int = 0) -> np.ndarray:
    """Polynomial hash (modulo 2**64) of every window of ``length`` values, by doubling.

    A window of 2n is two neighbouring windows of n; odd parts of the length are appended on the way.
    """
    if len(values) < length:
        return np.zeros(0, dtype=np.uint64)

    def joined(left: np.ndarray, n: int, right: np.ndarray, m: int) -> np.ndarray:
        count = len(values) - n - m + 1
        return left[:count] * np.uint64(pow(_BASE[base], m, 1 << 64)) + right[n : n + count]

    with np.errstate(over="ignore"):
        power, size, whole, have = values, 1, None, 0
        for bit in range(length.bit_length()):
            if bit:
                power, size = joined(power, size, power, size), 2 * size
            if length >> bit & 1:
                whole, have = (power, size) if whole is None else (joined(whole, have, power, size), have + size)
    return whole


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, done = values, 1
    while done * 2 <= width:
        out = np.minimum(out[: len(out) - done], out[done:])
        done *= 2
    more = width - done
    return np.minimum(out[: len(out) - more], out[more:]) if more else out


def levels(length: int, shortest: int = SHORTEST) -> list[int]:
    """Window lengths, ascending to ``length``: each is half of the next, rounded up."""
    out = [length]
    while out[0] > 1 and (half := -(-out[0] // 2)) >= shortest:
        out.insert(0, half)
    return out


def representatives(values: np.ndarray, length: int, part: int) -> np.ndarray:
    """For every full window the smallest hash of its windows of ``part`` words."""
    hashed = window_hashes(values, part)
    width = length - part + 1
    if len(hashed) < width:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):  # high bits of a polynomial are the good ones: spread them
        hashed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
    return sliding_min(hashed, width)


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    sizes = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, kind))


def _first_level(length: int, part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        count, digest, marks = [], [], []
        for t in b.column(1).to_pylist():
            words = t.split()
            count.append(len(words))
            digest.append(hashlib.sha256(b" ".join(words)).digest())
            reps = representatives(word_hashes(words), length, part) if len(words) >= length else np.zeros(0, np.uint64)
            marks.append(np.unique(reps).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                b.column(2),
                pa.array(count, pa.int64()),
                pa.array(digest, pa.binary()),
                _lists(marks, pa.int64()),
            ],
            ["doc_id", "text_hash", "n_words", "sha", "marks"],
        )


def _alive(values: np.ndarray, length: int, part: int, marks: list[int]) -> np.ndarray:
    """Starts of full windows whose representative of ``part`` words is one of ``marks``."""
    return np.nonzero(np.isin(representatives(values, length, part).view(np.int64), np.array(marks, np.int64)))[0]


def _next_level(length: int, part: int, longer: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Representatives of ``longer`` words of the full windows that are left at ``part`` words."""
    for b in sliced(batches):
        found = []
        for text, marks in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            values = word_hashes(text.split())
            left = _alive(values, length, part, marks)
            found.append(np.unique(representatives(values, length, longer)[left]).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), _lists(found, pa.int64())], ["doc_id", "text_hash", "marks"]
        )


def _last_level(length: int, part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full windows whose representative is repeated, one row per document and different window."""
    for b in sliced(batches):
        key, name, high, low, place = [], [], [], [], []
        for doc, text_hash, text, marks in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            values = word_hashes(text.split())
            wanted = _alive(values, length, part, marks)
            if not len(wanted):
                continue
            h = window_hashes(values, length)[wanted]
            g = window_hashes(values, length, 1)[wanted]
            order = np.lexsort((wanted, g, h))
            h, g, wanted = h[order], g[order], wanted[order]
            starts = np.nonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (g[1:] != g[:-1]))))[0]
            high.append(h[starts])
            low.append(g[starts])
            key.append(np.full(len(starts), doc, dtype=np.int64))
            name.append(np.full(len(starts), text_hash, dtype=np.int64))
            place += [w.astype(np.int32) for w in np.split(wanted, starts[1:])]
        if not key:
            continue
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(high).view(np.int64)),
                pa.array(np.concatenate(low).view(np.int64)),
                pa.array(np.concatenate(key)),
                pa.array(np.concatenate(name)),
                _lists(place, pa.int32()),
            ],
            ["h", "g", "doc_id", "text_hash", "places"],
        )


def covered(n_words: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    step = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + length, -1)
    return np.cumsum(step[:-1]) > 0


def _cut(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        removed, kept_text = [], []
        for text, starts in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            words = text.split()
            gone = covered(len(words), np.array(starts, dtype=np.int64), length)
            removed.append(int(gone.sum()))
            kept_text.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(removed, pa.int64()), pa.array(kept_text, pa.binary())],
            ["doc_id", "text_hash", "n_removed", "kept"],
        )


def repeats(docs: DataFrame, length: int = LENGTH, shortest: int = SHORTEST) -> DataFrame:
    """``(doc_id, text_hash, n_words, n_removed, kept_sha256)``, one row per row of ``docs``.

    Removed is each word covered by a window of ``length`` words whose word sequence also starts in a
    document with a smaller doc_id; all windows are judged on the input. Words are cut at ASCII white
    space and taken as they are. Null text has no words; a text shorter than the window keeps all of
    them. Rows with the same doc_id are parts of one document for this purpose: none removes words
    of another, each is reported on its own. Rows without doc_id neither lose words nor take any.
    No documents give no rows; other columns are ignored.

    Documents with the same words throughout are settled first: the smallest doc_id owns the text, the
    others lose all of it if it is long enough for one window. Only owners go on. ``shortest`` is the
    least number of words on the first level; it changes the work, never the result.
    """
    *parts, _ = levels(length, shortest)
    parts = parts or [length]
    scratch = Scratch(docs.sparkSession, "substring")
    text = text_or_empty()
    plain = docs.select(
        F.col("doc_id").cast("long"), text.cast("binary").alias("text"), F.xxhash64(text).alias("text_hash")
    )
    first = scratch.write(
        plain.mapInArrow(
            partial(_first_level, length, parts[0]),
            "doc_id long, text_hash long, n_words long, sha binary, marks array<long>",
        ),
        "first",
    )
    long_enough = first.where(f"n_words >= {length} and doc_id is not null")
    owners = scratch.write(long_enough.groupBy("sha").agg(F.min("doc_id").alias("owner")), "owners")
    own = (long_enough["sha"] == owners["sha"]) & (long_enough["doc_id"] == owners["owner"])
    owned = long_enough.join(owners, own, "left_semi").select("doc_id", "text_hash", "marks")
    mine = scratch.write(owned, f"level_{parts[0]}")
    texts = _repeated(scratch, plain, mine)
    for part, longer in zip(parts, parts[1:], strict=False):
        if texts.isEmpty():
            break
        mine = scratch.write(
            texts.mapInArrow(
                partial(_next_level, length, part, longer), "doc_id long, text_hash long, marks array<long>"
            ),
            f"level_{longer}",
        )
        left = _repeated(scratch, texts.drop("marks"), mine)
        scratch.drop(texts)
        texts = left
    windows = scratch.write(
        texts.mapInArrow(
            partial(_last_level, length, parts[-1]), "h long, g long, doc_id long, text_hash long, places array<int>"
        ),
        "windows",
    )
    twice = scratch.write(_in_two_documents(windows, "h", "g"), "twice")
    hits = (
        windows.join(twice, ["h", "g"])
        .where("doc_id > lowest")
        .groupBy("doc_id", "text_hash")
        .agg(F.flatten(F.collect_list("places")).alias("starts"))
    )
    kept = scratch.write(
        texts.select("doc_id", "text_hash", "text")
        .join(hits, ["doc_id", "text_hash"])
        .select("doc_id", "text_hash", "text", "starts")
        .mapInArrow(partial(_cut, length), "doc_id long, text_hash long, n_removed long, kept binary")
        .groupBy("doc_id", "text_hash")  # repeated rows: one
        .agg(F.max("n_removed").alias("n_removed"), F.max(F.sha2("kept", 256)).alias("kept_sha")),
        "kept",
    )
    scratch.drop(texts, windows, twice)
    copy = F.coalesce(F.col("doc_id") > F.col("owner"), F.lit(False))
    return (
        first.drop("marks")
        .join(owners, "sha", "left")
        .join(kept, ["doc_id", "text_hash"], "left")
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(copy, F.sha2(F.lit(b""), 256))
            .otherwise(F.coalesce("kept_sha", F.lower(F.hex("sha"))))
            .alias("kept_sha256"),
        )
    )


def _repeated(scratch: Scratch, texts: DataFrame, level: DataFrame) -> DataFrame:
    """``texts`` with those ``marks`` of a level that occur in two documents; texts without any go."""
    listed = level.select("doc_id", "text_hash", F.explode("marks").alias("mark"))
    shared = scratch.write(_in_two_documents(listed, "mark").select("mark"), "shared")
    wanted = listed.join(shared, "mark").groupBy("doc_id", "text_hash").agg(F.collect_set("mark").alias("marks"))
    out = texts.join(wanted, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "marks")
    out = scratch.write(out, "texts")
    scratch.drop(level, shared)
    return out


def _in_two_documents(listed: DataFrame, *key: str) -> DataFrame:
    """Keys that occur under at least two doc_ids, with the lowest; counted with map-side combine."""
    return (
        listed.groupBy(*key)
        .agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"))
        .where("lowest < highest")
        .drop("highest")
    )
