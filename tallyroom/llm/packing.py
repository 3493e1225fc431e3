"""Mixture-controlled packing of token streams into full windows by deficit round-robin.

Every source is a queue: its documents in ascending doc_id order, one after the other. The k-th id of a
source with weight w is due at (k + phase) / w, where phases keep sources of equal weight from being due
together; serving ids in the order of their due times is the deficit round-robin whose queues earn credit in proportion to their weights. A window takes the next
``length`` ids of that order, so each source gets its share of it, up to one id that it is owed or has had too much,
which is carried to the next window. Within a window the ids of a source stay together. Which ids a window takes
follows from its number and the queues' lengths alone, so windows are made in any order.

Sources too small for one id a window (of which there may be any number) share a queue in random order; the
others are at most ``length``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch, sliced, text_or_empty
from .tokens import encoder

LENGTH = 4096
#: Shortest stretch of a queue in which documents and windows are matched.
QUANTUM = 256
END = 2
REST = "rest"  # no source's name: those begin with =


def _tokenise(path: str, end: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    code, tail = encoder(path), np.array([end], dtype="<u4").tobytes()
    kind = "<u2" if max(code.tokenizer.get_vocab_size(), end) < 1 << 16 else "<u4"
    for b in sliced(batches):
        ids = [np.frombuffer(code.packed(t) + tail, dtype="<u4").astype(kind) for t in b.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                *(b.column(i) for i in range(3)),
                pa.array([len(i) for i in ids], pa.int64()),
                pa.array([i.tobytes() for i in ids], pa.binary()),
            ],
            ["row", "doc_id", "source", "n", "ids"],
        )
    code.rest()


def running(scratch: Scratch, df: DataFrame, order: list[str], size: str, out: str, name: str) -> DataFrame:
    """``df`` in the global order of ``order`` with ``out``: the sum of ``size`` over all rows before.

    Ranges are sorted and summed one by one; only one total per range is summed over all of them.
    """
    local = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    part = scratch.write(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), f"{name}-parts")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = scratch.write(
        part.groupBy("_part")
        .agg(F.sum(size).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")),
        f"{name}-totals",
    )
    made = scratch.write(
        part.withColumn(out, F.coalesce(F.sum(size).over(local), F.lit(0)))
        .join(totals, "_part")
        .withColumn(out, F.col(out) + F.col("_base"))
        .drop("_part", "_base"),
        name,
    )
    scratch.drop(part, totals)
    return made


def _cut(start: Column, length: Column, size: Column | int) -> Column:
    """Numbers of the stretches of ``size`` that ``length`` > 0 places from ``start`` on touch."""
    size = F.lit(size) if isinstance(size, int) else size
    return F.explode(F.sequence(F.floor(start / size), F.floor((start + length - 1) / size)))


class Queues:
    """Lengths and weights of the queues, and how many ids of each the first windows hold."""

    def __init__(self, names: list[str], totals: list[int], weights: list[float], length: int):
        self.names, self.length = names, length
        self.totals = np.array(totals, dtype=np.int64)
        self.weights = np.array(weights, dtype=np.float64)
        # multiples of the golden ratio lie evenly in (0, 1), however many there are
        self.phases = (np.arange(1, len(names) + 1) * 0.6180339887498949) % 1.0
        self.ids = int(self.totals.sum())
        self.windows = -(-self.ids // length)
        # all queues advance by weight x time until they end: the ids served by then, between the ends
        ends = np.unique(self.totals / self.weights)
        self.times = np.concatenate(([0.0], ends))
        self.served = np.array([np.minimum(self.weights * t, self.totals).sum() for t in self.times])

    def _due(self, k: np.ndarray) -> np.ndarray:
        return np.where((k >= 0) & (k < self.totals), (k + self.phases) / self.weights, np.where(k < 0, -np.inf, np.inf))

    def taken(self, windows: np.ndarray) -> np.ndarray:
        """For each number of windows the ids of each queue among the first ``length`` times as many in due order.

        Counts at about the right time are put right one id at a time; they are off by at most one id a queue.
        Ties go to the earlier queue.
        """
        wanted = np.minimum(windows * self.length, self.ids)
        at = np.interp(wanted, self.served, self.times)[:, None]
        n = np.clip(np.ceil(self.weights * at - self.phases).astype(np.int64), 0, self.totals)
        for _ in range(2):  # exactly those due before that time, as floating point has it
            n += self._due(n) < at
            n -= self._due(n - 1) >= at
        lacking = wanted - n.sum(axis=1)
        rows = np.nonzero(lacking > 0)[0]
        while len(rows):
            n[rows, np.argmin(self._due(n[rows]), axis=1)] += 1
            lacking[rows] -= 1
            rows = rows[lacking[rows] > 0]
        rows = np.nonzero(lacking < 0)[0]
        while len(rows):  # of the latest the last queue's
            late = self._due(n[rows] - 1)[:, ::-1]
            n[rows, len(self.names) - 1 - np.argmax(late, axis=1)] -= 1
            lacking[rows] += 1
            rows = rows[lacking[rows] < 0]
        return n

    def spans(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``(sequence_id, queue, from, to, offset)`` of the windows whose numbers come in."""
        step = max(1, (1 << 20) // len(self.names))
        for b in batches:
            for w in np.array_split(b.column(0).to_numpy(), max(1, -(-b.num_rows // step))):
                low, high = self.taken(w), self.taken(w + 1)
                size = high - low
                offset = np.cumsum(size, axis=1) - size
                row, queue = np.nonzero(size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (w[row], queue.astype(np.int32), low[row, queue], high[row, queue], offset[row, queue])],
                    ["sequence_id", "queue", "from", "to", "offset"],
                )


def _queues(totals: DataFrame, weights: dict[str, float] | None, length: int) -> Queues:
    """From ``(source, total)``: the sources that are due an id in each window, and the rest as one queue.

    Shares of one id a window or more are at most ``length``: so many rows come to the driver.
    """
    weight = F.col("total").cast("double")
    if weights is not None:
        if min(weights.values(), default=1.0) <= 0:
            raise ValueError("weights must be positive")
        given = F.create_map(*(F.lit(x) for s, w in weights.items() for x in (s, float(w)))) if weights else F.create_map()
        weight = F.coalesce(given[F.col("source")], F.lit(min(weights.values(), default=1.0))).cast("double")
    weighed = totals.withColumn("weight", weight)
    whole = weighed.agg(F.sum("weight")).first()[0]
    if whole is None:
        return Queues([], [], [], length)
    large = F.col("weight") * length >= whole
    name = F.when(large, F.col("source")).otherwise(REST)
    rows = weighed.groupBy(name.alias("queue")).agg(F.sum("total").alias("total"), F.sum("weight").alias("weight"))
    found = rows.orderBy("queue").collect()
    return Queues([r.queue for r in found], [r.total for r in found], [r.weight for r in found], length)


def _pieces(scratch: Scratch, docs: DataFrame, weights: dict[str, float] | None, length: int, quantum: int) -> DataFrame:
    """``(row, start, length, sequence_id, offset)`` for documents given as ``(row, doc_id, source, n)``."""
    spark = docs.sparkSession
    queues = _queues(docs.groupBy("source").agg(F.sum("n").alias("total")), weights, length)
    if not queues.names:
        return spark.createDataFrame([], "row long, start long, length long, sequence_id long, offset long")
    # a queue's ids are matched in cells about as long as its share of a window
    share = queues.weights / queues.weights.sum() * length
    table = spark.createDataFrame(
        [(q, i, int(max(quantum, np.ceil(share[i])))) for i, q in enumerate(queues.names)], "name string, queue int, cell long"
    )
    named = docs.join(F.broadcast(table.select(F.col("name").alias("source"), F.lit(True).alias("own"))), "source", "left")
    queue = F.when(F.col("own"), F.col("source")).otherwise(REST)
    key = F.when(F.col("own"), F.col("doc_id")).otherwise(F.xxhash64("doc_id", "row"))
    lined = named.select("row", "n", queue.alias("name"), key.alias("key"))
    queued = running(scratch, lined, ["name", "key", "row"], "n", "global_at", "queued")
    firsts = np.concatenate(([0], np.cumsum(queues.totals)[:-1])).tolist()
    lines = spark.createDataFrame(list(zip(queues.names, firsts, strict=True)), "name string, first long")
    at = F.col("global_at") - F.col("first")
    documents = (
        queued.join(F.broadcast(lines), "name")
        .join(F.broadcast(table), "name")
        .select("row", "queue", at.alias("at"), "n", "cell", _cut(at, F.col("n"), F.col("cell")).alias("stretch"))
    )
    spans = (
        spark.range(queues.windows)
        .mapInArrow(queues.spans, "sequence_id long, queue int, from long, to long, offset long")
        .join(F.broadcast(table.select("queue", "cell")), "queue")
        .select(
            "sequence_id", "queue", "from", "to", "offset",
            _cut(F.col("from"), F.col("to") - F.col("from"), F.col("cell")).alias("stretch"),
        )
    )
    low = F.greatest("at", "from", F.col("stretch") * F.col("cell"))
    high = F.least(F.col("at") + F.col("n"), F.col("to"), (F.col("stretch") + 1) * F.col("cell"))
    met = documents.join(spans, ["queue", "stretch"]).withColumn("low", low).withColumn("high", high).where("low < high")
    # cells cut what belongs together: a document and a window meet in one piece
    return (
        met.groupBy("row", "sequence_id", "at", "from", "offset")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .select(
            "row",
            (F.col("low") - F.col("at")).alias("start"),
            (F.col("high") - F.col("low")).alias("length"),
            "sequence_id",
            (F.col("offset") + F.col("low") - F.col("from")).alias("offset"),
        )
    )


def _slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in sliced(batches):
        doc, start, length, crc, total, seq, offset = [], [], [], [], [], [], []
        for d, n, ids, cuts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            all_ids = np.frombuffer(ids, dtype=f"<u{len(ids) // n}").astype("<u4")
            for c in sorted(cuts, key=lambda c: c["start"]):
                doc.append(d)
                start.append(c["start"])
                length.append(c["length"])
                crc.append(all_ids[c["start"] : c["start"] + c["length"]].tobytes())
                total.append(n)
                seq.append(c["sequence_id"])
                offset.append(c["offset"])
        made = [doc, start, length, crc, total, seq, offset]
        kinds = [pa.binary() if i == 3 else pa.int64() for i in range(7)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(made, kinds, strict=True)],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    tokenizer: str,
    weights: dict[str, float] | None = None,
    length: int = LENGTH,
    quantum: int = QUANTUM,
    end: int = END,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit bytes. Every id of every document, and its ``end`` id,
    lies in exactly one piece; sequences are filled to ``length`` except the last one. ``weights``
    gives target proportions by source; without it each source has its share of all ids, so that the
    mixture is the same from the first window to the last. A source without a weight gets the
    smallest one; when a queue is empty the others go on in their proportions. While its queue lasts a
    source has its share of each window, and of all windows so far, to within two ids.

    Null text is empty: a document of one id. A null source is a queue of its own. Repeated ids stay
    separate documents, null ids come first in their queue. No documents give no pieces; other columns
    are ignored.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    tokens = scratch.write(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), source.alias("source"),
            text_or_empty().alias("text"),
        ).mapInArrow(partial(_tokenise, tokenizer, end), "row long, doc_id long, source string, n long, ids binary"),
        "tokens",
    )
    named = None if weights is None else {f"={s}": w for s, w in weights.items()}
    pieces = _pieces(scratch, tokens.select("row", "doc_id", "source", "n"), named, length, quantum)
    cuts = pieces.groupBy("row").agg(
        F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("cuts")
    )
    cuts = scratch.write(cuts, "cuts")
    return (
        tokens.select("row", "doc_id", "n", "ids")
        .join(cuts, "row")
        .select("doc_id", "n", "ids", "cuts")
        .mapInArrow(
            _slice,
            "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
        )
    )
