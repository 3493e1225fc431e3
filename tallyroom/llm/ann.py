"""Nearest neighbours: an inverted file whose lists are scanned dimension by dimension.

Vectors are put into the list of their nearest centroid, rotated by a random orthogonal matrix and kept
in blocks, column after column. A query visits its nearest lists. Within a block the squared distance
grows one column block at a time; after d of D dimensions a candidate is given up when its distance so
far, scaled by D / d, exceeds the query's bound by the factor (1 + E / sqrt(d))**2, the level at which a
random rotation makes "it is within the bound" implausible. Survivors are measured exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import Scratch

#: Most vectors that centroids, probe counts and first bounds are fitted on; every vector is indexed.
SAMPLE = 20_000
#: Lists grow with the root of the table up to a quarter of the sample.
SHARE = 4
#: Share of a sample's true neighbours that must lie in the visited lists.
COVER = 0.97
COLUMNS = 16
E = 2.1
BLOCK = 1024
CHUNK = 256
K = 10
#: Rank in the sample whose distance bounds a query.
NEAREST = 3 * K


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``(vec_id, v array<double>)`` without null, zero, non-finite or odd-sized vectors, and the dimension.

    The dimension is the commonest length. Rows that repeat an id count once, with the smallest vector.
    """
    v = F.col("v")
    ok = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        .where(F.col("vec_id").isNotNull() & v.isNotNull())
        .where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    )
    size = ok.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dimension = size["n"] if size else 0
    return ok.where(F.size("v") == dimension).groupBy("vec_id").agg(F.min("v").alias("v")), dimension


class Plan:
    """What is fitted on the bounded sample: rotation, centroids, how many lists to visit, first bounds."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, total: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.ids, self.x = ids, x
        q, r = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))
        self.rotation = q * np.sign(np.diag(r))
        lists = int(max(1, min(round(total**0.5), len(x) // SHARE)))
        self.centroids = self._means(lists, rng)
        self.probes = self._probes()

    def _means(self, lists: int, rng) -> np.ndarray:
        c = self.x[rng.choice(len(self.x), lists, replace=False)].copy()
        for _ in range(8):
            near = squared(self.x, c).argmin(axis=1)
            sums = np.zeros_like(c)
            np.add.at(sums, near, self.x)
            count = np.bincount(near, minlength=lists)
            c[count > 0] = sums[count > 0] / count[count > 0, None]
        return c

    def _probes(self) -> int:
        """Lists to visit so that the sample's own neighbours are covered."""
        if len(self.x) <= 100 * K:
            return len(self.centroids)
        home = squared(self.x, self.centroids).argmin(axis=1)
        needed = []
        for some in np.array_split(np.arange(0, len(self.x), max(1, len(self.x) // 400)), 8):
            d = squared(self.x[some], self.x)
            d[np.arange(len(some)), some] = np.inf
            near = np.argpartition(d, K, axis=1)[:, :K]
            rank = squared(self.x[some], self.centroids).argsort(axis=1).argsort(axis=1)
            needed.append(np.take_along_axis(rank, home[near], axis=1).ravel())
        needed = np.sort(np.concatenate(needed))
        return int(needed[min(len(needed) - 1, int(COVER * len(needed)))]) + 1

    def bound(self, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Squared distance to the NEAREST-th of the sample, within which any table has at least as many vectors.

        They are more than K, so that K are found though some lie in lists that are not visited.
        """
        d = squared(q, self.x)
        d[ids[:, None] == self.ids[None, :]] = np.inf
        if d.shape[1] < NEAREST:
            return np.full(len(q), np.inf)
        return np.partition(d, NEAREST - 1, axis=1)[:, NEAREST - 1] * (1 + 1e-9) + 1e-12


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dimension)


def _assign(plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p: Plan = plan.value
    for b in batches:
        if b.num_rows:
            home = squared(_matrix(b.column(1), p.x.shape[1]), p.centroids).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(home, pa.int32()), *b.columns], ["list", "vec_id", "v"])


def _blocks(plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rotated columns in blocks beside the vectors themselves, both as bytes."""
    p: Plan = plan.value
    for b in batches:
        columns, plain = [], []
        for vectors in b.column(2).to_pylist():
            x = np.array(vectors, dtype="<f8")
            plain.append(x.tobytes())
            columns.append(np.ascontiguousarray((x @ p.rotation).T).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(columns, pa.binary()), pa.array(plain, pa.binary())],
            ["list", "ids", "columns", "plain"],
        )


def _visits(plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p: Plan = plan.value
    for b in batches:
        if not b.num_rows:
            continue
        ids, q = np.asarray(b.column(0)), _matrix(b.column(1), p.x.shape[1])
        near = np.argsort(squared(q, p.centroids), axis=1, kind="stable")[:, : p.probes]
        bound = p.bound(ids, q)
        take = pa.array(np.repeat(np.arange(len(ids)), near.shape[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(near.ravel().astype(np.int32)), b.column(0).take(take), pa.array(bound).take(take), b.column(1).take(take)],
            ["list", "query_id", "bound", "q"],
        )


def scan(ids: np.ndarray, columns: np.ndarray, plain: np.ndarray, own: np.ndarray, q: np.ndarray, turned: np.ndarray, bound: np.ndarray):
    """The up to K nearest of one block for each query: (query row, vector row, distance)."""
    dimension = len(columns)
    at_q, at_x = np.nonzero(own[:, None] != ids[None, :])
    so_far = np.zeros(len(at_q))
    for start in range(0, dimension, COLUMNS):
        done = min(start + COLUMNS, dimension)
        if len(at_q) * 4 > len(own) * len(ids):  # most are left: one product for all of them
            so_far += squared(turned[:, start:done], columns[start:done].T)[at_q, at_x]
        else:
            gap = turned[at_q, start:done] - columns[start:done, at_x].T
            so_far += (gap * gap).sum(axis=1)
        # single-precision columns: leave a margin for their rounding
        limit = bound[at_q] * ((1 + E / done**0.5) ** 2 if done < dimension else 1.0) * (1 + 1e-5) + 1e-6
        left = so_far * (dimension / done) <= limit
        at_q, at_x, so_far = at_q[left], at_x[left], so_far[left]
    gap = q[at_q] - plain[at_x]
    exact = np.sqrt((gap * gap).sum(axis=1))
    order = np.lexsort((ids[at_x], exact, at_q))
    at_q, at_x, exact = at_q[order], at_x[order], exact[order]
    first = np.searchsorted(at_q, at_q)
    best = np.arange(len(at_q)) - first < K
    return at_q[best], at_x[best], exact[best]


def _search(plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    p: Plan = plan.value
    dimension = p.x.shape[1]
    for b in batches:
        query, found, score = [], [], []
        for ids, columns, plain, asked in zip(*(c.to_pylist() for c in b.columns), strict=True):
            ids = np.array(ids, dtype=np.int64)
            own = np.array([a["query_id"] for a in asked], dtype=np.int64)
            q = np.array([a["q"] for a in asked], dtype=np.float64)
            bound = np.array([a["bound"] for a in asked], dtype=np.float64)
            at_q, at_x, exact = scan(
                ids,
                np.frombuffer(columns, "<f4").reshape(dimension, -1).astype(np.float64),
                np.frombuffer(plain, "<f8").reshape(-1, dimension),
                own, q, q @ p.rotation, bound,
            )
            query.append(own[at_q])
            found.append(ids[at_x])
            score.append(exact)
        if query:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v)) for v in (query, found, score)], ["query_id", "vec_id", "score"]
            )


def search(vectors: DataFrame, queries: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: up to ten nearest vectors by Euclidean distance, ties to the smaller id.

    ``queries`` are rows like ``vectors`` (default: every vector whose id is divisible by 100); a query
    never finds its own id. Null ids and vectors that are null, zero, of another length than most, or
    that hold nulls or non-finite numbers take no part. Without usable vectors there are no rows.
    Other columns are ignored.

    A list is cut into blocks of bounded size, so a list with a third of all vectors is as many tasks
    as it has blocks, and equal vectors are just members of blocks.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "ann")
    good, dimension = usable(vectors)
    good = scratch.write(good, "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow().combine_chunks()
    if not drawn.num_rows:
        return empty
    total = good.count()
    plan = spark.sparkContext.broadcast(
        Plan(drawn["vec_id"].to_numpy(), _matrix(drawn["v"].combine_chunks(), dimension), total)
    )
    home = scratch.write(
        good.mapInArrow(partial(_assign, plan), "list int, vec_id long, v array<double>").withColumn(
            "_n", F.monotonically_increasing_id()
        ),
        "assigned",
    )
    sizes = scratch.write(home.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("_blocks")), "sizes")
    index = scratch.write(
        home.join(sizes, "list")
        .groupBy("list", F.pmod(F.xxhash64("_n"), "_blocks").alias("_block"))
        .agg(F.collect_list("vec_id").alias("ids"), F.collect_list("v").alias("vs"))
        .select("list", "ids", "vs")
        .mapInArrow(partial(_blocks, plan), "list int, ids array<long>, columns binary, plain binary"),
        "index",
    )
    asked = good.where("vec_id % 100 = 0") if queries is None else usable(queries)[0].where(F.size("v") == dimension)
    asked = scratch.write(asked, "asked")
    chunks = max(1, -(-asked.count() // CHUNK))
    visits = scratch.write(
        asked.mapInArrow(partial(_visits, plan), "list int, query_id long, bound double, q array<double>")
        .groupBy("list", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).alias("chunk"))
        .agg(F.collect_list(F.struct("query_id", "bound", "q")).alias("asked")),
        "visits",
    )
    found = (
        index.join(visits, "list")
        .select("ids", "columns", "plain", "asked")
        .mapInArrow(partial(_search, plan), "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= K)
        .select("query_id", "rank", "vec_id", "score")
    )
