"""Approximate nearest neighbours by inner product: probed lists, scanned by dimensions with early abandoning.

With one more component, sqrt(M² - |x|²) for the largest norm M, all vectors have norm M and the largest inner product is the
smallest distance. The vectors are rotated by a random orthogonal matrix and kept in lists around centroids. A query scans its
home list first, whose k-th best becomes its threshold, and then the other lists it probes: after each block of columns a test
abandons the vectors whose partial distance makes it improbable that they beat the threshold. What is left is scored in double
precision on the original vectors.

The centroids come from at most ``SAMPLE`` vectors; every vector is indexed. ``PROBED`` of the lists are probed, which finds over
0.9 of the true neighbours even where vectors form no clusters. Vectors that are null, zero, of unusual length, or that hold null
or non-finite components take no part. Equal scores are ordered by the smaller id; rows of a query's own id are never its
neighbours; of query rows with one id, the smallest vector searches. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import staged
from .topk import same_length

TOP = 20
SAMPLE = 20_000
#: Vectors to a list on average, and lists at most.
PER_LIST, MOST_LISTS = 512, 1024
PROBED = 0.7
BLOCK, QUERY_BLOCK = 4096, 1024
COLUMNS = 16
#: Width of the test: larger abandons less.
EPSILON = 1.5
SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and ``x`` (doubles) of the vectors that take part."""
    x = F.col("embedding")
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return same_length(vectors.where(fine & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("x")), "x")


def centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly spaced rows of the sample."""
    centers = sample[np.linspace(0, len(sample) - 1, lists).astype(np.int64)].copy()
    for _ in range(rounds):
        near = _closeness(sample, centers).argmax(1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, sample)
        count = np.bincount(near, minlength=lists)
        centers[count > 0] = sums[count > 0] / count[count > 0, None]
    return centers


def _closeness(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return x @ centers.T - (centers ** 2).sum(1) / 2


class Index:
    """What tasks share: rotation, largest norm, and centroids in rotated space; their size depends on parameters only."""

    def __init__(self, sample: np.ndarray, largest: float, lists: int):
        d = sample.shape[1] + 1
        self.rotation = np.linalg.qr(np.random.default_rng(5).standard_normal((d, d)))[0]
        self.largest = largest
        self.centers = centroids(self.rotated(sample), lists)

    def rotated(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.largest ** 2 - (x ** 2).sum(1)))
        return (np.c_[x, more] @ self.rotation).astype(np.float32)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def scan(q: np.ndarray, x: np.ndarray, beat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) that no test abandons; ``beat`` is the squared distance to beat, infinite where there is none."""
    d = q.shape[1]
    rows = columns = partial = None
    for at in range(0, d, COLUMNS):
        a, b = q[:, at:at + COLUMNS], x[:, at:at + COLUMNS]
        if rows is None:
            partial = (a ** 2).sum(1)[:, None] + (b ** 2).sum(1) - 2 * a @ b.T
        else:
            partial = partial + ((a[rows] - b[columns]) ** 2).sum(1)
        done = min(d, at + COLUMNS)
        limit = beat * (done / d) * (1.0 if done == d else (1 + EPSILON / np.sqrt(done)) ** 2) * (1 + 1e-5) + 1e-9
        if rows is None:
            rows, columns = np.nonzero(partial <= limit[:, None])
            partial = partial[rows, columns]
        else:
            kept = partial <= limit[rows]
            rows, columns, partial = rows[kept], columns[kept], partial[kept]
    return rows, columns


def block_best(queries: pa.Table, candidates: pa.Table, index: Index, k: int) -> pa.Table:
    out_q, out_v, out_s = [], [], []
    if queries.num_rows and candidates.num_rows:
        ids, x, q_ids, q = candidates["vec_id"].to_numpy(), _matrix(candidates["x"]), queries["vec_id"].to_numpy(), _matrix(queries["x"])
        beat = index.largest ** 2 + (q ** 2).sum(1) - 2 * queries["least"].to_numpy()
        rows, columns = scan(index.rotated(q, True), index.rotated(x), beat.astype(np.float64))
        other = q_ids[rows] != ids[columns]
        rows, columns = rows[other], columns[other]
        for i in range(0, len(rows), 1 << 16):
            r, c = rows[i:i + (1 << 16)], columns[i:i + (1 << 16)]
            out_q.append(r), out_v.append(c), out_s.append((q[r] * x[c]).sum(1))
        if out_q:
            r, c, s = map(np.concatenate, (out_q, out_v, out_s))
            order = np.lexsort((ids[c], -s, r))
            r, c, s = r[order], c[order], s[order]
            place = np.arange(len(r)) - np.searchsorted(r, r, "left")
            r, c, s = r[place < k], c[place < k], s[place < k]
            return pa.table([pa.array(q_ids[r], pa.int64()), pa.array(ids[c], pa.int64()), pa.array(s)], ["query_id", "vec_id", "score"])
    return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], ["query_id", "vec_id", "score"])


def search(vectors: DataFrame, is_query: Column, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found among all other rows."""
    spark = vectors.sparkSession
    rows = staged(usable(vectors), "ann-vectors")
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    count, largest = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "x").limit(SAMPLE).select("x").toArrow()
    index = spark.sparkContext.broadcast(Index(_matrix(sample["x"]), largest, max(1, min(MOST_LISTS, count // PER_LIST))))

    def homes(batches):
        for batch in batches:
            if batch.num_rows:
                near = _closeness(index.value.rotated(_matrix(batch["x"])), index.value.centers).argmax(1)
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["x"], pa.array(near.astype(np.int32))], ["vec_id", "x", "list"])

    def probes(batches):
        for batch in batches:
            if batch.num_rows:
                close = _closeness(index.value.rotated(_matrix(batch["x"]), True), index.value.centers)
                order = np.argsort(-close, axis=1, kind="stable")[:, : int(np.ceil(PROBED * close.shape[1]))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["x"], pa.array(list(order), pa.list_(pa.int32()))], ["vec_id", "x", "lists"])

    listed = staged(rows.mapInArrow(homes, "vec_id long, x array<double>, list int"), "ann-lists")
    sizes = {r[0]: r[1] for r in listed.groupBy("list").count().collect()}  # MOST_LISTS rows at most
    parts = F.create_map(*[F.lit(v) for i, n in sizes.items() for v in (i, 1 + n // BLOCK)])
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("x").alias("x"))
    asked = staged(asked.mapInArrow(probes, "vec_id long, x array<double>, lists array<int>"), "ann-queries")
    groups = 1 + asked.count() // QUERY_BLOCK
    # rows of a list are dealt to blocks by chance, so that no vector can make a block large
    cells = (listed.withColumn("part", F.floor(F.rand(3) * parts[F.col("list")]).cast("int"))
             .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))
    cells = cells.groupBy("list", "part", "group")

    def scanned(queries: DataFrame, lists: Column) -> DataFrame:
        spread = (queries.withColumn("list", F.explode(lists)).withColumn("count", parts[F.col("list")]).where("count is not null")
                  .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("count") - 1))).withColumn("group", F.pmod(F.hash("vec_id"), F.lit(groups)))
                  .select("list", "part", "group", "vec_id", "x", "least"))
        return spread.groupBy("list", "part", "group").cogroup(cells).applyInArrow(lambda key, a, b: block_best(a, b, index.value, k), SCHEMA)

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    near_home = scanned(asked.withColumn("least", F.lit(float("-inf"))), F.slice("lists", 1, 1))
    near_home = staged(near_home.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "ann-home")
    least = near_home.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    rest = asked.join(least, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    found = near_home.drop("rank").unionByName(scanned(rest, F.slice("lists", 2, MOST_LISTS)))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
