"""Exact top-k by inner product with an impact-ordered, score-at-a-time index.

Candidates are split into blocks. In a block, each dimension is a term; its postings are sorted by quantised impact (the
component's level) into segments. For a query, segments are processed by descending impact |query component x level|: a round
adds the midpoint contributions of all segments above its threshold to the accumulators and, per vector, the bounds of what is
still open. A block is done with a query when at most ``OPEN_SHARE`` of its vectors can, by these bounds, still reach the k-th
best lower bound; these possible members are rescored exactly. Bounds are proofs, so results are exact.

Queries are a stated set; they meet the candidates block by block, so no task holds more than a block of either side. Vectors
that are null or hold null or non-finite components take no part, nor do those of another length than most of the table (by
count, then the longest). Rows with equal ids are candidates of their own and never those of a query of the same id; equal
scores are ordered by the smaller id. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import staged

TOP = 10
FACTOR = 1024
BLOCK, QUERY_BLOCK = 8192, 512
#: Levels of a dimension in a block.
LEVELS = 256
#: A round's threshold as a share of the largest impact.
ROUNDS = (0.3, 0.1, 0.03, 0.01)
OPEN_SHARE = 0.02
SCHEMA = "query_id long, vec_id long, score long"


def integers(vectors: DataFrame, factor: int = FACTOR) -> DataFrame:
    """vec_id and ``x``, the vector as floor(factor * component); only vectors that take part."""
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(fine & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: F.floor(F.lit(factor) * v.cast("double")).cast("long")).alias("x"))


def same_length(vectors: DataFrame, column: str) -> DataFrame:
    """The vectors of the most common length but zero; of equally common ones, the longest."""
    most = vectors.where(F.size(column) > 0).groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return vectors.where(F.size(column) == F.lit(most["n"] if most else -1))


class Block:
    """The postings of a block: per dimension the vectors by descending level, and the least component of each one's level."""

    def __init__(self, x: np.ndarray):
        self.x = x
        top = np.maximum(np.abs(x).max(0), 1)
        self.width = np.maximum(1, -(-2 * top // LEVELS))
        level = (x + top) // self.width
        self.order = np.ascontiguousarray(np.argsort(-level, axis=0, kind="stable").astype(np.int32).T)
        self.low = np.ascontiguousarray((np.take_along_axis(level, self.order.T.astype(np.int64), 0) * self.width - top).T)
        self.reach = np.abs(x).max(0)

    def possible(self, q: np.ndarray, k: int) -> np.ndarray:
        """Vectors that may be among the k best of the block: those whose upper bound reaches the k-th best lower bound.

        What a round has not processed contributes at most its threshold per dimension, or all of a dimension's reach where
        that is less; a processed posting is off its level's midpoint by half a level at most.
        """
        n, d = self.x.shape
        if n <= 4 * k:
            return np.arange(n)
        impact = np.abs(q) * self.reach
        half = float((np.abs(q) * (self.width - 1) / 2).max())
        total, seen = np.zeros(n), np.zeros(n, np.int64)
        first, last = np.zeros(d, np.int64), np.full(d, n, np.int64)
        for share in ROUNDS:
            limit = share * impact.max()
            strong = np.flatnonzero(impact > limit)
            ids, parts = [], []
            for j in strong:
                low, width, cut = self.low[j], self.width[j], limit / abs(q[j])
                begin = max(first[j], int(np.searchsorted(-low, width - 1 - cut, "left")))  # large components come first
                end = min(last[j], max(begin, int(np.searchsorted(-low, cut, "right"))))  # large negative ones last
                for a, b in ((first[j], begin), (end, last[j])):
                    if b > a:
                        ids.append(self.order[j, a:b])
                        parts.append(q[j] * (low[a:b] + (width - 1) / 2))
                first[j], last[j] = begin, end
            if ids:
                at = np.concatenate(ids)
                total += np.bincount(at, np.concatenate(parts), n)
                seen += np.bincount(at, minlength=n)
            rest = float(impact.sum() - impact[strong].sum())
            slack = seen * half + (len(strong) - seen) * limit + rest + 1e-9 * float(impact.sum())
            bound = np.partition(total - slack, n - k)[n - k]
            members = np.flatnonzero(total + slack >= bound)
            if len(members) <= max(4 * k, OPEN_SHARE * n):
                break
        return members


def block_best(key, queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    """The k best of a block's candidates for each of its queries."""
    out = []
    if queries.num_rows and candidates.num_rows:
        ids, x, q_ids, q = candidates["vec_id"].to_numpy(), _matrix(candidates), queries["vec_id"].to_numpy(), _matrix(queries)
        block = Block(x)
        twice = np.bincount(np.unique(ids, return_inverse=True)[1]).max()  # rows of the query's own id do not count
        for query, vector in zip(q_ids, q):
            at = block.possible(vector, k + int(twice))
            at = at[ids[at] != query]
            scores = x[at] @ vector
            best = np.lexsort((ids[at], -scores))[:k]
            out += [(int(query), int(ids[i]), int(s)) for i, s in zip(at[best], scores[best])]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[], [], []])], names)


def _matrix(table: pa.Table) -> np.ndarray:
    return table["x"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def search(vectors: DataFrame, is_query: Column, k: int = TOP, factor: int = FACTOR) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best among all other rows."""
    rows = staged(same_length(integers(vectors, factor), "x"), "impact-vectors")
    asked = staged(rows.where(is_query).groupBy("vec_id").agg(F.min("x").alias("x")), "impact-queries")
    blocks, groups = 1 + rows.count() // BLOCK, 1 + asked.count() // QUERY_BLOCK
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    # rows are dealt to blocks by chance, so that no id or vector can make a block large
    left = asked.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups))).withColumn("block", each(blocks))
    right = rows.withColumn("block", F.floor(F.rand(3) * blocks)).withColumn("group", each(groups))
    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(lambda key, a, b: block_best(key, a, b, k), SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
