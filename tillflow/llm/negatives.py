"""Hard negatives by Fagin's threshold algorithm.

Candidates are dealt to blocks by chance. A block's index holds, per dimension, its rows sorted by component. For an anchor
the lists are read by its signs, from the large end where its component is positive and from the small end where it is
negative; rows met in any list get their exact integer score by random access. The threshold, the sum over the lists of the
anchor's component times the last component read, bounds every row not met. A first search finds each anchor's best rows of
its own label (positives); a second one finds, per positive, the best rows of other labels whose score lies in the positive's
window. A search of a block ends once the threshold is strictly below the k-th score found in each window, or below the
window itself, so rows of equal score are never cut off and results are exact.

Rows with a null id or label, or a vector that is null or holds null or non-finite components, take no part, nor do vectors
of another length than most of the table. Rows with equal ids are candidates of their own, but never those of an anchor of the
same id; of several anchor rows with one id the least (label, vector) is the anchor. Equal scores are ordered by the smaller
id, then label. A positive without a negative in its window has no rows; a negative positive_score has an empty window. Inner
products that 64 bits cannot hold raise an error. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import staged
from .topk import same_length

FACTOR = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between LEAST % and MOST % of the positive's.
LEAST, MOST = 80, 100
#: Rows of a block, and anchors that meet a block in one task.
BLOCK, GROUP = 4096, 4096
#: Rows read from each list in the first round; each round doubles the depth.
DEPTH = 16
INDEX = "block long, ids binary, labels binary, x binary, order binary"
FOUND = "anchor_id long, place int, vec_id long, label long, score long"


def prepared(vectors: DataFrame, factor: int = FACTOR) -> DataFrame:
    """vec_id, label and ``x``, the vector as floor(factor * component); only rows that take part."""
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(fine & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda v: F.floor(F.lit(factor) * v.cast("double")).cast("long")).alias("x"))
    return same_length(rows, "x")


class Lists:
    """A block's sorted lists: ``order[j]`` has its rows by ascending component j."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, order: np.ndarray):
        self.ids, self.labels, self.x, self.order = ids, labels, x, order
        self.reach = np.abs(x).astype(float).max(0)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, least: np.ndarray, most: np.ndarray, k: int) -> list[np.ndarray]:
        """Per window [least, most] of scores the rows, of those allowed, that may be among its k best, best first."""
        n = len(self.ids)
        if float((np.abs(anchor) * self.reach).sum()) >= 2.0 ** 62:
            raise OverflowError("an inner product does not fit in 64 bits")
        signed = np.flatnonzero(anchor)
        up, down = signed[anchor[signed] > 0], signed[anchor[signed] < 0]
        met, scores = np.zeros(n, bool), np.zeros(n, np.int64)
        begun, depth = 0, DEPTH
        while True:
            depth = min(depth, n) if len(signed) else n
            new = np.zeros(n, bool)
            new[self.order[up, n - depth:n - begun]] = True
            new[self.order[down, begun:depth]] = True
            if depth == n:
                new[:] = True
            at = np.flatnonzero(new & ~met)
            scores[at] = self.x[at] @ anchor
            met |= new
            rows = np.flatnonzero(met & allowed)
            values = scores[rows]
            inside = [rows[(values >= a) & (values <= b)] for a, b in zip(least, most)]
            best = [r[np.lexsort((self.labels[r], self.ids[r], -scores[r]))[:k]] for r in inside]
            threshold = int((self.x[self.order[up, n - depth], up] * anchor[up]).sum() + (self.x[self.order[down, depth - 1], down] * anchor[down]).sum())
            if depth == n or all(threshold < (scores[r[-1]] if len(r) == k else a) for r, a in zip(best, least)):
                self.scores = scores
                return best
            begun, depth = depth, 2 * depth


def _index(key, rows: pa.Table) -> pa.Table:
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
    order = np.argsort(x, axis=0, kind="stable").T.astype(np.int32)
    columns = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), x, order
    return pa.table([pa.array([key[0].as_py()], pa.int64()), *(pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns)],
                    [f.split()[0] for f in INDEX.split(", ")])


def _lists(index: pa.Table) -> Lists:
    ids, labels, x, order = (index[c][0].as_py() for c in ("ids", "labels", "x", "order"))
    ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
    return Lists(ids, labels, np.frombuffer(x, np.int64).reshape(len(ids), -1), np.frombuffer(order, np.int32).reshape(-1, len(ids)))


def _searched(index: pa.Table, anchors: pa.Table, windows) -> pa.Table:
    """What ``windows`` asks for of every anchor in a block; it gives (same label?, least scores, most scores, k)."""
    out = []
    if index.num_rows and anchors.num_rows:
        lists = _lists(index)
        for a in anchors.to_pylist():
            same, least, most, k = windows(a)
            if len(least):
                allowed = ((lists.labels == a["label"]) == same) & (lists.ids != a["vec_id"])
                for place, rows in enumerate(lists.search(np.array(a["x"], np.int64), allowed, least, most, k)):
                    out += [(a["vec_id"], place, int(lists.ids[i]), int(lists.labels[i]), int(lists.scores[i])) for i in rows]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, kinds)], [f.split()[0] for f in FOUND.split(", ")])


def _best(index: DataFrame, anchors: DataFrame, blocks: int, groups: int, windows, k: int) -> DataFrame:
    """Each anchor's k best rows per window among all blocks, with their rank."""
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = index.withColumn("group", each(groups))
    right = anchors.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups))).withColumn("block", each(blocks))
    found = left.groupBy("block", "group").cogroup(right.groupBy("block", "group")).applyInArrow(lambda a, b: _searched(a, b, windows), FOUND)
    order = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id", "label")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, factor: int = FACTOR, positives: int = POSITIVES, negatives: int = NEGATIVES,
         least: int = LEAST, most: int = MOST) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: per anchor and positive the best rows of other labels in its window."""
    rows = staged(prepared(vectors, factor), "negatives-rows")
    blocks = 1 + rows.count() // BLOCK
    index = staged(rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(blocks))).groupBy("block").applyInArrow(lambda key, t: _index(key, t), INDEX), "negatives-index")
    anchors = staged(rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("a")).select("vec_id", "a.label", "a.x"), "negatives-anchors")
    groups = 1 + anchors.count() // GROUP
    wide = np.array([-(2 ** 62)]), np.array([2 ** 62])
    liked = _best(index, anchors, blocks, groups, lambda a: (True, *wide, positives), positives)
    liked = staged(liked.select("anchor_id", F.col("rank").alias("turn"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")

    def windows(a):
        scores = [s for s in a["scores"] if s >= 0]  # -(-x // 100) rounds up; below zero a window is empty
        return False, np.array([-(-least * s // 100) for s in scores], np.int64), np.array([most * s // 100 for s in scores], np.int64), negatives

    asked = anchors.join(liked.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("positive_score"), False).alias("scores")), "vec_id")
    found = _best(index, asked, blocks, groups, windows, negatives).select(
        "anchor_id", "place", F.col("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    # a window is that of a score: positives of equal score share it
    score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"))
    placed = liked.withColumn("place", F.dense_rank().over(score) - 1)
    return placed.join(found, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
