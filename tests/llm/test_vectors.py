"""Vector searches against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import nearest, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").cache()


def best(ids, scores, own, k):
    order = [j for j in np.lexsort((ids, -scores)) if ids[j] != own][:k]
    return [(own, n + 1, int(ids[j]), scores[j]) for n, j in enumerate(order)]


def test_topk_is_exact(vectors):
    rows = vectors.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.floor(1024 * np.array([r.embedding for r in rows], np.float32).astype(float)).astype(int)
    want = [b for i in np.flatnonzero(ids % 100 == 0) for b in best(ids, x @ x[i], ids[i], 10)]
    got = [tuple(r) for r in topk.search(vectors, F.col("vec_id") % 100 == 0).collect()]
    assert sorted(got) == sorted(want)


def test_nearest_recall_and_scores(vectors, monkeypatch):
    monkeypatch.setattr(nearest, "PER_LIST", 20)  # many lists, as a large table has
    rows = vectors.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32).astype(float)
    want = {b[0::2][:2] for i in np.flatnonzero(ids % 20 == 0) for b in best(ids, x @ x[i], ids[i], 20)}
    got = nearest.search(vectors, F.col("vec_id") % 20 == 0).collect()
    assert len(got) == len(want) and len({(r.query_id, r.vec_id) for r in got} & want) / len(want) >= 0.9
    at = {v: i for i, v in enumerate(ids)}
    assert all(math.isclose(r.score, x[at[r.query_id]] @ x[at[r.vec_id]], rel_tol=1e-12) for r in got)


def odd_vectors(spark):
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1) for _ in range(5)], 0) for i in range(40)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0], 0) for i in range(60)]  # ties
    rows += [(200, None, 0), (201, [None] * 5, 0), (202, [float("nan")] * 5, 0), (203, [float("inf")] * 5, 0), (204, [], 0), (205, [1.0], 0), (None, [1.0] * 5, 0),
             (220, [0.0] * 5, 0), (240, [0.0] * 5, 0)]
    return spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit(1)).withColumn("block", F.lit("b")).withColumn("list", F.lit(0)).withColumn("score", F.lit(0))


@pytest.mark.parametrize("search, factor, zero", [(topk.search, 1024, True), (nearest.search, None, False)])
def test_odd_vectors(spark, search, factor, zero):
    table = odd_vectors(spark)
    rows = [r for r in table.collect() if r.vec_id is not None and (r.vec_id < 200 or zero and r.vec_id in (220, 240))]
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float32).astype(float)
    x = np.floor(factor * x).astype(int) if factor else x
    k = 10 if factor else 20
    want = sorted(b[:3] for i in np.flatnonzero(ids % 20 == 0) for b in best(ids, (x * x[i]).sum(1), ids[i], k))
    assert sorted((r.query_id, r.rank, r.vec_id) for r in search(table, F.col("vec_id") % 20 == 0).collect()) == want
    assert search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
