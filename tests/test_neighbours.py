"""Exact nearest neighbours against all pairs, and over-sampling among them."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskspark.operators import models as M
from riskspark.operators import neighbours as N


def brute(x, k):
    d = N.distances(x, x)
    np.fill_diagonal(d, np.inf)
    order = [np.lexsort((np.arange(len(x)), row))[: min(k, len(x) - 1)] for row in d]
    return [[(float(d[i, j]), int(j)) for j in own] for i, own in enumerate(order)]


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(n // 2, 4)), rng.integers(0, 4, (n // 4, 4)), np.tile([1.0, 2.0, 0.0, 1.0], (n - n // 2 - n // 4, 1))])
    return x[rng.permutation(len(x))]


def frame(spark, x):
    return spark.createDataFrame([(i, Vectors.dense(v.tolist())) for i, v in enumerate(x)], ["k", "features"]).repartition(5)


@pytest.mark.parametrize("n,k,pivots,block", [(2000, 5, 9, 60), (300, 3, None, 2000), (40, 5, 40, 3), (4, 5, 2, 2), (1, 5, None, 10)])
def test_equals_all_pairs(spark, monkeypatch, n, k, pivots, block):
    """With ties, identical rows (a quarter of them), many blocks a cell, and repeated blocks."""
    monkeypatch.setattr(N, "VISITS", 100)
    x = corpus(n, n)
    out = N.knn(frame(spark, x), "features", "k", k, pivots, block)
    got = {r.k: [(p.distance, p.id) for p in r.neighbours] for r in out.collect()}
    assert got == dict(enumerate(brute(x, k)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_and_null_vectors(spark):
    df = frame(spark, corpus(8, 1)).limit(0)
    assert N.knn(df, "features", "k").count() == 0


def test_new_rows_lie_between_near_rows(spark):
    x = corpus(400, 3)
    y = (np.arange(400) % 5 == 0).astype(int)
    df = frame(spark, x).withColumn("y", (F.col("k") % 5 == 0).cast("int"))
    out = M.oversample_minority(df, "features", "y", ["k"], k=5)
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 320, 1: 320}
    own = np.flatnonzero(y)
    near = dict(zip(own.tolist(), ([own[j] for _, j in p] for p in brute(x[own], 5))))
    d = N.distances(x[own], x[own])
    for r in out.where("synthetic").collect():
        v = r.features.toArray()
        i = int(np.flatnonzero(own == r.k)[0])
        kth = np.sort(np.delete(d[i], i))[4]  # ties beyond the fifth may stand for it
        fits = [j for j in own if j != r.k and N.distances(x[r.k][None], x[j][None])[0, 0] <= kth + 1e-12]
        gap = min(N.distances(v[None], x[r.k][None])[0, 0] + N.distances(v[None], x[j][None])[0, 0] - N.distances(x[r.k][None], x[j][None])[0, 0] for j in fits)
        assert gap < 1e-9 and len(near[r.k]) == 5
    again = M.oversample_minority(df.repartition(3), "features", "y", ["k"], k=5)
    assert sorted(map(str, out.where("synthetic").collect())) == sorted(map(str, again.where("synthetic").collect()))
