"""Importance resampling: weights against a plain version, the cut, and what the sample holds."""

import math
import random
from collections import Counter

import pytest

from riskspark.llm import resample as R
from riskspark.llm.common import mix, word_hashes


def brute_weights(texts, target, buckets):
    import numpy as np

    def grams(t):
        h = word_hashes((t or "").encode().split())
        pairs = [int(mix(a * np.uint64(0x9E3779B97F4A7C15) + b)) for a, b in zip(h[:-1], h[1:])] if len(h) > 1 else []
        return [int(x) % buckets for x in h] + [p % buckets for p in pairs]

    def model_(ts):
        c = Counter(g for t in ts for g in grams(t))
        n = sum(c.values())
        return [(c[b] + 1) / (n + buckets) for b in range(buckets)]

    p, q = model_(target), model_(texts)
    return [sum(math.log(p[g] / q[g]) for g in grams(t)) for t in texts]


@pytest.mark.filterwarnings("ignore")
def test_weights_and_cut(spark):
    rnd = random.Random(8)
    good = [" ".join(rnd.choice("alpha beta gamma delta".split()) for _ in range(rnd.randint(1, 30))) for _ in range(150)]
    bad = [" ".join(rnd.choice("### $$$ alpha".split()) for _ in range(rnd.randint(1, 30))) for _ in range(150)]
    texts = [*good, *bad, None, "", "one"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, log_weight string, chars int").repartition(4)
    target = spark.createDataFrame([(t,) for t in good[:100]], "text string")
    rows = {r.doc_id: r for r in R.resample(docs, target, 0.5, 512).collect()}
    want = brute_weights(texts, good[:100], 512)
    assert len(rows) == len(texts)
    for i, w in enumerate(want):
        assert rows[i].log_weight == pytest.approx(w, abs=1e-9)
    order = sorted(rows.values(), key=lambda r: (-r.gumbel_sum, r.doc_id))
    assert [r.sampled for r in order] == [True] * round(0.5 * len(texts)) + [False] * (len(texts) - round(0.5 * len(texts)))
    assert sum(r.sampled for i, r in rows.items() if i < 150) > 120
    again = {r.doc_id: r.sampled for r in R.resample(docs.repartition(2), target, 0.5, 512).collect()}
    assert again == {i: r.sampled for i, r in rows.items()}


def test_cut_narrows_to_the_kth_row(spark, monkeypatch):
    monkeypatch.setattr(R, "BINS", 8)
    rnd = random.Random(9)
    rows = [(i, rnd.choice([rnd.gauss(0, 50), 1.5, -3.0])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, gumbel_sum double")
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for k in (1, 7, 150, 200, 399):
        v, doc = R.cut(df, k)
        assert (doc, v) == (order[k - 1][0], pytest.approx(order[k - 1][1]))
    assert R.cut(df, 400) is None
    assert R.cut(df, 0) == (float("inf"), None)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "a b"), (None, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.resample(none, none).count() == 0
    assert all(r.log_weight == 0 for r in R.resample(docs, none).collect())
