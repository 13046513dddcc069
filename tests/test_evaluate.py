"""Evaluation: golden confusion metrics, and curve metrics against brute force / plain windows."""
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.operators import evaluate as E
from riskspark.operators.prefix import running_sums


def _frame(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "y int, p int")


@pytest.mark.parametrize("counts,expected", [
    ((224, 23, 24, 23), (0.8401360544, 0.5, 0.4893617021, 0.4946236559)),
    ((237, 10, 26, 21), (0.8775510204, 0.6774193548, 0.4468085106, 0.5384615385)),
])
def test_metrics_at_threshold_golden(spark, counts, expected):
    r = E.metrics_at_threshold(_frame(spark, *counts), "y", "p", 0.5).first()
    assert (r.accuracy, r.precision, r.recall, r.f1_score) == pytest.approx(expected, abs=1e-9)
    assert (r.tn, r.fp, r.fn, r.tp) == counts


def _random_scores(spark, n=3000, seed=7, parts=8):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(rng.random(n) + 0.3 * y, 2)  # rounding creates ties
    df = spark.createDataFrame([(int(i), int(a), float(b)) for i, (a, b) in enumerate(zip(y, s))], "id long, y int, s double")
    return df.repartition(parts), y, s


def _brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def _brute_ap(y, s):
    order = np.unique(s)[::-1]
    P = y.sum()
    ap, prev_r = 0.0, 0.0
    for t in order:
        sel = s >= t
        tp = (y[sel] == 1).sum()
        r = tp / P
        ap += (r - prev_r) * tp / sel.sum()
        prev_r = r
    return ap


def test_auc_and_ap_match_brute_force(spark):
    df, y, s = _random_scores(spark)
    assert E.roc_auc(df, "y", "s").first()[0] == pytest.approx(_brute_auc(y, s), abs=1e-12)
    assert E.average_precision(df, "y", "s").first()[0] == pytest.approx(_brute_ap(y, s), abs=1e-12)


def test_results_do_not_depend_on_partitioning(spark):
    df, _, _ = _random_scores(spark)
    a = E.best_f1_threshold(df.repartition(1), "y", "s").first()
    b = E.best_f1_threshold(df.repartition(17), "y", "s").first()
    assert a == b


def test_bucketed_prefix_equals_plain_window(spark):
    df, _, _ = _random_scores(spark)
    st = E.score_table(df, "y", "s")
    ours = {r["s"]: (r["cum_pos"], r["cum_neg"]) for r in running_sums(st, "s", ["pos", "neg"], buckets=7).collect()}
    w = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    plain = {r["s"]: (r["a"], r["b"]) for r in st.select("s", F.sum("pos").over(w).alias("a"),
                                                          F.sum("neg").over(w).alias("b")).collect()}
    assert ours == plain


def test_capture_at_top_matches_row_number(spark):
    df, _, _ = _random_scores(spark)
    got = E.capture_at_top(df, "y", "s", "id", 10).first()
    w = Window.orderBy(F.desc("s"), "id")
    k = int(df.count() * 10 / 100)
    top = df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    assert got["flagged"] == k
    assert got["captured"] == top.agg(F.sum("y")).first()[0]


def test_capture_at_top_cuts_ties_zeros_nan_and_empty(spark):
    """Many rows tied at the cut, signed zeros, NaN (the highest score), no row flagged, no rows at all."""
    nan = float("nan")
    rows = [(i, i % 3 == 0, 0.5) for i in range(300)] + [(300 + i, i % 2 == 0, [0.0, -0.0, nan, 0.9][i % 4]) for i in range(100)]
    rows += [(900, None, 0.9), (901, True, None)]
    df = spark.createDataFrame([(i, None if y is None else int(y), s) for i, y, s in rows], "id long, y int, s double").repartition(5)
    order = sorted([r for r in rows if r[1] is not None and r[2] is not None], key=lambda r: (r[2] == r[2], -r[2] if r[2] == r[2] else 0, r[0]))
    total = sum(r[1] for r in order)
    for r in E.capture_at_top(df, "y", "s", "id", [0.1, 5, 50, 90, 100]).collect():
        k = int(len(order) * r.top_pct / 100)
        want = sum(x[1] for x in order[:k])
        assert (r.flagged, r.captured, r.recall, r.precision) == (k, want, want / total, want / k if k else 0.0)
    assert [tuple(r) for r in E.capture_at_top(df.limit(0), "y", "s", "id", 10).collect()] == [(10.0, 0, 0, 0.0, 0.0)]


def test_best_threshold_first_max_lowest(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)], "y int, s double")
    r = E.best_f1_threshold(df, "y", "s").first()
    assert r["threshold"] == 0.7


def test_thinned_buckets_per_part_equal_plain_window(spark):
    import numpy as np
    rng = np.random.default_rng(11)
    rows = [("big", float(x), 1) for x in np.round(rng.random(3000), 3)] + [("small", float(x), 1) for x in rng.random(50)]
    df = spark.createDataFrame(rows, "part string, v double, c int").groupBy("part", "v").agg(F.sum("c").alias("c"))
    ours = running_sums(df, "v", ["c"], part_cols=["part"], rows_per_bucket=200)
    w = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("part", "v", F.sum("c").over(w).alias("cum_c"))
    assert sorted(ours.select("part", "v", "cum_c").collect()) == sorted(plain.collect())


def test_hot_part_is_split_and_exact(spark):
    """A part holding a third of all rows gets several buckets; results equal a plain window."""
    from riskspark.operators.prefix import assign_buckets
    rows = [("hot", float(i), 1) for i in range(3000)] + [(f"p{j}", float(i), 1) for j in range(20) for i in range(300)]
    df = spark.createDataFrame(rows, "part string, v double, c int")
    tagged = assign_buckets(df, "v", ["part"], rows_per_bucket=500)
    hot_buckets = tagged.where("part = 'hot'").select("_bucket").distinct().count()
    assert hot_buckets > 1
    ours = running_sums(df, "v", ["c"], part_cols=["part"], rows_per_bucket=500)
    w = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("part", "v", F.sum("c").over(w).alias("cum_c"))
    assert sorted(ours.select("part", "v", "cum_c").collect()) == sorted(plain.collect())
