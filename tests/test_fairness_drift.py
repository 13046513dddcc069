"""Fairness and drift: golden values of the reference's reports and brute-force checks."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import drift as D
from riskspark.operators import fairness as G


def _groups(spark, spec):
    rows = []
    for g, n, flagged in spec:
        rows += [(g, 1 if i < flagged else 0, 0) for i in range(n)]
    return spark.createDataFrame(rows, "g string, pred int, y int")


@pytest.mark.parametrize("spec,ratio,ok", [
    ([("Female", 588, 97), ("Male", 882, 149)], 0.9765100671, True),
    ([("old", 522, 44), ("young", 948, 202)], 0.3955843860, False),
])
def test_impact_ratio_golden(spark, spec, ratio, ok):
    df = _groups(spark, spec)
    attrs = [G.Attribute("a", F.col("g"), protected=spec[0][0], reference=spec[1][0])]
    _, summary = G.audit(df, "y", "pred", attrs)
    r = summary.first()
    assert r["disparate_impact_ratio"] == pytest.approx(ratio, abs=1e-9)
    assert r["compliant_four_fifths"] is ok


def test_zero_reference_rate_gives_zero_ratio(spark):
    df = _groups(spark, [("a", 10, 3), ("b", 10, 0)])
    _, s = G.audit(df, "y", "pred", [G.Attribute("x", F.col("g"), "a", "b")])
    assert s.first()["disparate_impact_ratio"] == 0.0


def test_chi2_yates_golden(spark):
    # counts that reproduce the stored report value with the capped Yates correction
    ref = spark.createDataFrame([("Male",)] * 608 + [("Female",)] * 392, "Gender string")
    cur = spark.createDataFrame([("Male",)] * 285 + [("Female",)] * 185, "Gender string")
    r = D.drift_chi2(ref, cur, ["Gender"]).first()
    assert r["statistic"] == pytest.approx(0.00011620257844608408, rel=1e-9)
    assert r["p_value"] == pytest.approx(0.9913991864522801, rel=1e-9)
    assert r["dof"] == 1


def test_single_category_is_no_drift(spark):
    ref = spark.createDataFrame([("Y",)] * 5, "c string")
    r = D.drift_chi2(ref, ref, ["c"]).first()
    assert (r["statistic"], r["p_value"], r["drift_detected"]) == (0.0, 1.0, False)


def test_ks_statistic_brute_force(spark):
    rng = np.random.default_rng(3)
    a, b = np.round(rng.normal(0, 1, 400), 1), np.round(rng.normal(0.2, 1, 300), 1)
    ref = spark.createDataFrame([(float(x),) for x in a], "v double")
    cur = spark.createDataFrame([(float(x),) for x in b], "v double")
    r = D.drift_ks(ref, cur, ["v"]).first()
    grid = np.union1d(a, b)
    d = max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)
    assert r["statistic"] == pytest.approx(d, abs=1e-12)
    assert (r["n_ref"], r["n_cur"]) == (400, 300)


def test_summary_threshold(spark):
    rows = [(f"f{i}", i < 5) for i in range(29)]
    rep = spark.createDataFrame(rows, "feature string, drift_detected boolean")
    s = D.drift_summary(rep).first()
    assert s["drifting_features_percentage"] == pytest.approx(17.24137931034483)
    assert s["drift_detected"] is False
    rows = [(f"f{i}", i < 1) for i in range(4)]  # exactly 25% -> flagged (>=)
    assert D.drift_summary(spark.createDataFrame(rows, "feature string, drift_detected boolean")).first()[0] is True


def test_perturb_zero_severity_is_identity(spark):
    df = spark.createDataFrame([(1, 10, 5000, "No")], "id long, d int, inc int, ot string")
    assert D.perturb(df, ["id"], severity=0.0, shift={"d": 1}).collect() == df.collect()
    out = D.perturb(df, ["id"], severity=1.0, shift={"d": 1}, cut=["inc"]).first()
    assert (out["d"], out["inc"]) == (15, 4250)


def test_ks_against_reference_brute_force(spark):
    """Per-period KS without repeating the reference equals the direct two-sample statistic."""
    rng = np.random.default_rng(5)
    ref = np.round(rng.normal(0, 1, 500), 1)
    cur = {p: np.round(rng.normal(0.1 * p, 1 + 0.1 * p, 80 + 40 * p), 1) for p in range(4)}
    ref_counts = spark.createDataFrame([("x", float(v), 1) for v in ref], "feature string, v double, r long") \
        .groupBy("feature", "v").agg(F.sum("r").alias("r"))
    cur_counts = spark.createDataFrame([(p, "x", float(v), 1) for p, vs in cur.items() for v in vs],
                                       "period int, feature string, v double, c long") \
        .groupBy("period", "feature", "v").agg(F.sum("c").alias("c"))
    got = {r["period"]: r["statistic"] for r in D.ks_against_reference(ref_counts, cur_counts, ["period"]).collect()}
    for p, vs in cur.items():
        grid = np.union1d(ref, vs)
        want = max(abs((ref <= g).mean() - (vs <= g).mean()) for g in grid)
        assert got[p] == pytest.approx(want, abs=1e-12)


def test_chi2_against_reference_equals_explicit_cells(spark):
    """Per-group chi-square without repeating the reference equals the explicit union-of-cells form,
    including 2x2 tables (Yates), single-category groups and categories new in a group."""
    import random
    rnd = random.Random(3)
    ref_rows, cur_rows = [], []
    for feat, cats in [("f3", list("abcde")), ("f2", list("ab")), ("f2b", list("ab"))]:
        ref_rows += [(feat, v, rnd.randint(1, 50)) for v in cats]
        for p in range(6):
            present = rnd.sample(cats, rnd.randint(1, len(cats))) + (["zz"] if feat == "f3" and p == 5 else [])
            cur_rows += [(p, feat, v, rnd.randint(0, 40)) for v in present]
    ref = spark.createDataFrame(ref_rows, "feature string, v string, r long")
    cur = spark.createDataFrame(cur_rows, "period int, feature string, v string, c long")
    fast = {(r.period, r.feature): (r.statistic, r.dof) for r in D.chi2_against_reference(ref, cur, ["period"]).collect()}
    periods = cur.select("period").distinct()
    cells = (ref.crossJoin(periods).select("period", "feature", "v", "r", F.lit(0).cast("long").alias("c"))
             .unionByName(cur.select("period", "feature", "v", F.lit(0).cast("long").alias("r"), "c"))
             .groupBy("period", "feature", "v").agg(F.sum("r").alias("r"), F.sum("c").alias("c")))
    slow = {(r.period, r.feature): (r.statistic, r.dof) for r in D.chi2_from_counts(cells, ["period"]).collect()}
    assert set(fast) == set(slow)
    for key, (stat, dof) in slow.items():
        assert fast[key][1] == dof
        assert fast[key][0] == pytest.approx(stat, abs=1e-9)


def test_large_counts_do_not_overflow(spark):
    from riskspark.operators import drift as D
    from riskspark.operators import evaluate as E

    big = 5_000_000_000
    cells = spark.createDataFrame([("f", "a", big, big + 7), ("f", "b", 2 * big, big)], "feature string, v string, r long, c long")
    assert D.chi2_from_counts(cells).first()["statistic"] > 0
    ref, cur = cells.select("feature", "v", "r"), cells.select(F.lit(1).alias("p"), "feature", "v", "c")
    got = D.chi2_against_reference(ref, cur, ["p"]).first()["statistic"]
    assert got == pytest.approx(D.chi2_from_counts(cells).first()["statistic"], rel=1e-9)
    scores = spark.createDataFrame([(0.1, big, big), (0.9, big, 1)], "s double, pos long, neg long")
    original = E.score_table
    E.score_table = lambda *a, **k: scores
    try:
        assert 0.5 < E.roc_auc(scores, "x", "s").first()["roc_auc"] < 1
    finally:
        E.score_table = original


def test_report_of_no_feature_is_empty(spark):
    from riskspark.operators import drift as D

    a = spark.createDataFrame([(1,)], "x int")
    report = D.drift_report(a, a, ["absent"], ["gone"])
    assert report.count() == 0
    assert D.drift_summary(report).first().asDict() == {"drift_detected": False, "drifting_features_percentage": 0.0,
                                                         "drifting_features_count": 0, "total_features_checked": 0}


def test_density_of_a_class_without_spread_is_null(spark):
    from riskspark.operators import aggregates as A

    rows = [(0, 5.0), (0, 5.0), (1, 3.0), (2, 1.0), (2, 2.0), (2, 4.0)]
    out = A.density_by_class(spark.createDataFrame(rows, "y int, v double"), "v", "y", 0.0, 10.0, grid=11).collect()
    assert len(out) == 33 and all((r["density"] is None) == (r["cls"] != 2) for r in out)


def test_window_ks_equals_batch(spark, tmp_path):
    """Late rows, an open last window, nulls and NaN: statistic and p-value of each window as by the batch test."""
    import datetime as dt
    import random

    from riskspark.operators import drift as D
    from riskspark.streaming.stream import window_ks

    rnd = random.Random(1)
    day = dt.datetime(2024, 1, 1)
    rows = [(day + dt.timedelta(hours=rnd.randint(0, 24 * 6 - 1)), rnd.choice([None, float("nan"), round(rnd.gauss(0, 1), 1)])) for _ in range(1500)]
    schema = "ts timestamp_ntz, x double"
    df = spark.createDataFrame(rows, schema)
    df.orderBy("ts").repartition(6).write.parquet(str(tmp_path / "in"))
    base = df.where("ts < '2024-01-03'")
    for method in ("asymptotic", "exact"):
        got = {r.window_start.date(): r for r in window_ks(spark, str(tmp_path / "in"), schema, "ts", "x", base, delay="10 days", method=method).collect()}
        assert len(got) == 6
        for d, r in got.items():
            own = df.where((F.col("ts").cast("date") == F.lit(d)) & ~F.isnan("x"))
            want = D.drift_ks(base.where(~F.isnan("x")), own, ["x"], method=method).first()
            assert abs(r.statistic - want.statistic) < 1e-12 and abs(r.p_value - want.p_value) < 1e-9 and r.drift_detected == want.drift_detected


def test_stored_counts_give_the_report_of_a_full_run(spark, tmp_path):
    import datetime as dt
    import random

    rnd = random.Random(4)
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 20)), rnd.choice([None, rnd.gauss(0, 1)]), rnd.choice(["a", "b", "c", None])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "ts timestamp, x double, s string")
    base = F.col("ts") < "2024-01-05"
    args = ("ts", base, ["x"], ["s"], "day")
    path = str(tmp_path / "state")
    cuts = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-02-01"]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        new = df.where((F.col("ts") >= a) & (F.col("ts") < b))
        for _ in range(2):  # a batch that is run again counts once
            D.add_to_state(new, path, f"b{i}", *args)
    got = D.drift_from_state(spark, path).orderBy("period", "feature").collect()
    want = D.drift_by_period(df, *args).orderBy("period", "feature").collect()
    assert len(got) == len(want) > 20
    for g, w in zip(got, want):
        assert g[:3] == w[:3] and abs(g.statistic - w.statistic) < 1e-12 and abs(g.p_value - w.p_value) < 1e-9
