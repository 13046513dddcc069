"""Cleaning order, label encoding, schema completion, stratified split sizes, rules."""
from pyspark.sql import functions as F

import pytest

from riskspark.operators import clean as P
from riskspark.operators import explain as X
from riskspark.operators import models as M
from riskspark.operators.score import risk_tier


def test_clean_drops_then_dedups_then_encodes(spark):
    df = spark.createDataFrame([(1, "Yes", 1), (1, "Yes", 2), (2, "Maybe", 1)], "id int, Attrition string, EmployeeCount int")
    out = P.clean(df).orderBy("id").collect()
    assert len(out) == 2  # rows differ only in the dropped constant column
    assert [r["Attrition"] for r in out] == [1, None]
    assert "EmployeeCount" not in out[0].asDict()


def test_complete_schema_fills_absent_only(spark):
    df = spark.createDataFrame([(None,)], "Age double")
    out = P.complete_schema(df, ["Age", "DailyRate"], ["Gender"]).first()
    assert out["Age"] is None and out["DailyRate"] == 0.0 and out["Gender"] == "Unknown"


def test_stratified_split_sizes(spark):
    rows = [(i, 1 if i < 237 else 0) for i in range(1470)]
    df = spark.createDataFrame(rows, "id long, y int")
    s = M.stratified_split(df, "y", ["id"], 0.2)
    got = {r["y"]: r["n"] for r in s.where("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 47, 0: 247}
    folds = M.stratified_folds(df, "y", ["id"], 5).groupBy("y", "fold").count().collect()
    sizes = {(r["y"], r["fold"]): r["count"] for r in folds}
    assert max(sizes.values()) - min(v for (y, _), v in sizes.items() if y == 0) <= 237


def test_rule_contributions_fallback_and_order(spark):
    df = spark.createDataFrame([(1, 5.0), (0, 0.0)], "a int, b double")
    rules = [(F.col("a") == 1, "A", 0.28), (F.col("b") > 1, "B", -0.10)]
    out = X.rule_contributions(df, rules).orderBy(F.desc("a")).collect()
    assert [c["factor"] for c in out[0]["contributions"]] == ["B", "A"]
    assert [(c["factor"], c["value"]) for c in out[1]["contributions"]] == [("Baseline Factors", 0.02)]


def test_rule_score_cap(spark):
    df = spark.createDataFrame([(1,), (0,)], "a int")
    out = df.select(X.rule_score([(F.col("a") == 1, 2.0)]).alias("s")).collect()
    assert [r["s"] for r in out] == [0.95, 0.05]


def test_risk_tiers(spark):
    df = spark.createDataFrame([(0.5,), (0.3,), (0.1,), (None,)], "p double")
    assert [r[0] for r in df.select(risk_tier("p", 0.5)).collect()] == ["HIGH", "MEDIUM", "LOW", None]


def test_score_batch_mode_is_explicit(spark):
    from riskspark.operators.score import score_batch
    rows = [(1000.0 * (i % 5 + 1) + 37 * i, i % 5 + 1, i % 4, i % 7, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "MonthlyIncome double, JobLevel int, YearsInCurrentRole int, YearsAtCompany int, y int")
    from riskspark.operators.features import scoring_features
    train = scoring_features(df)
    prep = M.fit_prep(train, ["income_ratio_to_joblevel_avg", "role_tenure_ratio"], [])
    model = M.logistic("y").fit(prep.transform(train))
    table = {1: 900.0, 2: 2100.0, 3: 2900.0, 4: 4300.0, 5: 5200.0}
    feats = df.drop("y")

    def scores(frame, mode):
        return sorted(r["AttritionRisk"] for r in score_batch(frame, prep, model, 0.5, mode=mode, reference_table=table).collect())

    small, big = feats.limit(3), feats
    whole = {tuple(r[c] for c in feats.columns): r["AttritionRisk"] for r in score_batch(big, prep, model, 0.5, mode="reference_table", reference_table=table).collect()}
    part = score_batch(small, prep, model, 0.5, mode="reference_table", reference_table=table).collect()
    assert len(part) == 3 and all(r["AttritionRisk"] == whole[tuple(r[c] for c in feats.columns)] for r in part)
    assert scores(big, "batch_mean") != scores(big, "reference_table")
    with pytest.raises(TypeError):
        score_batch(big, prep, model, 0.5)
    with pytest.raises(ValueError):
        score_batch(big, prep, model, 0.5, mode="auto")


def test_draws_and_splits_keep_small_shares_and_nulls(spark):
    from riskspark.operators.clean import seeded_sample

    big = spark.range(4_000_000).withColumnRenamed("id", "k")
    assert 1 <= seeded_sample(big, ["k"], fraction=4e-6).count() <= 60
    assert seeded_sample(big, ["k"], fraction=0.0).count() == 0 and seeded_sample(big, ["k"], fraction=1.0).count() == 4_000_000
    rows = spark.createDataFrame([(i, None if i % 4 == 0 else i % 2) for i in range(100)], "k long, y int")
    s = M.stratified_split(rows, "y", ["k"], 0.2)
    assert s.count() == 100
    assert {r["y"]: (r["n"], r["t"]) for r in s.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()} == {None: (25, 5), 1: (50, 10), 0: (25, 5)}
    f = M.stratified_folds(rows, "y", ["k"], 4).groupBy("y", "fold").count().collect()
    assert len(f) == 12 and all(c["count"] in (6, 7, 12, 13) for c in f)
    assert not s._jdf.queryExecution().executedPlan().toString().count("rangepartitioning")


def test_positional_split_is_exact_on_a_hot_value(spark):
    rows = spark.createDataFrame([(5 if i % 3 else i, i % 7) for i in range(900)] + [(None, 1)] * 9, "v int, w int").repartition(4)
    for n in (0, 100, 700, 900, 905, 2000):
        a, b = P.positional_split(rows, "v", first_n=n)
        got = [r["v"] for r in a.collect()]
        assert len(got) == min(n, 909) and len(got) + b.count() == 909
        want = sorted((r["v"] is None, r["v"] or 0) for r in rows.collect())[:n]
        assert sorted((v is None, v or 0) for v in got) == want


def test_one_minority_row_is_copied(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(i, int(i == 0), Vectors.dense([float(i), 1.0])) for i in range(20)]
    out = M.oversample_minority(spark.createDataFrame(rows, ["k", "y", "features"]), "features", "y", ["k"])
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 19, 1: 19}


def test_one_hot_of_null_is_zero_and_no_category_is_lost(spark):
    from riskspark.operators import features as W

    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "c string")
    cats = W.collect_categories(W.fit_one_hot(df, ["c"]))
    assert cats == {"c": ["b", "c"]}
    assert [tuple(r)[1:] for r in W.apply_one_hot(df, cats).orderBy("c").collect()] == [(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (0.0, 1.0)]


def test_grid_defaults_are_the_reference_axes(spark):
    """The reference's axes: 3 x 3 x 3 x 3 x 2 x 2 points for trees, 4 C values for the regression."""
    from riskspark.operators import boosting as BT
    from riskspark.operators import models as M
    from riskspark.plans import attrition as AT
    from riskspark.plans import ml_queries as Q

    points = BT.grid(positive_weights=(1.0, *(3.0 * f for f in AT.POSITIVE_FACTORS)))
    assert len(points) == 324 and {p.trees for p in points} == {100, 150, 200} and {p.rate for p in points} == {0.03, 0.05, 0.1}
    assert {p.positive_weight for p in points} == {1.0, 2.25, 3.0} and {p.depth for p in points} == {3, 4, 5}
    assert {p.row_share for p in points} == {p.column_share for p in points} == {0.8, 1.0}
    assert len(BT.grid(trees=Q.GBT_QUERY_TREES, positive_weights=(1.0, 3.0, 2.25))) == 324
    lr = M.logistic("y", weight="weight")
    assert len(M.lr_grid(lr, 10.0)) == 8


def test_positional_split_of_files_writes_nothing(spark, tmp_path, monkeypatch):
    """Rows of Parquet files are cut by file and row number; both frames are the same on every read."""
    import riskspark.session as session

    rows = [(i, None if i % 10 == 9 else i % 7) for i in range(1000)]
    spark.createDataFrame(rows, "k long, v int").repartition(6).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    monkeypatch.setattr(session, "cut_lineage", lambda *a, **b: 1 / 0)
    for own in (df, df.where("k >= 100").withColumn("w", F.col("v") * 2)):
        total = own.count()
        for n in (1, 150, 500, total - 1, total + 5):
            a, b = P.positional_split(own, "v", n)
            first = {r.k for r in a.collect()}
            assert len(first) == min(n, total) and first == {r.k for r in a.collect()}
            rest = {r.k for r in b.collect()}
            assert not first & rest and len(first | rest) == total and a.columns == own.columns
            last = max(((r.v is None, r.v or 0) for r in a.collect()))
            assert all((r.v is None, r.v or 0) >= last for r in b.collect())
    assert P.file_position(spark.range(3)) is None and P.file_position(df.groupBy("v").count()) is None
