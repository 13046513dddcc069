"""Golden vectors of the reference's feature test (4 rows) and scaling/one-hot rules."""
import pytest

from pyspark.sql import functions as F

from riskspark.operators import features as W


def test_engineered_ratios(spark):
    df = spark.createDataFrame([(1, 2000, 2, 5), (1, 4000, 0, 0), (2, 6000, 5, 10), (2, 8000, 1, 1)],
                               "JobLevel int, MonthlyIncome int, YearsInCurrentRole int, YearsAtCompany int")
    out = W.engineer_features(df).orderBy("MonthlyIncome").collect()
    ratios = [r["income_ratio_to_joblevel_avg"] for r in out]
    tenure = [r["role_tenure_ratio"] for r in out]
    assert ratios[:3] == pytest.approx([2 / 3, 4 / 3, 6 / 7], rel=1e-5)
    assert tenure == pytest.approx([2 / 6, 0.0, 5 / 11, 0.5])


def test_null_key_gets_null_ratio(spark):
    df = spark.createDataFrame([(None, 100.0), (1, 50.0), (1, 150.0)], "k int, v double")
    out = {r["v"]: r["ratio"] for r in W.ratio_to_group_mean(df, "v", "k", "ratio").collect()}
    assert out[100.0] is None
    assert out[50.0] == pytest.approx(0.5, rel=1e-6)


def test_scaler_population_sd_and_zero_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    p = {r["feature"]: (r["mean"], r["scale"]) for r in W.fit_scaler(df, ["a", "b"]).collect()}
    assert p["a"] == (2.0, 1.0)  # population sd of (1, 3) is 1
    assert p["b"] == (5.0, 1.0)  # zero deviation stored as 1.0


def test_one_hot_drops_first_sorted_and_unknown_is_zero(spark):
    df = spark.createDataFrame([("Sales",), ("HR",), ("R&D",)], "Department string")
    cats = W.collect_categories(W.fit_one_hot(df, ["Department"]))
    assert cats == {"Department": ["R&D", "Sales"]}
    new = spark.createDataFrame([("HR",), ("Other",), ("Sales",)], "Department string")
    rows = W.apply_one_hot(new, cats).collect()
    assert [(r["Department_R&D"], r["Department_Sales"]) for r in rows] == [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0)]


def test_lookup_with_default(spark):
    df = spark.createDataFrame([(1, 2800.0), (9, 5000.0)], "JobLevel int, MonthlyIncome double")
    out = W.lookup_ratio(df, "MonthlyIncome", "JobLevel", {1: 2800.0}, "r").select("r").collect()
    assert [r[0] for r in out] == [1.0, 1.0]


def test_category_index_of_a_long_list(spark):
    """50,000 values in many partitions get the places of their sorted order; nulls and unseen values have no one."""
    n = 50_000
    df = spark.range(n).select(F.concat(F.lit("v"), F.col("id") % n).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("b")).repartition(16)
    index, size = W.category_index(df, ["a", "b"])
    assert size == n - 1 + 1
    got = {(r.feature, r.value): r["index"] for r in index.collect()}
    names = sorted(f"v{i}" for i in range(n))
    assert got == {**{("a", v): i for i, v in enumerate(names[1:])}, ("b", "2"): n - 1}
    new = spark.createDataFrame([(1, "v7", "2", 0), (2, "v0", "1", 0), (3, None, None, 0), (4, "unseen", "2", 0)], "k int, a string, b string, features int")
    rows = {r.k: r for r in W.sparse_ones(W.one_hot_indices(new, index, ["a", "b"]), size).collect()}
    assert rows[1].indices == [got["a", "v7"], n - 1] and rows[2].indices == [] and rows[3].indices == [] and rows[4].indices == [n - 1]
    assert rows[1].features.size == n and list(rows[1].features.indices) == rows[1].indices and list(rows[1].features.values) == [1.0, 1.0]
    assert rows[3].features.numNonzeros() == 0


def test_category_index_equals_the_named_columns(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("z", None), (None, 2), ("x", 10)], "a string, b int")
    names = W.one_hot_names(W.collect_categories(W.fit_one_hot(df, ["b", "a"])), ["b", "a"])
    index, size = W.category_index(df, ["b", "a"])
    assert {f"{r.feature}_{r.value}": r["index"] for r in index.collect()} == {n: i for i, n in enumerate(names)} and size == len(names)
    empty, none = W.category_index(df.where("false"), ["a", "b"])
    assert none == 0 and empty.count() == 0
