"""Scalar expressions (F-series) and small report helpers."""
import pytest
from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import aggregates as A
from riskspark.operators import clean as P
from riskspark.operators import drift as D


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("cat__Gender_Male", 2025, 1, 5, 0.1234, 15000.0, 3.0, 0.0)],
                               "name string, y int, m int, d int, p double, money double, a double, z double")
    r = df.select(
        X.second_part("name").alias("part"), X.iso_date("y", "m", "d").alias("date"),
        X.pct_text("p").alias("pct"), X.money_text("money").alias("money"),
        X.normalise(F.array(F.lit(1.0), F.lit(3.0))).alias("norm"),
        X.clamp(F.lit(1.2), 0.0, 0.95).alias("cl"), X.safe_div("a", "z").alias("sd"),
        X.trunc_int(F.lit(-2.7)).alias("tr"), X.to_binary(F.lit(0.5), 0.5).alias("b")).first()
    assert r.part == "Gender_Male" and r.date == "2025-01-05"
    assert r.pct == "12.3%" and r.money == "$15,000"
    assert r.norm == [0.25, 0.75] and r.cl == 0.95 and r.sd == 0.0 and r.tr == -2 and r.b == 1


def test_top_value_smallest_on_ties_and_value_counts_skip_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert A.top_value(df, "v").first()["top_value"] == "a"
    assert [(r.value, r.n) for r in A.value_counts(df, "v").collect()] == [("a", 2), ("b", 2)]


def test_exact_quantiles_match_percentile(spark):
    df = spark.createDataFrame([(1, float(x)) for x in [5, 1, 4, 4, 9, 2, 7]] + [(2, 3.0)], "g int, v double")
    ours = {r["g"]: (r["q0"], r["q1"], r["q2"]) for r in A.exact_quantiles(df, "g", "v", [0.25, 0.5, 0.9]).collect()}
    ref = {r["g"]: tuple(r["q"]) for r in df.groupBy("g").agg(
        F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.9))).alias("q")).collect()}
    assert all(ours[g] == pytest.approx(ref[g]) for g in ref)


def test_validate_domains_and_status_view(spark):
    df = spark.createDataFrame([(1, 99, "x"), (2, 5, "a")], "id int, age int, c string")
    v = P.validate_domains(df, ranges={"age": (18, 60)}, allowed={"c": ["a", "b"]}, id_cols=["id"])
    assert sorted((r.id, r.column) for r in v.collect()) == [(1, "age"), (1, "c"), (2, "age")]
    rep = spark.createDataFrame([("b", False), ("a", True), ("c", True)], "feature string, drift_detected boolean")
    assert [r.feature for r in D.status_view(rep).collect()] == ["a", "c", "b"]
    assert D.drifting_features(rep).first()[0] == ["a", "c"]


def test_join_breakdown_pre_aggregate_same_result(spark):
    parent = spark.createDataFrame([(1, "a", 10.0), (2, "a", 20.0), (3, "b", 30.0)], "id int, dept string, pay double")
    child = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (3, "y"), (3, "x")], "pid int, reason string")
    plain = A.join_breakdown(parent, child, "id", "pid", "dept", "reason", "pay").collect()
    eager = A.join_breakdown(parent, child, "id", "pid", "dept", "reason", "pay", pre_aggregate=True).collect()
    assert plain == eager
    li = spark.createDataFrame([(1, "O", "R"), (1, "O", "N"), (2, "F", "R")], "k int, st string, fl string")
    dim = spark.createDataFrame([(1, "H"), (2, "L")], "dk int, pr string")
    a = A.rate_by(li.join(dim, li.k == dim.dk), ["pr", "st"], "fl", "R").collect()
    b = A.rate_by_join(li, dim, "k", "dk", ["pr", "st"], "fl", "R").collect()
    assert a == b
