"""The employee workflow end to end on a small hand-made table (the reference's data file is absent)."""
import random

import pytest
from pyspark.sql import functions as F

from riskspark.plans import attrition as AT

SCHEMA = ("EmployeeNumber int, Age int, Attrition string, BusinessTravel string, DailyRate int, Department string, "
          "DistanceFromHome int, Education int, EducationField string, EmployeeCount int, EnvironmentSatisfaction int, "
          "Gender string, HourlyRate int, JobInvolvement int, JobLevel int, JobRole string, JobSatisfaction int, "
          "MaritalStatus string, MonthlyIncome int, MonthlyRate int, NumCompaniesWorked int, Over18 string, OverTime string, "
          "PercentSalaryHike int, PerformanceRating int, RelationshipSatisfaction int, StandardHours int, StockOptionLevel int, "
          "TotalWorkingYears int, TrainingTimesLastYear int, WorkLifeBalance int, YearsAtCompany int, YearsInCurrentRole int, "
          "YearsSinceLastPromotion int, YearsWithCurrManager int")


def _row(i, rnd):
    level = rnd.randint(1, 5)
    ot = rnd.choice(["Yes", "No"])
    sat = rnd.randint(1, 4)
    wlb = rnd.randint(1, 4)
    age = rnd.randint(18, 60)
    yac = rnd.randint(0, 20)
    risk = 0.05 + (0.35 if ot == "Yes" else 0) + (0.25 if sat == 1 else 0) + (0.15 if wlb == 1 else 0) + (0.1 if age < 30 else 0)
    left = "Yes" if rnd.random() < risk else "No"
    dept = rnd.choice(["Sales", "Research & Development", "Human Resources"])
    return (i, age, left, rnd.choice(["Travel_Rarely", "Travel_Frequently", "Non-Travel"]), rnd.randint(100, 1499), dept,
            rnd.randint(1, 29), rnd.randint(1, 5), rnd.choice(["Life Sciences", "Medical", "Other"]), 1, rnd.randint(1, 4),
            rnd.choice(["Male", "Female"]), rnd.randint(30, 100), rnd.randint(1, 4), level,
            rnd.choice(["Manager", "Sales Executive", "Research Scientist"]), sat, rnd.choice(["Single", "Married", "Divorced"]),
            1000 * level + rnd.randint(1000, 4000), rnd.randint(2000, 25999), rnd.randint(0, 9), "Y", ot, rnd.randint(11, 25),
            rnd.choice([3, 4]), rnd.randint(1, 4), 80, rnd.randint(0, 3), yac + rnd.randint(0, 10), rnd.randint(0, 6), wlb,
            yac, rnd.randint(0, yac), rnd.randint(0, yac), rnd.randint(0, yac))


@pytest.fixture(scope="module")
def employees(spark):
    rnd = random.Random(42)
    rows = [_row(i, rnd) for i in range(600)]
    rows.append(rows[0])  # a duplicate row, removed by cleaning
    return spark.createDataFrame(rows, SCHEMA)


def test_workflow(spark, employees):
    df = AT.prepare(employees)
    assert df.count() == 600
    assert {"EmployeeCount", "StandardHours", "Over18"}.isdisjoint(df.columns)
    trained = AT.train(df, folds=3, gbt_axes={"trees": (5,), "rates": (0.1,), "row_shares": (1.0,), "column_shares": (1.0,)})
    m = {r["model"]: r for r in trained.metrics.collect()}
    assert set(m) == {"logistic_regression", "boosted_trees"}
    assert all(0.5 < r["roc_auc"] <= 1.0 for r in m.values())
    assert sum(m["boosted_trees"][c] for c in ("tn", "fp", "fn", "tp")) == 120  # 20% holdout

    base = employees.drop("Attrition").limit(1).first().asDict()
    stable = dict(base, OverTime="No", JobSatisfaction=4, WorkLifeBalance=4, Age=45)
    risky = dict(base, OverTime="Yes", JobSatisfaction=1, WorkLifeBalance=1, Age=22)
    schema = ", ".join(f for f in SCHEMA.split(", ") if not f.startswith("Attrition "))
    two = spark.createDataFrame([stable, risky], schema)
    out = AT.predict_batch(two, trained, "logistic_regression", mode="reference_table").orderBy("Age", ascending=False).collect()
    assert out[0]["AttritionPrediction"] in (0, 1) and 0.0 <= out[0]["AttritionRisk"] <= 1.0
    assert out[1]["AttritionRisk"] > out[0]["AttritionRisk"]
    # scoring keeps every input column unchanged (SC2)
    assert {k: out[0][k] for k in stable} == stable

    groups, summary = AT.audit_fairness(df, trained)
    assert {r["attribute"] for r in summary.collect()} == {"gender", "age"}
    assert groups.groupBy("attribute").sum("count").collect()[0][1] == 600

    ref, cur = df.where("EmployeeNumber < 400"), AT.simulate_drift(df.where("EmployeeNumber >= 400"), 1.0)
    report, s = AT.analyze_drift(ref, cur)
    flagged = {r["feature"] for r in report.where("drift_detected").collect()}
    assert {"DistanceFromHome", "MonthlyIncome"} <= flagged
    assert s.first()["total_features_checked"] == len(AT.NUMERICAL_COLS) + len(AT.CATEGORICAL_COLS)


def test_reports(spark, employees):
    df = AT.prepare(employees)
    exits = df.where("Attrition = 1").select("EmployeeNumber", (F.col("EmployeeNumber") % 3).cast("string").alias("ExitReason"))
    reps = AT.reports(df, exits)
    assert set(reps) == {"rate_by_department_role", "mean_by_outcome", "rate_by_work_life_balance", "exit_reasons_by_department"}
    n_exits = df.where("Attrition = 1").count()
    assert reps["exit_reasons_by_department"].agg(F.sum("n")).first()[0] == n_exits
    assert reps["rate_by_work_life_balance"].agg(F.sum("total")).first()[0] == 600


def test_search_and_artifacts(spark, employees, tmp_path):
    df = AT.prepare(employees)
    trained = AT.train(df, folds=2, lr_axes={"cs": (0.1, 1.0)}, gbt_axes={"trees": (2, 3), "depths": (2,), "rates": (0.3,)})
    path = str(tmp_path / "artifacts")
    AT.save(spark, trained, path)
    back = AT.load(spark, path)
    assert back.prep == trained.prep and back.thresholds == trained.thresholds and back.explainer == trained.explainer
    assert back.models["boosted_trees"].point == trained.models["boosted_trees"].point and back.background.count() == 100
    x = AT.explain(df, back).withColumn("p", 1 / (1 + F.exp(-F.col("margin")))).select("EmployeeNumber", "p", "shap", "base", "margin")
    risk = AT.predict_batch(df, trained, mode="reference_table").select("EmployeeNumber", "AttritionRisk")
    got = x.join(risk, "EmployeeNumber").collect()
    assert len(got) == 600 and all(abs(r.p - r.AttritionRisk) < 1e-9 and abs(sum(r.shap) + r.base - r.margin) < 1e-9 for r in got)
    assert len(got[0].shap) == len(back.prep.feature_names)
    rows = df.drop("Attrition")
    for name in trained.models:
        a = AT.predict_batch(rows, trained, name, mode="batch_mean").select("EmployeeNumber", "AttritionRisk").collect()
        b = AT.predict_batch(rows, back, name, mode="batch_mean").select("EmployeeNumber", "AttritionRisk").collect()
        assert sorted(a) == sorted(b)
    with pytest.raises(FileNotFoundError):
        AT.load(spark, str(tmp_path / "nothing"))
    schema = ", ".join(f for f in SCHEMA.split(", ") if not f.startswith("Attrition "))
    record = employees.drop("Attrition").first().asDict()
    own = AT.predict_one(spark, record, schema, back, "logistic_regression").first()
    given = AT.predict_one(spark, dict(record, role_tenure_ratio=3.0), schema + ", role_tenure_ratio double", back, "logistic_regression").first()
    assert given["role_tenure_ratio"] == 3.0 and given["AttritionRisk"] != own["AttritionRisk"]
    lone = AT.predict_one(spark, dict(record, OverTime=None), schema, back, "logistic_regression").first()
    assert 0.0 <= lone["AttritionRisk"] <= 1.0  # a null category is all zeros
