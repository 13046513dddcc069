"""The reference's employee-attrition workflow on riskspark operators, with its column defaults, so a
user of the reference can switch over: clean -> features -> split -> preprocess -> train (weighted
logistic regression and boosted trees) -> F1 threshold from out-of-fold scores -> holdout metrics
-> batch / single scoring -> fairness audit -> drift report -> business figures.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators import boosting as BT
from riskspark.operators import business as B
from riskspark.operators import clean as P
from riskspark.operators import drift as D
from riskspark.operators import evaluate as E
from riskspark.operators import fairness as G
from riskspark.operators import features as W
from riskspark.operators import models as M
from riskspark.operators.score import score_batch
from riskspark.operators.shapley import Explainer
from riskspark.operators.shapley import explain as explain_rows
from riskspark.session import cut_lineage

# The reference's feature lists, key, label and reference level averages.
CATEGORICAL_COLS = ["BusinessTravel", "Department", "EducationField", "Gender", "MaritalStatus", "OverTime", "JobRole"]
NUMERICAL_COLS = [
    "Age", "DailyRate", "DistanceFromHome", "Education", "EnvironmentSatisfaction",
    "HourlyRate", "JobInvolvement", "JobLevel", "JobSatisfaction", "MonthlyIncome",
    "MonthlyRate", "NumCompaniesWorked", "PercentSalaryHike", "PerformanceRating",
    "RelationshipSatisfaction", "StockOptionLevel", "TotalWorkingYears",
    "TrainingTimesLastYear", "WorkLifeBalance", "YearsAtCompany", "YearsInCurrentRole",
    "YearsSinceLastPromotion", "YearsWithCurrManager", "income_ratio_to_joblevel_avg",
    "role_tenure_ratio",
]
LABEL = "Attrition"
KEY = "EmployeeNumber"
POSITIVE_FACTORS = (0.75, 1.0)  # fixed values: shares of the imbalance in the positive weight
LEVEL_AVERAGES = {1: 2800.0, 2: 5400.0, 3: 9800.0, 4: 15500.0, 5: 19100.0}


@dataclass
class Trained:
    prep: M.Prep
    models: dict
    thresholds: dict
    metrics: DataFrame
    explainer: Explainer  # of the boosted trees
    background: DataFrame  # 100 rows of the design matrix


def prepare(raw: DataFrame) -> DataFrame:
    """Cleaning (P4) then the engineered ratios on all rows (M1), as the reference does."""
    return W.engineer_features(P.clean(raw))


def train(df: DataFrame, numeric=tuple(NUMERICAL_COLS), categorical=tuple(CATEGORICAL_COLS), label: str = LABEL,
          key: str = KEY, folds: int = 5, lr_axes: Mapping | None = None, gbt_axes: Mapping | None = None) -> Trained:
    """M8-M15 + E1-E6: stratified 80/20 split, preprocessing fitted on train, both models searched by mean
    cross-validated ROC-AUC (``lr_axes``, ``gbt_axes``: the axes of models.lr_grid and boosting.grid; the defaults are the
    reference's, for boosted trees 324 points, all grown in one pass), thresholds of best F1 on out-of-fold
    probabilities of the best ones, metrics on the holdout, the leaf paths that explain the trees, 100 background rows."""
    split = cut_lineage(M.stratified_split(df, label, [key], 0.2))
    train_df, test_df = split.where(~F.col("is_test")), split.where("is_test")
    prep = M.fit_prep(train_df, list(numeric), list(categorical))
    weighted = M.with_weights(prep.transform(train_df, eps=0.0), label)
    tr = cut_lineage(M.stratified_folds(weighted, label, [key], folds))
    te = cut_lineage(prep.transform(test_df))
    lr = M.logistic(label, weight="weight")
    lr_points = M.lr_grid(lr, float(tr.count()), **(lr_axes or {}))
    scores = M.grid_search(lr, lr_points, tr, label, "fold").avgMetrics if len(lr_points) > 1 else [0.0]
    linear = lr.copy(lr_points[max(range(len(lr_points)), key=lambda i: scores[i])])
    imbalance = M.class_weights(tr, label).first()["imbalance"] or 1.0  # one row a class
    points = BT.grid(**{"positive_weights": (1.0, *(f * imbalance for f in POSITIVE_FACTORS)), **(gbt_axes or {})})
    fit = BT.Boosting(tr, "features", label, [key], "fold").fit(points)
    best = fit.best() if len(points) > 1 else points[0]
    found = {"logistic_regression": (linear.fit(tr), M.out_of_fold(linear, tr, "fold", folds, "p_oof")),
             "boosted_trees": (fit.model(best), fit.out_of_fold(best))}
    models, thresholds, rows = {}, {}, None
    for name, (model, oof) in found.items():
        t = float(E.best_f1_threshold(oof, label, "p_oof").first()["threshold"])  # one row
        pred = M.positive_probability(model.transform(te), "p")
        row = (E.metrics_at_threshold(pred, label, "p", t)
               .crossJoin(E.roc_auc(pred, label, "p")).crossJoin(E.average_precision(pred, label, "p"))
               .select(F.lit(name).alias("model"), "*", F.lit(t).alias("selected_threshold")))
        rows = row if rows is None else rows.unionByName(row)
        models[name], thresholds[name] = model, t
    fit.close()
    background = P.seeded_sample(tr, [key], n=100, seed=42).select(key, label, "features")
    return Trained(prep, models, thresholds, rows, Explainer.of(models["boosted_trees"]), background)


def explain(df: DataFrame, trained: Trained, key: str = KEY) -> DataFrame:
    """Shapley values of the boosted trees' margin for each row, in the order of ``trained.prep.feature_names``."""
    return explain_rows(trained.prep.transform(W.scoring_features(df, mode="reference_table", reference_table=LEVEL_AVERAGES)), trained.explainer, "features", [key])


def predict_batch(df: DataFrame, trained: Trained, model: str = "boosted_trees", *, mode: str) -> DataFrame:
    """SC2: adds AttritionPrediction and AttritionRisk, keeping all input columns; ``mode`` as in score_batch."""
    return score_batch(df, trained.prep, trained.models[model], trained.thresholds[model], mode=mode,
                       reference_table=LEVEL_AVERAGES)


def save(spark: SparkSession, trained: Trained, path: str) -> None:
    """IO8: models, explainer, background rows, preprocessing and thresholds in one folder."""
    M.save_model(trained.models["logistic_regression"], f"{path}/models/logistic_regression")
    trained.models["boosted_trees"].save(spark, f"{path}/models/boosted_trees")
    trained.explainer.save(spark, f"{path}/explainer", trained.background)
    spark.createDataFrame(list(trained.thresholds.items()), "model string, threshold double").coalesce(1).write.mode("overwrite").json(f"{path}/thresholds")
    trained.metrics.coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")
    M.save_prep(spark, trained.prep, f"{path}/preprocessing")


def load(spark: SparkSession, path: str) -> Trained:
    """What save() wrote; FileNotFoundError if the preprocessing, the thresholds or a model is not there."""
    from riskspark.sources.io import optional_frame

    def need(part, reader):
        got = optional_frame(spark, f"{path}/{part}", reader)
        if got is None:
            raise FileNotFoundError(f"no {part} in {path}")
        return got

    prep = M.load_prep(spark, f"{path}/preprocessing")
    rows = need("thresholds", lambda p: spark.read.schema("model string, threshold double").json(p)).collect()  # one row a model
    kinds = {"logistic_regression": LogisticRegressionModel.load, "boosted_trees": lambda p: BT.BoostedTrees.load(spark, p)}
    models = {r.model: need(f"models/{r.model}", kinds[r.model]) for r in rows}
    return Trained(prep, models, {r.model: r.threshold for r in rows}, need("metrics", spark.read.parquet), *Explainer.load(spark, f"{path}/explainer"))


def predict_one(spark: SparkSession, record: Mapping, schema, trained: Trained, model: str = "boosted_trees") -> DataFrame:
    """SC1: one entity as a one-row table scored against the reference level averages; ratios that it brings stay."""
    return score_batch(spark.createDataFrame([dict(record)], schema), trained.prep, trained.models[model], trained.thresholds[model],
                       mode="reference_table", reference_table=LEVEL_AVERAGES, feature_kwargs={"keep_given": True})


def fairness_attributes():
    return [G.Attribute("gender", F.col("Gender"), protected="Female", reference="Male"),
            G.Attribute("age", P.two_way_band(F.col("Age"), 40, "Age_40_Plus", "Age_Under_40"),
                        protected="Age_40_Plus", reference="Age_Under_40")]


def audit_fairness(df: DataFrame, trained: Trained, model: str = "boosted_trees") -> tuple[DataFrame, DataFrame]:
    """The whole table scored, then groups and summary for gender and the 40+ age band."""
    scored = predict_batch(df, trained, model, mode="batch_mean")
    return G.audit(scored, LABEL, "AttritionPrediction", fairness_attributes())


def analyze_drift(reference: DataFrame, current: DataFrame, alpha: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """D3/D4 with the reference's feature lists (absent features are skipped)."""
    report = D.drift_report(reference, current, NUMERICAL_COLS, CATEGORICAL_COLS, alpha, method="exact")
    return report, D.drift_summary(report)


def simulate_drift(df: DataFrame, severity: float = 1.0) -> DataFrame:
    """D6 with the reference's four perturbations."""
    return D.perturb(df, [KEY], severity, seed=99, shift={"DistanceFromHome": 1}, cut=["MonthlyIncome"],
                     redraw=["JobSatisfaction"], flip={"OverTime": ("No", "Yes")}, exact=True)


def business_stats(df: DataFrame, exits: DataFrame | None = None) -> DataFrame:
    """B1: headcount, exits, rate, loss, top exit reason."""
    return B.business_stats(df, LABEL, 1, child=exits, reason="ExitReason")


def reports(employees: DataFrame, exits: DataFrame | None = None) -> dict[str, DataFrame]:
    """A1-A4 on the employee schema: rate by department and role, mean tenure and income by outcome,
    rate by work-life balance, and exit reasons by department for leavers (join)."""
    from riskspark.operators import aggregates as A

    out = {
        "rate_by_department_role": A.rate_by(employees, ["Department", "JobRole"], LABEL, 1,
                                             rate_name="AttritionRatePercent", count_name="Headcount"),
        "mean_by_outcome": A.mean_by(employees, LABEL, ["YearsAtCompany", "MonthlyIncome"],
                                     names=["AvgTenureYears", "AvgMonthlyIncome"]),
        "rate_by_work_life_balance": A.rate_count_by(employees, "WorkLifeBalance", LABEL, 1),
    }
    if exits is not None:
        out["exit_reasons_by_department"] = A.join_breakdown(
            employees.where(F.col(LABEL) == 1), exits, KEY, KEY, "Department", "ExitReason", "MonthlyIncome")
    return out
