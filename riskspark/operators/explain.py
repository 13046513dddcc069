"""Attribution and rule operators (X1-X5, X7). Tree Shapley values (X6) live in ``shapley.py``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# The reference's per-row contribution rules (employee schema) and its fallback.
BASELINE_NAME = "Baseline Factors"
BASELINE_VALUE = 0.02
LEVEL_AVERAGES = {1: 2800.0, 2: 5400.0, 3: 9800.0, 4: 15500.0, 5: 19100.0}
LEVEL_AVERAGE_DEFAULT = 5000.0


def employee_contribution_rules() -> list[tuple[Column, str, float]]:
    """The reference's signed contributions, in its order."""
    from riskspark.operators.features import lookup

    ratio = F.col("MonthlyIncome") / lookup("JobLevel", LEVEL_AVERAGES, LEVEL_AVERAGE_DEFAULT)
    return [
        (F.col("OverTime") == "Yes", "Working Overtime", 0.28),
        (F.col("OverTime") != "Yes", "No Overtime", -0.10),
        (F.col("JobSatisfaction") == 1, "Low Job Satisfaction", 0.18),
        (F.col("JobSatisfaction") == 4, "High Job Satisfaction", -0.12),
        (F.col("WorkLifeBalance") == 1, "Low Work-Life Balance", 0.15),
        (F.col("WorkLifeBalance") == 4, "High Work-Life Balance", -0.08),
        (ratio < 0.85, "Paid Below Peer Average", 0.16),
        (ratio > 1.15, "Paid Above Peer Average", -0.10),
        (F.col("YearsSinceLastPromotion") > 4, "Promotion Gap (>4 Yrs)", 0.12),
        (F.col("Age") < 30, "Younger Age Cohort (<30)", 0.08),
        (F.col("DistanceFromHome") > 15, "Long Commute (>15 miles)", 0.10),
    ]


def rule_contributions(df: DataFrame, rules: Sequence[tuple[Column, str, float]],
                       baseline: tuple[str, float] = (BASELINE_NAME, BASELINE_VALUE)) -> DataFrame:
    """Adds ``contributions`` array<struct<factor, value>>: the rules that fire, or the
    baseline entry when none does, sorted by absolute value ascending (S3; ties keep rule order).
    The rule values are constants, so the order is fixed when the plan is built: the rules are
    listed pre-sorted and the fired ones are filtered in place (no per-row sort)."""
    ordered = sorted(enumerate(rules), key=lambda t: (abs(t[1][2]), t[0]))
    items = [F.when(cond, F.struct(F.lit(name).alias("factor"), F.lit(float(v)).alias("value")))
             for _, (cond, name, v) in ordered]
    fired = F.filter(F.array(*items), lambda x: x.isNotNull())
    base = F.array(F.struct(F.lit(baseline[0]).alias("factor"), F.lit(float(baseline[1])).alias("value")))
    return df.withColumn("contributions", F.when(F.size(fired) > 0, fired).otherwise(base))


def rule_score(increments: Sequence[tuple[Column, float]], base: float = 0.05, cap: float = 0.95) -> Column:
    """min(cap, base + sum of the increments whose condition holds)."""
    total = F.lit(float(base))
    for cond, inc in increments:
        total = total + F.when(cond, F.lit(float(inc))).otherwise(F.lit(0.0))
    return F.least(F.lit(float(cap)), total)


def rule_distribution(df: DataFrame, categories: Sequence[str], boosts: Sequence[tuple[Column, str, float]],
                      base_weight: float | None = None) -> DataFrame:
    """Per row, weights base (1/k each) + boosts by rule, normalised (F14); the report is the
    expected share of each category over all rows: (category, expected_share, expected_count).
    One aggregate over k normalised weight columns (no per-row explode)."""
    k = len(categories)
    w0 = base_weight if base_weight is not None else 1.0 / k
    weights = []
    for cat in categories:
        w = F.lit(float(w0))
        for cond, target, inc in boosts:
            if target == cat:
                w = w + F.when(cond, F.lit(float(inc))).otherwise(F.lit(0.0))
        weights.append(w)
    wide = df.select(*[w.alias(f"_w{i}") for i, w in enumerate(weights)])
    total = sum((F.col(f"_w{i}") for i in range(1, k)), F.col("_w0"))
    norm = wide.select(*[(F.col(f"_w{i}") / total).alias(f"_p{i}") for i in range(k)])
    agg = norm.agg(*[F.avg(f"_p{i}").alias(f"a{i}") for i in range(k)], *[F.sum(f"_p{i}").alias(f"s{i}") for i in range(k)])
    rows = F.array(*[F.struct(F.lit(c).alias("category"), F.col(f"a{i}").alias("expected_share"),
                              F.col(f"s{i}").alias("expected_count")) for i, c in enumerate(categories)])
    return agg.select(F.inline(rows))


def tiered_assignment(branches: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """Nested condition chain -> category (first matching branch)."""
    out = None
    for cond, val in branches:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(default) if out is not None else default


def linear_shapley(df: DataFrame, features_col: str, coefficients: Sequence[float], means: Sequence[float],
                   names: Sequence[str]) -> DataFrame:
    """Exact Shapley values of a linear margin: beta_j * (x_j - mean_j), as an array column
    ``shap`` in ``names`` order, plus ``shap_sum`` (= margin(x) - margin(mean))."""
    from pyspark.ml.functions import vector_to_array

    x = vector_to_array(F.col(features_col))
    beta = F.array(*[F.lit(float(b)) for b in coefficients])
    mu = F.array(*[F.lit(float(m)) for m in means])
    shap = F.transform(x, lambda v, i: F.element_at(beta, i + 1) * (v - F.element_at(mu, i + 1)))
    return df.withColumn("shap", shap).withColumn("shap_sum", F.aggregate("shap", F.lit(0.0), lambda a, b: a + b))


def attribution_summary(df: DataFrame, shap_col: str, names: Sequence[str]) -> DataFrame:
    """Mean |contribution| by feature, ranked (feature, mean_abs, rank)."""
    n_arr = F.array(*[F.lit(n) for n in names])
    long = df.select(F.posexplode(shap_col).alias("i", "v")).select(
        F.element_at(n_arr, F.col("i") + 1).alias("feature"), F.abs("v").alias("a"))
    agg = long.groupBy("feature").agg(F.avg("a").alias("mean_abs"))
    # one row a feature: the window without partition is bounded by the feature list
    ranked = agg.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("mean_abs"), "feature")))
    return ranked.orderBy("rank")
