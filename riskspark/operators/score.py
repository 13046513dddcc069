"""Batch scoring, risk tiers and the ranked view (SC1-SC4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.exprs import col_
from riskspark.operators import features as W

# The tier names and the medium-tier factor of the threshold.
HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"
MEDIUM_FACTOR = 0.5
PREDICTION_COL = "AttritionPrediction"
RISK_COL = "AttritionRisk"


def risk_tier(score: str | Column, threshold: float) -> Column:
    """SC3: >= t HIGH; >= 0.5 t MEDIUM; otherwise LOW (null score stays null)."""
    s = col_(score)
    return (F.when(s >= F.lit(threshold), F.lit(HIGH))
            .when(s >= F.lit(threshold * MEDIUM_FACTOR), F.lit(MEDIUM))
            .when(s.isNotNull(), F.lit(LOW)))


def ranked_view(df: DataFrame, cols: Sequence[str], score: str, tie_key: str, k: int | None = None) -> DataFrame:
    """SC4/W2: present columns, descending score (ties by key), with a rank column. With k, a top-k
    report (per-partition top-k then a merge, no global sort of the table)."""
    present = [c for c in cols if c in df.columns]
    ordered = df.select(*present).orderBy(F.desc(score), F.asc(tie_key))
    if k is not None:
        ordered = ordered.limit(int(k))
    from pyspark.sql import Window
    # at most k rows when k is given
    w = Window.orderBy(F.desc(score), F.asc(tie_key))
    return ordered.withColumn("rank", F.row_number().over(w)) if k is not None else ordered


def score_batch(df: DataFrame, prep, model, threshold: float, mode: str,
                reference_table: Mapping | None = None, feature_kwargs: Mapping | None = None) -> DataFrame:
    """SC1/SC2: features by batch mode (M2), schema completion (P9), scaling with the scoring-side
    epsilon (M4), one-hot (M6), model -> adds prediction (int) and risk (double); keeps every input
    column. ``mode`` is the caller's choice, whatever the size of the batch: ``batch_mean`` (the batch's own
    group means) or ``reference_table`` (fixed averages, so a row scores alike in any batch)."""
    if mode not in ("batch_mean", "reference_table"):
        raise ValueError(f"mode is batch_mean or reference_table, not {mode!r}")
    kw = dict(feature_kwargs or {})
    feats = W.scoring_features(df, mode=mode, reference_table=reference_table, **kw)
    x = prep.transform(feats, out="_features")
    pred = model.transform(x.withColumnRenamed("_features", "features"))
    from pyspark.ml.functions import vector_to_array
    p = vector_to_array(F.col("probability"))[1]
    keep = list(df.columns)
    return pred.select(*[F.col(c) for c in keep],
                       (p >= F.lit(float(threshold))).cast("int").alias(PREDICTION_COL),
                       p.alias(RISK_COL))
