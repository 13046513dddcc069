"""Group-fairness audit (G1-G6): selection rate, TPR, FPR per group, impact ratio, four-fifths
flag and FPR gap. All attributes are audited in one pass: each row is exploded into one
(attribute, group) pair per attribute, then a single grouped aggregate serves every attribute."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.exprs import in_band, safe_div

# The four-fifths band.
FOUR_FIFTHS_LOW = 0.80
FOUR_FIFTHS_HIGH = 1.25


@dataclass
class Attribute:
    """A protected attribute: a name, a group expression, and which group is compared to which
    (impact ratio = selection(protected) / selection(reference))."""
    name: str
    group: Column
    protected: str
    reference: str


def _group_aggs(y_true: str, y_pred: str) -> list[Column]:
    y, p = F.col(y_true).cast("int"), F.col(y_pred).cast("int")
    return [
        F.count(F.lit(1)).alias("count"),
        F.count_if(p == 1).alias("flagged"),
        F.count_if((y == 1) & (p == 1)).alias("_tp"),
        F.count_if((y == 1) & (p == 0)).alias("_fn"),
        F.count_if((y == 0) & (p == 1)).alias("_fp"),
        F.count_if((y == 0) & (p == 0)).alias("_tn"),
    ]


def _rates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(
        *keys, "count", "flagged",
        safe_div("flagged", "count").alias("selection_rate"),
        safe_div(F.col("_tp"), F.col("_tp") + F.col("_fn")).alias("tpr"),
        safe_div(F.col("_fp"), F.col("_fp") + F.col("_tn")).alias("fpr"),
    )


def group_metrics(df: DataFrame, y_true: str, y_pred: str, groups: Sequence[str]) -> DataFrame:
    """G1: count, flagged, selection rate, TPR, FPR per group; 0.0 on empty denominators."""
    return _rates(df.groupBy(*groups).agg(*_group_aggs(y_true, y_pred)), list(groups))


def audit_groups(df: DataFrame, y_true: str, y_pred: str, attributes: Sequence[Attribute]) -> DataFrame:
    """G1 over several attributes in one shuffle: (attribute, group, count, flagged, selection_rate,
    tpr, fpr). Rows whose group expression is null are in no group (P7)."""
    pairs = F.array(*[F.struct(F.lit(a.name).alias("attribute"), a.group.cast("string").alias("group"))
                      for a in attributes])
    long = df.select(F.col(y_true).alias("_y"), F.col(y_pred).alias("_p"), F.explode(pairs).alias("_ag"))
    long = long.select("_y", "_p", "_ag.attribute", "_ag.group").where(F.col("group").isNotNull())
    return group_metrics(long, "_y", "_p", ["attribute", "group"])


def audit_summary(groups: DataFrame, attributes: Sequence[Attribute]) -> DataFrame:
    """Impact ratio (0 when the reference rate is 0), four-fifths flag, FPR gap, per attribute.
    Works on the small per-group table: conditional aggregates, no pivot of the data."""
    spec = F.array(*[F.struct(F.lit(a.name).alias("attribute"), F.lit(a.protected).alias("protected"),
                              F.lit(a.reference).alias("reference")) for a in attributes])
    roles = groups.sparkSession.range(1).select(F.inline(spec))
    j = groups.join(F.broadcast(roles), "attribute")
    agg = j.groupBy("attribute").agg(
        F.max(F.when(F.col("group") == F.col("protected"), F.col("selection_rate"))).alias("_sp"),
        F.max(F.when(F.col("group") == F.col("reference"), F.col("selection_rate"))).alias("_sr"),
        F.max(F.when(F.col("group") == F.col("protected"), F.col("fpr"))).alias("_fp"),
        F.max(F.when(F.col("group") == F.col("reference"), F.col("fpr"))).alias("_fr"),
    )
    sp, sr = F.coalesce(F.col("_sp"), F.lit(0.0)), F.coalesce(F.col("_sr"), F.lit(0.0))
    ratio = F.when(sr > 0, sp / sr).otherwise(F.lit(0.0))
    fp, fr = F.coalesce(F.col("_fp"), F.lit(0.0)), F.coalesce(F.col("_fr"), F.lit(0.0))
    return agg.select(
        "attribute",
        ratio.alias("disparate_impact_ratio"),
        F.abs(fp - fr).alias("fpr_difference"),
        in_band(ratio, FOUR_FIFTHS_LOW, FOUR_FIFTHS_HIGH).alias("compliant_four_fifths"),
    )


def audit(df: DataFrame, y_true: str, y_pred: str, attributes: Sequence[Attribute]) -> tuple[DataFrame, DataFrame]:
    """The per-group table and the per-attribute summary."""
    groups = audit_groups(df, y_true, y_pred, attributes)
    return groups, audit_summary(groups, attributes)


def parity_table(groups: DataFrame) -> DataFrame:
    """Selection % and FPR % by group, for the parity chart."""
    return groups.select("attribute", "group", (F.col("selection_rate") * 100).alias("selection_pct"),
                         (F.col("fpr") * 100).alias("fpr_pct"))
