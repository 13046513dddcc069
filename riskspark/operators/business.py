"""Business figures (B1-B10): turnover, exposure, ROI scenarios and the briefing's statistics,
re-aimed as column-parametric aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.exprs import flag, safe_div
from riskspark.operators.aggregates import top_value
from riskspark.operators.prefix import running_sums

# Cost per departure, intervention cost per flagged person, default success rate,
# the dashboard's assumed recall by targeted percentage (default 0.80).
REPLACEMENT_COST = 15000
INTERVENTION_UNIT_COST = 1500
DEFAULT_SUCCESS_RATE = 30
RECALL_BY_TARGET = {5: 0.35, 10: 0.55, 15: 0.70, 20: 0.80, 25: 0.85, 30: 0.90, 35: 0.93, 40: 0.95, 45: 0.97, 50: 0.98}
DEFAULT_RECALL = 0.80
DEFAULT_TOP_REASON = "Career Change"


def business_stats(df: DataFrame, label: str, positive=1, child: DataFrame | None = None,
                   reason: str | None = None, cost: float = REPLACEMENT_COST) -> DataFrame:
    """B1: headcount, exits, rate %, loss = exits x cost, avg_cost, top reason (A12; a default
    when the child table or column is absent, IO11)."""
    base = df.agg(F.count(F.lit(1)).alias("headcount"),
                  F.count_if(F.col(label) == F.lit(positive)).alias("exits"))
    base = base.select("headcount", "exits", (safe_div("exits", "headcount") * 100.0).alias("rate"),
                       (F.col("exits") * F.lit(cost)).cast("double").alias("loss"),
                       F.lit(float(cost)).alias("avg_cost"))
    if child is not None and reason is not None and reason in child.columns:
        top = top_value(child, reason).select(F.col("top_value").alias("top_reason"))
        return base.crossJoin(F.broadcast(top))  # both sides are one row
    return base.withColumn("top_reason", F.lit(DEFAULT_TOP_REASON))


def roi_scenarios(stats: DataFrame, targets: Sequence[int], success_rates: Sequence[float] = (DEFAULT_SUCCESS_RATE,),
                  recall: DataFrame | None = None, unit_cost: float = INTERVENTION_UNIT_COST) -> DataFrame:
    """Per (target %, success %) scenario: recall (from a measured table with columns
    target_pct, recall, e.g. ``capture_at_top``; else the assumed map, default 0.80), captured
    exits, retained, gross, flagged = int(N x / 100), cost, net, captured_int (B4)."""
    spark = stats.sparkSession
    scen = spark.createDataFrame([(int(t), float(s)) for t in targets for s in success_rates],
                                 "target_pct int, success_rate double")
    if recall is None:
        from riskspark.operators.features import lookup
        scen = scen.withColumn("recall", lookup("target_pct", RECALL_BY_TARGET, DEFAULT_RECALL))
    else:
        scen = scen.join(F.broadcast(recall.select("target_pct", "recall")), "target_pct", "left").withColumn(
            "recall", F.coalesce("recall", F.lit(DEFAULT_RECALL)))
    j = scen.crossJoin(F.broadcast(stats.select("headcount", "exits", "avg_cost")))  # one stats row
    captured = F.col("exits") * F.col("recall")
    retained = captured * F.col("success_rate") / 100.0
    gross = retained * F.col("avg_cost")
    flagged = F.floor(F.col("headcount") * (F.col("target_pct") / 100.0)).cast("long")
    cost = flagged * F.lit(float(unit_cost))
    return j.select("target_pct", "success_rate", "recall", captured.alias("captured"),
                    captured.cast("long").alias("captured_int"), retained.alias("retained"), gross.alias("gross"),
                    flagged.alias("flagged"), cost.alias("intervention_cost"), (gross - cost).alias("net"),
                    (F.col("exits") * F.col("avg_cost")).cast("double").alias("direct_loss"))


def roi_rows(scenarios: DataFrame) -> DataFrame:
    """Three chart rows per scenario: direct loss, gross savings, max(0, net)."""
    return scenarios.select("target_pct", "success_rate", F.expr(
        "stack(3, 'Direct Loss (No Action)', direct_loss, 'Gross Savings', gross, "
        "'Net Value Generated', greatest(0D, net)) as (metric, amount)"))


def relative_risk(df: DataFrame, label: str, exposed: Column, positive=1) -> DataFrame:
    """Rate among exposed / rate among unexposed, in one aggregate."""
    y = flag(F.col(label) == F.lit(positive))
    agg = df.agg(F.avg(F.when(exposed, y)).alias("rate_exposed"), F.avg(F.when(~exposed, y)).alias("rate_unexposed"),
                 F.count_if(exposed).alias("n_exposed"), F.count_if(~exposed).alias("n_unexposed"))
    return agg.withColumn("relative_risk", F.try_divide("rate_exposed", "rate_unexposed"))


def segment_rate(df: DataFrame, label: str, segment: Column, positive=1) -> DataFrame:
    """Rate in a segment against the overall rate, and the relative excess."""
    y = flag(F.col(label) == F.lit(positive))
    agg = df.agg(F.avg(F.when(segment, y)).alias("segment_rate"), F.avg(y).alias("overall_rate"),
                 F.count_if(segment).alias("segment_n"))
    return agg.withColumn("relative_excess", F.try_divide(F.col("segment_rate"), F.col("overall_rate")) - 1.0)


def pay_gap_by_level(df: DataFrame, label: str, level: str, pay: str, positive=1) -> DataFrame:
    """Mean pay of leavers vs stayers within each level and the relative gap."""
    p = F.col(pay).cast("double")
    is_pos = F.col(label) == F.lit(positive)
    agg = df.groupBy(level).agg(F.avg(F.when(is_pos, p)).alias("mean_pos"), F.avg(F.when(~is_pos, p)).alias("mean_neg"))
    return agg.withColumn("relative_gap", F.try_divide(F.col("mean_pos"), F.col("mean_neg")) - 1.0).orderBy(level)


def rate_by_band(df: DataFrame, label: str, value: str, edges: Sequence[float], names: Sequence[str],
                 positive=1) -> DataFrame:
    """Bands of ``value`` (``value < edge``, first match; the last name is the rest), then
    headcount, positives and rate % per band."""
    v = F.col(value)
    band = None
    for e, nm in zip(edges, names):
        band = F.when(v < F.lit(e), F.lit(nm)) if band is None else band.when(v < F.lit(e), F.lit(nm))
    band = band.when(v.isNotNull(), F.lit(names[-1])) if band is not None else F.lit(names[-1])
    is_pos = F.col(label) == F.lit(positive)
    return df.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("total"), F.count_if(is_pos).alias("positives"),
                                             F.round(F.avg(flag(is_pos)) * 100.0, 2).alias("rate_pct")).orderBy("band")


def bottom_quartile(df: DataFrame, level: str, pay: str) -> DataFrame:
    """Flag rows in the lowest 25% of their level's pay: ``percent_rank < 0.25`` within level, where
    percent_rank = (rows with lower pay) / (rows in level - 1) grows with pay. So (level, pay) counts and bucketed
    prefix sums (a level holding a third of all rows is still split) give one cut pay per level, and the rows are
    compared with it; they are not shuffled. A null pay is neither in nor out (null)."""
    p = F.col(pay).cast("double")
    counts = df.groupBy(level, p.alias("_pay")).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(counts, "_pay", ["_c"], part_cols=[level])
    lower = F.col("cum__c") - F.col("_c")
    low = F.when(F.col("tot__c") > 1, lower / (F.col("tot__c") - 1) < F.lit(0.25)).otherwise(F.lit(True))
    cuts = cum.where(low).groupBy(F.col(level).alias("_level")).agg(F.max("_pay").alias("_cut"))
    out = df.join(cuts, df[level].eqNullSafe(cuts["_level"]), "left")
    flag_ = F.when(p.isNotNull(), F.coalesce(p <= F.col("_cut"), F.lit(False)))
    return out.withColumn("bottom_quartile", flag_).drop("_level", "_cut")


def bottom_quartile_summary(flagged: DataFrame, level: str) -> DataFrame:
    """B10 report: rows and flagged rows per level."""
    return flagged.groupBy(level).agg(F.count(F.lit(1)).alias("n"),
                                      F.count_if("bottom_quartile").alias("bottom_quartile_n")).orderBy(level)
