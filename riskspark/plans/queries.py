"""Registered queries over the driver tables: one per operator family of the survey (§7.3).

Each query takes (spark, sf_dir) and returns a lazy DataFrame over the whole tables. Doubles are
rounded (6 digits, 4 for large sums) so results compare across engines; ``plans/oracle.py`` holds
the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.exprs import round_all
from riskspark.operators import aggregates as A
from riskspark.operators import business as B
from riskspark.operators import clean as P
from riskspark.operators import drift as D
from riskspark.operators import evaluate as E
from riskspark.operators import explain as X
from riskspark.operators import fairness as G
from riskspark.operators import features as W
from riskspark.plans.tables import (EVENT_THRESHOLD, events_before_cut, events_labeled, lineitem_labeled,
                                    table)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    return round_all(df, 6)


# --- P: cleaning -----------------------------------------------------------------------------

@register("clean_lineitem")
def q_clean_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    c = P.clean(li, drop=["l_comment", "l_shipinstruct"], label="l_returnflag", mapping={"R": 1, "A": 0, "N": 0})
    return c.groupBy(F.col("l_returnflag").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@register("schema_completion")
def q_schema_completion(spark, sf):
    ev = P.select_present(table(spark, sf, "events"), ["event_id", "event_type", "value", "segment"])
    done = P.complete_schema(ev, numeric=["value", "discount_rate"], categorical=["event_type", "segment"])
    return P.conform(done, ["event_id", "event_type", "segment", "value", "discount_rate"])


@register("positional_split")
def q_positional_split(spark, sf):
    ev = table(spark, sf, "events")
    base, cur = P.positional_split(ev, "event_id", first_n=1000)
    tagged = base.withColumn("side", F.lit("baseline")).unionByName(cur.withColumn("side", F.lit("current")))
    return r6(tagged.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("min_id"),
                                         F.max("event_id").alias("max_id"), F.avg("value").alias("avg_value")))


@register("seeded_sample")
def q_seeded_sample(spark, sf):
    # a sampling operator: the row count is the feature
    return P.seeded_sample(table(spark, sf, "events"), ["event_id"], n=100, seed=42)


@register("seeded_fraction")
def q_seeded_fraction(spark, sf):
    return P.seeded_sample(table(spark, sf, "events"), ["event_id"], fraction=0.1, seed=42)


@register("table_shape")
def q_table_shape(spark, sf):
    return P.shape(table(spark, sf, "lineitem"))


@register("feature_head")
def q_feature_head(spark, sf):
    """The derived ratio columns of the first five lines by key (a head report: the limit is the feature)."""
    li = W.ratio_to_group_mean(table(spark, sf, "lineitem"), "l_extendedprice", "l_linenumber", "price_ratio")
    li = W.offset_ratio(li, "l_quantity", "l_linenumber", "qty_ratio", 1.0)
    return r6(li.select("l_orderkey", "l_linenumber", "l_partkey", "price_ratio", "qty_ratio")
              .orderBy("l_orderkey", "l_linenumber", "l_partkey", "price_ratio").limit(5))


@register("flagged_count")
def q_flagged_count(spark, sf):
    return r6(A.flagged_count(events_labeled(spark, sf).withColumn("flag", F.col("yhat") == 1), "flag"))


@register("domain_violations")
def q_domain_violations(spark, sf):
    li = P.validate_domains(table(spark, sf, "lineitem"),
                            ranges={"l_quantity": (1, 45), "l_discount": (0.0, 0.08), "l_tax": (0.0, 0.06)})
    od = P.validate_domains(table(spark, sf, "orders"), allowed={"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]})
    return (P.violation_counts(li).withColumn("tbl", F.lit("lineitem"))
            .unionByName(P.violation_counts(od).withColumn("tbl", F.lit("orders"))))


# --- A: aggregates ---------------------------------------------------------------------------

@register("rate_by_two_keys")
def q_rate_by_two_keys(spark, sf):
    li, od = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")  # broadcast or sort-merge: the planner decides by size
    return A.rate_by(j, ["o_orderpriority", "l_linestatus"], "l_returnflag", positive="R")


@register("mean_by_outcome")
def q_mean_by_outcome(spark, sf):
    return A.mean_by(lineitem_labeled(spark, sf), "label", ["l_quantity", "l_extendedprice"],
                     names=["avg_quantity", "avg_price"])


@register("rate_count_by_key")
def q_rate_count_by_key(spark, sf):
    return A.rate_count_by(table(spark, sf, "lineitem"), "l_linenumber", "l_returnflag", positive="R")


@register("join_breakdown")
def q_join_breakdown(spark, sf):
    cu, od = table(spark, sf, "customer"), table(spark, sf, "orders")
    return A.join_breakdown(cu, od, "c_custkey", "o_custkey", "c_mktsegment", "o_orderpriority", "c_acctbal",
                            child_filter=F.col("o_orderstatus") == "F")


@register("overall_rate")
def q_overall_rate(spark, sf):
    return r6(A.overall_rate(events_labeled(spark, sf), "y"))


@register("rate_by_group")
def q_rate_by_group(spark, sf):
    return r6(A.rate_by_group(events_labeled(spark, sf), F.hour("ts"), "y"))


@register("quartiles_by_outcome")
def q_quartiles_by_outcome(spark, sf):
    return r6(A.quartiles_by(lineitem_labeled(spark, sf), "label", "l_extendedprice"))


@register("histogram_by_class")
def q_histogram_by_class(spark, sf):
    return r6(A.histogram_by_class(events_labeled(spark, sf), "value", "y", 0.0, 500.0, 20))


@register("density_by_class")
def q_density_by_class(spark, sf):
    return r6(A.density_by_class(events_labeled(spark, sf), "value", "y", 0.0, 500.0, grid=50, pre_bins=1000))


@register("value_counts")
def q_value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "orders"), "o_orderpriority")


@register("top_value")
def q_top_value(spark, sf):
    return A.top_value(table(spark, sf, "orders"), "o_orderpriority")


@register("mean_risk_by_group")
def q_mean_risk_by_group(spark, sf):
    ev = table(spark, sf, "events").withColumn("score", F.col("value") / 100.0)
    return r6(A.mean_by_group(ev, "event_type", "score", "mean_risk"))


@register("class_counts")
def q_class_counts(spark, sf):
    return A.class_counts(table(spark, sf, "labels"), "quality")


# --- W/F/J: features -------------------------------------------------------------------------

@register("ratio_to_group_mean")
def q_ratio_to_group_mean(spark, sf):
    li = W.ratio_to_group_mean(table(spark, sf, "lineitem"), "l_extendedprice", "l_linenumber", "ratio")
    return round_all(li.agg(F.count(F.lit(1)).alias("n"), F.sum("ratio").alias("sum_ratio"),
                            F.max("ratio").alias("max_ratio"), F.min("ratio").alias("min_ratio")), 4)


@register("tenure_ratio")
def q_tenure_ratio(spark, sf):
    li = W.offset_ratio(table(spark, sf, "lineitem"), "l_quantity", "l_linenumber", "ratio", 1.0)
    return round_all(li.agg(F.count(F.lit(1)).alias("n"), F.sum("ratio").alias("sum_ratio"),
                            F.max("ratio").alias("max_ratio"), F.min("ratio").alias("min_ratio")), 4)


# Fixed values for the lookup query: a reference average per line number (6 and 7 take the default).
LINE_AVERAGES = {1: 20000.0, 2: 30000.0, 3: 40000.0, 4: 50000.0, 5: 60000.0}


@register("lookup_ratio")
def q_lookup_ratio(spark, sf):
    li = W.lookup_ratio(table(spark, sf, "lineitem"), "l_extendedprice", "l_linenumber", LINE_AVERAGES, "ratio")
    return r6(li.groupBy(W.pay_band_flag("ratio").alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("ratio").alias("avg_ratio")))


# --- M3-M11: preprocessing and splits ----------------------------------------------------------

@register("scale_fit")
def q_scale_fit(spark, sf):
    return r6(W.fit_scaler(table(spark, sf, "part"), ["p_size", "p_retailprice"]))


@register("scale_apply")
def q_scale_apply(spark, sf):
    part = table(spark, sf, "part")
    params = W.ScalerParams.from_table(W.fit_scaler(part, ["p_size", "p_retailprice"]))
    out = W.apply_scaler(part, params, suffix="_scaled")
    return r6(out.select("p_partkey", "p_size_scaled", "p_retailprice_scaled"))


@register("onehot_apply")
def q_onehot_apply(spark, sf):
    od = table(spark, sf, "orders")
    cats = W.collect_categories(W.fit_one_hot(od, ["o_orderpriority", "o_orderstatus"]))
    names = W.one_hot_names(cats, ["o_orderpriority", "o_orderstatus"])
    enc = W.apply_one_hot(od, cats, ["o_orderpriority", "o_orderstatus"])
    sums = enc.agg(*[F.sum(n).alias(n) for n in names])
    return sums.unpivot([], names, "dummy", "ones")


@register("stratified_split")
def q_stratified_split(spark, sf):
    from riskspark.operators.models import stratified_split
    tagged = stratified_split(table(spark, sf, "labels"), "quality", ["doc_id"], test_fraction=0.2)
    return tagged.groupBy(F.col("quality").alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("n_test"), F.count_if(~F.col("is_test")).alias("n_train"))


@register("kfold_sizes")
def q_kfold_sizes(spark, sf):
    from riskspark.operators.models import stratified_folds
    f = stratified_folds(table(spark, sf, "labels"), "quality", ["doc_id"], k=5)
    return f.groupBy(F.col("quality").alias("class"), "fold").agg(F.count(F.lit(1)).alias("n"))


@register("class_weights")
def q_class_weights(spark, sf):
    from riskspark.operators.models import class_weights
    return r6(class_weights(table(spark, sf, "labels"), "quality"))


# --- E: evaluation ---------------------------------------------------------------------------

@register("metrics_at_threshold")
def q_metrics_at_threshold(spark, sf):
    return r6(E.metrics_at_threshold(events_labeled(spark, sf), "y", "value", EVENT_THRESHOLD))


@register("class_report")
def q_class_report(spark, sf):
    return r6(E.class_report(events_labeled(spark, sf), "y", "yhat"))


@register("roc_auc")
def q_roc_auc(spark, sf):
    return r6(E.roc_auc(events_labeled(spark, sf), "y", "value"))


@register("avg_precision")
def q_avg_precision(spark, sf):
    return r6(E.average_precision(events_labeled(spark, sf), "y", "value"))


@register("pr_curve")
def q_pr_curve(spark, sf):
    return r6(E.pr_curve(events_labeled(spark, sf), "y", "value"))


@register("best_threshold")
def q_best_threshold(spark, sf):
    return r6(E.best_f1_threshold(events_labeled(spark, sf), "y", "value"))


@register("lift_gains")
def q_lift_gains(spark, sf):
    return r6(E.lift_gains(events_labeled(spark, sf), "y", "value", bins=10))


@register("capture_topx")
def q_capture_topx(spark, sf):
    return r6(E.capture_at_top(events_labeled(spark, sf), "y", "value", "event_id", [5, 10, 20]))


@register("metric_table_long")
def q_metric_table_long(spark, sf):
    ev = events_labeled(spark, sf)
    wide = None
    for t in (25, 50, 75):
        m = E.metrics_at_threshold(ev, "y", "value", float(t)).select(F.lit(f"t{t}").alias("model"), "*")
        wide = m if wide is None else wide.unionByName(m)
    return r6(E.metrics_long(wide))


# --- SC: scoring views -------------------------------------------------------------------------

@register("risk_tier")
def q_risk_tier(spark, sf):
    from riskspark.operators.score import risk_tier
    ev = table(spark, sf, "events").withColumn("score", F.col("value") / 100.0)
    return r6(ev.withColumn("tier", risk_tier("score", 0.5)).groupBy("tier").agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("avg_score")))


@register("ranked_scores")
def q_ranked_scores(spark, sf):
    from riskspark.operators.score import ranked_view
    ev = table(spark, sf, "events").withColumn("score", F.col("value") / 100.0)
    # a top-k report: the limit is the feature
    return r6(ranked_view(ev, ["event_id", "user_id", "event_type", "score"], "score", "event_id", k=20))


# --- X: rules ----------------------------------------------------------------------------------

def lineitem_rules():
    """Signed contributions on lineitem columns (the X1 operator with a rule list of this table)."""
    return [
        (F.col("l_returnflag") == "R", "Returned", 0.28),
        (F.col("l_discount") >= 0.08, "High Discount", 0.18),
        (F.col("l_discount") == 0.0, "No Discount", -0.12),
        (F.col("l_quantity") > 45, "Large Quantity", 0.15),
        (F.col("l_quantity") < 5, "Small Quantity", -0.08),
        (F.col("l_tax") > 0.06, "High Tax", 0.10),
        (F.col("l_linenumber") >= 6, "Late Line", 0.10),
    ]


@register("rule_contributions")
def q_rule_contributions(spark, sf):
    li = X.rule_contributions(table(spark, sf, "lineitem"), lineitem_rules())
    long = li.select(F.posexplode("contributions").alias("rank", "c")).select("rank", "c.factor", "c.value")
    return r6(long.groupBy("factor", "rank").agg(F.count(F.lit(1)).alias("n")))


@register("rule_score")
def q_rule_score(spark, sf):
    inc = [(F.col("l_returnflag") == "R", 0.25), (F.col("l_discount") >= 0.08, 0.20), (F.col("l_quantity") > 45, 0.15),
           (F.col("l_tax") > 0.06, 0.10), (F.col("l_linenumber") >= 6, 0.15), (F.col("l_linestatus") == "O", 0.08),
           (F.col("l_quantity") < 10, 0.08)]
    li = table(spark, sf, "lineitem").withColumn("score", X.rule_score(inc, base=0.05, cap=0.95))
    return r6(li.groupBy(F.round("score", 6).alias("score")).agg(F.count(F.lit(1)).alias("n")))


# The eight categories of the X3 distribution.
REASONS = ["Career Change", "Compensation & Benefits", "Workplace Culture", "Lack of Career Growth",
           "Work-Life Balance", "Relocation", "Retirement", "Personal Reasons"]


def lineitem_reason_boosts():
    return [
        ((F.col("l_linestatus") == "O") | (F.col("l_quantity") < 5), "Work-Life Balance", 0.4),
        (F.col("l_extendedprice") < 20000, "Compensation & Benefits", 0.4),
        (F.col("l_linenumber") > 4, "Lack of Career Growth", 0.4),
        (F.col("l_discount") == 0.0, "Workplace Culture", 0.4),
    ]


@register("rule_distribution")
def q_rule_distribution(spark, sf):
    out = X.rule_distribution(table(spark, sf, "lineitem"), REASONS, lineitem_reason_boosts(), base_weight=0.125)
    return round_all(out, 4)


@register("tier_assignment")
def q_tier_assignment(spark, sf):
    li = table(spark, sf, "lineitem")
    flag_, lvl = F.col("l_returnflag"), F.col("l_linenumber")
    role = X.tiered_assignment([
        (flag_ == "A", F.lit("Audit")),
        ((flag_ == "R") & (lvl >= 4), F.lit("Return Manager")),
        ((flag_ == "R") & (lvl == 3), F.lit("Return Executive")),
        (flag_ == "R", F.lit("Return Representative")),
        (lvl >= 4, F.when(F.col("l_quantity") > 25, F.lit("Senior")).otherwise(F.lit("Director"))),
        (lvl == 3, F.lit("Specialist")),
    ], F.lit("Associate"))
    band_low = W.lookup("l_linenumber", {1: 2000, 2: 3500, 3: 6000, 4: 10000, 5: 15000}, 0)
    return li.groupBy(role.alias("role"), band_low.alias("band_low")).agg(F.count(F.lit(1)).alias("n"))


# --- G: fairness -------------------------------------------------------------------------------

def event_attributes():
    return [
        G.Attribute("user_parity", F.when(F.col("user_id") % 2 == 0, "even").when(F.col("user_id") % 2 == 1, "odd"),
                    protected="even", reference="odd"),
        G.Attribute("hour_band", P.two_way_band(F.hour("ts"), 12, "pm", "am"), protected="pm", reference="am"),
    ]


@register("fairness_groups")
def q_fairness_groups(spark, sf):
    return r6(G.audit_groups(events_labeled(spark, sf), "y", "yhat", event_attributes()))


@register("fairness_audit")
def q_fairness_audit(spark, sf):
    attrs = event_attributes()
    groups = G.audit_groups(events_labeled(spark, sf), "y", "yhat", attrs)
    return r6(G.audit_summary(groups, attrs))


@register("fairness_docs")
def q_fairness_docs(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    j = labels.join(docs.select("doc_id", "lang", "n_chars"), "doc_id", "inner").withColumn(
        "pred", (F.col("n_chars") >= 2000).cast("int"))
    attrs = [G.Attribute("lang", F.col("lang"), protected="de", reference="en")]
    groups = G.audit_groups(j, "quality", "pred", attrs)
    return r6(groups.join(G.audit_summary(groups, attrs), "attribute"))


@register("parity_table")
def q_parity_table(spark, sf):
    return r6(G.parity_table(G.audit_groups(events_labeled(spark, sf), "y", "yhat", event_attributes())))


# --- D: drift ----------------------------------------------------------------------------------

def _event_sides(spark, sf):
    ev = table(spark, sf, "events")
    return ev.where(events_before_cut()), ev.where(~events_before_cut())


@register("drift_ks")
def q_drift_ks(spark, sf):
    ref, cur = _event_sides(spark, sf)
    return r6(D.ks_from_tagged(D.tag_sides(ref, cur, ["value", "user_id"]), ["value", "user_id"]))


@register("drift_chi2")
def q_drift_chi2(spark, sf):
    ref, cur = _event_sides(spark, sf)
    return r6(D.drift_chi2(ref, cur, ["event_type"]))


@register("drift_report")
def q_drift_report(spark, sf):
    ref, cur = _event_sides(spark, sf)
    return r6(D.drift_report(ref, cur, ["value", "user_id", "event_id"], ["event_type"]))


@register("drift_summary")
def q_drift_summary(spark, sf):
    ref, cur = _event_sides(spark, sf)
    return r6(D.drift_summary(D.drift_report(ref, cur, ["value", "user_id", "event_id"], ["event_type"])))


@register("drift_by_period")
def q_drift_by_period(spark, sf):
    od = table(spark, sf, "orders")
    base = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    out = D.drift_by_period(od, "o_orderdate", base, ["o_totalprice"], ["o_orderpriority"], unit="year")
    return r6(out.select(F.year("period").alias("year"), "feature", "type", "statistic"))


@register("perturb")
def q_perturb(spark, sf):
    li = D.perturb(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], severity=1.0,
                   shift={"l_linenumber": 1}, cut=["l_extendedprice"])
    return li.agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("sum_linenumber"),
                  F.sum("l_extendedprice").alias("sum_price_cut"))


@register("perturb_fraction")
def q_perturb_fraction(spark, sf):
    ev = table(spark, sf, "events").withColumn("sat", (F.col("user_id") % 4 + 1).cast("int"))
    out = D.perturb(ev, ["event_id"], severity=1.0, redraw=["sat"], flip={"event_type": ("view", "click")})
    return out.groupBy("event_type", "sat").agg(F.count(F.lit(1)).alias("n"))


@register("perturb_exact")
def q_perturb_exact(spark, sf):
    """D6 with exact counts: 40% of 'view' events (rounded) become 'click'."""
    ev = table(spark, sf, "events")
    out = D.perturb(ev, ["event_id"], severity=1.0, flip={"event_type": ("view", "click")}, exact=True)
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


# --- B: business -------------------------------------------------------------------------------

@register("relative_risk")
def q_relative_risk(spark, sf):
    return r6(B.relative_risk(table(spark, sf, "lineitem"), "l_returnflag", F.col("l_discount") >= 0.05, positive="R"))


@register("segment_rate")
def q_segment_rate(spark, sf):
    seg = (F.col("l_quantity") > 40) & (F.col("l_tax") < 0.02)
    return r6(B.segment_rate(table(spark, sf, "lineitem"), "l_returnflag", seg, positive="R"))


@register("pay_gap_by_level")
def q_pay_gap_by_level(spark, sf):
    return r6(B.pay_gap_by_level(table(spark, sf, "lineitem"), "l_returnflag", "l_linenumber", "l_extendedprice",
                                 positive="R"))


@register("rate_by_band")
def q_rate_by_band(spark, sf):
    return B.rate_by_band(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity", [10, 25], ["a_0_9", "b_10_24", "c_25_up"],
                          positive="R")


@register("bottom_quartile")
def q_bottom_quartile(spark, sf):
    flagged = B.bottom_quartile(table(spark, sf, "lineitem"), "l_linenumber", "l_extendedprice")
    return B.bottom_quartile_summary(flagged, "l_linenumber")


def _customer_stats(spark, sf):
    cu = table(spark, sf, "customer").withColumn("churned", (F.col("c_acctbal") < 0).cast("int"))
    return B.business_stats(cu, "churned", 1, child=table(spark, sf, "orders"), reason="o_orderpriority")


@register("business_stats")
def q_business_stats(spark, sf):
    return r6(_customer_stats(spark, sf))


@register("roi_scenarios")
def q_roi_scenarios(spark, sf):
    return r6(B.roi_scenarios(_customer_stats(spark, sf), [5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 60], [30.0, 50.0]))


@register("roi_rows")
def q_roi_rows(spark, sf):
    return r6(B.roi_rows(B.roi_scenarios(_customer_stats(spark, sf), [10, 20, 30], [30.0])))


def all_queries() -> dict[str, Query]:
    from riskspark.plans import ml_queries  # noqa: F401  (registers the model queries)
    from riskspark.plans import io_queries  # noqa: F401
    from riskspark.plans import fact_queries  # noqa: F401
    return dict(QUERIES)
