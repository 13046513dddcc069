"""Queries of operators that are otherwise used inside workflows: engineered and scoring-time features, category lists of
any length, text forms, drifting features, samples, optional input. All read whole tables and have DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import exprs as X
from riskspark.operators import clean as P
from riskspark.operators import drift as D
from riskspark.operators import features as W
from riskspark.plans.queries import LINE_AVERAGES, _event_sides, r6, register
from riskspark.plans.tables import table
from riskspark.sources import io as IO

RATIOS = {"income": "l_extendedprice", "level": "l_linenumber", "role_years": "l_quantity", "company_years": "l_suppkey"}
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register("engineered_features")
def q_engineered_features(spark, sf):
    out = W.engineer_features(table(spark, sf, "lineitem"), **RATIOS)
    return r6(out.select(*LINE, "income_ratio_to_joblevel_avg", "role_tenure_ratio"))


@register("scoring_features")
def q_scoring_features(spark, sf):
    """The ratios of a batch, of fixed averages, without the level (a fixed level), and without any input (defaults)."""
    li = table(spark, sf, "lineitem")
    ways = {"batch": W.scoring_features(li, "batch_mean", **RATIOS),
            "table": W.scoring_features(li, "reference_table", LINE_AVERAGES, **RATIOS),
            "no level": W.scoring_features(li, "reference_table", LINE_AVERAGES, **{**RATIOS, "level": "absent"}),
            "none": W.scoring_features(li, "batch_mean", income="absent", level="absent", role_years="absent", company_years="absent")}
    out = None
    for way, rows in ways.items():
        one = rows.groupBy(F.lit(way).alias("way"), "l_linestatus").agg(
            F.count(F.lit(1)).alias("n"), F.avg("income_ratio_to_joblevel_avg").alias("income_ratio"), F.max("role_tenure_ratio").alias("max_tenure"))
        out = one if out is None else out.unionByName(one)
    return r6(out)


@register("onehot_indices")
def q_onehot_indices(spark, sf):
    """Places of the ones of every event, over all users and event types, and the number of places."""
    ev, cols = table(spark, sf, "events"), ["event_type", "user_id"]
    index, size = W.category_index(ev, cols)
    coded = W.one_hot_indices(ev.select("event_id", *cols), index, cols)
    return coded.select("event_id", F.array_join(F.col("indices").cast("array<string>"), ",").alias("places"), F.lit(size).cast("long").alias("width"))


@register("report_texts")
def q_report_texts(spark, sf):
    od = table(spark, sf, "orders")
    shares = X.normalise(F.array(F.col("o_totalprice"), F.col("o_custkey").cast("double"), F.lit(1.0)))
    return r6(od.select(
        "o_orderkey", X.dummy_name("prio", "o_orderpriority").alias("dummy"),
        X.second_part(F.concat(F.lit("cat__"), F.col("o_orderstatus"))).alias("part"),
        X.iso_date(F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")).alias("day"),
        X.pct_text(F.col("o_custkey") / 1000.0, 2).alias("pct"), X.money_text("o_totalprice").alias("money"), shares[0].alias("share")))


@register("drifting_features")
def q_drifting_features(spark, sf):
    ref, cur = _event_sides(spark, sf)
    report = D.drift_report(ref, cur, ["value", "user_id", "event_id"], ["event_type"])
    return D.drifting_features(report).select(F.posexplode("features").alias("place", "feature"))


@register("sample_facts")
def q_sample_facts(spark, sf):
    """Rows of a fixed-size sample, distinct ones, rows of it in the table, rows drawn again by the same seed; whether the
    share of a tenth lies within five standard deviations."""
    ev = table(spark, sf, "events")
    one, again = (P.seeded_sample(ev, ["event_id"], n=100, seed=7).select("event_id") for _ in range(2))
    tenth = P.seeded_sample(ev, ["event_id"], fraction=0.1, seed=7).agg(F.count(F.lit(1)).alias("k"))
    facts = one.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("n_distinct"))
    inside = one.join(ev, "event_id", "left_semi").agg(F.count(F.lit(1)).alias("n_inside"))
    same = one.join(again, "event_id", "left_semi").agg(F.count(F.lit(1)).alias("n_again"))
    whole = ev.agg(F.count(F.lit(1)).alias("m"))
    fair = F.abs(F.col("k") - 0.1 * F.col("m")) <= 5 * F.sqrt(0.09 * F.col("m"))
    return facts.crossJoin(inside).crossJoin(same).crossJoin(tenth).crossJoin(whole).select(  # one row each
        "n", "n_distinct", "n_inside", "n_again", fair.alias("tenth_is_fair"))


@register("optional_input")
def q_optional_input(spark, sf):
    """Rows read where the input exists, and of the default where it does not."""
    found = IO.optional_frame(spark, f"{sf.rstrip('/')}/supplier.parquet", spark.read.parquet, table(spark, sf, "part"))
    missing = IO.optional_frame(spark, f"{sf.rstrip('/')}/no-such-table.parquet", spark.read.parquet, table(spark, sf, "part"))
    named = [df.agg(F.lit(name).alias("input"), F.count(F.lit(1)).alias("n")) for name, df in (("given", found), ("default", missing))]
    return named[0].unionByName(named[1])
