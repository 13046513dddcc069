"""Grouped reports (A1-A16). Every aggregate is a partial (map-side) + final hash aggregate."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.exprs import col_, flag, rate_pct, safe_div


def _pos(label: str | Column, positive=1) -> Column:
    return col_(label) == F.lit(positive)


def rate_by(df: DataFrame, keys: Sequence[str], label: str, positive=1, digits: int = 2,
            rate_name: str = "rate_pct", count_name: str = "n") -> DataFrame:
    """A1: ROUND(AVG(CASE WHEN label = positive THEN 1 ELSE 0) * 100, 2) and COUNT(*) by keys,
    ordered by rate desc (ties by the keys, to make the order total)."""
    out = df.groupBy(*keys).agg(rate_pct(_pos(label, positive), digits).alias(rate_name),
                                F.count(F.lit(1)).alias(count_name))
    return out.orderBy(F.desc(rate_name), *keys)


def rate_by_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, keys: Sequence[str], label: str,
                 positive=1, digits: int = 2, rate_name: str = "rate_pct", count_name: str = "n") -> DataFrame:
    """A1 over a fact-dimension join with eager aggregation: the fact side is first reduced to
    (join key, its grouping keys) with positive and row counts, then joined and summed. Same
    result as ``rate_by(fact JOIN dim)``. It pays off only when many fact rows share a key and the
    input is clustered by it; measured slower than the planner's own join on the driver tables,
    so the registered query uses the plain join."""
    fact_keys = [k for k in keys if k in fact.columns and k not in dim.columns]
    dim_keys = [k for k in keys if k not in fact_keys]
    pre = fact.groupBy(fact_key, *fact_keys).agg(F.count_if(_pos(label, positive)).alias("_pos"),
                                                 F.count(F.lit(1)).alias("_n"))
    j = pre.join(dim.select(dim_key, *dim_keys), pre[fact_key] == dim[dim_key], "inner")
    out = j.groupBy(*keys).agg(F.sum("_pos").alias("_p"), F.sum("_n").alias(count_name))
    return (out.select(*keys, F.round(F.col("_p") / F.col(count_name) * 100.0, digits).alias(rate_name), count_name)
            .orderBy(F.desc(rate_name), *keys))


def mean_by(df: DataFrame, label: str, cols: Sequence[str], digits: int = 2,
            names: Sequence[str] | None = None) -> DataFrame:
    """A2: ROUND(AVG(c), 2) for each column by the label."""
    names = list(names) if names else [f"avg_{c}" for c in cols]
    return df.groupBy(label).agg(*[F.round(F.avg(F.col(c).cast("double")), digits).alias(n)
                                   for c, n in zip(cols, names)])


def rate_count_by(df: DataFrame, key: str, label: str, positive=1, digits: int = 2) -> DataFrame:
    """A3: headcount, SUM(label = positive), rate % by one key, ordered by key."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("total"),
                                F.count_if(_pos(label, positive)).alias("positives"),
                                rate_pct(_pos(label, positive), digits).alias("rate_pct"))
            .orderBy(key))


def join_breakdown(parent: DataFrame, child: DataFrame, parent_on: str, child_on: str, parent_key: str,
                   child_key: str, value: str, label: str | None = None, positive=1, digits: int = 2,
                   child_filter: Column | None = None, pre_aggregate: bool = False) -> DataFrame:
    """A4 (J1 + P6): inner join, outcome filter (pushed below the join), count and mean of a parent
    value by (parent attribute, child reason), ordered by attribute then count desc.

    By default the join is left to the planner (broadcast or sort-merge by size). With
    ``pre_aggregate`` the child is first reduced to (join key, reason) counts and the mean is
    count-weighted: fewer rows reach the join when a parent has many child rows per reason and
    the input is clustered by the key (it adds an aggregation stage otherwise)."""
    p = parent if label is None else parent.where(_pos(label, positive))
    c = child if child_filter is None else child.where(child_filter)
    v = F.col(value).cast("double")
    if not pre_aggregate:
        j = p.join(c, p[parent_on] == c[child_on], "inner")
        return (j.groupBy(parent_key, child_key)
                .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(v), digits).alias("avg_value"))
                .orderBy(parent_key, F.desc("n"), child_key))
    pre = c.groupBy(F.col(child_on).alias("_ck"), F.col(child_key).alias(child_key)).agg(F.count(F.lit(1)).alias("_c"))
    j = p.select(parent_on, parent_key, v.alias("_v")).join(pre, F.col(parent_on) == F.col("_ck"), "inner")
    return (j.groupBy(parent_key, child_key)
            .agg(F.sum("_c").alias("n"), F.round(F.sum(F.col("_v") * F.col("_c")) / F.sum("_c"), digits).alias("avg_value"))
            .orderBy(parent_key, F.desc("n"), child_key))


def overall_rate(df: DataFrame, label: str, positive=1) -> DataFrame:
    """A5: headcount, positives, mean of the 0/1 label and the rate in %."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(_pos(label, positive)).alias("positives"),
                  F.avg(flag(_pos(label, positive))).alias("rate")).withColumn("rate_pct", F.col("rate") * 100.0)


def rate_by_group(df: DataFrame, key: str | Column, label: str, positive=1, z: float = 1.96,
                  key_name: str = "grp") -> DataFrame:
    """Mean label by one key, with count and a normal-approximation interval (bar chart
    with error bars), ordered by rate desc."""
    k = col_(key).alias(key_name)
    out = df.groupBy(k).agg(F.avg(flag(_pos(label, positive))).alias("rate"), F.count(F.lit(1)).alias("n"))
    half = F.lit(z) * F.sqrt(F.col("rate") * (1 - F.col("rate")) / F.col("n"))
    return out.withColumns({"ci_low": F.col("rate") - half, "ci_high": F.col("rate") + half}).orderBy(
        F.desc("rate"), key_name)


def exact_quantiles(df: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (position p * (n - 1), like ``percentile`` and
    DuckDB's ``quantile_cont``) without holding a group's values in one task: distinct values per
    group with counts, bucketed prefix counts, then the values at ranks floor/ceil of the position.
    Returns (group, q0, q1, ...) in the order of ``probs``."""
    from riskspark.operators.prefix import running_sums

    v = F.col(value).cast("double")
    counts = df.where(v.isNotNull()).groupBy(group, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(counts, "_v", ["_c"], part_cols=[group])
    # rows with 0-based ranks [cum - c, cum - 1] hold value _v
    lo_rank = F.col("cum__c") - F.col("_c")
    hi_rank = F.col("cum__c") - 1
    aggs = []
    for i, p in enumerate(probs):
        pos = F.lit(float(p)) * (F.col("tot__c") - 1)
        r0, r1 = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when((lo_rank <= r0) & (r0 <= hi_rank), F.col("_v"))).alias(f"_a{i}"),
                 F.max(F.when((lo_rank <= r1) & (r1 <= hi_rank), F.col("_v"))).alias(f"_b{i}"),
                 F.first(pos - r0).alias(f"_f{i}")]
    q = cum.groupBy(group).agg(*aggs)
    return q.select(group, *[(F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.col(f"_f{i}")).alias(f"q{i}")
                             for i in range(len(probs))])


def quartiles_by(df: DataFrame, label: str, value: str, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """Box-plot summary by outcome: q1, median, q3, 1.5*IQR whiskers (clipped to data) and
    outlier count. Exact quantiles through prefix counts (scales with a hot group), or
    ``percentile_approx``. Whiskers and outliers come from the distinct values and their counts."""
    v = F.col(value).cast("double")
    if exact:
        qs = exact_quantiles(df, label, value, [0.25, 0.5, 0.75]).select(
            label, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    else:
        qs = df.groupBy(label).agg(F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy).alias("_q")).select(
            label, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    fences = qs.select(F.col(label).alias("_grp"), "q1", "median", "q3", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_lo"),
                       (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_hi"))
    # the distinct values again (the same aggregate as the quantiles', so its exchange is reused), not the rows
    counts = df.where(v.isNotNull()).groupBy(label, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    j = counts.join(fences, F.col(label).eqNullSafe(F.col("_grp")))
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    return j.groupBy(label, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("_c"))).cast("long").alias("outliers"))


def histogram_by_class(df: DataFrame, value: str, label: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Equal-width bin counts of a feature by label, with the stacked running count per bin
    (classes in ascending order). Bins are 1..bins (hi falls in the last); values below ``lo`` are counted in bin 0
    (bin_lo null) and values above ``hi`` in bin bins + 1."""
    v = F.col(value).cast("double")
    b = F.when(v == F.lit(hi), F.lit(bins)).otherwise(F.width_bucket(v, F.lit(lo), F.lit(hi), F.lit(bins))).cast("int")
    counts = df.where(v.isNotNull()).groupBy(b.alias("bin"), F.col(label).alias("cls")).agg(
        F.count(F.lit(1)).alias("n"))
    # per bin at most #classes rows
    w = Window.partitionBy("bin").orderBy("cls").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    width = (hi - lo) / bins
    return counts.select("bin", "cls", "n", F.sum("n").over(w).alias("stacked"),
                         F.when(F.col("bin") > 0, F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("bin_lo"))


def density_by_class(df: DataFrame, value: str, label: str, lo: float, hi: float, grid: int = 50,
                     pre_bins: int = 1000) -> DataFrame:
    """A10: Gaussian kernel density per class on a grid over [lo, hi], from counts in bins of the same width on the
    whole axis (so the cost is bins x grid, not rows x grid, and values outside [lo, hi] weigh in from where
    they are). Bandwidth: Scott's rule, sd * n^(-1/5) per class.
    Output: cls, x, density (integrates to 1 per class; null for a class without spread: one row or equal values)."""
    v = F.col(value).cast("double")
    width = (hi - lo) / pre_bins
    b = F.floor((v - F.lit(lo)) / F.lit(width))
    base = df.where(v.isNotNull()).select(F.col(label).alias("cls"), v.alias("_v"), b.alias("_b"))
    stats = base.groupBy("cls").agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_v").alias("_sd"))
    binned = base.groupBy("cls", "_b").agg(F.count(F.lit(1)).alias("_c"))
    centre = F.lit(lo) + (F.col("_b") + 0.5) * F.lit(width)
    step = (hi - lo) / (grid - 1)
    h = F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    # each (class, bin) row fans out to the fixed grid
    j = (binned.join(stats, "cls")
         .withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
         .withColumn("x", F.lit(lo) + F.col("g") * F.lit(step)))
    h = F.when(h > 0, h)  # otherwise there is no curve
    kern = F.exp(-0.5 * F.pow((F.col("x") - centre) / h, 2)) / (h * F.lit(math.sqrt(2 * math.pi)))
    return j.groupBy("cls", "g", "x").agg((F.sum(F.col("_c") * kern) / F.first("_n")).alias("density")).drop("g")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count by category, nulls ignored (N2), count desc then value asc."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value"))


def top_value(df: DataFrame, col: str) -> DataFrame:
    """The mode with the smallest value on ties (N3), and its count."""
    vc = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # min over (-count, value) by struct ordering: one partial aggregate, no sort
    best = vc.agg(F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("nn"), F.col("value"))).alias("_b"))
    return best.select(F.col("_b.value").alias("top_value"), F.col("_b.n").alias("n"))


def mean_by_group(df: DataFrame, key: str, value: str, name: str = "mean_value") -> DataFrame:
    """Average score per group."""
    return df.groupBy(key).agg(F.avg(F.col(value).cast("double")).alias(name))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def flagged_count(df: DataFrame, flag_col: str) -> DataFrame:
    """Number of flagged rows and the fraction."""
    return df.agg(F.count_if(F.col(flag_col)).alias("flagged"), F.count(F.lit(1)).alias("total")).withColumn(
        "fraction", safe_div("flagged", "total"))
