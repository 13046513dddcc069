"""Two-sample drift report.

Both samples are tagged with a side (0 = reference, 1 = current) and unpivoted once, so all
features go through one plan (the reference loops one feature at a time):

* KS (numeric): counts per (feature, value, side) -> bucketed prefix sums per feature ->
  D = max |F_ref - F_cur|; p-value on the one-row-per-feature result (pandas UDF).
* Chi-square (categorical): counts per (feature, category, side), +1 on every cell, expected
  counts from per-feature totals (a small join), Yates' correction when dof = 1.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.exprs import safe_div
from riskspark.functions.stats import chi2_sf_col, ks_pvalue_col
from riskspark.operators.clean import hash_fraction, hash_uniform
from riskspark.operators.cuts import chosen, hash_cuts, with_cuts
from riskspark.operators.prefix import running_sums

SIDE = "_side"
# Test names and thresholds of the report.
KS_NAME = "Kolmogorov-Smirnov"
CHI2_NAME = "Chi-Square Contingency"
DEFAULT_ALPHA = 0.05
DRIFT_SHARE_LIMIT = 0.25
CELL_SMOOTHING = 1


def tag_sides(ref: DataFrame, cur: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    keep = [*by, *cols]
    return (ref.select(*keep).withColumn(SIDE, F.lit(0))
            .unionByName(cur.select(*keep).withColumn(SIDE, F.lit(1))))


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spread the one-row-per-feature result over the cluster before the p-value UDF: an exact KS
    p-value costs up to n*m <= 1e8 steps, so features (and periods) should not queue in one task.
    An explicit partition number is kept by AQE (it does not coalesce it away)."""
    return df.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism), *keys)


def _present(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> list[str]:
    """D3: features missing on either side are skipped."""
    return [c for c in cols if c in ref.columns and c in cur.columns]


REPORT_SCHEMA = ("feature string, type string, test_name string, statistic double, p_value double, "
                 "drift_detected boolean")


def _long(df: DataFrame, ids: Sequence[str], cols: Sequence[str], kind: str) -> DataFrame:
    return (df.select(*ids, *[F.col(c).cast(kind).alias(c) for c in cols])
            .unpivot(list(ids), list(cols), "feature", "v").where(F.col("v").isNotNull()))


def side_counts(tagged: DataFrame, cols: Sequence[str], kind: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, v, r, c): rows per value on the reference (r) and current (c) side."""
    long = _long(tagged, [*by, SIDE], cols, kind)
    return long.groupBy(*by, "feature", "v").agg(F.count_if(F.col(SIDE) == 0).alias("r"),
                                                 F.count_if(F.col(SIDE) == 1).alias("c"))


def ks_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """D1 from side counts: (by..., feature, statistic, n_ref, n_cur)."""
    cum = running_sums(counts, "v", ["r", "c"], part_cols=[*by, "feature"])
    gap = F.abs(safe_div("cum_r", "tot_r") - safe_div("cum_c", "tot_c"))
    return cum.groupBy(*by, "feature").agg(F.max(gap).alias("statistic"), F.first("tot_r").alias("n_ref"),
                                           F.first("tot_c").alias("n_cur"))


def ks_from_tagged(tagged: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return ks_from_counts(side_counts(tagged, cols, "double", by), by)


def drift_ks(ref: DataFrame, cur: DataFrame, cols: Sequence[str], alpha: float = DEFAULT_ALPHA,
             method: str = "asymptotic") -> DataFrame:
    """KS statistic and p-value (``method`` as in functions/stats.py) per numeric feature (nulls dropped per feature)."""
    cols = _present(ref, cur, cols)
    ks = ks_from_tagged(tag_sides(ref, cur, cols), cols)
    if method == "exact":
        ks = _spread(ks, ["feature"])
    return ks.withColumn("p_value", ks_pvalue_col("statistic", "n_ref", "n_cur", method)).withColumn(
        "drift_detected", F.col("p_value") < F.lit(alpha))


def chi2_from_counts(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """D2 from side counts over the union of both sides' categories (J2, U1): +1 on every cell,
    expected counts from per-feature totals, Yates on 2x2. (by..., feature, statistic, dof)."""
    # doubles: products of two counts leave the range of a long
    cells = counts.select(*by, "feature", "v", (F.col("r") + F.lit(CELL_SMOOTHING)).cast("double").alias("o_r"),
                          (F.col("c") + F.lit(CELL_SMOOTHING)).cast("double").alias("o_c"))
    keys = [*by, "feature"]
    tot = cells.groupBy(*keys).agg(F.sum("o_r").alias("t_r"), F.sum("o_c").alias("t_c"),
                                   F.count(F.lit(1)).alias("k"))
    j = cells.join(tot, keys)  # one row per (feature[, period]): broadcast by AQE at run time
    n = F.col("t_r") + F.col("t_c")
    row_tot = F.col("o_r") + F.col("o_c")
    e_r = row_tot * F.col("t_r") / n
    e_c = row_tot * F.col("t_c") / n
    dof = F.col("k") - 1

    def term(o: Column, e: Column) -> Column:
        d = F.abs(o - e)
        # Yates' continuity correction on 2x2 tables, never more than the difference
        d = F.when(dof == 1, d - F.least(F.lit(0.5), d)).otherwise(d)
        return d * d / e

    return j.groupBy(*keys).agg(
        F.sum(term(F.col("o_r"), e_r) + term(F.col("o_c"), e_c)).alias("statistic"),
        F.first(dof).alias("dof"))


def chi2_from_tagged(tagged: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return chi2_from_counts(side_counts(tagged, cols, "string", by), by)


def drift_chi2(ref: DataFrame, cur: DataFrame, cols: Sequence[str], alpha: float = DEFAULT_ALPHA) -> DataFrame:
    """Smoothed chi-square per categorical feature; a table with one category (dof 0) gives
    statistic 0, p 1, no drift (the reference's failure branch)."""
    cols = _present(ref, cur, cols)
    chi = chi2_from_tagged(tag_sides(ref, cur, cols), cols)
    return _chi2_finish(chi, alpha)


def _chi2_finish(chi: DataFrame, alpha: float) -> DataFrame:
    ok = F.col("dof") >= 1
    return (chi.withColumn("statistic", F.when(ok, F.col("statistic")).otherwise(F.lit(0.0)))
            .withColumn("p_value", F.when(ok, chi2_sf_col("statistic", "dof")).otherwise(F.lit(1.0)))
            .withColumn("drift_detected", F.col("p_value") < F.lit(alpha)))


def drift_report(ref: DataFrame, cur: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 alpha: float = DEFAULT_ALPHA, method: str = "asymptotic") -> DataFrame:
    """D3: one row per checked feature: feature, type, test_name, statistic, p_value, drift_detected."""
    parts = []
    num = _present(ref, cur, numeric)
    cat = _present(ref, cur, categorical)
    if num:
        parts.append(drift_ks(ref, cur, num, alpha, method).select(
            "feature", F.lit("numerical").alias("type"), F.lit(KS_NAME).alias("test_name"),
            "statistic", "p_value", "drift_detected"))
    if cat:
        parts.append(drift_chi2(ref, cur, cat, alpha).select(
            "feature", F.lit("categorical").alias("type"), F.lit(CHI2_NAME).alias("test_name"),
            "statistic", "p_value", "drift_detected"))
    if not parts:
        return ref.sparkSession.createDataFrame([], REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def drift_summary(report: DataFrame, limit: float = DRIFT_SHARE_LIMIT, by: Sequence[str] = ()) -> DataFrame:
    """Drifting count, total checked, percentage, and the alert flag (share >= limit, as the
    code does, N12); 0 when nothing was checked."""
    s = report.groupBy(*by).agg(F.count_if("drift_detected").alias("drifting_features_count"),
                                F.count(F.lit(1)).alias("total_features_checked"))
    frac = safe_div("drifting_features_count", "total_features_checked")
    frac = F.coalesce(frac, F.lit(0.0))
    return s.select(*by, ((frac >= F.lit(limit)) & (F.col("total_features_checked") > 0)).alias("drift_detected"),
                    (frac * 100.0).alias("drifting_features_percentage"),
                    "drifting_features_count", "total_features_checked")


def drifting_features(report: DataFrame) -> DataFrame:
    """Names of the flagged features (sorted), and the status view ordered drifting first."""
    return report.where("drift_detected").agg(F.sort_array(F.collect_list("feature")).alias("features"))


def status_view(report: DataFrame) -> DataFrame:
    """Drifting first, then by feature name."""
    return report.orderBy(F.desc("drift_detected"), "feature")


def ks_against_reference(ref_counts: DataFrame, cur_counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """KS of every group of ``cur_counts`` (by..., feature, v, c) against one reference sample
    ``ref_counts`` (feature, v, r), without repeating the reference per group.

    The reference CDF is read at each current point from one prefix sum over the merged value
    order (reference values and all current values, one row per (feature, v)). Between two
    consecutive current points the current CDF is constant and the reference CDF is monotone,
    so the supremum is attained at a current point v as |F_ref(v) - F_cur(v)| or
    |F_ref(v-) - F_cur(v-)|: exact, with rows = reference values + current values."""
    keys = [*by, "feature"]
    points = (ref_counts.select("feature", "v", F.col("r").cast("long").alias("R"))
              .unionByName(cur_counts.select("feature", "v", F.lit(0).cast("long").alias("R")))
              .groupBy("feature", "v").agg(F.sum("R").alias("R")))
    ref_cdf = running_sums(points, "v", ["R"], part_cols=["feature"]).select(
        "feature", "v", (F.col("cum_R") / F.col("tot_R")).alias("fr"),
        ((F.col("cum_R") - F.col("R")) / F.col("tot_R")).alias("fr_minus"), F.col("tot_R").alias("n_ref"))
    cur_cdf = running_sums(cur_counts, "v", ["c"], part_cols=keys).select(
        *keys, "v", (F.col("cum_c") / F.col("tot_c")).alias("fc"),
        ((F.col("cum_c") - F.col("c")) / F.col("tot_c")).alias("fc_minus"), F.col("tot_c").alias("n_cur"))
    j = cur_cdf.join(ref_cdf, ["feature", "v"], "inner")  # every current point is in ref_cdf
    gap = F.greatest(F.abs(F.col("fr") - F.col("fc")), F.abs(F.col("fr_minus") - F.col("fc_minus")))
    return j.groupBy(*keys).agg(F.max(gap).alias("statistic"), F.first("n_ref").alias("n_ref"),
                                F.first("n_cur").alias("n_cur"))


def chi2_against_reference(ref_counts: DataFrame, cur_counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Smoothed chi-square (+1 cells, Yates on 2x2) of every group of ``cur_counts`` (by..., feature,
    v, c) against one reference ``ref_counts`` (feature, v, r), without repeating the reference's
    categories per group. Output (by..., feature, statistic, dof).

    Cells are the union of reference and group categories. With row totals R_v, column totals
    t_r, t_c and N: chi2 = N * (sum_v o_r^2 / (R_v t_r) + o_c^2 / (R_v t_c)) - N. Reference
    categories absent from a group have o_c = 1, so their part is a per-feature constant minus the
    part of the categories that are present (found by an equi-join). A 2x2 table (Yates) is closed
    form: |o - e| = |o11 o22 - o12 o21| / N for every cell."""
    keys = [*by, "feature"]
    # doubles: products of two counts leave the range of a long
    ref_counts = ref_counts.withColumn("r", F.col("r").cast("double"))
    cur_counts = cur_counts.withColumn("c", F.col("c").cast("double"))
    ref_stats = ref_counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_k0"), F.sum("r").alias("_rtot"),
        F.sum((F.col("r") + 1) ** 2 / (F.col("r") + 2)).alias("_A"), F.sum(1.0 / (F.col("r") + 2)).alias("_B"))
    j = cur_counts.join(ref_counts, ["feature", "v"], "left")  # at most one reference row per cell
    in_ref = F.col("r").isNotNull()
    o_r = F.coalesce(F.col("r"), F.lit(0.0)) + 1
    o_c = F.col("c") + 1
    rv = o_r + o_c
    per = j.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_ncur"), F.count_if(~in_ref).alias("_new"), F.sum("c").alias("_ctot"),
        F.sum(F.when(in_ref, F.col("r"))).alias("_rpres"),
        F.sum(o_r * o_r / rv).alias("_xr"), F.sum(o_c * o_c / rv).alias("_xc"),
        F.sum(F.when(in_ref, (F.col("r") + 1) ** 2 / (F.col("r") + 2))).alias("_apres"),
        F.sum(F.when(in_ref, 1.0 / (F.col("r") + 2))).alias("_bpres"),
        F.min_by(F.struct(o_r.alias("a"), o_c.alias("b")), F.col("v")).alias("_c1"),
        F.max_by(F.struct(o_r.alias("a"), o_c.alias("b")), F.col("v")).alias("_c2"))
    x = per.join(ref_stats, "feature")
    k = F.col("_k0") + F.col("_new")
    t_r = F.col("_rtot") + k
    t_c = F.col("_ctot") + k
    n = t_r + t_c
    rpres = F.coalesce(F.col("_rpres"), F.lit(0.0))
    plain = n * ((F.col("_xr") + F.col("_A") - F.coalesce(F.col("_apres"), F.lit(0.0))) / t_r
                 + (F.col("_xc") + F.col("_B") - F.coalesce(F.col("_bpres"), F.lit(0.0))) / t_c) - n
    # 2x2: the second cell is the other current category, or the one reference-only category
    second_a = F.when(F.col("_ncur") == 2, F.col("_c2.a")).otherwise(F.col("_rtot") - rpres + 1)
    second_b = F.when(F.col("_ncur") == 2, F.col("_c2.b")).otherwise(F.lit(1.0))
    d = F.abs(F.col("_c1.a") * second_b - second_a * F.col("_c1.b")) / n
    r1, r2 = F.col("_c1.a") + F.col("_c1.b"), second_a + second_b
    yates = F.pow(F.greatest(d - 0.5, F.lit(0.0)), 2) * n * (1.0 / r1 + 1.0 / r2) * (1.0 / t_r + 1.0 / t_c)
    stat = F.when(k == 2, yates).when(k >= 3, plain).otherwise(F.lit(0.0))
    return x.select(*keys, stat.cast("double").alias("statistic"), (k - 1).cast("long").alias("dof"))


STATE_SCHEMA = "_base boolean, period timestamp, feature string, n double, s string, c long"


def count_periods(df: DataFrame, time_col: str, baseline: Column, numeric: Sequence[str], categorical: Sequence[str], unit: str = "week") -> DataFrame:
    """D7's counts in one scan: rows of every (side, period, feature, value); ``_base`` marks the baseline's, which
    have no period. Counts of parts of a table add up to those of the whole."""
    is_base = F.coalesce(baseline, F.lit(False))
    values = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("n"), F.lit(None).cast("string").alias("s")) for c in numeric]
    values += [F.struct(F.lit(c).alias("feature"), F.lit(None).cast("double").alias("n"), F.col(c).cast("string").alias("s")) for c in categorical]
    if not values:
        raise ValueError("drift by period needs a numeric or a categorical feature")
    long = df.select(is_base.alias("_base"), F.when(~is_base, F.date_trunc(unit, F.col(time_col))).alias("period"), F.inline(F.array(*values)))
    return (long.where(F.col("n").isNotNull() | F.col("s").isNotNull())
            .groupBy("_base", "period", "feature", "n", "s").agg(F.count(F.lit(1)).alias("c")))


def drift_of_counts(cells: DataFrame, alpha: float = DEFAULT_ALPHA, method: str = "asymptotic", kinds: Sequence[str] = ("n", "s")) -> DataFrame:
    """D7 from counts (as count_periods gives them): (period, feature, type, statistic, p_value, drift_detected).
    Neither numeric (``ks_against_reference``) nor categorical (``chi2_against_reference``) features repeat the
    baseline per period."""
    def side(kind: str) -> tuple[DataFrame, DataFrame]:
        own = cells.where(F.col(kind).isNotNull()).select("_base", "period", "feature", F.col(kind).alias("v"), "c")
        return own.where("_base").select("feature", "v", F.col("c").alias("r")), own.where("not _base").drop("_base")

    parts = []
    if "n" in kinds:
        ks = ks_against_reference(*side("n"), ["period"])
        if method == "exact":
            ks = _spread(ks, ["period", "feature"])
        parts.append(ks.select("period", "feature", F.lit("numerical").alias("type"), "statistic",
                               ks_pvalue_col("statistic", "n_ref", "n_cur", method).alias("p_value")))
    if "s" in kinds:
        # the chi-square tail is a cheap closed form: no need to spread rows before it
        chi = _chi2_finish(chi2_against_reference(*side("s"), ["period"]), alpha)
        parts.append(chi.select("period", "feature", F.lit("categorical").alias("type"), "statistic", "p_value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("drift_detected", F.col("p_value") < F.lit(alpha))


def drift_by_period(df: DataFrame, time_col: str, baseline: Column, numeric: Sequence[str],
                    categorical: Sequence[str], unit: str = "week", alpha: float = DEFAULT_ALPHA,
                    method: str = "asymptotic") -> DataFrame:
    """Every period (``date_trunc(unit)``) of the non-baseline rows against the baseline rows,
    all periods and features in one plan: (period, feature, type, statistic, p_value, drift_detected).
    One scan counts; the counts are written once and both tests read them."""
    from riskspark.session import cut_lineage

    cells = cut_lineage(count_periods(df, time_col, baseline, numeric, categorical, unit))
    return drift_of_counts(cells, alpha, method, ["n"] * bool(numeric) + ["s"] * bool(categorical))


def add_to_state(df: DataFrame, path: str, batch: str, time_col: str, baseline: Column, numeric: Sequence[str], categorical: Sequence[str],
                 unit: str = "week") -> None:
    """D7 as a stored state: the counts of these rows, written as ``batch`` of the state at ``path``. Reads these rows only; a batch
    that is written again (after a failure) replaces itself, so every batch counts once."""
    count_periods(df, time_col, baseline, numeric, categorical, unit).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def drift_from_state(spark: SparkSession, path: str, alpha: float = DEFAULT_ALPHA, method: str = "asymptotic") -> DataFrame:
    """D7 of all batches of a stored state: the report of one run over all their rows, which are not read again."""
    from riskspark.session import cut_lineage

    cells = spark.read.schema(STATE_SCHEMA).parquet(path).groupBy("_base", "period", "feature", "n", "s").agg(F.sum("c").alias("c"))
    return drift_of_counts(cut_lineage(cells), alpha, method)


# The drift simulation's rules (shift 5*s, income x (1 - 0.15*s), 0.5*s of rows get a
# satisfaction drawn with weights 0.35/0.35/0.20/0.10 for 1/2/3/4, 0.4*s of "No" overtime become "Yes").
SHIFT_PER_SEVERITY = 5
CUT_PER_SEVERITY = 0.15
REDRAW_SHARE = 0.5
REDRAW_VALUES = [1, 2, 3, 4]
REDRAW_WEIGHTS = [0.35, 0.35, 0.20, 0.10]
FLIP_SHARE = 0.4


def exact_pick(df: DataFrame, key: Sequence[str], fraction: float, seed: int, eligible: Column | None = None,
               out: str = "_pick") -> DataFrame:
    """Adds ``out``: exactly round(fraction * n) of the eligible rows (HALF_UP), the ones with the
    smallest seeded hash of ``key``, found by a cut value: no row is sorted or moved."""
    elig = F.coalesce(eligible if eligible is not None else F.lit(True), F.lit(False))
    cuts = hash_cuts(df.where(elig), [], key, seed, [lambda n: F.round(n * F.lit(float(fraction)))])
    return with_cuts(df, cuts, []).withColumn(out, elig & chosen(key, seed)).drop("_cuts")


def perturb(df: DataFrame, key: Sequence[str], severity: float = 1.0, seed: int = 99,
            shift: Mapping[str, int] | None = None, cut: Sequence[str] = (),
            redraw: Sequence[str] = (), flip: Mapping[str, tuple[str, str]] | None = None,
            exact: bool = False) -> DataFrame:
    """What-if perturbation keyed by a hash of ``key`` (deterministic, no driver RNG).
    shift: c + int(5*s); cut: int(c * (1 - 0.15*s)); redraw: a fraction 0.5*s of rows get a value
    drawn with fixed weights; flip: a fraction 0.4*s of rows equal to ``from`` become ``to``.
    Fractions are seeded Bernoulli draws, or with ``exact`` exactly round(f * n) rows as the
    reference's sampling does (one prefix-count pass per rule). s <= 0 is the identity."""
    if severity <= 0:
        return df
    out = df
    for c in (shift or {}):
        out = out.withColumn(c, F.col(c) + F.lit(int(SHIFT_PER_SEVERITY * severity)))
    for c in cut:
        out = out.withColumn(c, (F.col(c) * F.lit(1 - CUT_PER_SEVERITY * severity)).cast("int"))
    for i, c in enumerate(redraw):
        if exact:
            out = exact_pick(out, key, REDRAW_SHARE * severity, seed + 10 * i, out="_pick")
            pick = F.col("_pick")
        else:
            pick = hash_fraction(key, REDRAW_SHARE * severity, seed + 10 * i)
        u = hash_uniform(key, seed + 10 * i + 1)
        draw = None
        acc = 0.0
        for v, w in zip(REDRAW_VALUES, REDRAW_WEIGHTS):
            acc += w
            draw = F.when(u < F.lit(acc), F.lit(v)) if draw is None else draw.when(u < F.lit(acc), F.lit(v))
        draw = draw.otherwise(F.lit(REDRAW_VALUES[-1]))
        out = out.withColumn(c, F.when(pick, draw.cast(df.schema[c].dataType)).otherwise(F.col(c)))
        out = out.drop("_pick") if exact else out
    for j, (c, (src, dst)) in enumerate((flip or {}).items()):
        if exact:
            out = exact_pick(out, key, FLIP_SHARE * severity, seed + 100 + j, F.col(c) == F.lit(src), out="_pick")
            out = out.withColumn(c, F.when(F.col("_pick"), F.lit(dst)).otherwise(F.col(c))).drop("_pick")
        else:
            pick = hash_fraction(key, FLIP_SHARE * severity, seed + 100 + j)
            out = out.withColumn(c, F.when((F.col(c) == F.lit(src)) & pick, F.lit(dst)).otherwise(F.col(c)))
    return out
