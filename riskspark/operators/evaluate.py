"""Classifier evaluation as distributed aggregates.

Curve metrics (ROC-AUC, average precision, PR curve, best-F1 threshold, capture at top X%) reduce
rows to distinct scores first (one row per score with positive/negative counts, map-side combined)
and then use the bucketed prefix sums of ``prefix.py``: no step puts all rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.exprs import col_, safe_div
from riskspark.operators.prefix import running_sums

F1_EPS = 1e-10


def confusion_aggs(label: str | Column, pred: str | Column) -> list[Column]:
    y, p = col_(label).cast("int"), col_(pred).cast("int")
    return [
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    ]


def ratios_from_confusion(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """accuracy, precision, recall, F1 from tn/fp/fn/tp; 0 on a zero denominator."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision = safe_div(tp, tp + fp)
    recall = safe_div(tp, tp + fn)
    return df.select(
        *keep,
        safe_div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "tn", "fp", "fn", "tp",
    )


def metrics_at_threshold(df: DataFrame, label: str, score: str, threshold: float = 0.5,
                         by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by`` group) of accuracy, precision, recall, f1_score and confusion counts."""
    pred = (F.col(score) >= F.lit(float(threshold))).cast("int")
    counts = df.groupBy(*by).agg(*confusion_aggs(label, pred))
    return ratios_from_confusion(counts, keep=list(by))


def class_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """E5: per-class precision, recall, F1 and support, plus accuracy, macro and weighted averages.
    Rows: class '0', '1', 'accuracy', 'macro avg', 'weighted avg'."""
    c = df.agg(*confusion_aggs(label, pred))
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    p0, r0 = safe_div(tn, tn + fn), safe_div(tn, tn + fp)
    f1 = safe_div(2 * tp, 2 * tp + fp + fn)
    f0 = safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f0.alias("f1_score"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1.alias("f1_score"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), safe_div(tp + tn, n).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f0 + f1) / 2).alias("f1_score"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), safe_div(p0 * s0 + p1 * s1, n).alias("precision"),
                 safe_div(r0 * s0 + r1 * s1, n).alias("recall"), safe_div(f0 * s0 + f1 * s1, n).alias("f1_score"),
                 n.alias("support")),
    )
    return c.select(F.inline(rows)).withColumn("support", F.col("support").cast("long"))


def score_table(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct scores with positive/negative counts (rows with a null label or score are dropped)."""
    y = col_(label).cast("int")
    return (df.where(F.col(score).isNotNull() & y.isNotNull())
            .groupBy(*by, F.col(score).cast("double").alias("s"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))


def cumulative_scores(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score s: pos, neg; cum_pos/cum_neg = counts with score <= s; tot_pos/tot_neg.
    TP(>= s) = tot_pos - cum_pos + pos, FP(>= s) likewise."""
    return running_sums(score_table(df, label, score, by), "s", ["pos", "neg"], part_cols=by)


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """P(score_pos > score_neg) + P(tie)/2, exact, per ``by`` group."""
    return _auc(cumulative_scores(df, label, score, by), by)


def roc_auc_of_counts(df: DataFrame, score: str, pos: str, neg: str, by: Sequence[str] = ()) -> DataFrame:
    """E2 of rows that stand for ``pos`` positive and ``neg`` negative rows of one score; a score may come more than once."""
    table = df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("s")).agg(F.sum(pos).alias("pos"), F.sum(neg).alias("neg"))
    return _auc(running_sums(table, "s", ["pos", "neg"], part_cols=by), by)


def _auc(cs: DataFrame, by: Sequence[str]) -> DataFrame:
    neg_below = F.col("cum_neg") - F.col("neg")
    return (cs.groupBy(*by).agg(
        F.sum(F.col("pos").cast("double") * (neg_below + F.col("neg") / 2.0)).alias("_u"),
        F.first("tot_pos").cast("double").alias("_p"), F.first("tot_neg").cast("double").alias("_n"))
        .select(*by, safe_div(F.col("_u"), F.col("_p") * F.col("_n")).alias("roc_auc")))


def _with_tp_fp(cs: DataFrame) -> DataFrame:
    return (cs.withColumn("tp", (F.col("tot_pos") - F.col("cum_pos") + F.col("pos")).cast("long"))
              .withColumn("fp", (F.col("tot_neg") - F.col("cum_neg") + F.col("neg")).cast("long")))


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Step sum over thresholds of (R_n - R_{n-1}) * P_n (no interpolation)."""
    cs = _with_tp_fp(cumulative_scores(df, label, score, by))
    term = safe_div(F.col("pos"), F.col("tot_pos")) * safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    return cs.groupBy(*by).agg(F.sum(term).alias("pr_auc"))


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct threshold: tp, fp (score >= threshold), precision, recall, F1."""
    cs = _with_tp_fp(cumulative_scores(df, label, score, by))
    precision = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = safe_div(F.col("tp"), F.col("tot_pos"))
    return cs.select(
        *by, F.col("s").alias("threshold"), "tp", "fp",
        precision.alias("precision"), recall.alias("recall"),
        (2 * precision * recall / (precision + recall + F.lit(F1_EPS))).alias("f1"),
    )


def best_f1_threshold(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """The threshold of maximum F1, first (lowest threshold) on ties; one row per group.
    A max-by aggregate over a struct (F1 desc, threshold asc): partial aggregation, no sort."""
    curve = pr_curve(df, label, score, by)
    best = F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("neg_t"), "precision", "recall"))
    return (curve.groupBy(*by).agg(best.alias("b"))
            .select(*by, (-F.col("b.neg_t")).alias("threshold"), F.col("b.f1").alias("f1"),
                    F.col("b.precision").alias("precision"), F.col("b.recall").alias("recall")))


def lift_gains(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Gains table by score bins. bin = floor(bins * (rows with a strictly higher score) / N) + 1,
    so tied scores share a bin. Per bin: rows, positives, rate, lift = rate / base rate,
    cumulative capture = positives so far / all positives."""
    cs = cumulative_scores(df, label, score)
    n = F.col("tot_pos") + F.col("tot_neg")
    higher = n - (F.col("cum_pos") + F.col("cum_neg"))
    binned = cs.withColumn("bin", (F.floor(F.lit(float(bins)) * higher / n) + 1).cast("int"))
    per_bin = binned.groupBy("bin").agg(
        F.sum(F.col("pos") + F.col("neg")).alias("rows"), F.sum("pos").alias("positives"),
        F.first("tot_pos").alias("_P"), F.first(n).alias("_N"))
    # at most ``bins`` rows: a window without partition is bounded here
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_bin.select(
        "bin", F.col("rows").cast("long").alias("rows"), F.col("positives").cast("long").alias("positives"),
        safe_div("positives", "rows").alias("rate"),
        safe_div(safe_div("positives", "rows"), safe_div("_P", "_N")).alias("lift"),
        safe_div(F.sum("positives").over(w), F.col("_P")).alias("cum_capture"),
    )


def capture_at_top(df: DataFrame, label: str, score: str, key: str, pct) -> DataFrame:
    """For each top-X% (a number or a list), flag the top int(N * X / 100) rows by score
    (ties broken by ``key`` ascending) and report flagged count, positives captured, recall and
    precision: (top_pct, flagged, captured, recall, precision).

    Exact at scale, with no global sort: prefix sums over distinct scores give the score at each cut. They run when the
    call is made, once, and leave a row per percentage on the driver; the cut scores then reach the
    scan as a filter, so that only the rows tied at a cut are read again and ranked by key (bucketed prefix counts, a
    part per percentage) when the result is."""
    pcts = [float(p) for p in (pct if isinstance(pct, (list, tuple)) else [pct])]
    y = F.col(label).cast("int")
    base = df.where(F.col(score).isNotNull() & y.isNotNull()).select(
        F.col(score).cast("double").alias("_score"), F.col(key).alias("_key"), y.alias("_y"))
    cs = cumulative_scores(base, "_y", "_score")
    cs = cs.select(F.col("s").alias("_at"), (F.col("tot_pos") + F.col("tot_neg")).cast("long").alias("_N"), F.col("tot_pos").cast("long").alias("_P"),
                   (F.col("tot_pos") - F.col("cum_pos")).cast("long").alias("_pos_above"), (F.col("tot_neg") - F.col("cum_neg")).cast("long").alias("_neg_above"),
                   (F.col("pos") + F.col("neg")).cast("long").alias("_here"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col("_N") * F.lit(p) / F.lit(100.0)).cast("long").alias("k")) for i, p in enumerate(pcts)])
    above = F.col("_pos_above") + F.col("_neg_above")  # rows with a strictly higher score
    hits = F.filter(wanted, lambda t: (above < t["k"]) & (above + F.col("_here") >= t["k"]))
    found = cs.select("_at", "_P", "_pos_above", above.alias("_above"), F.inline(hits)).collect()  # at most a row per percentage
    cut = {r.i: r for r in found}  # a percentage without a cut flags no row
    positives = found[0]["_P"] if found else 0
    kinds = ("int", "double", "long", "double", "long", "long")
    names = ("_i", "top_pct", "flagged", "_at", "_need", "_pos_above")
    rows = [(i, p, c["k"], c["_at"], c["k"] - c["_above"], c["_pos_above"]) if (c := cut.get(i)) else (i, p, 0, None, None, None) for i, p in enumerate(pcts)]
    cuts = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(r, kinds, names)]) for r in rows])))  # a row per percentage
    at = [r["_at"] for r in found]
    # zeros of either sign, and NaN, are equal here, but need not be in a file's statistics: such cuts stay out of the scan
    tied = base if any(v == 0 or v != v for v in at) else base.where(F.col("_score").isin(at))
    tied = (tied.join(F.broadcast(cuts.select("_i", "_at", "_need")), F.col("_score") == F.col("_at"))
            .groupBy("_i", "_need", "_key").agg(F.count_if(F.col("_y") == 1).alias("_p1"), F.count(F.lit(1)).alias("_c1")))
    got = (running_sums(tied, "_key", ["_c1"], part_cols=["_i"]).where(F.col("cum__c1") <= F.col("_need"))
           .groupBy("_i").agg(F.sum("_p1").alias("_tied_pos")))
    captured = (F.coalesce("_pos_above", F.lit(0)) + F.coalesce("_tied_pos", F.lit(0))).cast("long")
    return cuts.join(got, "_i", "left").select(
        "top_pct", "flagged", captured.alias("captured"),
        F.coalesce(safe_div(captured, F.lit(positives)), F.lit(0.0)).alias("recall"),
        F.coalesce(safe_div(captured, F.col("flagged")), F.lit(0.0)).alias("precision"))


def metrics_long(metrics: DataFrame, id_col: str = "model") -> DataFrame:
    """The model comparison table transposed to (model, metric, value)."""
    value_cols = [c for c in metrics.columns if c != id_col]
    wide = metrics.select(id_col, *[F.col(c).cast("double").alias(c) for c in value_cols])
    return wide.unpivot([id_col], value_cols, "metric", "value")
