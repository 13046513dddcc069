"""DuckDB SQL for the registered queries (independent formulations: plain windows and CASE sums).
Views: region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations. Doubles are rounded like the Spark side."""

from __future__ import annotations

from riskspark.operators.drift import CHI2_NAME, DRIFT_SHARE_LIMIT, KS_NAME

Y = "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END"
YF = "CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END"
R = "CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END"


def d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


ORACLE: dict[str, str] = {}

ORACLE["clean_lineitem"] = """
SELECT CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 WHEN 'N' THEN 0 END AS label, COUNT(*) AS n
FROM (SELECT DISTINCT * FROM lineitem) t GROUP BY 1"""

ORACLE["schema_completion"] = """
SELECT event_id, event_type, 'Unknown' AS segment, value, CAST(0.0 AS DOUBLE) AS discount_rate FROM events"""

ORACLE["positional_split"] = """
WITH r AS (SELECT event_id, value, ROW_NUMBER() OVER (ORDER BY event_id) AS rn FROM events)
SELECT CASE WHEN rn <= 1000 THEN 'baseline' ELSE 'current' END AS side, COUNT(*) AS n,
       MIN(event_id) AS min_id, MAX(event_id) AS max_id, ROUND(AVG(value), 6) AS avg_value
FROM r GROUP BY 1"""

ORACLE["domain_violations"] = """
SELECT 'l_quantity' AS "column", 'range[1,45]' AS rule, COUNT(*) AS violations, 'lineitem' AS tbl
  FROM lineitem WHERE NOT (l_quantity BETWEEN 1 AND 45)
UNION ALL
SELECT 'l_discount', 'range[0.0,0.08]', COUNT(*), 'lineitem' FROM lineitem WHERE NOT (l_discount BETWEEN 0.0 AND 0.08)
UNION ALL
SELECT 'l_tax', 'range[0.0,0.06]', COUNT(*), 'lineitem' FROM lineitem WHERE NOT (l_tax BETWEEN 0.0 AND 0.06)
UNION ALL
SELECT 'o_orderpriority', 'allowed_set', COUNT(*), 'orders' FROM orders
  WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""

ORACLE["rate_by_two_keys"] = f"""
SELECT o_orderpriority, l_linestatus, ROUND(AVG({R}) * 100, 2) AS rate_pct, COUNT(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2 ORDER BY rate_pct DESC, 1, 2"""

ORACLE["mean_by_outcome"] = """
SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, ROUND(AVG(l_quantity), 2) AS avg_quantity,
       ROUND(AVG(l_extendedprice), 2) AS avg_price
FROM lineitem GROUP BY 1"""

ORACLE["rate_count_by_key"] = f"""
SELECT l_linenumber, COUNT(*) AS total, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS positives,
       ROUND(AVG({R}) * 100, 2) AS rate_pct
FROM lineitem GROUP BY 1 ORDER BY 1"""

ORACLE["join_breakdown"] = """
SELECT c_mktsegment, o_orderpriority, COUNT(*) AS n, ROUND(AVG(c_acctbal), 2) AS avg_value
FROM customer JOIN orders ON c_custkey = o_custkey
WHERE o_orderstatus = 'F'
GROUP BY 1, 2 ORDER BY 1, n DESC, 2"""

ORACLE["overall_rate"] = f"""
SELECT COUNT(*) AS n, CAST(SUM({Y}) AS BIGINT) AS positives, ROUND(AVG({YF}), 6) AS rate,
       ROUND(AVG({YF}) * 100.0, 6) AS rate_pct
FROM events"""

ORACLE["rate_by_group"] = f"""
WITH g AS (SELECT CAST(hour(ts) AS INTEGER) AS grp, AVG({YF}) AS rate, COUNT(*) AS n FROM events GROUP BY 1)
SELECT grp, ROUND(rate, 6) AS rate, n,
       ROUND(rate - 1.96 * sqrt(rate * (1 - rate) / n), 6) AS ci_low,
       ROUND(rate + 1.96 * sqrt(rate * (1 - rate) / n), 6) AS ci_high
FROM g"""

ORACLE["quartiles_by_outcome"] = """
WITH b AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_extendedprice AS v FROM lineitem),
q AS (SELECT label, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM b GROUP BY label),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.label, ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
       ROUND(MIN(CASE WHEN v >= lo AND v <= hi THEN v END), 6) AS whisker_low,
       ROUND(MAX(CASE WHEN v >= lo AND v <= hi THEN v END), 6) AS whisker_high,
       COUNT(*) FILTER (WHERE NOT (v >= lo AND v <= hi)) AS outliers
FROM b JOIN f ON b.label = f.label GROUP BY f.label, q1, median, q3"""

ORACLE["histogram_by_class"] = f"""
WITH c AS (
  SELECT CAST(CASE WHEN value < 0.0 THEN 0 WHEN value = 500.0 THEN 20 WHEN value > 500.0 THEN 21
                   ELSE FLOOR((value - 0.0) / (500.0 - 0.0) * 20) + 1 END AS INTEGER) AS bin, {Y} AS cls, COUNT(*) AS n
  FROM events WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT bin, CAST(cls AS INTEGER) AS cls, n, CAST(SUM(n) OVER (PARTITION BY bin ORDER BY cls) AS BIGINT) AS stacked,
       CASE WHEN bin > 0 THEN ROUND(0.0 + (bin - 1) * {d(25.0)}, 6) END AS bin_lo
FROM c"""

ORACLE["density_by_class"] = f"""
WITH base AS (
  SELECT CAST({Y} AS INTEGER) AS cls, value AS v,
         CAST(FLOOR((value - 0.0) / {d(0.5)}) AS BIGINT) AS b
  FROM events WHERE value IS NOT NULL),
st AS (SELECT cls, COUNT(*) AS n, STDDEV_SAMP(v) AS sd FROM base GROUP BY cls),
bn AS (SELECT cls, b, COUNT(*) AS c FROM base GROUP BY cls, b),
g AS (SELECT range AS g, 0.0 + range * {d(500.0 / 49)} AS x FROM range(50)),
j AS (SELECT bn.cls, g.g, g.x, bn.c, st.n, st.sd * pow(CAST(st.n AS DOUBLE), -0.2) AS h,
             0.0 + (bn.b + 0.5) * {d(0.5)} AS centre
      FROM bn JOIN st ON bn.cls = st.cls CROSS JOIN g)
SELECT cls, ROUND(x, 6) AS x,
       ROUND(SUM(c * exp(-0.5 * pow((x - centre) / h, 2)) / (h * {d(2.5066282746310002)})) / MAX(n), 6) AS density
FROM j GROUP BY cls, g, x"""

ORACLE["value_counts"] = """
SELECT o_orderpriority AS value, COUNT(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL
GROUP BY 1 ORDER BY n DESC, 1"""

ORACLE["top_value"] = """
SELECT o_orderpriority AS top_value, COUNT(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL
GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1"""

ORACLE["mean_risk_by_group"] = """
SELECT event_type, ROUND(AVG(value / 100.0), 6) AS mean_risk FROM events GROUP BY 1"""

ORACLE["class_counts"] = """SELECT quality, COUNT(*) AS n FROM labels GROUP BY 1"""

ORACLE["ratio_to_group_mean"] = """
WITH r AS (SELECT l_extendedprice / (AVG(l_extendedprice) OVER (PARTITION BY l_linenumber) + 1e-5) AS ratio FROM lineitem)
SELECT COUNT(*) AS n, ROUND(SUM(ratio), 4) AS sum_ratio, ROUND(MAX(ratio), 4) AS max_ratio, ROUND(MIN(ratio), 4) AS min_ratio
FROM r"""

ORACLE["tenure_ratio"] = """
WITH r AS (SELECT l_quantity / (CAST(l_linenumber AS DOUBLE) + 1.0) AS ratio FROM lineitem)
SELECT COUNT(*) AS n, ROUND(SUM(ratio), 4) AS sum_ratio, ROUND(MAX(ratio), 4) AS max_ratio, ROUND(MIN(ratio), 4) AS min_ratio
FROM r"""

ORACLE["lookup_ratio"] = """
WITH r AS (SELECT l_extendedprice / CASE l_linenumber WHEN 1 THEN 20000.0 WHEN 2 THEN 30000.0 WHEN 3 THEN 40000.0
                                     WHEN 4 THEN 50000.0 WHEN 5 THEN 60000.0 ELSE 5000.0 END AS ratio FROM lineitem)
SELECT CASE WHEN ratio IS NULL THEN NULL WHEN ratio < 0.85 THEN 'below' WHEN ratio > 1.15 THEN 'above' ELSE 'within' END AS band,
       COUNT(*) AS n, ROUND(AVG(ratio), 6) AS avg_ratio
FROM r GROUP BY 1"""

ORACLE["scale_fit"] = """
SELECT 'p_size' AS feature, ROUND(AVG(p_size), 6) AS mean,
       ROUND(CASE WHEN STDDEV_POP(p_size) = 0 THEN 1.0 ELSE STDDEV_POP(p_size) END, 6) AS scale FROM part
UNION ALL
SELECT 'p_retailprice', ROUND(AVG(p_retailprice), 6),
       ROUND(CASE WHEN STDDEV_POP(p_retailprice) = 0 THEN 1.0 ELSE STDDEV_POP(p_retailprice) END, 6) FROM part"""

ORACLE["scale_apply"] = """
WITH s AS (SELECT AVG(p_size) AS m1, STDDEV_POP(p_size) AS s1, AVG(p_retailprice) AS m2, STDDEV_POP(p_retailprice) AS s2 FROM part)
SELECT p_partkey,
       ROUND((p_size - m1) / (CASE WHEN s1 = 0 THEN 1.0 ELSE s1 END + 1e-10), 6) AS p_size_scaled,
       ROUND((p_retailprice - m2) / (CASE WHEN s2 = 0 THEN 1.0 ELSE s2 END + 1e-10), 6) AS p_retailprice_scaled
FROM part CROSS JOIN s"""

ORACLE["onehot_apply"] = """
WITH c AS (SELECT o_orderpriority AS feature_value, 'o_orderpriority' AS f FROM orders
           UNION ALL SELECT o_orderstatus, 'o_orderstatus' FROM orders),
k AS (SELECT f, feature_value, COUNT(*) AS n,
             ROW_NUMBER() OVER (PARTITION BY f ORDER BY feature_value) AS pos FROM c WHERE feature_value IS NOT NULL GROUP BY 1, 2)
SELECT f || '_' || feature_value AS dummy, CAST(n AS DOUBLE) AS ones FROM k WHERE pos > 1"""

ORACLE["stratified_split"] = """
SELECT quality AS class, COUNT(*) AS n, CAST(ROUND(COUNT(*) * 0.2) AS BIGINT) AS n_test,
       COUNT(*) - CAST(ROUND(COUNT(*) * 0.2) AS BIGINT) AS n_train
FROM labels GROUP BY 1"""

ORACLE["kfold_sizes"] = """
WITH r AS (SELECT quality, ROW_NUMBER() OVER (PARTITION BY quality ORDER BY doc_id) AS rn FROM labels)
SELECT quality AS class, CAST((rn - 1) % 5 AS INTEGER) AS fold, COUNT(*) AS n FROM r GROUP BY 1, 2"""

ORACLE["class_weights"] = """
WITH c AS (SELECT quality AS class, COUNT(*) AS n FROM labels GROUP BY 1),
t AS (SELECT SUM(n) AS total, SUM(CASE WHEN class = 0 THEN n END) AS neg, SUM(CASE WHEN class = 1 THEN n END) AS pos FROM c)
SELECT class, n, ROUND(CAST(total AS DOUBLE) / (2.0 * n), 6) AS weight, ROUND(CAST(neg AS DOUBLE) / pos, 6) AS imbalance
FROM c CROSS JOIN t"""

_CONF = f"""
WITH c AS (SELECT
  COUNT(*) FILTER (WHERE {Y} = 0 AND value < 50) AS tn, COUNT(*) FILTER (WHERE {Y} = 0 AND value >= 50) AS fp,
  COUNT(*) FILTER (WHERE {Y} = 1 AND value < 50) AS fn, COUNT(*) FILTER (WHERE {Y} = 1 AND value >= 50) AS tp
  FROM events)"""

ORACLE["metrics_at_threshold"] = _CONF + """
SELECT ROUND(CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn), 6) AS accuracy,
       ROUND(CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END, 6) AS precision,
       ROUND(CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END, 6) AS recall,
       ROUND(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, 6) AS f1_score,
       tn, fp, fn, tp
FROM c"""

ORACLE["class_report"] = _CONF + """,
m AS (SELECT CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) AS tp FROM c),
r AS (SELECT tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fn + fp) AS f0, tn + fp AS s0,
             tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS s1,
             (tp + tn) / (tp + tn + fp + fn) AS acc FROM m)
SELECT '0' AS class, ROUND(p0, 6) AS precision, ROUND(r0, 6) AS recall, ROUND(f0, 6) AS f1_score, CAST(s0 AS BIGINT) AS support FROM r
UNION ALL SELECT '1', ROUND(p1, 6), ROUND(r1, 6), ROUND(f1, 6), CAST(s1 AS BIGINT) FROM r
UNION ALL SELECT 'accuracy', NULL, NULL, ROUND(acc, 6), CAST(s0 + s1 AS BIGINT) FROM r
UNION ALL SELECT 'macro avg', ROUND((p0 + p1) / 2, 6), ROUND((r0 + r1) / 2, 6), ROUND((f0 + f1) / 2, 6), CAST(s0 + s1 AS BIGINT) FROM r
UNION ALL SELECT 'weighted avg', ROUND((p0 * s0 + p1 * s1) / (s0 + s1), 6), ROUND((r0 * s0 + r1 * s1) / (s0 + s1), 6),
                 ROUND((f0 * s0 + f1 * s1) / (s0 + s1), 6), CAST(s0 + s1 AS BIGINT) FROM r"""

_CUM = f"""
WITH s AS (SELECT value AS s, CAST(SUM({Y}) AS DOUBLE) AS pos, CAST(SUM(1 - {Y}) AS DOUBLE) AS neg
           FROM events WHERE value IS NOT NULL GROUP BY value),
c AS (SELECT s, pos, neg,
             SUM(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
             SUM(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
             SUM(neg) OVER (ORDER BY s ASC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS neg_below,
             SUM(pos) OVER () AS P, SUM(neg) OVER () AS N
      FROM s)"""

ORACLE["roc_auc"] = _CUM + """
SELECT ROUND(SUM(pos * (COALESCE(neg_below, 0) + neg / 2.0)) / (MAX(P) * MAX(N)), 6) AS roc_auc FROM c"""

ORACLE["avg_precision"] = _CUM + """
SELECT ROUND(SUM(pos / P * tp / (tp + fp)), 6) AS pr_auc FROM c"""

ORACLE["pr_curve"] = _CUM + """,
k AS (SELECT s, tp, fp, tp / (tp + fp) AS prec, tp / P AS rec FROM c)
SELECT ROUND(s, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, ROUND(prec, 6) AS precision,
       ROUND(rec, 6) AS recall, ROUND(2 * prec * rec / (prec + rec + 1e-10), 6) AS f1 FROM k"""

ORACLE["best_threshold"] = _CUM + """,
k AS (SELECT s, tp / (tp + fp) AS prec, tp / P AS rec FROM c),
f AS (SELECT s, prec, rec, 2 * prec * rec / (prec + rec + 1e-10) AS f1 FROM k)
SELECT ROUND(s, 6) AS threshold, ROUND(f1, 6) AS f1, ROUND(prec, 6) AS precision, ROUND(rec, 6) AS recall
FROM f ORDER BY f1 DESC, s ASC LIMIT 1"""

ORACLE["lift_gains"] = f"""
WITH r AS (SELECT {Y} AS y, RANK() OVER (ORDER BY value DESC) - 1 AS higher, COUNT(*) OVER () AS n,
                  SUM({Y}) OVER () AS P FROM events WHERE value IS NOT NULL),
b AS (SELECT CAST(FLOOR(10.0 * higher / n) + 1 AS INTEGER) AS bin, COUNT(*) AS rows, CAST(SUM(y) AS BIGINT) AS positives,
             MAX(P) AS P, MAX(n) AS n FROM r GROUP BY 1)
SELECT bin, rows, positives, ROUND(CAST(positives AS DOUBLE) / rows, 6) AS rate,
       ROUND((CAST(positives AS DOUBLE) / rows) / (CAST(P AS DOUBLE) / n), 6) AS lift,
       ROUND(CAST(SUM(positives) OVER (ORDER BY bin) AS DOUBLE) / P, 6) AS cum_capture
FROM b"""

ORACLE["capture_topx"] = " UNION ALL ".join(f"""
SELECT CAST({p}.0 AS DOUBLE) AS top_pct, MAX(k) AS flagged, CAST(SUM(CASE WHEN rn <= k THEN y ELSE 0 END) AS BIGINT) AS captured,
       ROUND(SUM(CASE WHEN rn <= k THEN y ELSE 0 END) / CAST(SUM(y) AS DOUBLE), 6) AS recall,
       ROUND(CASE WHEN MAX(k) = 0 THEN 0.0 ELSE SUM(CASE WHEN rn <= k THEN y ELSE 0 END) / CAST(MAX(k) AS DOUBLE) END, 6) AS precision
FROM (SELECT {Y} AS y, ROW_NUMBER() OVER (ORDER BY value DESC, event_id) AS rn,
             CAST(FLOOR(COUNT(*) OVER () * {p}.0 / 100.0) AS BIGINT) AS k FROM events WHERE value IS NOT NULL) t"""
                                            for p in (5, 10, 20))

ORACLE["risk_tier"] = """
WITH s AS (SELECT value / 100.0 AS score FROM events)
SELECT CASE WHEN score >= 0.5 THEN 'HIGH' WHEN score >= 0.25 THEN 'MEDIUM' WHEN score IS NOT NULL THEN 'LOW' END AS tier,
       COUNT(*) AS n, ROUND(AVG(score), 6) AS avg_score
FROM s GROUP BY 1"""

ORACLE["ranked_scores"] = """
SELECT event_id, user_id, event_type, ROUND(value / 100.0, 6) AS score,
       CAST(ROW_NUMBER() OVER (ORDER BY value DESC, event_id) AS INTEGER) AS rank
FROM events ORDER BY value DESC, event_id LIMIT 20"""

# X1 in SQL: each fired rule's rank = number of fired rules sorted before it (|value| asc, then rule order)
_RULES = [
    ("l_returnflag = 'R'", "Returned", 0.28),
    ("l_discount >= 0.08", "High Discount", 0.18),
    ("l_discount = 0.0", "No Discount", -0.12),
    ("l_quantity > 45", "Large Quantity", 0.15),
    ("l_quantity < 5", "Small Quantity", -0.08),
    ("l_tax > 0.06", "High Tax", 0.10),
    ("l_linenumber >= 6", "Late Line", 0.10),
]


def _x1_sql() -> str:
    parts = []
    for i, (cond, name, v) in enumerate(_RULES):
        before = [f"CASE WHEN {c2} THEN 1 ELSE 0 END" for j, (c2, _, v2) in enumerate(_RULES)
                  if abs(v2) < abs(v) or (abs(v2) == abs(v) and j < i)]
        rank = " + ".join(before) if before else "0"
        parts.append(f"SELECT '{name}' AS factor, CAST({rank} AS INTEGER) AS rank, COUNT(*) AS n "
                     f"FROM lineitem WHERE {cond} GROUP BY 2")
    none = " AND ".join(f"NOT ({c})" for c, _, _ in _RULES)
    parts.append(f"SELECT 'Baseline Factors', 0, COUNT(*) FROM lineitem WHERE {none} HAVING COUNT(*) > 0")
    return "\nUNION ALL\n".join(parts)


ORACLE["rule_contributions"] = _x1_sql()

ORACLE["rule_score"] = """
WITH s AS (SELECT LEAST(0.95, 0.05
  + CASE WHEN l_returnflag = 'R' THEN 0.25 ELSE 0.0 END + CASE WHEN l_discount >= 0.08 THEN 0.20 ELSE 0.0 END
  + CASE WHEN l_quantity > 45 THEN 0.15 ELSE 0.0 END + CASE WHEN l_tax > 0.06 THEN 0.10 ELSE 0.0 END
  + CASE WHEN l_linenumber >= 6 THEN 0.15 ELSE 0.0 END + CASE WHEN l_linestatus = 'O' THEN 0.08 ELSE 0.0 END
  + CASE WHEN l_quantity < 10 THEN 0.08 ELSE 0.0 END) AS score FROM lineitem)
SELECT ROUND(CAST(score AS DOUBLE), 6) AS score, COUNT(*) AS n FROM s GROUP BY 1"""

_REASONS = ["Career Change", "Compensation & Benefits", "Workplace Culture", "Lack of Career Growth",
            "Work-Life Balance", "Relocation", "Retirement", "Personal Reasons"]
_BOOST = {
    "Work-Life Balance": "(l_linestatus = 'O' OR l_quantity < 5)",
    "Compensation & Benefits": "l_extendedprice < 20000",
    "Lack of Career Growth": "l_linenumber > 4",
    "Workplace Culture": "l_discount = 0.0",
}


def _x3_sql() -> str:
    w = {r: (f"(0.125 + CASE WHEN {_BOOST[r]} THEN 0.4 ELSE 0.0 END)" if r in _BOOST else "0.125") for r in _REASONS}
    total = " + ".join(w[r] for r in _REASONS)
    cols = ", ".join(f"CAST({w[r]} AS DOUBLE) / ({total}) AS w{i}" for i, r in enumerate(_REASONS))
    sel = "\nUNION ALL\n".join(
        f"SELECT '{r.replace(chr(39), chr(39) * 2)}' AS category, ROUND(AVG(w{i}), 4) AS expected_share, "
        f"ROUND(SUM(w{i}), 4) AS expected_count FROM p" for i, r in enumerate(_REASONS))
    return f"WITH p AS (SELECT {cols} FROM lineitem)\n{sel}"


ORACLE["rule_distribution"] = _x3_sql()

ORACLE["tier_assignment"] = """
SELECT CASE WHEN l_returnflag = 'A' THEN 'Audit'
            WHEN l_returnflag = 'R' AND l_linenumber >= 4 THEN 'Return Manager'
            WHEN l_returnflag = 'R' AND l_linenumber = 3 THEN 'Return Executive'
            WHEN l_returnflag = 'R' THEN 'Return Representative'
            WHEN l_linenumber >= 4 THEN CASE WHEN l_quantity > 25 THEN 'Senior' ELSE 'Director' END
            WHEN l_linenumber = 3 THEN 'Specialist' ELSE 'Associate' END AS role,
       CASE l_linenumber WHEN 1 THEN 2000 WHEN 2 THEN 3500 WHEN 3 THEN 6000 WHEN 4 THEN 10000 WHEN 5 THEN 15000 ELSE 0 END AS band_low,
       COUNT(*) AS n
FROM lineitem GROUP BY 1, 2"""

_GROUPS = f"""
WITH e AS (SELECT {Y} AS y, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS p,
                  CASE WHEN user_id % 2 = 0 THEN 'even' WHEN user_id % 2 = 1 THEN 'odd' END AS g1,
                  CASE WHEN hour(ts) >= 12 THEN 'pm' WHEN hour(ts) < 12 THEN 'am' END AS g2 FROM events),
l AS (SELECT 'user_parity' AS attribute, g1 AS "group", y, p FROM e WHERE g1 IS NOT NULL
      UNION ALL SELECT 'hour_band', g2, y, p FROM e WHERE g2 IS NOT NULL),
g AS (SELECT attribute, "group", COUNT(*) AS count, COUNT(*) FILTER (WHERE p = 1) AS flagged,
             COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS tp, COUNT(*) FILTER (WHERE y = 1 AND p = 0) AS fn,
             COUNT(*) FILTER (WHERE y = 0 AND p = 1) AS fp, COUNT(*) FILTER (WHERE y = 0 AND p = 0) AS tn
      FROM l GROUP BY 1, 2),
m AS (SELECT attribute, "group", count, flagged, CAST(flagged AS DOUBLE) / count AS selection_rate,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS tpr,
             CASE WHEN fp + tn = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / (fp + tn) END AS fpr FROM g)"""

ORACLE["fairness_groups"] = _GROUPS + """
SELECT attribute, "group", count, flagged, ROUND(selection_rate, 6) AS selection_rate, ROUND(tpr, 6) AS tpr,
       ROUND(fpr, 6) AS fpr FROM m"""

ORACLE["parity_table"] = _GROUPS + """
SELECT attribute, "group", ROUND(selection_rate * 100, 6) AS selection_pct, ROUND(fpr * 100, 6) AS fpr_pct FROM m"""

ORACLE["fairness_audit"] = _GROUPS + """,
s AS (SELECT attribute,
        MAX(CASE WHEN "group" IN ('even', 'pm') THEN selection_rate END) AS sp,
        MAX(CASE WHEN "group" IN ('odd', 'am') THEN selection_rate END) AS sr,
        MAX(CASE WHEN "group" IN ('even', 'pm') THEN fpr END) AS fp_,
        MAX(CASE WHEN "group" IN ('odd', 'am') THEN fpr END) AS fr_ FROM m GROUP BY 1),
r AS (SELECT attribute, CASE WHEN COALESCE(sr, 0) > 0 THEN COALESCE(sp, 0) / sr ELSE 0.0 END AS ratio,
             ABS(COALESCE(fp_, 0) - COALESCE(fr_, 0)) AS gap FROM s)
SELECT attribute, ROUND(ratio, 6) AS disparate_impact_ratio, ROUND(gap, 6) AS fpr_difference,
       (ratio BETWEEN 0.8 AND 1.25) AS compliant_four_fifths FROM r"""

ORACLE["fairness_docs"] = """
WITH j AS (SELECT quality AS y, CASE WHEN n_chars >= 2000 THEN 1 ELSE 0 END AS p, lang
           FROM labels JOIN documents USING (doc_id) WHERE lang IS NOT NULL),
g AS (SELECT lang AS "group", COUNT(*) AS count, COUNT(*) FILTER (WHERE p = 1) AS flagged,
             COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS tp, COUNT(*) FILTER (WHERE y = 1 AND p = 0) AS fn,
             COUNT(*) FILTER (WHERE y = 0 AND p = 1) AS fp, COUNT(*) FILTER (WHERE y = 0 AND p = 0) AS tn FROM j GROUP BY 1),
m AS (SELECT "group", count, flagged, CAST(flagged AS DOUBLE) / count AS sel,
             CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS tpr,
             CASE WHEN fp + tn = 0 THEN 0.0 ELSE CAST(fp AS DOUBLE) / (fp + tn) END AS fpr FROM g),
s AS (SELECT MAX(CASE WHEN "group" = 'de' THEN sel END) AS sp, MAX(CASE WHEN "group" = 'en' THEN sel END) AS sr,
             MAX(CASE WHEN "group" = 'de' THEN fpr END) AS fp_, MAX(CASE WHEN "group" = 'en' THEN fpr END) AS fr_ FROM m),
r AS (SELECT CASE WHEN COALESCE(sr, 0) > 0 THEN COALESCE(sp, 0) / sr ELSE 0.0 END AS ratio,
             ABS(COALESCE(fp_, 0) - COALESCE(fr_, 0)) AS gap FROM s)
SELECT 'lang' AS attribute, "group", count, flagged, ROUND(sel, 6) AS selection_rate, ROUND(tpr, 6) AS tpr, ROUND(fpr, 6) AS fpr,
       ROUND(ratio, 6) AS disparate_impact_ratio, ROUND(gap, 6) AS fpr_difference,
       (ratio BETWEEN 0.8 AND 1.25) AS compliant_four_fifths
FROM m CROSS JOIN r"""


def _ks_sql(feature: str) -> str:
    return f"""
SELECT '{feature}' AS feature, ROUND(MAX(ABS(cr / tr - cc / tc)), 6) AS statistic,
       CAST(MAX(tr) AS BIGINT) AS n_ref, CAST(MAX(tc) AS BIGINT) AS n_cur
FROM (SELECT SUM(r) OVER (ORDER BY v) AS cr, SUM(c) OVER (ORDER BY v) AS cc, SUM(r) OVER () AS tr, SUM(c) OVER () AS tc
      FROM (SELECT CAST({feature} AS DOUBLE) AS v,
                   CAST(SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END) AS DOUBLE) AS r,
                   CAST(SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END) AS DOUBLE) AS c
            FROM events WHERE {feature} IS NOT NULL GROUP BY 1) a) b"""


ORACLE["drift_ks"] = _ks_sql("value") + "\nUNION ALL\n" + _ks_sql("user_id")

ORACLE["drift_chi2"] = """
WITH c AS (SELECT event_type AS v, SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END) + 1 AS o_r,
                  SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END) + 1 AS o_c
           FROM events WHERE event_type IS NOT NULL GROUP BY 1),
t AS (SELECT SUM(o_r) AS t_r, SUM(o_c) AS t_c, COUNT(*) AS k FROM c),
x AS (SELECT SUM(pow(o_r - (o_r + o_c) * t_r / (t_r + t_c), 2) / ((o_r + o_c) * t_r / (t_r + t_c))
               + pow(o_c - (o_r + o_c) * t_c / (t_r + t_c), 2) / ((o_r + o_c) * t_c / (t_r + t_c))) AS stat,
             MAX(k) - 1 AS dof FROM c CROSS JOIN t)
SELECT 'event_type' AS feature, ROUND(stat, 6) AS statistic, dof,
       ROUND(exp(-stat / 2) * (1 + stat / 2), 6) AS p_value, exp(-stat / 2) * (1 + stat / 2) < 0.05 AS drift_detected
FROM x"""


def _ks_p(stat: str, n: str, m: str) -> str:
    """Limiting series of the two-sample KS distribution with Stephens' factor."""
    lam = f"((sqrt({n} * {m} / ({n} + {m})) + 0.12 + 0.11 / sqrt({n} * {m} / ({n} + {m}))) * {stat})"
    series = f"list_sum([(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * {lam} * {lam}) FOR k IN range(1, 101)])"
    return f"(CASE WHEN {stat} <= 0 OR {lam} < 0.2 THEN CAST(1.0 AS DOUBLE) ELSE least(1.0, greatest(0.0, {series})) END)"


def _report_ks(feature: str) -> str:
    return f"""
SELECT '{feature}' AS feature, 'numerical' AS type, '{KS_NAME}' AS test_name, stat AS statistic, {_ks_p("stat", "n", "m")} AS p_value
FROM (SELECT MAX(ABS(cr / tr - cc / tc)) AS stat, MAX(tr) AS n, MAX(tc) AS m
FROM (SELECT SUM(r) OVER (ORDER BY v) AS cr, SUM(c) OVER (ORDER BY v) AS cc, SUM(r) OVER () AS tr, SUM(c) OVER () AS tc
      FROM (SELECT CAST({feature} AS DOUBLE) AS v,
                   CAST(SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END) AS DOUBLE) AS r,
                   CAST(SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END) AS DOUBLE) AS c
            FROM events WHERE {feature} IS NOT NULL GROUP BY 1) a) b)"""


_REPORT = " UNION ALL ".join(_report_ks(f) for f in ("value", "user_id", "event_id")) + f"""
UNION ALL SELECT 'event_type', 'categorical', '{CHI2_NAME}', statistic, p_value FROM (
WITH c AS (SELECT event_type AS v, SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END) + 1 AS o_r,
                  SUM(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END) + 1 AS o_c
           FROM events WHERE event_type IS NOT NULL GROUP BY 1),
t AS (SELECT SUM(o_r) AS t_r, SUM(o_c) AS t_c, COUNT(*) AS k FROM c),
x AS (SELECT SUM(pow(o_r - (o_r + o_c) * t_r / (t_r + t_c), 2) / ((o_r + o_c) * t_r / (t_r + t_c))
               + pow(o_c - (o_r + o_c) * t_c / (t_r + t_c), 2) / ((o_r + o_c) * t_c / (t_r + t_c))) AS stat FROM c CROSS JOIN t)
SELECT stat AS statistic, exp(-stat / 2) * (1 + stat / 2) AS p_value FROM x)"""

ORACLE["drift_report"] = f"""
SELECT feature, type, test_name, ROUND(statistic, 6) AS statistic, ROUND(p_value, 6) AS p_value, p_value < 0.05 AS drift_detected
FROM ({_REPORT})"""

ORACLE["drift_summary"] = f"""
SELECT COUNT(*) FILTER (WHERE p_value < 0.05) / CAST(COUNT(*) AS DOUBLE) >= {d(DRIFT_SHARE_LIMIT)} AS drift_detected,
       ROUND(100.0 * COUNT(*) FILTER (WHERE p_value < 0.05) / CAST(COUNT(*) AS DOUBLE), 6) AS drifting_features_percentage,
       COUNT(*) FILTER (WHERE p_value < 0.05) AS drifting_features_count, COUNT(*) AS total_features_checked
FROM ({_REPORT})"""


def _period_ks() -> str:
    return """
WITH b AS (SELECT o_totalprice AS v, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN NULL ELSE year(o_orderdate) END AS yr
           FROM orders WHERE o_totalprice IS NOT NULL),
periods AS (SELECT DISTINCT yr FROM b WHERE yr IS NOT NULL),
ref AS (SELECT v, COUNT(*) AS r FROM b WHERE yr IS NULL GROUP BY v),
cur AS (SELECT yr, v, COUNT(*) AS c FROM b WHERE yr IS NOT NULL GROUP BY yr, v),
u AS (SELECT p.yr, ref.v, ref.r, 0 AS c FROM ref CROSS JOIN periods p UNION ALL SELECT yr, v, 0, c FROM cur),
a AS (SELECT yr, v, CAST(SUM(r) AS DOUBLE) AS r, CAST(SUM(c) AS DOUBLE) AS c FROM u GROUP BY yr, v),
w AS (SELECT yr, SUM(r) OVER (PARTITION BY yr ORDER BY v) AS cr, SUM(c) OVER (PARTITION BY yr ORDER BY v) AS cc,
             SUM(r) OVER (PARTITION BY yr) AS tr, SUM(c) OVER (PARTITION BY yr) AS tc FROM a)
SELECT CAST(yr AS INTEGER) AS year, 'o_totalprice' AS feature, 'numerical' AS type, ROUND(MAX(ABS(cr / tr - cc / tc)), 6) AS statistic
FROM w GROUP BY yr"""


def _period_chi2() -> str:
    return """
WITH b AS (SELECT o_orderpriority AS v, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN NULL ELSE year(o_orderdate) END AS yr
           FROM orders WHERE o_orderpriority IS NOT NULL),
periods AS (SELECT DISTINCT yr FROM b WHERE yr IS NOT NULL),
ref AS (SELECT v, COUNT(*) AS r FROM b WHERE yr IS NULL GROUP BY v),
cur AS (SELECT yr, v, COUNT(*) AS c FROM b WHERE yr IS NOT NULL GROUP BY yr, v),
u AS (SELECT p.yr, ref.v, ref.r, 0 AS c FROM ref CROSS JOIN periods p UNION ALL SELECT yr, v, 0, c FROM cur),
cells AS (SELECT yr, v, CAST(SUM(r) + 1 AS DOUBLE) AS o_r, CAST(SUM(c) + 1 AS DOUBLE) AS o_c FROM u GROUP BY yr, v),
t AS (SELECT yr, SUM(o_r) AS t_r, SUM(o_c) AS t_c, COUNT(*) AS k FROM cells GROUP BY yr),
e AS (SELECT cells.yr, o_r, o_c, (o_r + o_c) * t_r / (t_r + t_c) AS e_r, (o_r + o_c) * t_c / (t_r + t_c) AS e_c, k
      FROM cells JOIN t ON cells.yr = t.yr),
y AS (SELECT yr, k, CASE WHEN k - 1 = 1 THEN ABS(o_r - e_r) - LEAST(0.5, ABS(o_r - e_r)) ELSE ABS(o_r - e_r) END AS dr,
             CASE WHEN k - 1 = 1 THEN ABS(o_c - e_c) - LEAST(0.5, ABS(o_c - e_c)) ELSE ABS(o_c - e_c) END AS dc, e_r, e_c FROM e)
SELECT CAST(yr AS INTEGER) AS year, 'o_orderpriority' AS feature, 'categorical' AS type,
       ROUND(CASE WHEN MAX(k) - 1 >= 1 THEN SUM(dr * dr / e_r + dc * dc / e_c) ELSE 0.0 END, 6) AS statistic
FROM y GROUP BY yr"""


ORACLE["drift_by_period"] = f"SELECT * FROM ({_period_ks()}) a\nUNION ALL\nSELECT * FROM ({_period_chi2()}) b"

ORACLE["perturb"] = """
SELECT COUNT(*) AS n, CAST(SUM(l_linenumber + 5) AS BIGINT) AS sum_linenumber,
       CAST(SUM(CAST(TRUNC(l_extendedprice * 0.85::DOUBLE) AS INTEGER)) AS BIGINT) AS sum_price_cut
FROM lineitem"""

ORACLE["relative_risk"] = f"""
WITH a AS (SELECT AVG(CASE WHEN l_discount >= 0.05 THEN {R} END) AS rate_exposed,
                  AVG(CASE WHEN NOT (l_discount >= 0.05) THEN {R} END) AS rate_unexposed,
                  COUNT(*) FILTER (WHERE l_discount >= 0.05) AS n_exposed,
                  COUNT(*) FILTER (WHERE NOT (l_discount >= 0.05)) AS n_unexposed FROM lineitem)
SELECT ROUND(rate_exposed, 6) AS rate_exposed, ROUND(rate_unexposed, 6) AS rate_unexposed, n_exposed, n_unexposed,
       ROUND(rate_exposed / rate_unexposed, 6) AS relative_risk FROM a"""

ORACLE["segment_rate"] = f"""
WITH a AS (SELECT AVG(CASE WHEN l_quantity > 40 AND l_tax < 0.02 THEN {R} END) AS segment_rate, AVG({R}) AS overall_rate,
                  COUNT(*) FILTER (WHERE l_quantity > 40 AND l_tax < 0.02) AS segment_n FROM lineitem)
SELECT ROUND(segment_rate, 6) AS segment_rate, ROUND(overall_rate, 6) AS overall_rate, segment_n,
       ROUND(segment_rate / overall_rate - 1.0, 6) AS relative_excess FROM a"""

ORACLE["pay_gap_by_level"] = """
WITH a AS (SELECT l_linenumber, AVG(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END) AS mean_pos,
                  AVG(CASE WHEN NOT (l_returnflag = 'R') THEN l_extendedprice END) AS mean_neg FROM lineitem GROUP BY 1)
SELECT l_linenumber, ROUND(mean_pos, 6) AS mean_pos, ROUND(mean_neg, 6) AS mean_neg,
       ROUND(mean_pos / mean_neg - 1.0, 6) AS relative_gap FROM a ORDER BY 1"""

ORACLE["rate_by_band"] = f"""
SELECT CASE WHEN l_quantity < 10 THEN 'a_0_9' WHEN l_quantity < 25 THEN 'b_10_24' WHEN l_quantity IS NOT NULL THEN 'c_25_up' END AS band,
       COUNT(*) AS total, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS positives, ROUND(AVG({R}) * 100.0, 2) AS rate_pct
FROM lineitem GROUP BY 1 ORDER BY 1"""

ORACLE["bottom_quartile"] = """
WITH r AS (SELECT l_linenumber, PERCENT_RANK() OVER (PARTITION BY l_linenumber ORDER BY l_extendedprice) AS pr FROM lineitem)
SELECT l_linenumber, COUNT(*) AS n, COUNT(*) FILTER (WHERE pr < 0.25) AS bottom_quartile_n FROM r GROUP BY 1 ORDER BY 1"""

_STATS = """
WITH st AS (SELECT COUNT(*) AS headcount, COUNT(*) FILTER (WHERE c_acctbal < 0) AS exits FROM customer),
top AS (SELECT o_orderpriority AS top_reason FROM orders WHERE o_orderpriority IS NOT NULL
        GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1),
b AS (SELECT headcount, exits, CAST(exits AS DOUBLE) / headcount * 100.0 AS rate, CAST(exits * 15000 AS DOUBLE) AS loss,
             CAST(15000 AS DOUBLE) AS avg_cost, top_reason FROM st CROSS JOIN top)"""

ORACLE["business_stats"] = _STATS + """
SELECT headcount, exits, ROUND(rate, 6) AS rate, ROUND(loss, 6) AS loss, ROUND(avg_cost, 6) AS avg_cost, top_reason FROM b"""


def _roi_sql(targets, rates) -> str:
    vals = ", ".join(f"({t}, CAST({s!r} AS DOUBLE))" for t in targets for s in rates)
    return _STATS + f""",
scen AS (SELECT * FROM (VALUES {vals}) v(target_pct, success_rate)),
j AS (SELECT CAST(target_pct AS INTEGER) AS target_pct, success_rate,
             CASE target_pct WHEN 5 THEN 0.35 WHEN 10 THEN 0.55 WHEN 15 THEN 0.70 WHEN 20 THEN 0.80 WHEN 25 THEN 0.85
                 WHEN 30 THEN 0.90 WHEN 35 THEN 0.93 WHEN 40 THEN 0.95 WHEN 45 THEN 0.97 WHEN 50 THEN 0.98 ELSE 0.80 END::DOUBLE AS recall,
             headcount, exits, avg_cost FROM scen CROSS JOIN b),
k AS (SELECT *, exits * recall AS captured, exits * recall * success_rate / 100.0 AS retained,
             exits * recall * success_rate / 100.0 * avg_cost AS gross,
             CAST(FLOOR(headcount * (target_pct / 100.0)) AS BIGINT) AS flagged FROM j)"""


ORACLE["roi_scenarios"] = _roi_sql([5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 60], [30.0, 50.0]) + """
SELECT target_pct, ROUND(success_rate, 6) AS success_rate, ROUND(recall, 6) AS recall, ROUND(captured, 6) AS captured,
       CAST(TRUNC(captured) AS BIGINT) AS captured_int, ROUND(retained, 6) AS retained, ROUND(gross, 6) AS gross, flagged,
       ROUND(CAST(flagged AS DOUBLE) * 1500.0, 6) AS intervention_cost, ROUND(gross - CAST(flagged AS DOUBLE) * 1500.0, 6) AS net,
       ROUND(CAST(exits * avg_cost AS DOUBLE), 6) AS direct_loss FROM k"""

ORACLE["roi_rows"] = _roi_sql([10, 20, 30], [30.0]) + """
SELECT target_pct, ROUND(success_rate, 6) AS success_rate, 'Direct Loss (No Action)' AS metric, ROUND(CAST(exits * avg_cost AS DOUBLE), 6) AS amount FROM k
UNION ALL SELECT target_pct, ROUND(success_rate, 6), 'Gross Savings', ROUND(gross, 6) FROM k
UNION ALL SELECT target_pct, ROUND(success_rate, 6), 'Net Value Generated', ROUND(GREATEST(0.0, gross - flagged * 1500.0), 6) FROM k"""


_DRIVER_SQL = [
    ("Return rate by order priority and line status", """
SELECT o.o_orderpriority, l.l_linestatus, COUNT(*) AS n FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY 1, 2"""),
    ("Mean quantity and price of returned and kept lines", """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned FROM lineitem GROUP BY 1"""),
    ("Return rate by line number", "SELECT l_linenumber FROM lineitem GROUP BY 1"),
    ("Finished orders by customer segment and priority (join)", """
SELECT c.c_mktsegment, o.o_orderpriority FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
WHERE o.o_orderstatus = 'F' GROUP BY 1, 2"""),
]

ORACLE["sql_file_reports"] = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS idx, '{t}' AS title, COUNT(*) AS n_rows FROM ({q}) t{i}" for i, (t, q) in enumerate(_DRIVER_SQL))

ORACLE["sql_file_report_rows"] = """
WITH r1 AS (
  SELECT o.o_orderpriority || '/' || l.l_linestatus AS row_key, COUNT(*) AS n,
         ROUND(AVG(CASE WHEN l.l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 2) AS rate_pct
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderpriority, l.l_linestatus
), r2 AS (
  SELECT CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS VARCHAR) AS row_key,
         ROUND(AVG(l_quantity), 2) AS avg_quantity, ROUND(AVG(l_extendedprice), 2) AS avg_price FROM lineitem GROUP BY 1
), r3 AS (
  SELECT CAST(l_linenumber AS VARCHAR) AS row_key, COUNT(*) AS total, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned,
         ROUND(AVG(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 2) AS rate_pct
  FROM lineitem GROUP BY 1
), r4 AS (
  SELECT c.c_mktsegment || '/' || o.o_orderpriority AS row_key, COUNT(*) AS n, ROUND(AVG(c.c_acctbal), 2) AS avg_acctbal
  FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey WHERE o.o_orderstatus = 'F' GROUP BY c.c_mktsegment, o.o_orderpriority
)
SELECT 1 AS idx, row_key, 'rate_pct' AS measure, CAST(rate_pct AS DOUBLE) AS value FROM r1
UNION ALL
SELECT 1 AS idx, row_key, 'n' AS measure, CAST(n AS DOUBLE) AS value FROM r1
UNION ALL
SELECT 2 AS idx, row_key, 'avg_quantity' AS measure, CAST(avg_quantity AS DOUBLE) AS value FROM r2
UNION ALL
SELECT 2 AS idx, row_key, 'avg_price' AS measure, CAST(avg_price AS DOUBLE) AS value FROM r2
UNION ALL
SELECT 3 AS idx, row_key, 'total' AS measure, CAST(total AS DOUBLE) AS value FROM r3
UNION ALL
SELECT 3 AS idx, row_key, 'returned' AS measure, CAST(returned AS DOUBLE) AS value FROM r3
UNION ALL
SELECT 3 AS idx, row_key, 'rate_pct' AS measure, CAST(rate_pct AS DOUBLE) AS value FROM r3
UNION ALL
SELECT 4 AS idx, row_key, 'n' AS measure, CAST(n AS DOUBLE) AS value FROM r4
UNION ALL
SELECT 4 AS idx, row_key, 'avg_acctbal' AS measure, CAST(avg_acctbal AS DOUBLE) AS value FROM r4"""

ORACLE["sql_report_join"] = """
SELECT c.c_mktsegment, o.o_orderpriority, COUNT(*) AS n, ROUND(AVG(c.c_acctbal), 2) AS avg_acctbal
FROM customer c INNER JOIN orders o ON c.c_custkey = o.o_custkey
WHERE o.o_orderstatus = 'F'
GROUP BY c.c_mktsegment, o.o_orderpriority
ORDER BY c.c_mktsegment, n DESC"""

ORACLE["json_metadata"] = ORACLE["scale_fit"]

ORACLE["csv_roundtrip"] = """
SELECT COUNT(*) AS n, ROUND(SUM(value), 4) AS sum_value, COUNT(*) FILTER (WHERE props IS NULL) AS null_props FROM events"""

# what a whole round trip must give: every row, none lost, none added
ORACLE["csv_roundtrip_rows"] = "SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS lost, CAST(0 AS BIGINT) AS added FROM events"

ORACLE["stream_score"] = ORACLE["risk_tier"]

ORACLE["metric_table_long"] = "\nUNION ALL\n".join(f"""
SELECT 't{t}' AS model, metric, ROUND(value, 6) AS value FROM (
  SELECT CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1_score,
         CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) AS tp
  FROM (SELECT COUNT(*) FILTER (WHERE {Y} = 0 AND value < {t}) AS tn, COUNT(*) FILTER (WHERE {Y} = 0 AND value >= {t}) AS fp,
               COUNT(*) FILTER (WHERE {Y} = 1 AND value < {t}) AS fn, COUNT(*) FILTER (WHERE {Y} = 1 AND value >= {t}) AS tp
        FROM events) c
) UNPIVOT (value FOR metric IN (accuracy, precision, recall, f1_score, tn, fp, fn, tp))""" for t in (25, 50, 75))

ORACLE["smote_counts"] = """
WITH c AS (SELECT quality, COUNT(*) - CAST(ROUND(COUNT(*) * 0.2) AS BIGINT) AS n_train
           FROM labels JOIN documents USING (doc_id) GROUP BY 1)
SELECT quality AS class, (SELECT MAX(n_train) FROM c) AS n, (SELECT MAX(n_train) FROM c) - n_train AS n_synthetic FROM c"""

# ST2: a daily window is emitted once the watermark (max event time - 1 day) passes its end
ORACLE["stream_window_drift"] = """
WITH cur AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS d, event_type AS v, COUNT(*) AS c
        FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2),
days AS (SELECT DISTINCT d FROM cur),
ref AS (SELECT event_type AS v, COUNT(*) AS r FROM events
        WHERE ts < TIMESTAMP '2024-01-08' AND event_type IS NOT NULL GROUP BY 1),
u AS (SELECT days.d, ref.v, ref.r, 0 AS c FROM ref CROSS JOIN days
      UNION ALL SELECT cur.d, cur.v, 0, cur.c FROM cur JOIN days ON cur.d = days.d),
cells AS (SELECT d, v, CAST(SUM(r) + 1 AS DOUBLE) AS o_r, CAST(SUM(c) + 1 AS DOUBLE) AS o_c FROM u GROUP BY d, v),
t AS (SELECT d, SUM(o_r) AS t_r, SUM(o_c) AS t_c, COUNT(*) AS k FROM cells GROUP BY d),
e AS (SELECT cells.d, o_r, o_c, (o_r + o_c) * t_r / (t_r + t_c) AS e_r, (o_r + o_c) * t_c / (t_r + t_c) AS e_c, k
      FROM cells JOIN t ON cells.d = t.d),
y AS (SELECT d, k, CASE WHEN k - 1 = 1 THEN ABS(o_r - e_r) - LEAST(0.5, ABS(o_r - e_r)) ELSE ABS(o_r - e_r) END AS dr,
             CASE WHEN k - 1 = 1 THEN ABS(o_c - e_c) - LEAST(0.5, ABS(o_c - e_c)) ELSE ABS(o_c - e_c) END AS dc, e_r, e_c FROM e),
x AS (SELECT d, SUM(dr * dr / e_r + dc * dc / e_c) AS stat, MAX(k) - 1 AS dof FROM y GROUP BY d)
SELECT d AS window_start, 'event_type' AS feature, ROUND(stat, 6) AS statistic, dof,
       ROUND(exp(-stat / 2) * (1 + stat / 2), 6) AS p_value, exp(-stat / 2) * (1 + stat / 2) < 0.05 AS drift_detected
FROM x"""

ORACLE["perturb_exact"] = """
WITH c AS (SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1),
v AS (SELECT CAST(ROUND(n * 0.4) AS BIGINT) AS moved FROM c WHERE event_type = 'view')
SELECT event_type, n + CASE WHEN event_type = 'click' THEN (SELECT moved FROM v)
                            WHEN event_type = 'view' THEN -(SELECT moved FROM v) ELSE 0 END AS n
FROM c"""

ORACLE["score_batch_facts"] = """SELECT COUNT(*) AS n, TRUE AS columns_kept, TRUE AS risk_in_range, TRUE AS prediction_fits FROM documents"""

ORACLE["artifacts_roundtrip"] = """SELECT COUNT(*) AS n, TRUE AS identical FROM documents"""

ORACLE["grid_search_facts"] = """
WITH c AS (SELECT quality, COUNT(*) - CAST(ROUND(COUNT(*) * 0.2) AS BIGINT) AS k FROM labels JOIN documents USING (doc_id) GROUP BY 1)
SELECT CAST(324 AS BIGINT) AS points, CAST(324 * 5 AS BIGINT) AS fits, CAST(5 AS BIGINT) AS folds, TRUE AS auc_in_range, TRUE AS best_is_first,
       CAST(SUM(k) AS BIGINT) AS n_oof, CAST(SUM(k) AS BIGINT) AS n_documents, TRUE AS p_in_range FROM c"""

ORACLE["explainer_roundtrip"] = """
WITH c AS (SELECT quality, COUNT(*) - CAST(ROUND(COUNT(*) * 0.2) AS BIGINT) AS k FROM labels JOIN documents USING (doc_id) GROUP BY 1)
SELECT (SELECT COUNT(*) FROM documents) AS n, TRUE AS identical, TRUE AS sum_rule_holds, LEAST(100, CAST(SUM(k) AS BIGINT)) AS n_background FROM c"""

ORACLE["tree_shapley_check"] = """SELECT COUNT(*) AS n, TRUE AS sum_rule_holds FROM documents"""

ORACLE["model_roundtrip"] = """
WITH c AS (SELECT quality, CAST(ROUND(COUNT(*) * 0.2) AS BIGINT) AS k FROM labels JOIN documents USING (doc_id) GROUP BY 1)
SELECT CAST(SUM(k) AS BIGINT) AS n, TRUE AS identical FROM c"""

ORACLE["stream_equals_batch"] = r"""
SELECT COUNT(*) AS n, CAST(SUM(len(string_split_regex(trim(text), '\s+'))) AS BIGINT) AS words, TRUE AS identical FROM documents"""

ORACLE["table_shape"] = """SELECT COUNT(*) AS n_rows, 11 AS n_cols FROM lineitem"""

ORACLE["feature_head"] = """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  l_extendedprice / (AVG(l_extendedprice) OVER (PARTITION BY l_linenumber) + 1e-5) AS price_ratio,
                  l_quantity / (CAST(l_linenumber AS DOUBLE) + 1.0) AS qty_ratio FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, ROUND(price_ratio, 6) AS price_ratio, ROUND(qty_ratio, 6) AS qty_ratio
FROM r ORDER BY l_orderkey, l_linenumber, l_partkey, price_ratio LIMIT 5"""

ORACLE["flagged_count"] = """
SELECT COUNT(*) FILTER (WHERE value >= 50) AS flagged, COUNT(*) AS total,
       ROUND(CAST(COUNT(*) FILTER (WHERE value >= 50) AS DOUBLE) / COUNT(*), 6) AS fraction FROM events"""

ORACLE["nearest_parts"] = """
WITH d AS (SELECT a.p_partkey, b.p_partkey AS near_partkey,
                  sqrt((CAST(a.p_size AS DOUBLE) - b.p_size) * (CAST(a.p_size AS DOUBLE) - b.p_size)
                       + (CAST(a.p_retailprice AS DOUBLE) - b.p_retailprice) * (CAST(a.p_retailprice AS DOUBLE) - b.p_retailprice)) AS distance
           FROM part a JOIN part b ON a.p_partkey <> b.p_partkey),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_partkey ORDER BY distance, near_partkey) AS place FROM d)
SELECT p_partkey, CAST(place AS INTEGER) AS place, near_partkey, ROUND(distance, 6) AS distance FROM r WHERE place <= 5"""

ORACLE["sql_runtime_errors"] = """
SELECT 1 AS idx, 'Lines by flag' AS title, COUNT(DISTINCT l_returnflag) AS n_rows, CAST(NULL AS VARCHAR) AS error FROM lineitem
UNION ALL SELECT 2, 'Quantity per line of no order', NULL, 'DIVIDE_BY_ZERO'
UNION ALL SELECT 3, 'A table that is not there', NULL, 'TABLE_OR_VIEW_NOT_FOUND'
UNION ALL SELECT 4, 'Orders by status', COUNT(DISTINCT o_orderstatus), NULL FROM orders"""

ORACLE["json_report"] = ORACLE["rate_by_two_keys"]

ORACLE["scored_export"] = """
SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN value >= 50 THEN 1 ELSE 0 END) AS BIGINT) AS flagged, TRUE AS identical FROM events"""

ORACLE["stream_window_ks"] = """
WITH cur AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS d, value AS v, COUNT(*) AS c FROM events WHERE value IS NOT NULL GROUP BY 1, 2),
ref AS (SELECT value AS v, COUNT(*) AS r FROM events WHERE ts < TIMESTAMP '2024-01-08' AND value IS NOT NULL GROUP BY 1),
u AS (SELECT days.d, ref.v, ref.r, 0 AS c FROM ref CROSS JOIN (SELECT DISTINCT d FROM cur) days UNION ALL SELECT d, v, 0, c FROM cur),
m AS (SELECT d, v, SUM(r) AS r, SUM(c) AS c FROM u GROUP BY d, v),
cum AS (SELECT d, SUM(r) OVER w AS cr, SUM(c) OVER w AS cc, SUM(r) OVER (PARTITION BY d) AS tr, SUM(c) OVER (PARTITION BY d) AS tc FROM m WINDOW w AS (PARTITION BY d ORDER BY v))
SELECT d AS window_start, 'value' AS feature, ROUND(MAX(ABS(CAST(cr AS DOUBLE) / tr - CAST(cc AS DOUBLE) / tc)), 6) AS statistic,
       CAST(MAX(tr) AS BIGINT) AS n_ref, CAST(MAX(tc) AS BIGINT) AS n_cur FROM cum GROUP BY d"""

_LINE_AVERAGE = "CASE {} WHEN 1 THEN 20000.0 WHEN 2 THEN 30000.0 WHEN 3 THEN 40000.0 WHEN 4 THEN 50000.0 WHEN 5 THEN 60000.0 ELSE 5000.0 END"

ORACLE["engineered_features"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       ROUND(l_extendedprice / (AVG(l_extendedprice) OVER (PARTITION BY l_linenumber) + 1e-5), 6) AS income_ratio_to_joblevel_avg,
       ROUND(l_quantity / (CAST(l_suppkey AS DOUBLE) + 1.0), 6) AS role_tenure_ratio
FROM lineitem"""

ORACLE["scoring_features"] = f"""
WITH r AS (SELECT l_linestatus, l_quantity / (CAST(l_suppkey AS DOUBLE) + 1.0) AS tenure,
                  l_extendedprice / (AVG(l_extendedprice) OVER (PARTITION BY l_linenumber) + 1e-5) AS batch,
                  l_extendedprice / {_LINE_AVERAGE.format("l_linenumber")} AS fixed_, l_extendedprice / {_LINE_AVERAGE.format("1")} AS first_
           FROM lineitem)
SELECT way, l_linestatus, COUNT(*) AS n, ROUND(AVG(ratio), 6) AS income_ratio, ROUND(MAX(t), 6) AS max_tenure
FROM (SELECT 'batch' AS way, l_linestatus, batch AS ratio, tenure AS t FROM r UNION ALL SELECT 'table', l_linestatus, fixed_, tenure FROM r
      UNION ALL SELECT 'no level', l_linestatus, first_, tenure FROM r
      UNION ALL SELECT 'none', l_linestatus, CAST(1.0 AS DOUBLE), CAST(0.5 AS DOUBLE) FROM r) GROUP BY 1, 2"""

ORACLE["onehot_indices"] = """
WITH v AS (SELECT DISTINCT 0 AS f, event_type AS value FROM events WHERE event_type IS NOT NULL
           UNION ALL SELECT DISTINCT 1, CAST(user_id AS VARCHAR) FROM events WHERE user_id IS NOT NULL),
k AS (SELECT f, value FROM (SELECT f, value, ROW_NUMBER() OVER (PARTITION BY f ORDER BY value) AS pos FROM v) WHERE pos > 1),
i AS (SELECT f, value, ROW_NUMBER() OVER (ORDER BY f, value) - 1 AS place FROM k)
SELECT event_id, concat_ws(',', a.place, b.place) AS places, (SELECT COUNT(*) FROM k) AS width
FROM events LEFT JOIN i a ON a.f = 0 AND a.value = event_type LEFT JOIN i b ON b.f = 1 AND b.value = CAST(user_id AS VARCHAR)"""

ORACLE["report_texts"] = """
SELECT o_orderkey, concat_ws('_', 'prio', o_orderpriority) AS dummy, o_orderstatus AS part, strftime(o_orderdate, '%Y-%m-%d') AS day,
       printf('%.2f%%', o_custkey / 1000.0 * 100.0) AS pct, '$' || format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)) AS money,
       ROUND(o_totalprice / (o_totalprice + o_custkey + 1.0), 6) AS share
FROM orders"""

ORACLE["drifting_features"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY feature) - 1 AS INTEGER) AS place, feature FROM ({_REPORT}) WHERE p_value < 0.05"""

ORACLE["sample_facts"] = """
SELECT LEAST(100, COUNT(*)) AS n, LEAST(100, COUNT(*)) AS n_distinct, LEAST(100, COUNT(*)) AS n_inside, LEAST(100, COUNT(*)) AS n_again,
       TRUE AS tenth_is_fair FROM events"""

ORACLE["optional_input"] = """
SELECT 'given' AS input, COUNT(*) AS n FROM supplier UNION ALL SELECT 'default', COUNT(*) FROM part"""
