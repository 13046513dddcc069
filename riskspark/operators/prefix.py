"""Exact running sums over a global order without a single-task window (survey §4.3.1).

``Window.orderBy(v)`` with no partition key moves every row to one task. Instead:

1. the caller pre-aggregates to distinct (part..., v) rows (map-side combine, so a value held by
   a third of all rows is one row here);
2. bucket edges per part from mergeable quantile sketches of a small sample, merged in two steps;
3. each row finds its bucket by a binary search written as column expressions (log2(B) compares);
4. bucket totals -> exclusive prefix over the few buckets of a part (small table);
5. a window partitioned by (part, bucket) gives the running sum inside the bucket, plus the offset.

Edges only steer balance, never the result: any monotone bucket assignment gives the same sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import shuffle_partitions

BUCKET = "_bucket"
KLL_K = 1024


def default_buckets(df: DataFrame) -> int:
    # two buckets per shuffle partition: at cluster scale shuffle partitions are sized so that a
    # partition fits in executor memory, so a bucket (half of one) does too
    return max(2, 2 * shuffle_partitions(df.sparkSession))


def _bucket_column(tagged: DataFrame, v: Column, n_b: int) -> DataFrame:
    """Binary search for the number of edges strictly below v, one projection per level (log2 B
    compares per row). A probe past the end of the edge array is null, i.e. +inf."""
    levels = max(1, math.ceil(math.log2(max(2, n_b))))
    tagged = tagged.withColumn(BUCKET, F.lit(0))
    step = 2 ** (levels - 1)
    while step >= 1:
        probe = F.try_element_at(F.col("_edges"), (F.col(BUCKET) + F.lit(step)).cast("int"))
        tagged = tagged.withColumn(BUCKET, F.when(probe < v, F.col(BUCKET) + F.lit(step)).otherwise(F.col(BUCKET)))
        step //= 2
    return tagged


# a bucket is one window task's share of distinct rows; small parts keep one bucket
ROWS_PER_BUCKET = 20_000
SAMPLES_PER_BUCKET = 64


def assign_buckets(df: DataFrame, order_col: str, part_cols: Sequence[str] = (),
                   buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``_bucket`` (int): a monotone, balanced bucket of ``order_col`` within each part.

    Edges only steer balance, so they come from a small hash sample (SAMPLES_PER_BUCKET rows for each
    ``rows_per_bucket``), reduced to quantiles in two steps: by part and one of a few salts, then by part. A part
    gets about one bucket per ``rows_per_bucket`` rows, at most two per shuffle partition. An explicit ``buckets``
    (tests) samples every row. The edge table (a row for each part that the sample met) is joined as the planner
    sees fit, null-safe; parts that it lacks have one bucket."""
    n_b = buckets or default_buckets(df)
    parts = list(part_cols)
    v = F.col(order_col).cast("double")
    h = F.xxhash64(*parts, order_col)
    rows = df.where(v.isNotNull() & ~F.isnan(v))
    if buckets is None:
        share = min(1.0, SAMPLES_PER_BUCKET / rows_per_bucket)
        rows = rows.where(h < F.lit(min(2**63 - 1, round(share * 2**64) - 2**63)))
    sketch = rows.groupBy(*parts, F.pmod(h, F.lit(32)).alias("_salt")).agg(F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias("_sketch"))
    whole = sketch.groupBy(*parts).agg(F.kll_merge_agg_double("_sketch", F.lit(KLL_K)).alias("_sketch")).withColumn("_seen", F.kll_sketch_get_n_double("_sketch"))
    wanted = F.lit(n_b) if buckets else F.least(F.lit(n_b), F.ceil(F.col("_seen") / F.lit(SAMPLES_PER_BUCKET)).cast("int"))
    ranks = F.array(*[F.lit(i / n_b) for i in range(1, n_b)])
    stride = F.ceil(F.lit(float(n_b)) / F.greatest(F.lit(1), wanted)).cast("int")  # every stride-th of n_b - 1 edges
    edges = whole.select(*parts, F.when(F.col("_seen") > 0, F.array_distinct(F.filter(
        F.kll_sketch_get_quantile_double("_sketch", ranks), lambda x, i: (i + 1) % stride == 0))).alias("_edges"))
    if parts:
        right = edges.select(*[F.col(p).alias(f"_e_{p}") for p in parts], "_edges")
        cond = F.lit(True)
        for p in parts:
            cond = cond & df[p].eqNullSafe(right[f"_e_{p}"])
        tagged = df.join(right, cond, "left").drop(*[f"_e_{p}" for p in parts])
    else:
        tagged = df.crossJoin(F.broadcast(edges.agg(F.first("_edges").alias("_edges"))))  # one row of at most n_b doubles
    return _bucket_column(tagged, v, n_b).drop("_edges")


def running_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str], part_cols: Sequence[str] = (),
                 buckets: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """For rows distinct on (part_cols, order_col), add per sum column c:

    * ``cum_c``: sum of c over rows with order <= this row's (ascending, inclusive),
    * ``tot_c``: total of c in the part.
    """
    parts = list(part_cols)
    tagged = assign_buckets(df, order_col, parts, buckets, rows_per_bucket)
    # bucket totals: one row per non-empty (part, bucket)
    btot = tagged.groupBy(*parts, BUCKET).agg(*[F.sum(c).alias(f"_bt_{c}") for c in sum_cols])
    w_off = Window.partitionBy(*parts).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*parts)
    offsets = btot.select(
        *parts, BUCKET,
        *[F.coalesce(F.sum(f"_bt_{c}").over(w_off), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_bt_{c}").over(w_all).alias(f"tot_{c}") for c in sum_cols],
    )
    w_in = (Window.partitionBy(*parts, BUCKET).orderBy(F.col(order_col).asc())
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # global order: at most n_b offset rows, broadcast. With parts, the offsets join shares the
    # window's (part, bucket) partitioning, so a plain join adds no extra exchange of the big side.
    off = offsets.withColumnsRenamed({c: f"_o_{c}" for c in [*parts, BUCKET]})
    cond = tagged[BUCKET] == off[f"_o_{BUCKET}"]
    for p in parts:
        cond = cond & tagged[p].eqNullSafe(off[f"_o_{p}"])  # a null part is a part
    out = tagged.join(off if parts else F.broadcast(off), cond)
    return out.select(
        *[c for c in tagged.columns if c != BUCKET],
        *[(F.sum(c).over(w_in) + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"tot_{c}") for c in sum_cols],
    )
