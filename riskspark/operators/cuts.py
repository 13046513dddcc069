"""Exact choices of the k rows with the smallest seeded hash of their key, by cut values.

The rows are never sorted or shuffled: counts by the first 16 bits of the hash (a row per prefix) show in which prefix
the k-th row lies, counts by the next 16 bits narrow it down, and only the rows of that small range are ranked by
(hash, key). The result is one cut (hash, key) per part and target; a row belongs to the choice if its own
(hash, key) is not above the cut, which is a filter on the row alone, so it reads the same on every run. Rows
with equal keys share a cut and stay on one side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hashed_key(key_cols: Sequence[str], seed: int) -> Column:
    """(hash, key...) of a row, as rows are ordered here."""
    return F.struct(F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols]).alias("h"), *[F.col(c) for c in key_cols])


def hash_cuts(df: DataFrame, parts: Sequence[str], key_cols: Sequence[str], seed: int,
              targets: Sequence[Callable[[Column], Column]]) -> DataFrame:
    """(parts..., _cuts): an array of (target number, cut) per part, in target order. ``targets`` give the rank of
    the last chosen row from the number of rows of the part; a target of 0 has no cut."""
    parts = list(parts)
    base = df.select(*parts, hashed_key(key_cols, seed).alias("_k")).withColumn("_h", F.col("_k.h"))
    base = base.withColumns({"_p1": F.shiftright("_h", 48), "_p2": F.shiftright("_h", 32)})
    top = base.groupBy(*parts, "_p1").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    # at most 65,536 rows a part
    top = top.withColumns({"_n": F.sum("_c").over(w), "_end": F.sum("_c").over(w.orderBy("_p1"))})
    wanted = F.array(*[F.struct(F.lit(j).alias("j"), t(F.col("_n")).cast("long").alias("k")) for j, t in enumerate(targets)])
    top = top.withColumn("_t", F.explode(wanted)).select(*parts, "_p1", (F.col("_end") - F.col("_c")).alias("_before"), "_end", "_t.j", "_t.k")
    top = top.where((F.col("_before") < F.col("k")) & (F.col("k") <= F.col("_end"))).select(*parts, "_p1", "_before", "j", "k")

    def inside(border: DataFrame, prefix: str) -> DataFrame:
        b = border.select(*[F.col(p).alias(f"_b_{p}") for p in parts], F.col(prefix).alias("_b"), "_before", "j", "k")
        cond = base[prefix] == b["_b"]
        for p in parts:
            cond = cond & base[p].eqNullSafe(b[f"_b_{p}"])
        return base.join(b, cond).drop("_b", *[f"_b_{p}" for p in parts])

    w = Window.partitionBy(*parts, "j").orderBy("_p2")
    mid = inside(top, "_p1").groupBy(*parts, "j", "k", "_before", "_p2").agg(F.count(F.lit(1)).alias("_c"))
    mid = mid.withColumn("_end", F.col("_before") + F.sum("_c").over(w)).withColumn("_before", F.col("_end") - F.col("_c"))
    mid = mid.where((F.col("_before") < F.col("k")) & (F.col("k") <= F.col("_end"))).select(*parts, "_p2", "_before", "j", "k")
    last = inside(mid, "_p2").withColumn("_rank", F.row_number().over(Window.partitionBy(*parts, "j").orderBy("_k")))
    cuts = last.where(F.col("_rank") == F.col("k") - F.col("_before"))
    return cuts.groupBy(*parts).agg(F.sort_array(F.collect_list(F.struct("j", F.col("_k").alias("cut")))).alias("_cuts"))


def with_cuts(df: DataFrame, cuts: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``df`` with the cuts of each row's part (null where it has none); a small table on the right."""
    if not parts:
        return df.crossJoin(F.broadcast(cuts.agg(F.first("_cuts").alias("_cuts"))))  # one row
    right = cuts.select(*[F.col(p).alias(f"_c_{p}") for p in parts], "_cuts")
    cond = F.lit(True)
    for p in parts:
        cond = cond & df[p].eqNullSafe(right[f"_c_{p}"])
    return df.join(right, cond, "left").drop(*[f"_c_{p}" for p in parts])


def chosen(key_cols: Sequence[str], seed: int) -> Column:
    """Whether a row (after with_cuts, one target) is among the chosen."""
    return F.coalesce(hashed_key(key_cols, seed) <= F.col("_cuts")[0]["cut"], F.lit(False))
