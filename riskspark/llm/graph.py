"""Connected components by alternating large and small stars; every round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node on an edge (u, v); the label is the least node of its component. A hub's edges
    are aggregated before the shuffle; the least neighbours are written first, so that both sides of the joins back are
    plain tables and the planner can split a hub's rows over tasks."""
    cur = materialize(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(cur)
    while before[0]:
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large")
        floor = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "floor")
        small = large.join(floor, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        # a node's own link to its least neighbour is the row with v = m; the other rows link its other neighbours
        cur = materialize(small.filter("u != v").distinct(), "edges")
        now = _state(cur)
        if now == before:
            break
        before = now
    leaves = cur.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return leaves.union(cur.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
