"""Exact k nearest neighbours of every row among all rows, as Spark joins over pivot cells.

1. Equal vectors become one point, which keeps its least k + 1 ids (no row needs more of them), so a vector that a third of
   all rows share is one point.
2. A point belongs to the cell of its nearest pivot (a bounded seeded draw of points); a cell is dealt into blocks of
   about ``block`` points by a hash.
3. The distances inside a point's own block bound its k-th neighbour's distance: its radius.
4. By the triangle inequality, cell j can hold a nearer point only if its distance bound is within the radius: d(p, pivot j) - (largest distance
   in the cell), (smallest one) - d(p, pivot j), and the distance to the border between both pivots' cells. A point visits
   the blocks of these cells only. Blocks with many visits are repeated, so no task gets more than VISITS of them.
5. The least (distance, id) pairs of all blocks are a point's, and its rows' without themselves.

Ties are broken by id. Rows without k others have fewer neighbours. Null vectors are left out; NaN makes no sense here.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskspark.session import cut_lineage, ship_package

MAX_PIVOTS = 256
BLOCK = 2000
VISITS = 20_000
SLACK = 1e-9  # of a bound, for rounding
PAIRS = 2_000_000  # distances that a task holds at once
FOUND = "pid long, found array<struct<distance:double,id:long>>"


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, dimension by dimension, so that a pair's is the same in any batch."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        total += (a[:, j][:, None] - b[:, j][None, :]) ** 2
    return np.sqrt(total)


def _nearest(queries: pd.DataFrame, points: pd.DataFrame, k: int) -> list[list[tuple[float, int]]]:
    """For each query the least k + 1 (distance, id) among the ids of the points."""
    sizes = points["ids"].map(len).to_numpy()
    owner, ids = np.repeat(np.arange(len(points)), sizes), np.concatenate(points["ids"].to_list())
    q, p = np.vstack(queries["x"].to_list()), np.vstack(points["x"].to_list())
    out, step = [], max(1, PAIRS // max(1, len(ids)))
    for i in range(0, len(q), step):
        for row in distances(q[i:i + step], p)[:, owner]:
            if len(row) > k + 1:
                near = np.flatnonzero(row <= np.partition(row, k)[k])
            else:
                near = np.arange(len(row))
            near = near[np.lexsort((ids[near], row[near]))][: k + 1]
            out.append([(float(row[n]), int(ids[n])) for n in near])
    return out


def knn(df: DataFrame, features_col: str, id_col: str, k: int = 5, pivots: int | None = None, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """(id_col, neighbours: array of (distance, id), nearest first) for each row of ``df``; ids are distinct longs."""
    from pyspark.ml.functions import vector_to_array

    spark = df.sparkSession
    ship_package(spark)
    rows = df.where(F.col(features_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vector_to_array(F.col(features_col)).alias("x"))
    firsts = rows.groupBy("x").agg(F.min("id").alias("pid"))
    member = cut_lineage(rows.join(firsts, "x"))
    # the k + 1 least ids of each point: the filter on the rank is taken before the shuffle, too, so a hot point's rows stay in their tasks
    ranked = member.withColumn("_rank", F.row_number().over(Window.partitionBy("pid").orderBy("id"))).where(F.col("_rank") <= k + 1)
    lists = ranked.groupBy("pid").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = cut_lineage(firsts.join(lists.select("pid", "ids"), "pid"))
    n = points.count()
    wanted = min(MAX_PIVOTS, max(1, -(-n // block))) if pivots is None else pivots
    chosen = points.orderBy(F.xxhash64("pid", F.lit(seed)), "pid").limit(wanted).select("x").collect()  # at most MAX_PIVOTS vectors
    if not chosen:
        return df.select(F.col(id_col).cast("long").alias(id_col)).limit(0).withColumn("neighbours", F.expr("cast(array() as array<struct<distance:double,id:long>>)"))
    centre = np.array([r.x for r in chosen], float)

    def place(batches):
        for pdf in batches:
            if len(pdf):
                d = distances(np.vstack(pdf["x"].to_list()), centre)
                pdf["cell"] = d.argmin(axis=1).astype("int32")
                pdf["own"] = d.min(axis=1)
                yield pdf

    placed = cut_lineage(points.mapInPandas(place, "x array<double>, pid long, ids array<long>, cell int, own double"))
    shape = {r.cell: r for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.min("own").alias("low"), F.max("own").alias("high")).collect()}  # a row a cell
    blocks = F.create_map(*[F.lit(v) for c, r in shape.items() for v in (int(c), int(-(-r["size"] // block)))])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("pid"), F.element_at(blocks, F.col("cell"))).cast("int"))

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pid": pdf["pid"], "found": _nearest(pdf, pdf, k)})

    first = cut_lineage(placed.groupBy("cell", "block").applyInPandas(inside, FOUND))
    radius = F.when(F.size("found") > k, F.element_at("found", -1)["distance"]).otherwise(F.lit(float("inf")))
    between = distances(centre, centre)
    low, high = (np.array([shape[c][f] if c in shape else empty for c in range(len(centre))]) for f, empty in (("low", np.inf), ("high", -np.inf)))
    counts = [int(-(-shape[c]["size"] // block)) if c in shape else 0 for c in range(len(centre))]

    def visits(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            d = distances(np.vstack(pdf["x"].to_list()), centre)
            own, r = pdf["cell"].to_numpy(), pdf["radius"].to_numpy()
            with np.errstate(divide="ignore", invalid="ignore"):
                border = np.nan_to_num((d**2 - d[np.arange(len(d)), own][:, None] ** 2) / (2 * between[own]), nan=0.0, posinf=0.0, neginf=0.0)
            bound = np.maximum(np.maximum(d - high[None, :], low[None, :] - d), border)
            bound[np.arange(len(d)), own] = 0.0
            row, cell = np.nonzero(bound <= (r * (1 + SLACK) + SLACK)[:, None])
            reach = [(i, c, b) for i, c in zip(row.tolist(), cell.tolist()) for b in range(counts[c]) if (c, b) != (own[i], pdf["block"].iat[i])]
            if reach:
                i, c, b = zip(*reach)
                yield pd.DataFrame({"pid": pdf["pid"].to_numpy()[list(i)], "x": pdf["x"].to_numpy()[list(i)], "cell": np.array(c, "int32"), "block": np.array(b, "int32")})

    seekers = placed.join(first.select("pid", radius.alias("radius")), "pid").select("pid", "x", "cell", "block", "radius")
    asked = cut_lineage(seekers.mapInPandas(visits, "pid long, x array<double>, cell int, block int"))
    loads = asked.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / VISITS).cast("int").alias("copies"))
    right = placed.join(loads, ["cell", "block"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).select("x", "ids", "cell", "block", "salt")
    left = asked.join(loads, ["cell", "block"]).withColumn("salt", F.pmod(F.xxhash64("pid"), F.col("copies")).cast("int")).drop("copies")

    def meet(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"pid": pd.Series([], dtype="int64"), "found": []})
        return pd.DataFrame({"pid": q["pid"], "found": _nearest(q, p, k)})

    key = ["cell", "block", "salt"]
    second = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(meet, FOUND)
    best = first.unionByName(second).groupBy("pid").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found"))
    out = member.select("id", "pid").join(best, "pid")
    return out.select(F.col("id").alias(id_col), F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k).alias("neighbours"))
