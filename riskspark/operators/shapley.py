"""Shapley values of a Spark GBT model per row (X6), as a ``mapInPandas`` job.

The fitted trees are turned into leaf paths: per leaf and feature on its path the interval (low, high] that a row's
value must lie in to follow every split, and the share of the cover that does. This table (an Explainer) is all that
is needed to explain rows: it is stored and loaded with the model and its background rows, and shipped with the task
closure (model parameters, bounded by trees x 2^maxDepth). Rows stay on the executors and are processed an Arrow batch
at a time; values and margin come from one pass over the leaves.

Values are the path-dependent (cover-weighted) Shapley values of the raw margin F(x) = sum_t w_t
tree_t(x): for each tree, v(S) fixes the features in S to the row's values and averages over the
other splits by node cover. v is a sum over leaves of per-feature products, so the Shapley values
come leaf by leaf from a small polynomial (no subset enumeration; deep trees stay polynomial).
Exact: per row, sum_j phi_j + E[F] = F(x).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType


def _flatten_tree(root) -> dict:
    """Driver side: one Java tree -> arrays (feature, threshold, left, right, value, cover)."""
    feats, thr, left, right, val, cover = [], [], [], [], [], []

    def visit(node) -> int:
        idx = len(feats)
        feats.append(-1)
        thr.append(0.0)
        left.append(-1)
        right.append(-1)
        val.append(float(node.prediction()))
        cover.append(float(node.impurityStats().rawCount()))
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            feats[idx] = int(split.featureIndex())
            thr[idx] = float(split.threshold())
            left[idx] = visit(node.leftChild())
            right[idx] = visit(node.rightChild())
        return idx

    visit(root)
    return {"feature": np.array(feats), "threshold": np.array(thr), "left": np.array(left),
            "right": np.array(right), "value": np.array(val), "cover": np.array(cover)}


def extract_gbt(model) -> tuple[list[dict], list[float]]:
    """Trees of a fitted GBTClassificationModel or BoostedTrees (continuous splits: x <= threshold goes left)."""
    from riskspark.operators.boosting import BoostedTrees

    if isinstance(model, BoostedTrees):
        kids = lambda tree: np.arange(len(tree["feature"])) * 2
        return [{**t, "left": kids(t) + 1, "right": kids(t) + 2} for t in model.trees], [1.0] * len(model.trees)
    trees = [_flatten_tree(t._call_java("rootNode")) for t in model.trees]
    return trees, [float(w) for w in model.treeWeights]


LEAF_PATHS = "tree int, leaf int, value double, feature int, low double, high double, share double"


@dataclass
class Explainer:
    """Leaf paths: (weighted leaf value, [(feature, low, high, cover share)]) by leaf."""
    leaves: list[tuple[float, list[tuple[int, float, float, float]]]]
    trees: list[int]  # the tree of each leaf

    @staticmethod
    def of(model) -> Explainer:
        """The leaf paths of a fitted model."""
        trees, weights = extract_gbt(model)
        return Explainer.from_trees(trees, weights)

    @staticmethod
    def from_trees(trees: Sequence[dict], weights: Sequence[float]) -> Explainer:
        leaves, numbers = [], []

        def walk(tree: dict, weight: float, number: int, node: int, path: dict) -> None:
            f = int(tree["feature"][node])
            if f < 0:
                leaves.append((weight * float(tree["value"][node]), [(k, *v) for k, v in path.items()]))
                numbers.append(number)
                return
            low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
            at, whole = float(tree["threshold"][node]), float(tree["cover"][node])
            for child, own in ((tree["left"][node], (low, min(high, at))), (tree["right"][node], (max(low, at), high))):
                part = float(tree["cover"][child]) / whole if whole > 0 else 0.0
                walk(tree, weight, number, int(child), {**path, f: (*own, share * part)})

        for number, (tree, weight) in enumerate(zip(trees, weights)):
            walk(tree, weight, number, 0, {})
        return Explainer(leaves, numbers)

    def batch(self, x: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
        """phi (rows x features), the expected margin E[F] and the rows' margins, exact, in O(leaves x depth^3) per row.

        For one leaf, the cover-weighted game is a product over the distinct features k on its path:
        g(S) = prod_k (O_k if k in S else Z_k), with O_k = 1 when the row's value lies in the leaf's interval of k and
        Z_k the share of the cover. Its Shapley value is
        phi_j = (O_j - Z_j) * sum_s w(s) [t^s] prod_{k != j} (Z_k + O_k t), w(s) = s!(d-s-1)!/d!,
        evaluated for all rows of the batch at once. The row's margin is the value of the leaves where all O_k are 1."""
        n, dim = x.shape
        phi, base, margin = np.zeros((n, dim)), 0.0, np.zeros(n)
        for value, path in self.leaves:
            d = len(path)
            # a missing value fails every "<=" and goes right
            inside = [~(x[:, f] <= low) & ((x[:, f] <= high) if high < math.inf else True) for f, low, high, _ in path]
            O = [o.astype(float) for o in inside]
            Z = [share for *_, share in path]
            base += value * math.prod(Z)
            margin += value * np.logical_and.reduce(inside) if d else value
            coef_w = np.array([math.factorial(s_) * math.factorial(d - s_ - 1) / math.factorial(d) for s_ in range(d)])
            for j in range(d):
                poly = np.zeros((n, d))
                poly[:, 0] = 1.0
                for k in range(d):
                    if k == j:
                        continue
                    nxt = poly * Z[k]
                    nxt[:, 1:] += poly[:, :-1] * O[k][:, None]
                    poly = nxt
                phi[:, path[j][0]] += value * (O[j] - Z[j]) * (poly @ coef_w)
        return phi, base, margin

    def rows(self) -> list[tuple]:
        """LEAF_PATHS rows; a leaf without splits has one row of feature -1."""
        return [(t, i, value, *p) for i, (t, (value, path)) in enumerate(zip(self.trees, self.leaves))
                for p in (path or [(-1, -math.inf, math.inf, 1.0)])]

    def save(self, spark: SparkSession, path: str, background: DataFrame | None = None) -> None:
        """IO8: the leaf paths as a table, and the background rows (M18) beside it."""
        spark.createDataFrame(self.rows(), LEAF_PATHS).coalesce(1).write.mode("overwrite").parquet(f"{path}/leaf_paths")
        if background is not None:
            background.coalesce(1).write.mode("overwrite").parquet(f"{path}/background")

    @staticmethod
    def load(spark: SparkSession, path: str) -> tuple[Explainer, DataFrame | None]:
        """What save() wrote: the explainer, and the background rows where there are any."""
        from riskspark.sources.io import optional_frame

        table = optional_frame(spark, f"{path}/leaf_paths", spark.read.schema(LEAF_PATHS).parquet)
        if table is None:
            raise FileNotFoundError(f"no explainer at {path}")
        leaves: dict[int, tuple[int, float, list]] = {}
        for r in sorted(table.collect(), key=lambda r: r.leaf):  # model parameters
            leaves.setdefault(r.leaf, (r.tree, r.value, []))[2].extend([(r.feature, r.low, r.high, r.share)] if r.feature >= 0 else [])
        own = Explainer([(value, p) for _, value, p in leaves.values()], [t for t, *_ in leaves.values()])
        return own, optional_frame(spark, f"{path}/background", spark.read.parquet)


def explain(df: DataFrame, explainer: Explainer, features_col: str, id_cols: Sequence[str]) -> DataFrame:
    """(ids..., shap array<double>, base double, margin double) per row via mapInPandas."""
    from pyspark.ml.functions import vector_to_array

    from riskspark.session import ship_package

    ship_package(df.sparkSession)
    id_fields = [df.schema[c] for c in id_cols]
    schema = StructType([*id_fields, StructField("shap", ArrayType(DoubleType())),
                         StructField("base", DoubleType()), StructField("margin", DoubleType())])
    arr = df.select(*id_cols, vector_to_array(F.col(features_col)).alias("_x"))

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            phi, base, margin = explainer.batch(np.vstack(pdf["_x"].to_numpy()).astype(float))
            out = pdf[list(id_cols)].copy()
            out["shap"] = list(phi)
            out["base"] = base
            out["margin"] = margin
            yield out

    return arr.mapInPandas(run, schema)


def tree_shapley(df: DataFrame, model, features_col: str, id_cols: Sequence[str]) -> DataFrame:
    """X6 for a fitted model: explain() by its leaf paths."""
    return explain(df, Explainer.of(model), features_col, id_cols)
