"""Shapley values of trees by their definition, for tests."""

import itertools
import math
from collections.abc import Sequence

import numpy as np


def expected(tree: dict, x: np.ndarray, fixed: frozenset, node: int = 0) -> np.ndarray:
    """v(S) for a batch: features in ``fixed`` follow the rows' values, others the cover average."""
    f = tree["feature"][node]
    if f < 0:
        return np.full(x.shape[0], tree["value"][node])
    lft, rgt = tree["left"][node], tree["right"][node]
    if f in fixed:
        go_left = x[:, f] <= tree["threshold"][node]
        return np.where(go_left, expected(tree, x, fixed, lft), expected(tree, x, fixed, rgt))
    cl, cr = tree["cover"][lft], tree["cover"][rgt]
    tot = cl + cr
    return (cl * expected(tree, x, fixed, lft) + cr * expected(tree, x, fixed, rgt)) / tot


def tree_shap_subsets(trees: Sequence[dict], weights: Sequence[float], x: np.ndarray) -> tuple[np.ndarray, float]:
    """Reference form for tests: Shapley average over all subsets of each tree's features."""
    n, d = x.shape
    phi = np.zeros((n, d))
    base = 0.0
    for tree, w in zip(trees, weights):
        used = sorted({int(f) for f in tree["feature"] if f >= 0})
        m = len(used)
        cache = {}
        for r in range(m + 1):
            for sub in itertools.combinations(used, r):
                cache[frozenset(sub)] = expected(tree, x, frozenset(sub))
        base += w * float(cache[frozenset()][0]) if n else 0.0
        for j in used:
            others = [f for f in used if f != j]
            for r in range(m):
                coef = math.factorial(r) * math.factorial(m - r - 1) / math.factorial(m)
                for sub in itertools.combinations(others, r):
                    s_ = frozenset(sub)
                    phi[:, j] += w * coef * (cache[s_ | {j}] - cache[s_])
    return phi, base
