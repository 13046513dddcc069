"""Small linear models over sparse rows, fitted inside a task on a bounded sample."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows: indexes and values one after the other, offsets by row."""

    def __init__(self, index: np.ndarray, value: np.ndarray, offsets: np.ndarray, dim: int):
        self.index, self.value, self.dim, self.n = index, value, dim, len(offsets) - 1
        self.row = np.repeat(np.arange(self.n), np.diff(offsets))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=self.value * w[self.index], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.index, weights=self.value * g[self.row], minlength=self.dim)

    def _norms(self) -> np.ndarray:
        return np.bincount(self.row, weights=self.value**2, minlength=self.n)

    def top_norm(self) -> float:
        return float(self._norms().max()) if self.n else 0.0

    def mean_norm(self, share: np.ndarray | None = None) -> float:
        """Mean squared length of the rows, by ``share`` (which sums to 1) or of equal rows: no eigenvalue of the mean
        outer product of the rows is above it, while a single long row hardly moves it."""
        if not self.n:
            return 0.0
        return float(self._norms().mean() if share is None else (share * self._norms()).sum())


def descend(gradient, dim: int, lipschitz: float, steps: int) -> np.ndarray:
    """Accelerated gradient descent from zero on a smooth convex function."""
    w = np.zeros(dim)
    look, t = w, 1.0
    for _ in range(steps):
        new = look - gradient(look) / lipschitz
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        look = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


def svm(rows: Rows, y: np.ndarray, weight: np.ndarray, reg: float, steps: int) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss; y is -1 or 1. (weights, intercept)"""
    share = weight / weight.sum()

    def gradient(wb):
        w, b = wb[:-1], wb[-1]
        gap = np.maximum(0, 1 - y * (rows.times(w) + b))
        g = -2 * share * y * gap
        return np.append(rows.back(g) + reg * w, g.sum())

    wb = descend(gradient, rows.dim + 1, 2 * (rows.top_norm() + 1) + reg, steps)
    return wb[:-1], float(wb[-1])


def logistic(rows: Rows, y: np.ndarray, weight: np.ndarray, reg: float, steps: int, left: Rows | None = None, right: Rows | None = None,
             balance: float = 0.0) -> tuple[np.ndarray, float]:
    """Logistic regression with the penalty balance * mean((w.left_i - w.right_i)^2) over pairs of rows; y is 0 or 1."""
    share = weight / weight.sum()
    pairs = left.n if left is not None and balance > 0 else 0

    def gradient(wb):
        w, b = wb[:-1], wb[-1]
        g = share * (1 / (1 + np.exp(-(rows.times(w) + b))) - y)
        out = rows.back(g) + reg * w
        if pairs:
            change = 2 * balance / pairs * (left.times(w) - right.times(w))
            out += left.back(change) - right.back(change)
        return np.append(out, g.sum())

    steep = 0.25 * (rows.mean_norm(share) + 1) + reg + (4 * balance * (left.mean_norm() + right.mean_norm()) if pairs else 0)
    wb = descend(gradient, rows.dim + 1, steep, steps)
    return wb[:-1], float(wb[-1])
