"""p-values for the drift tests, evaluated on the tiny one-row-per-feature results.

The statistics themselves (KS distance, chi-square sum) are computed by Spark; only the
distribution tail is evaluated here, vectorised per Arrow batch through a pandas UDF.

* KS two-sample, two-sided, by the caller's choice of method, whatever the sample size: ``asymptotic`` (the
  default), the Kolmogorov limiting series with Stephens' small-sample factor, as a column expression; or
  ``exact``, the lattice-path probability, n * m steps in a pandas UDF.
* Chi-square upper tail for integer degrees of freedom in closed form (even: Poisson sum;
  odd: erfc plus a half-integer series), evaluated in log space so large dof do not underflow.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

KS_METHODS = ("asymptotic", "exact")
KS_TERMS = 100


def ks_exact_pvalue(d: float, n: int, m: int) -> float:
    """P(D >= d) for the two-sample KS statistic, both samples without ties, by counting
    monotone lattice paths from (0, 0) to (n, m) that stay strictly inside the band
    |i/n - j/m| < d. Row i is a masked prefix sum of row i-1; rows are rescaled to stay finite."""
    if n <= 0 or m <= 0:
        return 1.0
    if n < m:
        n, m = m, n
    g = math.gcd(n, m)
    a, b = m // g, n // g  # |i/n - j/m| = |i*a - j*b| / lcm
    lcm = n * a
    h = int(round(d * lcm))
    if h <= 0:
        return 1.0
    j = np.arange(m + 1, dtype=np.int64)
    row = np.zeros(m + 1)
    inside0 = np.abs(0 * a - j * b) < h
    # row 0: one path to every (0, j) while still inside the band
    row[:] = np.cumprod(inside0).astype(float)
    exp2 = 0
    for i in range(1, n + 1):
        inside = np.abs(i * a - j * b) < h
        # A(i,j) = A(i-1,j) + A(i,j-1) inside the band (an interval of j), zero outside, so
        # row i is the prefix sum of row i-1 restarted at the band's first cell
        lo = int(np.argmax(inside)) if inside.any() else m + 1
        if lo > m:
            return 1.0
        acc = np.cumsum(row)
        if lo > 0:
            acc -= acc[lo - 1]
        row = acc * inside
        top = row.max()
        if top <= 0:
            return 1.0
        if top > 2.0 ** 600:
            # rescale by an exact power of two so no rounding enters the count
            row = np.ldexp(row, -600)
            exp2 += 600
    inside_paths = row[m]
    if inside_paths <= 0:
        return 1.0
    # exact rational arithmetic for the normalisation by C(n+m, n)
    p_inside = Fraction(float(inside_paths)) * (Fraction(2) ** exp2) / math.comb(n + m, n)
    p = float(min(Fraction(1), max(Fraction(0), 1 - p_inside)))
    return p if p > 1e-6 else _ks_tail(h, n, m, a, b)


def _ks_tail(h: int, n: int, m: int, a: int, b: int) -> float:
    """A small P(D >= d), where 1 - P(inside) would be rounding noise: the sum over the first steps that leave the
    band |i*a - j*b| < h of (paths to the step inside the band) * (paths from there to the end)."""
    def log_comb(x: int, y: int) -> float:
        return math.lgamma(x + y + 1) - math.lgamma(x + 1) - math.lgamma(y + 1)

    total = log_comb(n, m)
    j = np.arange(m + 1, dtype=np.int64)
    row, exp2, p = np.zeros(m + 1), 0, 0.0
    before = None
    for i in range(n + 1):
        inside = np.abs(i * a - j * b) < h
        lo, hi = int(np.argmax(inside)), m - int(np.argmax(inside[::-1]))
        if before is None:
            row = np.where(inside, 1.0, 0.0)
        else:
            for k in range(before, lo):  # steps to the next i that end beyond the band's lower end
                if row[k] > 0:
                    p += math.exp(math.log(row[k]) + exp2 * math.log(2) + log_comb(n - i, m - k) - total)
            row[:lo] = 0.0
            row = np.cumsum(row) * inside
        if hi < m and row[hi] > 0:  # the step in j over the band's upper end
            p += math.exp(math.log(row[hi]) + exp2 * math.log(2) + log_comb(n - i, m - hi - 1) - total)
        before = lo
        if row.max() > 2.0 ** 600:
            row = np.ldexp(row, -600)
            exp2 += 600
    return min(1.0, p)


def ks_asymptotic_pvalue(d: float, n: int, m: int) -> float:
    """Kolmogorov limiting distribution with Stephens' correction of the effective size."""
    if n <= 0 or m <= 0 or d <= 0:
        return 1.0
    en = math.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 0.2:
        return 1.0
    total = 0.0
    for k in range(1, KS_TERMS + 1):
        term = 2.0 * (-1) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam)
        total += term
        if abs(term) < 1e-16:
            break
    return float(min(1.0, max(0.0, total)))


def ks_pvalue(d: float, n: int, m: int, method: str = "asymptotic") -> float:
    if d is None or n is None or m is None or (isinstance(d, float) and math.isnan(d)):
        return float("nan")
    return (ks_exact_pvalue if method == "exact" else ks_asymptotic_pvalue)(float(d), int(n), int(m))


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the chi-square distribution for integer dof."""
    if x is None or dof is None or dof <= 0 or (isinstance(x, float) and math.isnan(x)):
        return float("nan")
    if x <= 0:
        return 1.0
    half = x / 2.0
    if dof % 2 == 0:
        # Q = exp(-x/2) * sum_{k=0}^{dof/2-1} (x/2)^k / k!
        logs = [k * math.log(half) - half - math.lgamma(k + 1) for k in range(dof // 2)]
        base = 0.0
    else:
        # Q = erfc(sqrt(x/2)) + sum_{k=1}^{(dof-1)/2} (x/2)^(k-1/2) exp(-x/2) / Gamma(k+1/2)
        base = math.erfc(math.sqrt(half))
        logs = [(k - 0.5) * math.log(half) - half - math.lgamma(k + 0.5) for k in range(1, (dof - 1) // 2 + 1)]
    if logs:
        top = max(logs)
        series = math.exp(top) * sum(math.exp(v - top) for v in logs)
    else:
        series = 0.0
    return float(min(1.0, max(0.0, base + series)))


@F.pandas_udf(DoubleType())
def _ks_exact_udf(d: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
    return pd.Series([ks_pvalue(a, b, c, "exact") for a, b, c in zip(d, n, m)], dtype="float64")


@F.pandas_udf(DoubleType())
def _chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(a, int(b)) if pd.notna(b) else float("nan") for a, b in zip(x, dof)], dtype="float64")


def _ship() -> None:
    from riskspark.session import ship_package

    ship_package()


def ks_pvalue_col(d: Column | str, n: Column | str, m: Column | str, method: str = "asymptotic") -> Column:
    d, n, m = (F.col(x) if isinstance(x, str) else x for x in (d, n, m))
    if method not in KS_METHODS:
        raise ValueError(f"method is one of {KS_METHODS}, not {method!r}")
    if method == "exact":
        _ship()
        return _ks_exact_udf(d, n.cast("long"), m.cast("long"))
    n, m = n.cast("double"), m.cast("double")
    en = F.sqrt(n * m / (n + m))
    lam = (en + 0.12 + 0.11 / en) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0), lambda acc, k: acc + F.when(
        k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam))
    return F.when((n <= 0) | (m <= 0) | (d <= 0) | (lam < 0.2), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def chi2_sf_col(x: Column | str, dof: Column | str) -> Column:
    _ship()
    return _chi2_sf_udf(F.col(x) if isinstance(x, str) else x, (F.col(dof) if isinstance(dof, str) else dof).cast("long"))
