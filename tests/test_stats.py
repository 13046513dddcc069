"""p-values against values stored in the reference's sample drift report (1000 vs 470 rows)."""
import pytest

from riskspark.functions.stats import chi2_sf, ks_asymptotic_pvalue, ks_pvalue

KS_GOLDEN = [
    (0.028595744680851062, 0.947653919628235),
    (0.069, 0.0899044463375355),
    (0.08474468085106383, 0.018836646460749444),
    (0.1405531914893617, 5.612095036339555e-06),
    (0.01551063829787234, 0.9999968689490084),
    (0.005531914893617021, 1.0),
]


@pytest.mark.parametrize("d,p", KS_GOLDEN)
def test_ks_exact_matches_report(d, p):
    assert ks_pvalue(d, 1000, 470, "exact") == pytest.approx(p, rel=1e-9, abs=1e-12)


def test_ks_symmetric_and_large_sample_path():
    assert ks_pvalue(0.069, 470, 1000, "exact") == pytest.approx(ks_pvalue(0.069, 1000, 470, "exact"))
    p = ks_pvalue(0.01, 20000, 30000)  # asymptotic branch
    assert 0.0 < p < 1.0
    assert p == ks_asymptotic_pvalue(0.01, 20000, 30000)


@pytest.mark.parametrize("x,dof,p", [
    (9.602315444353492, 2, 0.008220224801474519),
    (4.818634230758462, 2, 0.08987664900223491),
    (1.6587577976502441, 5, 0.894054058296492),
    (0.00011620257844608408, 1, 0.9913991864522801),
    (1.82736082633, 4, 0.76747290172),
])
def test_chi2_sf(x, dof, p):
    assert chi2_sf(x, dof) == pytest.approx(p, rel=1e-9)


def test_chi2_large_dof_no_underflow():
    assert chi2_sf(1500.0, 1500) == pytest.approx(0.49, abs=0.02)


def test_small_exact_tails_are_counted_directly():
    from fractions import Fraction
    from math import comb

    from riskspark.functions.stats import ks_exact_pvalue

    def count(d, n, m):  # paths that leave the band, by exact integers
        inside = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n + 1):
            for j in range(m + 1):
                if abs(Fraction(i, n) - Fraction(j, m)) < d:
                    inside[i][j] = 1 if i == j == 0 else (inside[i - 1][j] if i else 0) + (inside[i][j - 1] if j else 0)
        return float(1 - Fraction(inside[n][m], comb(n + m, n)))

    for n, m, d in ((60, 40, Fraction(7, 10)), (50, 50, Fraction(4, 5)), (80, 30, Fraction(2, 3)), (40, 60, Fraction(9, 10)), (30, 30, Fraction(1))):
        assert ks_exact_pvalue(float(d), n, m) == pytest.approx(count(d, n, m), rel=1e-9)
    tails = [ks_exact_pvalue(d, 1000, 470) for d in (0.3, 0.5, 0.7)]
    assert tails[0] > 1e3 * tails[1] > 1e6 * tails[2] > 0


def test_method_does_not_depend_on_the_sample_size(spark):
    from riskspark.functions.stats import ks_pvalue_col

    df = spark.createDataFrame([(0.05, 10_000, 5_000), (0.05, 10_001, 5_000), (0.001, 50, 60), (0.3, 100, 100)], "d double, n long, m long")
    got = [r.p for r in df.select(ks_pvalue_col("d", "n", "m").alias("p")).collect()]
    assert got == pytest.approx([ks_asymptotic_pvalue(r.d, r.n, r.m) for r in df.collect()], rel=1e-12)
    with pytest.raises(ValueError):
        ks_pvalue_col("d", "n", "m", "auto")
