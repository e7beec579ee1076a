"""Chances and curves where counts are large."""

import math
from fractions import Fraction

import numpy as np

from quadrat.functions.hypergeometric import hypergeometric_of
from quadrat.operators import rarefaction as R


def exact(y, k, n, m):
    out = Fraction(math.comb(y, k))
    for i in range(k):
        out *= Fraction(m - i, n - i)
    for i in range(y - k):
        out *= Fraction(n - m - i, n - k - i)
    return float(out)


def test_hypergeometric():
    cases = [(y, k, n, m) for n in (7, 1000, 36_000_000) for m in {1, n // 1000, n // 2, n - 1} - {0} for y in (1, 2, 7, 30, 200) if y <= n for k in (0, 1, 3, y - 1, y) if max(0, m - n + y) <= k <= min(y, m)]
    got = hypergeometric_of(*np.array(cases, dtype=float).T)
    want = np.array([exact(*c) for c in cases])
    assert np.all(np.abs(got - want) <= 1e-12 * want)


def test_curve_of_many_individuals(spark):
    """Of 36 million individuals: q0 of half of them, and q1 beyond all, against exact fractions."""
    spec = [(y, 40_000 * (1 + y % 3)) for y in range(5, 35)]
    n = sum(y * f for y, f in spec)
    df = spark.createDataFrame([(y, f, float(f)) for y, f in spec], "y long, f long, l double")
    plots = spark.createDataFrame([(n,)], "n long")
    got = {r["m"]: r for r in R.curve(df, plots, R.sizes_table(plots, [], [0.5, 2.0]), []).collect()}
    m = n // 2
    assert abs(got[m]["q0"] - sum(f * (1 - exact(y, 0, n, m)) for y, f in spec)) < 1e-4
    # q1 of n less that of n - 1, with 60 digits
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    t = Decimal(n)
    q1 = (t.ln() - sum(f * y * Decimal(y).ln() for y, f in spec) / t).exp()
    e = sum(f * (Decimal(n - y) / n * y * Decimal(y).ln() + Decimal(y) / n * (y - 1) * Decimal(y - 1).ln()) for y, f in spec)
    r1 = ((t - 1).ln() - e / (t - 1)).exp()
    end = Decimal(R.asymptote(df, plots, []).first()["q1"])
    want = q1 + (end - q1) * (1 - (1 - (q1 - r1) / (end - r1)) ** n)
    assert abs(got[2 * n]["q1"] - float(want)) < 1e-3
