"""The fit of dissimilarities goes on until no coefficient has a way down."""

import numpy as np
import pytest

from quadrat.operators import models as M
from quadrat.plans import catalog


def way_down(d, x, n, beta):
    """How far the coefficients would go along the slope of the deviance within their bounds."""
    a = np.column_stack([np.ones(len(x)), x])
    eta = np.maximum(a @ beta, 1e-9)
    slope = a.T @ (n * ((1 - d) - d * np.exp(-eta) / -np.expm1(-eta))) / n.sum()
    return np.abs(beta - np.maximum(beta - slope, 0)).max()


def test_of_all_suppliers(spark, sf_dir):
    got = {r["term"]: r["beta"] for r in catalog.QUERIES["M19"](spark, sf_dir).collect()}
    t = catalog.Tables(spark, sf_dir)
    li, su = t.lineitem.select("l_suppkey", "l_partkey", "l_quantity").toPandas().astype(float), t.supplier.select("s_suppkey", "s_acctbal").toPandas().astype(float)
    c = li.pivot_table(index="l_suppkey", columns="l_partkey", values="l_quantity", aggfunc="sum", fill_value=0.0)
    c, x = c.to_numpy(), su.set_index("s_suppkey")["s_acctbal"].loc[c.index].to_numpy() / 10000
    i, j = np.triu_indices(len(c), 1)
    both = np.concatenate([np.minimum(c[k], c[k + 1 :]).sum(axis=1) for k in range(len(c) - 1)])
    d = 1 - 2 * both / (c.sum(axis=1)[i] + c.sum(axis=1)[j])
    assert way_down(d, np.abs(x[i] - x[j]), np.ones(len(d)), np.array([got["intercept"], got["dx"]])) < 1e-8


@pytest.mark.parametrize("beta", [(0.2, 3.0), (4.0, 0.0), (0.0, 2.5, 0.7)])
def test_coefficients_are_found(spark, beta):
    rng = np.random.default_rng(1)
    x = rng.random((300, len(beta) - 1))
    names = [f"x{k}" for k in range(x.shape[1])]
    eta = beta[0] + x @ np.array(beta[1:])
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, -np.expm1(-eta), strict=True)], ", ".join(f"{c} double" for c in [*names, "y"]))
    assert M.fit_dissimilarity(df, names, "y") == pytest.approx(list(beta), abs=1e-6)


def test_a_slope_below_zero_stays_at_its_bound(spark):
    x = np.linspace(0, 1, 200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, 0.9 - 0.5 * x, strict=True)], "dx double, y double")
    got = M.fit_dissimilarity(df, ["dx"], "y")
    assert got == pytest.approx([-np.log(1 - 0.65), 0.0], abs=1e-8)
