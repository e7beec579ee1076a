import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quadrat.functions import special
from quadrat.operators import designs as G
from quadrat.operators import diversity as D
from quadrat.operators import images as I
from quadrat.operators import models as M
from quadrat.operators import rarefaction as R
from quadrat.operators import relational as L
from quadrat.operators import series as S
from quadrat.operators import validation as V
from quadrat.sources import runs


def test_special_functions(spark):
    xs = [0.3, 1.0, 2.5, 7.0, 40.0, 1e4, 1e7]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", special.lgamma(F.col("x")).alias("g"), special.digamma(F.col("x")).alias("d"), special.normal_cdf(F.col("x") / 10 - 1).alias("n"))
    for r in df.collect():
        assert r["g"] == pytest.approx(math.lgamma(r["x"]), rel=1e-10, abs=1e-11)
        h = r["x"] * 1e-4
        assert r["d"] == pytest.approx((math.lgamma(r["x"] + h) - math.lgamma(r["x"] - h)) / (2 * h), rel=1e-5, abs=1e-5)
        assert r["n"] == pytest.approx(0.5 * math.erfc(-(r["x"] / 10 - 1) / math.sqrt(2)), abs=1e-7)


def test_curves_by_enumeration(spark):
    """Rarefied species numbers are means over all subsets of plots."""
    from itertools import combinations

    plots = [{1, 2, 3}, {1, 4}, {2, 5, 6}, {1, 2}, {7}]
    rows = [(p, s) for p, own in enumerate(plots) for s in own]
    y = spark.createDataFrame(rows, "plot int, unit int").groupBy("unit").agg(F.count("*").alias("y")).withColumn("length", F.lit(1.0))
    n = spark.createDataFrame([(5,)], "n long")
    c = R.curve(R.spectrum(y, []), n, spark.createDataFrame([(m,) for m in (1, 2, 4, 5, 9)], "m long"), [])
    got = {r["m"]: r for r in c.collect()}
    for m in (1, 2, 4, 5):
        assert got[m]["q0"] == pytest.approx(np.mean([len(set().union(*x)) for x in combinations(plots, m)]))
    assert got[9]["q0"] > got[5]["q0"] and got[9]["method"] == "Extrapolation"


def test_coverage_sizes(spark):
    counts = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 9, 2), (2, 4, 3)], "plot int, y long, f long")
    got = {r["plot"]: (r["n"], r["m"]) for r in R.coverage_size(counts, ["plot"], 0.7).collect()}
    x, n = [1] * 5 + [2] * 3 + [9] * 2, 29
    cover = lambda m: 1 - sum(k / n * math.comb(n - k, m) / math.comb(n - 1, m) for k in x)
    assert got[1] == (n, next(m for m in range(1, n) if cover(m) >= 0.7)) and got[2][0] == 12


def test_images():
    rng = np.random.default_rng(2)
    x = rng.standard_normal(64)
    wide = np.linspace(-8, 8, 4096)
    whole = np.cumsum(np.exp(-wide * wide / 2) * np.cos(5 * wide)) * (wide[1] - wide[0])
    got = I.wavelet(x, 5)
    for scale in range(1, 6):  # the sum over the curve, one value at a time
        at = (np.arange(16 * scale + 1) / (scale * (wide[1] - wide[0]))).astype(int)
        f = whole[at[at < 4096]][::-1]
        full = [sum(x[i] * f[k - i] for i in range(64) if 0 <= k - i < len(f)) for k in range(64 + len(f) - 1)]
        d = np.diff(full) * math.sqrt(scale)
        spare = (len(d) - 64) / 2
        assert np.allclose(got[scale - 1], np.abs(d[math.floor(spare) : len(d) - math.ceil(spare)]))
    assert I.spectrogram(x).shape == (9, 17) and I.correlation_2d(x).shape == (2, 6, 6) and I.wavelet(x).shape == (24, 64)
    assert I.transition_field(np.ones(8)).tolist() == np.ones((8, 8)).tolist()
    with pytest.raises(ValueError):
        I.make_transform("nothing")


def test_hilbert_neighbours():
    for order in (1, 2, 3, 4):
        side, cells = 1 << order, S.hilbert_order(order)
        assert sorted(cells) == list(range(side * side)) and cells[0] == 0 and cells[-1] == side - 1
        assert all(abs(a // side - b // side) + abs(a % side - b % side) == 1 for a, b in zip(cells, cells[1:], strict=False))


def test_coordinates():
    rng = np.random.default_rng(4)
    p = rng.standard_normal((12, 3))
    d = np.sqrt(((p[:, None] - p[None]) ** 2).sum(axis=2))
    scores, shares, added = D.coordinates_of(d, 3)
    again = np.sqrt(((scores[:, None] - scores[None]) ** 2).sum(axis=2))
    assert added == 0 and np.allclose(again, d) and shares.sum() == pytest.approx(1)
    bent = d**2.5 / 9  # not Euclidean
    scores, shares, added = D.coordinates_of(bent, 12)
    again = np.sqrt(((scores[:, None] - scores[None]) ** 2).sum(axis=2))
    assert added > 0 and np.allclose(again, np.where(np.eye(12, dtype=bool), 0, bent + added), atol=1e-6)


def test_dense_matrices_are_refused_before_they_are_fetched(spark):
    pairs = spark.createDataFrame([(i, i + 1, 0.5) for i in range(40)], "plot_a long, plot_b long, d double")
    with pytest.raises(ValueError):
        D.principal_coordinates(pairs, 2, most=20)


def test_greedy_pairs(spark):
    rnd = random.Random(3)
    rows = [(a, b, round(rnd.choice([0.1, 0.2, 0.5, rnd.random()]), 3)) for a in range(25) for b in range(100, 130) if rnd.random() < 0.4]
    want, ua, ub = [], set(), set()
    for w, a, b in sorted(((w, a, b) for a, b, w in rows), reverse=True):
        if a not in ua and b not in ub:
            want.append((a, b, w))
            ua.add(a)
            ub.add(b)
    got = G.greedy_pairs(spark.createDataFrame(rows, "a int, b int, w double"), "a", "b", "w").collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert G.greedy_pairs(spark.createDataFrame([], "a int, b int, w double"), "a", "b", "w").count() == 0


def test_spaced_draw(spark):
    rnd = random.Random(1)
    rows = [(c, c * 1000 + i, rnd.random(), rnd.random(), i % 3, float((i % 3) * 2)) for c in range(3) for i in range(200)]
    p = spark.createDataFrame(rows, "cell int, id int, x double, y double, `class` int, weight double")
    got = G.spaced_draw(p, spark.createDataFrame([(0, 30), (1, 12), (2, 500)], "cell int, n int"), 0.05, 7).collect()
    at = {r[1]: r for r in rows}
    for c in range(3):
        own = [at[r["id"]] for r in got if r["cell"] == c]
        assert all((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 >= 0.05**2 for i, a in enumerate(own) for b in own[:i])
        assert len(own) == (30, 12, len(own))[c] and (c == 2 or [r[4] for r in own].count(2) > [r[4] for r in own].count(1))


def test_sparse_pairs():
    rng = np.random.default_rng(6)
    k = rng.standard_normal((9, 7))
    u, s, v = np.linalg.svd(k)
    x, z, strength = M.sparse_pairs(k, 1, 10, 10)[0]
    assert strength == pytest.approx(s[0]) and np.allclose(np.abs(x), np.abs(u[:, 0])) and np.allclose(np.abs(z), np.abs(v[0]))
    for x, z, _ in M.sparse_pairs(k, 3, 0.5, 0.5):
        assert np.abs(x).sum() <= 0.5 * 3 + 1e-6 and np.abs(z).sum() <= 0.5 * math.sqrt(7) + 1e-6 and np.linalg.norm(x) == pytest.approx(1)
    assert np.allclose(M.bounded(np.array([3.0, 0.1, 0.0]), 1.0), [1, 0, 0], atol=1e-3)


def test_components_equal_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((80, 5)) @ rng.standard_normal((5, 5))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double, d double, e double")
    got = np.array([r[1:] for r in sorted(tuple(r) for r in M.principal_components(df, "id", list("abcde"), 2).collect())])
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    w, v = np.linalg.eigh(np.corrcoef(x.T))
    want = z @ v[:, ::-1][:, :2]
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8)


def test_splines_and_smearing(spark):
    one = spark.range(1)
    i = [one.select(c.alias("v")).first()["v"] for c in V.ispline(F.lit(3.0), (0.0, 5.0, 10.0))]
    assert i == pytest.approx([0.6 * 1.4, 0.216, 0.0])
    assert [one.select(c.alias("v")).first()["v"] for c in V.ispline(F.lit(3.0), (2.0, 2.0, 2.0))] == [0.0, 0.0, 0.0]
    exact = one.select(V.smeared(F.lit(1.37), [-0.2, 0.1, 0.4], 0.5, 0.0, 90.0).alias("v")).first()["v"]
    table = V.smearing_table([-0.2, 0.1, 0.4], 0.5, -5.0, 9.0, 0.0, 90.0, 4097)
    assert one.select(V.from_table(F.lit(1.37), table, -5.0, 9.0, 0.0, 90.0).alias("v")).first()["v"] == pytest.approx(exact, rel=1e-4)
    assert one.select(V.from_table(F.lit(None).cast("double"), table, -5.0, 9.0, 0.0, 90.0).alias("v")).first()["v"] is None


def test_paired_tests(spark):
    from quadrat.operators.models import wilcoxon

    rng = np.random.default_rng(9)
    d = {"a": rng.normal(0.3, 1, 200).round(2), "b": rng.normal(0, 1, 60).round(1)}
    rows = [(k, float(x)) for k, v in d.items() for x in v]
    got = {r["k"]: r for r in V.paired_tests(spark.createDataFrame(rows, "k string, d double"), ["k"]).collect()}
    for k, v in d.items():
        t = v.mean() / (v.std(ddof=1) / math.sqrt(len(v)))
        assert got[k]["t"] == pytest.approx(t) and got[k]["p_w"] == pytest.approx(wilcoxon(pd.DataFrame({"d": v})), abs=1e-6)
        assert got[k]["p_t_family"] == pytest.approx(min(1, 2 * got[k]["p_t"])) and abs(got[k]["p_t"] - math.erfc(abs(t) / math.sqrt(2))) < 0.02


def test_refusals(spark):
    with pytest.raises(ValueError):
        L.resolve_targets(["x", "bad"], {}, {"bad"}, ["x", "bad"])
    with pytest.raises(ValueError):
        L.resolve_targets("s", {"s": ["gone"]}, set(), ["x"])
    t = spark.createDataFrame([(1, 2)], "id int, v int")
    with pytest.raises(KeyError):
        L.aligned([t], spark.createDataFrame([(1,), (2,)], "id int"), "id")
    with pytest.raises(ValueError):
        L.column_family(t, ["id"], ("gm_",), "median", "x_")


def test_runs(spark):
    seen = []
    out = runs.run_matrix(spark, ["a", "b", "c"], lambda j: seen.append(j) or (1 / 0 if j == "b" else None), lambda j: j == "c")
    assert {r["job"]: r["status"] for r in out.collect()} == {"a": "done", "b": "failed", "c": "skipped"} and seen == ["a", "b"]


def test_pixel_predictors(spark):
    from quadrat.operators import cubes as C

    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 3))
    rows = [(i % 2, [float(v) for v in r], float(r.sum()), i % 12 + 1) for i, r in enumerate(x)] + [(9, [1.0, 1.0, 1.0], 3.0, 1)]
    got = {r["k"]: r for r in C.pixel_predictors(spark.createDataFrame(rows, "k int, b array<double>, i double, m int"), "k", "b", "i", "m").collect()}
    own = x[::2]
    m = D.geometric_median(own)
    assert got[0]["gm_emad"] == pytest.approx(np.median(np.linalg.norm(own - m, axis=1))) and got[0]["obs_mean"] == pytest.approx(own.sum(axis=1).mean())
    djf = [r.sum() for i, r in enumerate(x) if i % 2 == 0 and i % 12 + 1 in (12, 1, 2)]
    assert got[0]["seas_djf"] == pytest.approx(np.median(djf)) and got[9]["gm_emad"] is None and got[9]["gm_count"] == 1
    pull = sum((own - m) / np.linalg.norm(own - m, axis=1)[:, None])
    assert np.linalg.norm(pull) < 1e-5  # the unit vectors to the points cancel out
