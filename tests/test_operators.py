"""Operators on hand-made tables, against dense or plain computations and known answers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrat.operators import diversity as D
from quadrat.operators import graph, relational as R
from quadrat.operators import series as S
from quadrat.operators import space as G
from quadrat.operators import validation as V


def community(seed, plots=8, species=12):
    rng = np.random.default_rng(seed)
    m = rng.integers(1, 9, (plots, species)) * (rng.random((plots, species)) < 0.3)
    m[0], m[1] = 0, 0
    m[0, :3], m[1, 3:6] = (1, 2, 3), (4, 5, 6)  # two plots that share nothing
    for i in np.flatnonzero(m.sum(axis=1) == 0):
        m[i, 0] = 1
    return m.astype(float)


def long_form(spark, m):
    return spark.createDataFrame([(i, j, float(v)) for i, r in enumerate(m) for j, v in enumerate(r) if v], "plot long, species long, value double")


@pytest.mark.parametrize("seed", [0, 1])
def test_diversity_equals_dense(spark, seed):
    m = community(seed)
    df = long_form(spark, m)
    p = m / m.sum(axis=1, keepdims=True)
    for r in D.hill_numbers(df).collect():
        q = p[r["plot"]][p[r["plot"]] > 0]
        assert (r["q0"], r["q1"], r["q2"]) == pytest.approx((len(q), math.exp(-(q * np.log(q)).sum()), 1 / (q * q).sum()))
    jac = lambda a, b: 1 - ((a > 0) & (b > 0)).sum() / ((a > 0) | (b > 0)).sum()
    bray = lambda a, b: np.abs(a - b).sum() / (a + b).sum()
    for kind, f in (("jaccard", jac), ("bray", bray)):
        rows = D.dissimilarity(df, kind).collect()
        assert len(rows) == len(m) * (len(m) - 1) // 2 and all(r["d"] == pytest.approx(f(m[r["plot_a"]], m[r["plot_b"]])) for r in rows)
        assert next(r["d"] for r in rows if (r["plot_a"], r["plot_b"]) == (0, 1)) == 1
    h = np.sqrt(p)
    ss = ((h - h.mean(axis=0)) ** 2).sum(axis=1)
    assert {r["plot"]: r["lcbd"] for r in D.hellinger_lcbd(df).collect()} == pytest.approx(dict(enumerate(ss / ss.sum())))
    d2 = np.array([[jac(a, b) ** 2 for b in m] for a in m])
    pairs = D.dissimilarity(df, "jaccard").selectExpr("plot_a", "plot_b", "d * d d2")
    j = np.eye(len(m)) - 1 / len(m)
    g = -j @ d2 @ j / 2
    assert all(r["g"] == pytest.approx(g[r["plot_a"], r["plot_b"]], abs=1e-12) for r in D.gower_centred(pairs).collect())
    assert {r["plot"]: r["lcbd"] for r in D.lcbd_from_squared(pairs).collect()} == pytest.approx(dict(enumerate(np.diag(g) / np.trace(g))))
    axes = D.principal_coordinates(D.dissimilarity(df, "jaccard").selectExpr("plot_a", "plot_b", "sqrt(d) d"), 2).collect()
    w = np.sort(np.linalg.eigvalsh(-j @ np.sqrt(d2) @ j / 2))[::-1]
    for k in (1, 2):
        s = [r["score"] for r in axes if r["axis"] == k]
        assert sum(x * x for x in s) == pytest.approx(w[k - 1]) and max(s, key=abs) > 0
    for r in D.partition(df).collect():
        assert r["gamma"] == pytest.approx(r["alpha"] * r["beta"]) and r["beta"] >= 1 - 1e-9


def test_tree_measures(spark):
    edges = spark.createDataFrame([("r", None, 0.0), ("a", "r", 1.0), ("b", "r", 2.0), ("x", "a", 3.0), ("y", "a", 1.0), ("z", "b", 1.5)], "node string, parent string, length double")
    up = D.ancestors(edges)
    comm = spark.createDataFrame([(1, "x", 1.0), (1, "y", 1.0), (2, "x", 2.0), (2, "z", 1.0), (2, "y", 0.0), (3, "z", 1.0)], "plot long, species string, value double")
    assert {r["plot"]: r["pd"] for r in D.faith_pd(comm, up).collect()} == pytest.approx({1: 5.0, 2: 7.5, 3: 3.5})
    got = {r["plot"]: r["mpd"] for r in D.mean_pairwise(comm, up).collect()}
    assert got[1] == pytest.approx(4.0) and got[2] == pytest.approx(7.5) and got[3] is None
    assert {r["branch"]: r["y"] for r in D.branch_incidence(comm, up).collect()} == {"r": 3, "a": 2, "b": 2, "x": 2, "y": 1, "z": 2}
    with pytest.raises(ValueError):
        D.ancestors(spark.createDataFrame([("a", "b", 1.0), ("b", "a", 1.0)], "node string, parent string, length double"), 5)


def test_rarefaction_and_permutation(spark):
    m = community(3)
    df = long_form(spark, m)
    for r in D.rarefied(df, [1, 4, 1000]).collect():
        x = m[r["plot"]][m[r["plot"]] > 0].astype(int)
        n = int(x.sum())
        want = None if r["m"] > n else sum(1 - math.comb(n - k, r["m"]) / math.comb(n, r["m"]) for k in x.tolist())
        assert (r["q0"] is None or math.isnan(r["q0"])) if want is None else r["q0"] == pytest.approx(want)
    rows = D.permuted_lcbd(df, 19, 5).collect()
    assert len(rows) == len(m) and all(0.05 <= r["p"] <= 1 for r in rows)


def test_geometric_median(spark):
    assert D.geometric_median(np.array([[1.0, 0], [-1, 0], [0, 1], [0, -1]])) == pytest.approx([0, 0], abs=1e-6)
    x = np.random.default_rng(0).standard_normal((40, 3))
    m = D.geometric_median(x)
    cost = lambda y: np.linalg.norm(x - y, axis=1).sum()
    assert all(cost(m) <= cost(m + d) + 1e-9 for d in 1e-3 * np.vstack([np.eye(3), -np.eye(3)]))


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(20)] + [(7, 7), (200, 200), (None, 3)]
    label = {v: v for e in edges for v in e if None not in e}
    for _ in range(100):
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    got = graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(label) and {r["vertex"]: r["component"] for r in got} == label
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_overlaps_and_neighbours(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 100.0, 0.0), (3, 260.0, 0.0), (4, 10000.0, 0.0)], "id long, x double, y double")
    assert {r["id"]: r["component"] for r in G.overlap_components(p, 150.0).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    rng = np.random.default_rng(1)
    xy = np.vstack([rng.random((80, 2)), [[50.0, 50.0]]])
    q = spark.createDataFrame([(i, float(a), float(b), i % 3) for i, (a, b) in enumerate(xy)], "id long, x double, y double, fold int")
    d = np.linalg.norm(xy[:, None] - xy[None], axis=2)
    same = np.eye(len(xy), dtype=bool)
    assert {r["id"]: r["dist"] for r in G.nearest(q, q, 0.05).collect()} == pytest.approx(dict(enumerate(np.where(same, np.inf, d).min(axis=1))))
    fold = np.arange(len(xy)) % 3
    assert {r["id"]: r["dist"] for r in G.nearest(q, q, 0.05, unlike="fold").collect()} == pytest.approx(dict(enumerate(np.where(fold[:, None] == fold[None], np.inf, d).min(axis=1))))


def test_gridding(spark):
    rows = [("a", float(t), float(v)) for t, v in ((0, 1), (1, 3), (4, 0), (9, 5), (10, 7), (10, 9))] + [("b", 0.0, 1.0), ("b", 5.0, 2.0)] + [("a", 2.0, None), ("a", 3.0, float("nan"))]
    got = S.gridded(spark.createDataFrame(rows, "k string, t double, v double"), "k", "t", "v", 11).collect()
    want = np.interp(np.linspace(0, 10, 11), [0, 1, 4, 9, 10], [1, 3, 0, 5, 8])
    assert [r["g"] for r in sorted((r for r in got if r["k"] == "a"), key=lambda r: r["step"])] == pytest.approx(list(want))
    assert len(got) == 22 and all(r["g"] is None for r in got if r["k"] == "b")


def test_trend_and_curves(spark):
    rows = [(k, i, float(i * (1 if k else -2))) for k in (0, 1) for i in range(10)]
    got = {r["k"]: r for r in S.mann_kendall(spark.createDataFrame(rows, "k int, i int, v double"), "k", "i", "v").collect()}
    assert got[1]["s"] == 45 and got[1]["tau"] == 1 and got[0]["slope"] == -2 and got[0]["p"] < 0.001
    h = S.hilbert_order(3)
    assert sorted(h) == list(range(64)) and all(abs(a // 8 - b // 8) + abs(a % 8 - b % 8) == 1 for a, b in zip(h, h[1:]))
    assert S.serpentine_order(3) == [0, 1, 2, 5, 4, 3, 6, 7, 8]


def test_folds(spark):
    years = spark.createDataFrame([(i, 1995 + i % 7) for i in range(140)], "id int, y int")
    rows = V.time_folds(years, "id", "y", [1994, 1996, 1998, 2001]).collect()
    year = {r["id"]: r["y"] for r in years.collect()}
    for f in range(3):
        test = [year[r["id"]] for r in rows if r["fold"] == f and r["split"] == "test"]
        train = [year[r["id"]] for r in rows if r["fold"] == f and r["split"] == "train"]
        assert test and all(y < min(test) - 2 or y - 2 > max(test) for y in train) and len(test) + len(train) < 140
    assert V.packed_folds({"a": 9, "b": 5, "c": 4, "d": 1}, 2) == {"a": 0, "b": 1, "c": 1, "d": 0}
    g = V.grouped_kfold(spark.createDataFrame([(i, i % 11) for i in range(110)], "id int, g int"), "id", "g", 5)
    by = {}
    for r in g.collect():
        by.setdefault(r["id"] % 11, set()).add(r["fold"])
    assert all(len(f) == 1 for f in by.values()) and len({next(iter(f)) for f in by.values()}) == 5


def test_transform_and_back(spark):
    df = spark.createDataFrame([(float(x),) for x in np.random.default_rng(0).lognormal(1, 0.7, 500) - 2], "x double")
    lam = V.fit_lambda(df, "x")
    for value in (lam, 0.0, 2.0, 1.0):
        r = df.select("x", V.yeo_johnson_inverse(V.yeo_johnson(F.col("x"), value), value).alias("b")).collect()
        assert [x["b"] for x in r] == pytest.approx([x["x"] for x in r])
    assert -1 < lam < 1


def test_relational(spark):
    df = spark.createDataFrame([(1, 2.5, 3.5), (2, None, 1.0), (3, 2.5, 3.5)], "id int, x double, y double")
    assert [(r["step"], r["n"]) for r in R.filter_cascade(df, [("x", F.col("x").isNotNull()), ("id", F.col("id") > 1)]).collect()] == [("x", 2), ("id", 1)]
    assert {r["id"]: r["twice"] for r in R.repeated(df, ["x", "y"], "twice").collect()} == {1: True, 2: False, 3: True}
    assert df.where("id = 1").select(R.rounded_cell(F.col("x"), F.col("y"), 1.0).alias("c")).first()["c"] == "2_4"
    years = spark.createDataFrame([(2000,), (2004,)], "m int")
    got = R.nearest_year(spark.createDataFrame([(2002,), (2003,), (1990,)], "y int"), years, "y", "m").collect()
    assert sorted((r["y"], r["m"], r["delta"]) for r in got) == [(1990, 2000, 10), (2002, 2000, -2), (2003, 2004, 1)]
