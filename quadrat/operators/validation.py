"""Folds without leakage, scores of predictions, and their transformation back."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrat.functions.special import normal_cdf
from quadrat.operators.relational import pair_join
from quadrat.scratch import drop_scratch, materialize


def leave_one_group_out(df: DataFrame, key: str, group: str, least: int, most: int = 10_000) -> DataFrame:
    """(fold, held_out, key, split): each group of at least `least` rows is a test fold, in sorted order.

    The result has a row for each row and fold, so more than `most` folds are refused; they are counted
    before they are broadcast.
    """
    own = df.groupBy(group).agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    if own.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} groups")
    g = own.withColumn("fold", F.row_number().over(Window.orderBy(group)) - 1)
    big = g.select("fold", F.col(group).cast("string").alias("held_out"), F.col(group).alias("_g"))
    return df.select(key, group).crossJoin(F.broadcast(big)).select("fold", "held_out", key, F.when(F.col(group) == F.col("_g"), "test").otherwise("train").alias("split"))


def packed_folds(sizes: dict, k: int) -> dict:
    """Groups to k folds, largest first to the smallest fold; ties by the order of keys and folds."""
    load, out = [0] * k, {}
    for g in sorted(sizes, key=lambda g: (-sizes[g], str(g))):
        f = min(range(k), key=lambda i: (load[i], i))
        out[g], load[f] = f, load[f] + sizes[g]
    return out


def grouped_kfold(df: DataFrame, key: str, group: str, k: int = 5, most: int = 1_000_000) -> DataFrame:
    """(key, fold): whole groups in folds of even size.

    The greedy step needs all groups in order, so their sizes come to the driver; more than `most` groups
    are refused (hash them to fewer first).
    """
    g = df.groupBy(group).agg(F.count("*").alias("n"))
    rows = g.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many groups")
    folds = packed_folds({r[group]: r["n"] for r in rows}, k)
    table = df.sparkSession.createDataFrame(list(folds.items()), f"{group} {df.schema[group].dataType.simpleString()}, fold int")
    return df.select(key, group).join(table, group).select(key, "fold")


def random_kfold(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """(key, fold) by a digest of the key: no order of all rows is needed; folds are even up to chance."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return df.select(key, (h % k).cast("int").alias("fold"))


def time_folds(df: DataFrame, key: str, year: str, edges: list[int], reach: int = 2) -> DataFrame:
    """(fold, key, split): each block (lo, hi] of years is a test fold; rows whose window year-reach..year meets a test window have no row.

    The blocks are a handful, so each row looks them up in its own expressions.
    """
    blocks = F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))])
    y = F.col(year)
    spans = df.select(F.explode(blocks).alias("b"), y.alias("y")).where((F.col("y") > F.col("b.lo")) & (F.col("y") <= F.col("b.hi"))).groupBy(F.col("b.fold").alias("fold")).agg((F.min("y") - reach).alias("w0"), F.max("y").alias("w1"))
    rows = df.select(F.col(key), y.alias("y"), F.explode(blocks).alias("b")).select(key, "y", F.col("b.fold").alias("fold"), ((F.col("y") > F.col("b.lo")) & (F.col("y") <= F.col("b.hi"))).alias("test"))
    out = rows.join(F.broadcast(spans), "fold").where(F.col("test") | (F.col("y") < F.col("w0")) | (F.col("y") - reach > F.col("w1")))
    return out.select("fold", key, F.when(F.col("test"), "test").otherwise("train").alias("split"))


def scores(df: DataFrame, by: list[str], obs: str = "obs", pred: str = "pred") -> DataFrame:
    """n, r2, rmse, nrmse (by the range from the 1st to the 99th percentile), mae, bias and pearson of each group; null below three."""
    e = F.col(pred) - F.col(obs)
    ok = df.where(F.col(obs).isNotNull() & F.col(pred).isNotNull())
    g = ok.groupBy(*by).agg(F.count("*").alias("n"), F.avg(e * e).alias("_mse"), F.var_pop(obs).alias("_v"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"), F.expr(f"percentile({obs}, array(0.01, 0.99))").alias("_p"), F.corr(obs, pred).alias("pearson"))
    keep = lambda c: F.when(F.col("n") >= 3, c)
    rmse, span = F.sqrt("_mse"), F.col("_p")[1] - F.col("_p")[0]
    return g.select(*by, "n", keep(1 - F.col("_mse") / F.when(F.col("_v") > 0, F.col("_v"))).alias("r2"), keep(rmse).alias("rmse"), keep(rmse / F.when(span > 0, span)).alias("nrmse"), keep(F.col("mae")).alias("mae"), keep(F.col("bias")).alias("bias"), keep(F.col("pearson")).alias("pearson"))


def spearman(df: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """(by, rho): Pearson's correlation of average ranks."""
    ranked = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    for c in (a, b):
        w, ties = Window.partitionBy(*by).orderBy(c), Window.partitionBy(*by, c)
        ranked = ranked.withColumn(f"_r{c}", F.rank().over(w) + (F.count("*").over(ties) - 1) / 2)
    return ranked.groupBy(*by).agg(F.corr(f"_r{a}", f"_r{b}").alias("rho"))


def spearman_of_all(df: DataFrame, a: str, b: str, buckets: int = 1024) -> tuple[int, float | None]:
    """(rows, rho) of Pearson's correlation of average ranks over the whole table, however often a value occurs.

    Pairs of values are counted first.  Ranks come from counts of the buckets before, of equal width, and an
    order within a bucket; those of b are added up for each a, so only a's values are ranked after that.
    """
    def ranked(t: DataFrame, c: str) -> DataFrame:
        """t (c, _c rows each) with the average rank _r of c among all rows."""
        ends = t.agg(F.min(c).alias("lo"), F.max(c).alias("hi")).first()
        width = (ends["hi"] - ends["lo"]) or 1.0
        t = t.withColumn("_b", F.floor((F.col(c) - ends["lo"]) / width * (buckets - 1)).cast("int"))
        w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        before = t.groupBy("_b").agg(F.sum("_c").alias("_s")).select("_b", F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_s"))
        upto = F.sum("_c").over(Window.partitionBy("_b").orderBy(c))  # with all of the same value
        return t.join(F.broadcast(before), "_b").withColumn("_r", F.col("_s") + upto - (F.col("_c") - 1) / 2).drop("_b", "_s")

    own = materialize(df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b")).agg(F.count("*").alias("_n")), "ranks")
    n = own.agg(F.sum("_n")).first()[0] or 0
    if n == 0:
        return 0, None
    of_b = materialize(ranked(own.groupBy("b").agg(F.sum("_n").alias("_c")), "b"), "ranks")
    mean = (n + 1) / 2
    sb = of_b.agg(F.sum(F.col("_c") * (F.col("_r") - mean) * (F.col("_r") - mean))).first()[0]
    of_a = own.join(of_b.select("b", "_r"), "b").groupBy("a").agg(F.sum("_n").alias("_c"), F.sum(F.col("_n") * (F.col("_r") - mean)).alias("_t"))
    r = ranked(of_a, "a").withColumn("_r", F.col("_r") - mean).agg(F.sum(F.col("_c") * F.col("_r") * F.col("_r")).alias("sa"), F.sum(F.col("_t") * F.col("_r")).alias("ab")).first()
    drop_scratch(own)
    drop_scratch(of_b)
    return n, r["ab"] / (r["sa"] * sb) ** 0.5 if r["sa"] * sb > 0 else None


def imputed(df: DataFrame, train: Column, cols: list[str]) -> DataFrame:
    """df with cols imputed by the training median, an indicator `<c>_isna`, and scaled by training moments (sd 1 where it is next to nothing)."""
    t = df.where(train)
    med = t.agg(*[F.expr(f"percentile({c}, 0.5)").alias(f"_m{c}") for c in cols])
    filled = df.crossJoin(F.broadcast(med)).withColumns({f"{c}_isna": F.col(c).isNull().cast("double") for c in cols}).withColumns({c: F.coalesce(c, f"_m{c}") for c in cols})
    s = filled.where(train).agg(*[F.avg(c).alias(f"_a{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s{c}") for c in cols])
    out = filled.crossJoin(F.broadcast(s)).withColumns({c: (F.col(c) - F.col(f"_a{c}")) / F.when(F.col(f"_s{c}") > 1e-12, F.col(f"_s{c}")).otherwise(1.0) for c in cols})
    return out.drop(*[f"_{k}{c}" for k in "mas" for c in cols])


def yeo_johnson(x: Column, lam: float) -> Column:
    pos = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    neg = -F.log1p(-x) if abs(lam - 2) < 1e-12 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def yeo_johnson_inverse(z: Column, lam: float) -> Column:
    pos = F.expm1(z) if abs(lam) < 1e-12 else F.pow(z * lam + 1, F.lit(1 / lam)) - 1
    neg = 1 - F.exp(-z) if abs(lam - 2) < 1e-12 else 1 - F.pow(1 - (2 - lam) * z, F.lit(1 / (2 - lam)))
    return F.when(z >= 0, pos).otherwise(neg)


def fit_lambda(df: DataFrame, col: str, lo: float = -2.0, hi: float = 4.0, steps: int = 25, rounds: int = 3) -> float:
    """The exponent of greatest likelihood, by a grid that is refined; each round is one aggregate over the column."""
    x = F.col(col).cast("double")
    for _ in range(rounds):
        grid = np.linspace(lo, hi, steps)
        r = df.where(x.isNotNull()).agg(F.count("*").alias("n"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias("j"), *[F.var_pop(yeo_johnson(x, float(g))).alias(f"v{i}") for i, g in enumerate(grid)]).first()
        like = [-r["n"] / 2 * math.log(r[f"v{i}"]) + (g - 1) * r["j"] if r[f"v{i}"] else -math.inf for i, g in enumerate(grid)]
        best = int(np.argmax(like))
        lo, hi = grid[max(0, best - 1)], grid[min(steps - 1, best + 1)]
    return float(grid[best])


def smeared(pred: Column, residuals: list[float], lam: float, lo: float, hi: float) -> Column:
    """Mean of the inverse over residual draws (a fixed, bounded list), clipped to the range of training."""
    draws = F.array(*[F.lit(float(r)) for r in residuals])
    vals = F.transform(draws, lambda r: F.greatest(F.lit(lo), F.least(F.lit(hi), yeo_johnson_inverse(pred + r, lam))))
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.aggregate(vals, F.lit(0.0), lambda a, x: a + x) / len(residuals)))


def ispline(x: Column, knots: tuple) -> list[Column]:
    """Three monotone I-spline columns over knots (minimum, median, maximum), from 0 to 1 each; one whose knots are equal is 0."""
    a, b, c = (k if isinstance(k, Column) else F.lit(float(k)) for k in knots)
    part = lambda lo, hi: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - lo) / F.when(hi > lo, hi - lo)))
    u, v, w = part(a, b), part(a, c), part(b, c)
    zero = lambda col, lo, hi: F.when(hi > lo, col).otherwise(0.0)
    return [zero(u * (2 - u), a, b), zero(v * v * (3 - 2 * v), a, c), zero(w * w, b, c)]


def masked_huber(pred: Column, obs: Column, delta: float = 1.0) -> Column:
    """An aggregate: mean Huber loss over rows with an observation."""
    e = F.abs(pred - obs)
    return F.avg(F.when(obs.isNotNull(), F.when(e <= delta, e * e / 2).otherwise(delta * (e - delta / 2))))


def paired_tests(df: DataFrame, by: list[str], family: list[str] | None = None, d: str = "d") -> DataFrame:
    """(by, n, mean, t, p_t, w, p_w, p_t_family, p_w_family) of paired differences: Student's and Wilcoxon's signed-rank test.

    p_t takes Student's distribution by its normal transformation (Abramowitz and Stegun 26.7.8), p_w the
    normal approximation with ties, zeros left out.  The last two are Bonferroni's, over the rows that
    share the columns of family (all rows without any).
    """
    v = F.col(d)
    own = df.where(v.isNotNull())
    n, t = F.col("n"), F.col("t")
    first = own.groupBy(*by).agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("_s")).withColumn("t", F.col("mean") / F.when(F.col("_s") > 0, F.col("_s") / F.sqrt(n)))
    ranks, ties = Window.partitionBy(*by).orderBy(F.abs(v)), Window.partitionBy(*by, F.abs(v))
    ranked = own.where(v != 0).withColumn("_c", F.count("*").over(ties)).withColumn("_r", F.rank().over(ranks) + (F.col("_c") - 1) / 2)
    w = ranked.groupBy(*by).agg(F.count("*").alias("_m"), F.coalesce(F.sum(F.when(v > 0, F.col("_r"))), F.lit(0.0)).alias("w"), F.sum(F.col("_c") * F.col("_c") - 1).alias("_t"))
    m = F.col("_m")
    var = m * (m + 1) * (2 * m + 1) / 24 - F.col("_t") / 48
    two = lambda z: 2 * (1 - normal_cdf(F.abs(z)))
    p_t = two(t * (1 - 1 / (4.0 * (n - 1))) / F.sqrt(1 + t * t / (2.0 * (n - 1))))
    p_w = F.coalesce(two((F.col("w") - m * (m + 1) / 4) / F.sqrt(F.when(var > 0, var))), F.lit(1.0))
    out = first.join(w, by, "left").select(*by, "n", "mean", "t", p_t.alias("p_t"), "w", p_w.alias("p_w"))
    size = out.groupBy(*family).agg(F.count("*").alias("_k")) if family else out.agg(F.count("*").alias("_k"))
    out = out.join(size, family) if family else out.crossJoin(size)
    return out.withColumns({f"{c}_family": F.least(F.lit(1.0), F.col(c) * F.col("_k")) for c in ("p_t", "p_w")}).drop("_k")


def ispline_of(x: Column, knots: Column) -> list[Column]:
    """ispline() over knots that are an array column."""
    return ispline(x, (knots[0], knots[1], knots[2]))


def binomial_deviance(y: Column, p: Column) -> Column:
    """Twice the distance of a share y from a fitted p, zero where they are equal; to be summed."""
    q = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), p))
    s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), y))
    return 2 * (F.when(s > 0, s * F.log(s / q)).otherwise(0.0) + F.when(s < 1, (1 - s) * F.log((1 - s) / (1 - q))).otherwise(0.0))


def deviance_explained(df: DataFrame, y: str, pred: str) -> DataFrame:
    """(explained): the share of the deviance of the mean that predictions take away."""
    null = df.agg(F.avg(y).alias("_m"))
    both = df.crossJoin(F.broadcast(null)).agg(F.sum(binomial_deviance(F.col(y), F.col(pred))).alias("a"), F.sum(binomial_deviance(F.col(y), F.col("_m"))).alias("b"))
    return both.select((1 - F.col("a") / F.when(F.col("b") > 0, F.col("b"))).alias("explained"))


def smearing_table(residuals: list[float], lam: float, lo: float, hi: float, y_lo: float, y_hi: float, steps: int) -> list[float]:
    """The mean of the inverse over residual draws at even steps from lo to hi of the fitted scale."""
    def back(z: float) -> float:
        if z >= 0:
            return math.expm1(z) if abs(lam) < 1e-12 else (z * lam + 1) ** (1 / lam) - 1
        return 1 - math.exp(-z) if abs(lam - 2) < 1e-12 else 1 - (1 - (2 - lam) * z) ** (1 / (2 - lam))

    at = [lo + (hi - lo) * k / (steps - 1) for k in range(steps)]
    return [sum(back(min(max(x + r, lo), hi)) for r in residuals) / len(residuals) for x in at]


def from_table(pred: Column, table: list[float], lo: float, hi: float, y_lo: float, y_hi: float) -> Column:
    """A prediction bounded to lo..hi, read off a table by a line between its steps, and bounded to y_lo..y_hi; null stays null."""
    values = F.array(*[F.lit(float(v)) for v in table])
    x = F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), pred))
    at = (x - lo) * ((len(table) - 1) / (hi - lo))
    low = F.least(F.floor(at).cast("int"), F.lit(len(table) - 2))
    y = values[low] + (values[low + 1] - values[low]) * (at - low)
    return F.when(pred.isNotNull(), F.greatest(F.lit(float(y_lo)), F.least(F.lit(float(y_hi)), y)))


def variance_shares(df: DataFrame, group: str, seed: str = "seed", obs: str = "obs", pred: str = "pred") -> DataFrame:
    """(seed, total, within, between, ss_within, ss_total): R2 of predictions overall, inside groups (each centred on its own means), and of the groups' means.

    Sums of squares and products of each group are enough, so rows are read once and no window is needed.
    """
    o, p = F.col(obs), F.col(pred)
    g = df.groupBy(seed, group).agg(F.count("*").alias("n"), F.avg(o).alias("mo"), F.avg(p).alias("mp"), F.var_pop(o).alias("vo"), F.var_pop(o - p).alias("ve"), F.avg((o - p) * (o - p)).alias("e2"))
    n = F.col("n")
    grand = g.groupBy(seed).agg((F.sum(n * F.col("mo")) / F.sum(n)).alias("gm"), F.avg("mo").alias("um"))
    j = g.join(grand, seed)
    within = F.sum(n * F.col("vo"))
    total = F.sum(n * (F.col("vo") + (F.col("mo") - F.col("gm")) * (F.col("mo") - F.col("gm"))))
    gap = (F.col("mo") - F.col("mp")) * (F.col("mo") - F.col("mp"))
    return j.groupBy(seed).agg((1 - F.sum(n * F.col("e2")) / total).alias("total"), (1 - F.sum(n * F.col("ve")) / within).alias("within"), (1 - F.sum(gap) / F.sum((F.col("mo") - F.col("um")) * (F.col("mo") - F.col("um")))).alias("between"), within.alias("ss_within"), total.alias("ss_total"))


def scheme_decomposition(df: DataFrame, model: str, base: str, time: str, place: str, both: str) -> DataFrame:
    """(model, base, d_time, d_place, d_both, interaction) of mean scores (model, scheme, score) under four schemes."""
    p = df.groupBy(model).pivot("scheme", [base, time, place, both]).agg(F.avg("score"))
    d = lambda s: F.col(s) - F.col(base)
    return p.select(model, F.col(base).alias("base"), d(time).alias("d_time"), d(place).alias("d_place"), d(both).alias("d_both"), (d(both) - d(time) - d(place)).alias("interaction"))


def out_of_fold_lines(df: DataFrame, key: str, x: str, y: str, k: int) -> DataFrame:
    """(seed, fold, key, obs, pred): y on x by least squares of all other folds, for each seed of (seed, fold, key, x, y).

    The moments of the other folds are those of all less the fold's own, so rows are read twice and no
    fold is fitted by itself.
    """
    a, b = F.col(x), F.col(y)
    own = df.groupBy("seed", "fold").agg(F.count("*").alias("n"), F.sum(a).alias("sx"), F.sum(b).alias("sy"), F.sum(a * a).alias("sxx"), F.sum(a * b).alias("sxy"))
    every = own.groupBy("seed").agg(*[F.sum(c).alias(f"_{c}") for c in ("n", "sx", "sy", "sxx", "sxy")])
    rest = own.join(every, "seed").select("seed", "fold", *[(F.col(f"_{c}") - F.col(c)).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    var = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.when(var != 0, var)
    fit = rest.withColumn("_b", slope).select("seed", "fold", "_b", ((F.col("sy") - F.col("_b") * F.col("sx")) / F.col("n")).alias("_a"))
    return df.join(F.broadcast(fit), ["seed", "fold"]).select("seed", "fold", key, b.alias("obs"), (F.col("_a") + F.col("_b") * a).alias("pred"))


def pair_design(df: DataFrame, key: str, columns: list[str], also: list[str] | None = None) -> DataFrame:
    """(a, b, intercept, columns): the absolute differences of all pairs a < b; `also` columns go along as <name>_a and <name>_b.  As many rows as there are pairs, by definition."""
    also = also or []
    side = lambda n: df.select(F.col(key).alias(n), *[F.col(c).alias(f"_{c}_{n}") for c in (*columns, *also)])
    j = pair_join(side("a"), side("b"), F.col("a") < F.col("b"))
    return j.select("a", "b", F.lit(1.0).alias("intercept"), *[F.abs(F.col(f"_{c}_a") - F.col(f"_{c}_b")).alias(c) for c in columns], *[F.col(f"_{c}_{n}").alias(f"{c}_{n}") for c in also for n in ("a", "b")])


def ensemble(df: DataFrame, keys: list[str], members: list[Column]) -> DataFrame:
    """(keys, mean, sd, members): the mean of those predictions that have a value, their spread (0 for one) and how many they are."""
    have = F.filter(F.array(*members), lambda v: v.isNotNull())
    own = df.select(*keys, have.alias("_v"))
    n = F.size("_v")
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda p, v: p + v)
    own = own.withColumn("mean", add(F.col("_v")) / F.when(n > 0, n))
    sd = F.sqrt(add(F.transform("_v", lambda v: (v - F.col("mean")) * (v - F.col("mean")))) / F.when(n > 1, n - 1))
    return own.select(*keys, "mean", F.coalesce(sd, F.lit(0.0)).alias("sd"), n.cast("long").alias("members"))


def counterfactual_spread(df: DataFrame, own: Column, swapped: list[Column]) -> DataFrame:
    """Medians and 90th percentiles, over rows, of the deviation and the range of predictions under reference values, and the deviation of the own predictions."""
    v = F.array(*swapped)
    rows = df.select(own.alias("own"), v.alias("v"))
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda p, x: p + x)
    rows = rows.withColumn("m", add(F.col("v")) / len(swapped))
    sd = F.sqrt(add(F.transform("v", lambda x: (x - F.col("m")) * (x - F.col("m")))) / (len(swapped) - 1))
    each = rows.select("own", sd.alias("sd"), (F.array_max("v") - F.array_min("v")).alias("range"))
    q = lambda c, p: F.expr(f"percentile({c}, {p})")
    return each.agg(q("sd", 0.5).alias("sd_median"), q("sd", 0.9).alias("sd_p90"), q("range", 0.5).alias("range_median"), q("range", 0.9).alias("range_p90"), F.stddev_samp("own").alias("natural_sd"))
