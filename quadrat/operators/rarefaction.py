"""Hill numbers of incidences: observed, rarefied, extrapolated and asymptotic, with bands by resampling.

A *spectrum* has the columns of ``by`` (one group for each assemblage), y, f and l: f units (species, or
branches of a tree) of total weight l occur in y of the assemblage's n plots.  However many units there
are, a spectrum is as long as there are different y.  For species the weight is 1, for branches their
length.  Counts of individuals are treated alike, with n the number of individuals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrat.functions.hypergeometric import hypergeometric
from quadrat.functions.special import digamma, draw_order


def spectrum(units: DataFrame, by: list[str]) -> DataFrame:
    """The spectrum of units (by, y, length)."""
    return units.where("y > 0").groupBy(*by, "y").agg(F.count("*").alias("f"), F.sum("length").alias("l"))


def _moments(spec: DataFrame, by: list[str]) -> DataFrame:
    y, l = F.col("y").cast("double"), F.col("l")  # noqa: E741
    return spec.groupBy(*by).agg(F.sum(l).alias("_l"), F.sum(y * l).alias("_u"), F.sum(l * y * F.log(y)).alias("_e"), F.sum(l * y * y).alias("_s"))


def hill_of_incidence(spec: DataFrame, by: list[str]) -> DataFrame:
    """(by, q0, q1, q2) of what was observed."""
    m = _moments(spec, by)
    return m.select(*by, F.col("_l").alias("q0"), F.exp(F.log("_u") - F.col("_e") / F.col("_u")).alias("q1"), (F.col("_u") * F.col("_u") / F.col("_s")).alias("q2"))


def singletons(spec: DataFrame, plots: DataFrame, by: list[str]) -> DataFrame:
    """(by, n, f1, f2, g1, g2, a): units seen once and twice, their weights, and Good and Turing's estimate, from plots (by, n)."""
    once, twice = F.col("y") == 1, F.col("y") == 2
    part = lambda c, v: F.coalesce(F.sum(F.when(c, F.col(v))), F.lit(0))
    s = spec.groupBy(*by).agg(part(once, "f").alias("f1"), part(twice, "f").alias("f2"), part(once, "l").cast("double").alias("g1"), part(twice, "l").cast("double").alias("g2"))
    s = _with(s, plots, by)
    a = F.when(F.col("f2") > 0, 2 * F.col("f2") / ((F.col("n") - 1) * F.col("f1") + 2 * F.col("f2"))).when(F.col("f1") > 0, 2 / ((F.col("n") - 1) * (F.col("f1") - 1) + 2)).otherwise(1.0)
    return s.select(*by, "n", "f1", "f2", "g1", "g2", a.alias("a"))


def _with(df: DataFrame, small: DataFrame, by: list[str]) -> DataFrame:
    """df with the columns of a table of one row for each assemblage."""
    return df.join(small, by) if by else df.crossJoin(small)


def _unseen(g1: Column, g2: Column, n: Column) -> Column:
    """Weight of what was never seen, by the estimate of Chao."""
    return F.greatest(F.lit(0.0), (n - 1) / n * F.when(g2 > 0, g1 * g1 / (2 * F.when(g2 > 0, g2))).otherwise(g1 * (g1 - 1) / 2))


def asymptote(spec: DataFrame, plots: DataFrame, by: list[str]) -> DataFrame:
    """(by, q0, q1, q2) for a number of plots without end; null where q2 has nothing that was seen twice."""
    n, y, l = F.col("n").cast("double"), F.col("y").cast("double"), F.col("l")  # noqa: E741
    s = singletons(spec, plots, by)
    sums = _with(spec, plots, by).groupBy(*by).agg(
        F.sum(l).alias("_l"), (F.sum(l * y) / F.first(n)).alias("_t"), F.sum(F.when(y <= n - 1, l * y / n * (digamma(n) - digamma(y)))).alias("_h"), F.sum(l * y * (y - 1) / (n * (n - 1))).alias("_p"),
    )
    a, g1 = F.col("a"), F.col("g1")
    # the tail of a series whose terms go as (1 - a)^k, so some multiple of 1 / a of them is enough
    terms = F.sequence(F.lit(0), F.least(F.lit(1_000_000), F.ceil(40 / a)).cast("int"))
    tail = F.aggregate(terms, F.lit(0.0), lambda acc, k: acc + F.pow(1 - a, k + 1) / (n + k))
    rest = F.when((a == 1) | (g1 == 0), 0.0).otherwise(g1 / n * tail)
    t = F.col("_t")
    both = _with(s, sums, by)
    return both.select(*by, (F.col("_l") + _unseen(g1, F.col("g2"), n)).alias("q0"), (t * F.exp((F.coalesce("_h", F.lit(0.0)) + rest) / t)).alias("q1"), (t * t / F.when(F.col("_p") > 0, F.col("_p"))).alias("q2"))


def _rarefied(spec: DataFrame, sizes: DataFrame, by: list[str]) -> DataFrame:
    """(by, m, q0, q1, q2) of m < n plots, from sizes (by, n, m)."""
    y, m, n, l, k = (F.col(c) for c in ("y", "m", "n", "l", "k"))  # noqa: E741
    rows = _with(spec, sizes, by)
    # the expected weight of what is seen k times in m plots; terms that cannot be are left out
    seen = rows.withColumn("k", F.explode(F.sequence(F.greatest(F.lit(1), m - (n - y)), F.greatest(F.least(y, m), F.lit(1))))).where((k <= y) & (k <= m) & (m - k <= n - y))
    seen = seen.groupBy(*by, "m", "n", "k").agg(F.sum(l * hypergeometric(y, k, n, m)).alias("_g"))
    return seen.groupBy(*by, "m").agg(F.sum("_g").alias("_l"), F.sum(k * F.col("_g")).alias("_u"), F.sum(F.col("_g") * k * F.log(k)).alias("_e"), F.sum(F.col("_g") * k * k).alias("_s")).select(
        *by, "m", F.col("_l").alias("q0"), F.exp(F.log("_u") - F.col("_e") / F.col("_u")).alias("q1"), (F.col("_u") * F.col("_u") / F.col("_s")).alias("q2")
    )


def _last_step(spec: DataFrame, plots: DataFrame, by: list[str]) -> DataFrame:
    """(by, _d): by how much ln q1 of all n > 1 plots is above that of n - 1.

    A unit in y plots is seen y - 1 times in n - 1 plots with the chance y / n, else y times; written out, the
    difference needs no subtraction of large numbers, whatever n is.
    """
    y, l, n = F.col("y").cast("double"), F.col("l"), F.col("n")  # noqa: E741
    sums = _with(spec, plots.where("n > 1"), by).groupBy(*by, "n").agg(F.sum(F.when(y > 1, l * y * (y - 1) * F.log1p(-1 / y)).otherwise(0.0)).alias("_s"), F.sum(l * y).alias("_t"))
    return sums.select(*by, (F.col("_s") / (F.col("_t") * (n - 1)) - F.log1p(-1.0 / n)).alias("_d"))


def curve(spec: DataFrame, plots: DataFrame, sizes: DataFrame, by: list[str]) -> DataFrame:
    """(by, m, method, q0, q1, q2) at the sizes (by, m): rarefied below the n plots, observed at n, extrapolated beyond."""
    at = _with(sizes.distinct(), plots, by)
    below = _rarefied(spec, at.where("m < n"), by).withColumn("method", F.lit("Rarefaction"))
    seen = hill_of_incidence(spec, by)
    here = _with(seen, at.where("m = n").select(*by, "m"), by).withColumn("method", F.lit("Observed"))
    last = _last_step(spec, plots, by)
    end = asymptote(spec, plots, by).select(*by, F.col("q1").alias("_a1"))
    far = at.where("m > n").drop("n")
    for small in (singletons(spec, plots, by), seen, last, end):
        far = _with(far, small, by)
    n, m, g1, q0, q1 = (F.col(c) for c in ("n", "m", "g1", "q0", "q1"))
    g0 = _unseen(g1, F.col("g2"), n)
    more0 = F.when((g0 <= 0) | (g1 <= 0), q0).otherwise(q0 + g0 * (1 - F.pow(1 - g1 / (n * g0 + g1), m - n)))
    gain = -q1 * F.expm1(-F.col("_d"))  # q1 of n plots less that of n - 1
    step = F.col("_a1") - q1 + gain
    beta = F.when(step == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), gain / F.when(step != 0, step))))
    more1 = q1 + (F.col("_a1") - q1) * (1 - F.pow(1 - beta, m - n))
    # of order 2 a sum over the spectrum is needed: 1 / sum of l / t^2 * (y / (n m) + (m - 1) / m * y (y - 1) / (n (n - 1)))
    two = _with(spec, plots, by).groupBy(*by).agg((F.sum(F.col("l") * F.col("y")) / F.first("n")).alias("_t"), F.sum(F.col("l") * F.col("y") / n).alias("_x"), F.sum(F.col("l") * F.col("y") * (F.col("y") - 1) / (n * (n - 1))).alias("_y"))
    far = _with(far, two, by)
    more2 = F.col("_t") * F.col("_t") / (F.col("_x") / m + (m - 1) / m * F.col("_y"))
    beyond = far.select(*by, "m", more0.alias("q0"), more1.alias("q1"), more2.alias("q2"), F.lit("Extrapolation").alias("method"))
    names = [*by, "m", "method", "q0", "q1", "q2"]
    return below.select(*names).unionByName(here.select(*names)).unionByName(beyond.select(*names))


def draws(plots: DataFrame, sizes: DataFrame, reps: int, seed: int, by: list[str]) -> DataFrame:
    """(by, m, rep, plot): for each repetition the plots in a random order, the first m of them; all plots are one draw.

    plots has (by, plot), sizes (by, m).  An order needs all plots of a repetition in one task: they are
    sites, not records.
    """
    n = plots.groupBy(*by).agg(F.count("*").alias("n"))
    reps_of = plots.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
    w = Window.partitionBy(*by, "rep").orderBy(draw_order(seed, F.col("rep"), F.col("plot")), "plot")
    ranked = _with(reps_of.withColumn("rank", F.row_number().over(w)), n, by)
    at = _with(ranked, sizes.distinct(), by) if by else ranked.crossJoin(F.broadcast(sizes.distinct()))
    return at.where("rank <= m AND m <= n AND (m < n OR rep = 0)").select(*by, "m", "rep", "plot")


def _bounds(df: DataFrame, keys: list[str], cols: list[str], conf: float, mean: bool) -> DataFrame:
    a = (1 - conf) / 2
    out = []
    for c in cols:
        out += ([F.avg(c).alias(f"{c}_mean")] if mean else []) + [F.expr(f"percentile({c}, {p})").alias(f"{c}_{k}") for k, p in (("lo", a), ("hi", 1 - a))]
    return df.groupBy(*keys).agg(F.count("*").alias("reps"), *out)


def band(units: DataFrame, drawn: DataFrame, by: list[str], conf: float = 0.95) -> DataFrame:
    """(by, m, reps, q0_lo .. q2_hi): bounds of Hill numbers over draws of plots, from units (by, plot, unit, length) and draws()."""
    keys = [*by, "m", "rep"]
    y = units.join(drawn, [*by, "plot"]).groupBy(*keys, "unit", "length").agg(F.count("*").alias("y"))
    return _bounds(hill_of_incidence(spectrum(y, keys), keys), [*by, "m"], ["q0", "q1", "q2"], conf, False)


def partition_curve(comm: DataFrame, drawn: DataFrame, conf: float = 0.95) -> DataFrame:
    """(m, q, reps, alpha_mean, alpha_lo, .. gamma_hi): partitions of diversity over draws of plots of (plot, species, value)."""
    own = comm.where("value > 0")
    p = own.join(own.groupBy("plot").agg(F.sum("value").alias("t")), "plot").select("plot", "species", (F.col("value") / F.col("t")).alias("p"))
    plot = p.groupBy("plot").agg(F.count("*").alias("s"), (-F.sum(F.col("p") * F.log("p"))).alias("h"), F.sum(F.col("p") * F.col("p")).alias("d"))
    keys = ["m", "rep"]
    a = drawn.join(plot, "plot").groupBy(*keys).agg(F.avg("s").alias("a0"), F.exp(F.avg("h")).alias("a1"), (1 / F.avg("d")).alias("a2"))
    pool = drawn.join(p, "plot").groupBy(*keys, "species").agg((F.sum("p") / F.col("m")).alias("p"))
    g = pool.groupBy(*keys).agg(F.count("*").cast("double").alias("g0"), F.exp(-F.sum(F.col("p") * F.log("p"))).alias("g1"), (1 / F.sum(F.col("p") * F.col("p"))).alias("g2"))
    rows = F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"a{q}").cast("double").alias("alpha"), (F.col(f"g{q}") / F.col(f"a{q}")).alias("beta"), F.col(f"g{q}").alias("gamma")) for q in range(3)])
    each = a.join(g, keys).select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")
    return _bounds(each, ["m", "q"], ["alpha", "beta", "gamma"], conf, True)


def log_sizes(least: int, most: int, steps: int) -> list[int]:
    """Whole numbers from least to most at even steps of their logarithms, each once."""
    import math

    if most <= least:
        return [most]
    return sorted({round(math.exp(math.log(least) + (math.log(most) - math.log(least)) * k / (steps - 1))) for k in range(steps)})


def sizes_table(plots: DataFrame, by: list[str], shares: list[float], fixed: tuple[int, ...] = ()) -> DataFrame:
    """(by, m): the number n of plots times shares, rounded down, and some fixed sizes; none below 1."""
    n = F.col("n")
    at = F.array(*[F.floor(n * s).cast("long") for s in shares], *[F.lit(k).cast("long") for k in fixed])
    return plots.select(*by, F.explode(at).alias("m")).where("m >= 1").distinct()


def coverage_size(counts: DataFrame, by: list[str], level: float) -> DataFrame:
    """(by, n, m): the least number of individuals, up to 2 n, whose expected sample coverage reaches a level (2 n where none does).

    counts is a spectrum of counts of individuals, f species with y each: its rows of one assemblage are few.
    """
    import math

    import numpy as np
    import pandas as pd

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        y, f = pdf["y"].to_numpy(np.int64), pdf["f"].to_numpy(float)
        n = int((y * f).sum())
        f1, f2 = float(f[y == 1].sum()), float(f[y == 2].sum())
        lg = math.lgamma

        def cover(m: int) -> float:
            if m < n:
                missed = [c * x / n * math.exp(lg(n - x + 1) - lg(n - x - m + 1) + lg(n - m) - lg(n)) for x, c in zip(y.tolist(), f.tolist(), strict=True) if n - x >= m]
                return 1 - math.fsum(missed)
            if f1 == 0:
                return 1.0
            a = (n - 1) * f1 / ((n - 1) * f1 + 2 * f2) if f2 > 0 else (n - 1) * (f1 - 1) / ((n - 1) * (f1 - 1) + 2)
            return 1 - f1 / n * a ** (m - n + 1)

        lo, hi = 1, 2 * n
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if cover(mid) >= level - 1e-12 else (mid + 1, hi)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in by}, "n": [n], "m": [lo]})

    kinds = ", ".join(f"{k} {counts.schema[k].dataType.simpleString()}" for k in by)
    return counts.select(*by, "y", "f").groupBy(*by).applyInPandas(one, f"{kinds}, n long, m long")
