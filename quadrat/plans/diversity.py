"""Queries of diversity, dissimilarity and phylogeny."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrat.operators import diversity as D
from quadrat.plans.catalog import query
from quadrat.plans.relational import COMM, comm, r6

#: Tips 0..59 in genera of six and families of thirty; all branches have length 1.
TIPS = "comm AS (SELECT l_orderkey AS plot, l_partkey % 60 AS species, sum(l_quantity) AS value FROM lineitem GROUP BY ALL)"
BRANCHES = "SELECT DISTINCT plot, 't' || species AS b FROM comm UNION SELECT plot, 'g' || (species // 6) FROM comm UNION SELECT plot, 'f' || (species // 30) FROM comm"


def tips(t):
    return t.lineitem.groupBy(F.col("l_orderkey").alias("plot"), F.concat(F.lit("t"), F.col("l_partkey") % 60).alias("species")).agg(F.sum("l_quantity").alias("value"))


def closure(t):
    r = t.spark.range
    e = r(60).selectExpr("concat('t', id) node", "concat('g', id div 6) parent", "1.0D length").union(r(10).selectExpr("concat('g', id)", "concat('f', id div 5)", "1.0D")).union(r(2).selectExpr("concat('f', id)", "cast(null as string)", "1.0D"))
    return D.ancestors(e)


@query("D01", f"WITH {COMM}, p AS (SELECT plot, value / sum(value) OVER (PARTITION BY plot) AS p FROM comm WHERE value > 0) SELECT plot, count(*) AS q0, round(exp(-sum(p * ln(p))), 6) AS q1, round(1 / sum(p * p), 6) AS q2 FROM p GROUP BY plot")
def _(t):
    return D.hill_numbers(comm(t)).select("plot", "q0", r6("q1").alias("q1"), r6("q2").alias("q2"))


_JACCARD = f"""WITH {COMM}, s AS (SELECT plot, count(*) AS t FROM comm GROUP BY 1), w AS (SELECT a.plot AS pa, b.plot AS pb, count(*) AS w FROM comm a JOIN comm b USING (species) WHERE a.plot < b.plot GROUP BY ALL),
d AS (SELECT a.plot AS plot_a, b.plot AS plot_b, 1 - coalesce(w, 0) / (a.t + b.t - coalesce(w, 0)) AS d FROM s a JOIN s b ON a.plot < b.plot LEFT JOIN w ON pa = a.plot AND pb = b.plot)"""
_BRAY = f"""WITH {COMM}, s AS (SELECT plot, sum(value) AS t FROM comm GROUP BY 1), w AS (SELECT a.plot AS pa, b.plot AS pb, sum(least(a.value, b.value)) AS w FROM comm a JOIN comm b USING (species) WHERE a.plot < b.plot GROUP BY ALL),
d AS (SELECT a.plot AS plot_a, b.plot AS plot_b, 1 - 2 * coalesce(w, 0) / (a.t + b.t) AS d FROM s a JOIN s b ON a.plot < b.plot LEFT JOIN w ON pa = a.plot AND pb = b.plot)"""


@query("D02", _JACCARD + " SELECT plot_a, plot_b, round(d, 6) AS d FROM d")
def _(t):
    return D.dissimilarity(comm(t), "jaccard").withColumn("d", r6("d"))


@query("D03", _BRAY + " SELECT plot_a, plot_b, round(d, 6) AS d FROM d")
def _(t):
    return D.dissimilarity(comm(t), "bray").withColumn("d", r6("d"))


@query("D04", f"""WITH {COMM}, plots AS (SELECT DISTINCT plot FROM comm), species AS (SELECT DISTINCT species FROM comm),
h AS (SELECT plot, species, coalesce(sqrt(value / sum(value) OVER (PARTITION BY plot)), 0) AS h FROM plots CROSS JOIN species LEFT JOIN comm USING (plot, species)),
c AS (SELECT plot, pow(h - avg(h) OVER (PARTITION BY species), 2) AS d FROM h)
SELECT plot, round(sum(d) / (SELECT sum(d) FROM c), 8) AS lcbd FROM c GROUP BY plot""")
def _(t):
    return D.hellinger_lcbd(comm(t)).select("plot", F.round("lcbd", 8).alias("lcbd"))


_LCBD = "x AS (SELECT plot_a AS i, plot_b AS j, d2 FROM q UNION ALL SELECT plot_b, plot_a, d2 FROM q), r AS (SELECT i AS plot, sum(d2) AS s FROM x GROUP BY 1), e AS (SELECT count(*) AS n, sum(s) / count(*) / count(*) AS m FROM r) SELECT plot, round((s / n - m / 2) / (n * m / 2), 8) AS lcbd FROM r, e"


@query("D05", _JACCARD + f", q AS (SELECT plot_a, plot_b, d * d AS d2 FROM d), {_LCBD}")
def _(t):
    return D.lcbd_from_squared(D.dissimilarity(comm(t), "jaccard").selectExpr("plot_a", "plot_b", "d * d AS d2")).select("plot", F.round("lcbd", 8).alias("lcbd"))


@query("D06", _JACCARD + """, q AS (SELECT plot_a, plot_b, d * d AS d2 FROM d UNION ALL SELECT plot, plot, 0 FROM s), x AS (SELECT plot_a AS i, plot_b AS j, d2 FROM q UNION SELECT plot_b, plot_a, d2 FROM q),
c AS (SELECT i, j, -(d2 - avg(d2) OVER (PARTITION BY i) - avg(d2) OVER (PARTITION BY j) + avg(d2) OVER ()) / 2 AS g FROM x) SELECT i AS plot_a, j AS plot_b, round(g, 6) + 0.0 AS g FROM c WHERE i <= j""")
def _(t):
    return D.gower_centred(D.dissimilarity(comm(t), "jaccard").selectExpr("plot_a", "plot_b", "d * d AS d2")).select("plot_a", "plot_b", (r6("g") + 0.0).alias("g"))


@query("D07")
def _(t):
    return D.permuted_lcbd(comm(t), 99, 1)


@query("D11", _BRAY + f", q AS (SELECT plot_a, plot_b, d AS d2 FROM d), {_LCBD}")
def _(t):
    return D.lcbd_from_squared(D.dissimilarity(comm(t), "bray").selectExpr("plot_a", "plot_b", "d AS d2")).select("plot", F.round("lcbd", 8).alias("lcbd"))


@query("D14", f"WITH {TIPS}, b AS ({BRANCHES}) SELECT b AS branch, 1.0::DOUBLE AS length, count(DISTINCT plot) AS y FROM b GROUP BY 1")
def _(t):
    return D.branch_incidence(tips(t), closure(t))


@query("D17", "WITH c AS (SELECT l_suppkey AS plot, l_partkey, count(*) AS x FROM lineitem GROUP BY ALL), n AS (SELECT plot, sum(x)::BIGINT AS n FROM c GROUP BY 1) SELECT plot, m::INT AS m, round(CASE WHEN any_value(n) >= m THEN sum(1 - CASE WHEN n - x >= m THEN exp(lgamma(n - x + 1.0) - lgamma(n - x - m + 1.0) + lgamma(n - m + 1.0) - lgamma(n + 1.0)) ELSE 0 END) END, 4) AS q0 FROM c JOIN n USING (plot), (VALUES (10), (50), (100), (200)) v(m) GROUP BY plot, m")
def _(t):
    c = t.lineitem.groupBy(F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species")).agg(F.count("*").alias("value"))
    return D.rarefied(c, [10, 50, 100, 200]).withColumn("q0", F.round("q0", 4))


@query("D25", f"""WITH {COMM}, p AS (SELECT plot, species, value / sum(value) OVER (PARTITION BY plot) AS p FROM comm), n AS (SELECT count(DISTINCT plot) AS n FROM p),
s AS (SELECT plot, count(*) AS s, -sum(p * ln(p)) AS h, sum(p * p) AS d FROM p GROUP BY 1), a AS (SELECT avg(s) AS a0, exp(avg(h)) AS a1, 1 / avg(d) AS a2 FROM s),
g AS (SELECT count(*)::DOUBLE AS g0, exp(-sum(p * ln(p))) AS g1, 1 / sum(p * p) AS g2 FROM (SELECT sum(p) / n AS p FROM p, n GROUP BY species, n))
SELECT 0 AS q, round(a0, 6) AS alpha, round(g0 / a0, 6) AS beta, round(g0, 6) AS gamma FROM a, g UNION ALL SELECT 1, round(a1, 6), round(g1 / a1, 6), round(g1, 6) FROM a, g UNION ALL SELECT 2, round(a2, 6), round(g2 / a2, 6), round(g2, 6) FROM a, g""")
def _(t):
    return D.partition(comm(t)).select("q", *[r6(c).alias(c) for c in ("alpha", "beta", "gamma")])


@query("D29", f"WITH {TIPS}, b AS ({BRANCHES}) SELECT plot, count(*)::DOUBLE AS pd FROM b GROUP BY 1")
def _(t):
    return D.faith_pd(tips(t), closure(t))


@query("D33", "WITH s AS (SELECT l_suppkey AS plot, count(DISTINCT l_partkey)::DOUBLE AS y, sum(l_quantity) AS area FROM lineitem GROUP BY 1) SELECT plot, round(y * pow(10000 / area, (SELECT regr_slope(ln(y), ln(area)) FROM s)), 4) AS corrected FROM s")
def _(t):
    s = t.lineitem.groupBy(F.col("l_suppkey").alias("plot")).agg(F.count_distinct("l_partkey").cast("double").alias("y"), F.sum("l_quantity").alias("area"))
    return D.species_area(s, "y", "area", 10000.0).select("plot", F.round("corrected", 4).alias("corrected"))


@query("D34", "WITH c AS (SELECT i, j, covar_samp(embedding[i]::DOUBLE, embedding[j]::DOUBLE) AS c FROM embeddings, range(1, 65) a(i), range(1, 65) b(j) GROUP BY ALL) SELECT round(pow(sum(c) FILTER (i = j), 2) / sum(c * c), 4) AS dim FROM c")
def _(t):
    return D.participation(t.embeddings, "embedding").select(F.round("dim", 4).alias("dim"))


@query("D35")
def _(t):
    return D.geometric_medians(t.embeddings, "label", "embedding").select("label", "gm")


@query("D36")
def _(t):
    return D.geometric_medians(t.embeddings, "label", "embedding").select("label", "euclid", "cosine", "bray")


@query("D37", "SELECT plot, species, round(1 / sqrt(count(*) OVER (PARTITION BY plot)), 6) AS h FROM (SELECT DISTINCT l_suppkey AS plot, l_partkey AS species FROM lineitem)")
def _(t):
    own = t.lineitem.select(F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species")).distinct()
    return own.join(own.groupBy("plot").agg(F.count("*").alias("n")), "plot").select("plot", "species", r6(1 / F.sqrt("n")).alias("h"))
