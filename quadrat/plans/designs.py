"""Queries of designs, terrain, climate, families of tests, retransformation and feature blocks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrat.functions.names import folded_name
from quadrat.operators import designs as G
from quadrat.operators import relational as R
from quadrat.operators import series as S
from quadrat.operators import validation as V
from quadrat.plans.catalog import query
from quadrat.plans.curves import cdf_sql, rounded
from quadrat.plans.images import u_sql
from quadrat.plans.relational import r6
from quadrat.plans.series import seconds
from quadrat.plans.space import POINTS, points
from quadrat.sources import runs


def r_sql(places: int, *cols: str) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in cols)


# pairing ---------------------------------------------------------------------------------------------

_SETS = "x AS (SELECT o_custkey % 40 AS loc, o_custkey AS a, o_orderdate::DATE AS item FROM orders WHERE o_orderkey % 2 = 0), y AS (SELECT o_custkey % 40 AS loc, 'r' || (o_custkey + 40) AS b, o_orderdate::DATE AS item FROM orders WHERE o_orderkey % 3 = 0)"
_JACCARD = """xs AS (SELECT DISTINCT * FROM x), ys AS (SELECT DISTINCT * FROM y), m AS (SELECT loc, a, b, count(*) AS w FROM xs JOIN ys USING (loc, item) GROUP BY ALL), nx AS (SELECT loc, a, count(*) AS n FROM xs GROUP BY ALL), ny AS (SELECT loc, b, count(*) AS k FROM ys GROUP BY ALL),
j AS (SELECT loc, a, b, round(coalesce(w, 0) / (n + k - coalesce(w, 0)), 9) AS jaccard FROM nx JOIN ny USING (loc) LEFT JOIN m USING (loc, a, b))"""


@query("J19", f"""WITH RECURSIVE {_SETS}, {_JACCARD}, o AS (SELECT *, row_number() OVER (PARTITION BY loc ORDER BY jaccard DESC, a DESC, b DESC) AS k FROM j),
g AS (SELECT loc, 0::BIGINT AS k, []::BIGINT[] AS ua, []::VARCHAR[] AS ub, NULL::BIGINT AS a, NULL::VARCHAR AS b, NULL::DOUBLE AS jaccard FROM (SELECT DISTINCT loc FROM o)
UNION ALL SELECT g.loc, o.k, CASE WHEN free THEN list_append(ua, o.a) ELSE ua END, CASE WHEN free THEN list_append(ub, o.b) ELSE ub END, CASE WHEN free THEN o.a END, CASE WHEN free THEN o.b END, CASE WHEN free THEN o.jaccard END
FROM g JOIN o ON o.loc = g.loc AND o.k = g.k + 1, LATERAL (SELECT NOT list_contains(ua, o.a) AND NOT list_contains(ub, o.b) AS free) f)
SELECT a, b, jaccard FROM g WHERE a IS NOT NULL""")
def _(t):
    """Customers and rows of another list paired one to one within a place, by the likeness of their dates."""
    x = t.orders.where("o_orderkey % 2 = 0").select((F.col("o_custkey") % 40).alias("loc"), F.col("o_custkey").alias("a"), F.to_date("o_orderdate").alias("item"))
    y = t.orders.where("o_orderkey % 3 = 0").select((F.col("o_custkey") % 40).alias("loc"), F.concat(F.lit("r"), F.col("o_custkey") + 40).alias("b"), F.to_date("o_orderdate").alias("item"))
    return G.pairs_by_likeness(x, y, "loc", "a", "b", "item")


# designs ---------------------------------------------------------------------------------------------

_CELLS = "cells AS (SELECT s_suppkey AS cell, -30 - s_suppkey % 23 * 0.7::DOUBLE AS lat FROM supplier), bw AS (SELECT round_even(-30 - c_nationkey * 0.6::DOUBLE, 0)::BIGINT AS band, count(*)::DOUBLE AS w FROM customer GROUP BY 1)"


def _cells(t):
    cells = t.supplier.select(F.col("s_suppkey").alias("cell"), (-30 - F.col("s_suppkey") % 23 * 0.7).alias("lat"))
    weights = t.customer.groupBy(F.bround(-30 - F.col("c_nationkey") * 0.6).cast("long").alias("band")).agg(F.count("*").cast("double").alias("w"))
    return cells, weights


@query("G16", f"WITH {_CELLS}, o AS (SELECT *, round_even(lat, 0)::BIGINT AS band FROM cells), q AS (SELECT o.*, coalesce(w, 0) / count(*) OVER (PARTITION BY o.band) AS v FROM o LEFT JOIN bw USING (band)) SELECT cell, lat, band, greatest(2, least(40, round_even(v / sum(v) OVER () * 900, 0)))::INT AS quota FROM q")
def _(t):
    return G.allocate(*_cells(t), 900)


_YEARS = [(y, w) for y, w in zip(range(2003, 2013), (1, 2, 5, 3, 8, 1, 0, 4, 2, 6), strict=True)]
_YEAR_SQL = "(VALUES " + ", ".join(f"({y}, {w}.0::DOUBLE)" for y, w in _YEARS if w) + ") v(year, w)"


@query("J25", f"""WITH c AS (SELECT s_suppkey AS cell, s_nationkey FROM supplier), k AS (SELECT cell, s_nationkey, year::INT AS year, ln({u_sql("'9'", 'cell', 'year')}) / w AS k FROM c, {_YEAR_SQL}), d AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY cell ORDER BY k DESC, year) <= 3),
p AS (SELECT d.cell, year, c_custkey AS point, row_number() OVER (PARTITION BY d.cell, year ORDER BY md5('9|' || d.cell || '|' || year || '|' || c_custkey), c_custkey) AS r FROM d JOIN customer ON c_nationkey = s_nationkey)
SELECT cell, year, point, year - 2 AS win_start, year AS win_end, 'U' || lpad((row_number() OVER (ORDER BY cell, year, r) - 1)::VARCHAR, 6, '0') AS sample_id FROM p WHERE r <= 2""")
def _(t):
    """A pool: years drawn by weight for each cell, points for each of them, and ids in a row."""
    years = G.weighted_years(t.supplier.select(F.col("s_suppkey").alias("cell"), "s_nationkey"), _YEARS, 3, 9)
    drawn = G.drawn_points(years, t.customer.select(F.col("c_nationkey").alias("s_nationkey"), F.col("c_custkey").alias("point")), "s_nationkey", 9, 2)
    # ids in a row: counts of the cells before, and an order within a cell
    before = drawn.groupBy("cell").agg(F.count("*").alias("n")).withColumn("b", F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    own = drawn.join(F.broadcast(before), "cell").withColumn("i", F.col("b") + F.row_number().over(Window.partitionBy("cell").orderBy("year", "r")) - 1)
    return own.select("cell", "year", "point", (F.col("year") - 2).alias("win_start"), F.col("year").alias("win_end"), F.concat(F.lit("U"), F.lpad(F.col("i").cast("string"), 6, "0")).alias("sample_id"))


@query("G17")
def _(t):
    p = t.embeddings.select((F.col("vec_id") % 5).alias("cell"), F.col("vec_id").alias("id"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in ((0, "x"), (1, "y"))], F.col("label").alias("class"), (F.col("label") % 4).cast("double").alias("weight"))
    return G.spaced_draw(p, p.select("cell").distinct().withColumn("n", F.lit(20)), 0.03, 4)


_D = "dom AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings), smp AS (SELECT id, x, y FROM dom WHERE id % 4 = 0)"
_PCT = (5, 25, 50, 75, 95)


@query("G04", f"""WITH {_D}, gj AS (SELECT a.id, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS d FROM smp a JOIN smp b ON a.id <> b.id GROUP BY 1), gi AS (SELECT a.id, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS d FROM dom a, smp b GROUP BY 1),
u AS (SELECT d, TRUE AS own FROM gj UNION ALL SELECT d, FALSE FROM gi), n AS (SELECT (SELECT count(*) FROM gj) AS na, (SELECT count(*) FROM gi) AS nb, (SELECT (max(x) - min(x)) * (max(y) - min(y)) FROM dom) AS area, (SELECT avg(d) FROM gj) AS m, (SELECT median(d) FROM gi) / (SELECT median(d) FROM gj) AS ratio),
c AS (SELECT d, sum(own::INT) OVER (ORDER BY d RANGE UNBOUNDED PRECEDING) / na AS fa, sum((NOT own)::INT) OVER (ORDER BY d RANGE UNBOUNDED PRECEDING) / nb AS fb FROM u, n), k AS (SELECT max(abs(fa - fb)) AS ks FROM c),
o AS (SELECT *, m / (0.5 / sqrt(na / area)) AS r, ks * sqrt(na * nb / (na + nb)) AS lam FROM n, k)
SELECT CASE WHEN ratio >= 1.5 THEN 'clustered' WHEN r >= 1.2 THEN 'regular' ELSE 'random' END AS label, round(r, 6) AS clark_evans, round(ratio, 6) AS ratio, round(area, 6) AS area, na AS n_sample, nb AS n_domain, round(ks, 6) AS ks_stat, round(greatest(0, least(1, 2 * (SELECT sum(CASE WHEN q % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * q * q * lam * lam)) FROM range(1, 101) t(q)))), 6) AS ks_p,
{', '.join(f"(SELECT round(quantile_cont(d, {p / 100}), 6) FROM {s}) AS {g}_p{p}" for s, g in (('gj', 'gj'), ('gi', 'gij')) for p in _PCT)} FROM o""")
def _(t):
    dom = points(t).select("id", "x", "y")
    out = G.sampling_pattern(dom.where("id % 4 = 0"), dom, 0.02)
    return rounded(out, 6, *[c for c in out.columns if c not in ("label", "n_sample", "n_domain")])


@query("G06", f"WITH {POINTS} SELECT round(avg(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))), 6) AS mean, (SELECT count(*) FROM p) AS n FROM p a JOIN p b ON a.id < b.id")
def _(t):
    return rounded(G.mean_pairwise_distance(points(t), ["x", "y"]), 6, "mean")


_Z = "g AS (SELECT l_suppkey % 10 AS r, l_linenumber - 1 AS c, avg(l_quantity) AS z FROM lineitem GROUP BY ALL)"
_TERRAIN = ["slope", "aspect", "northness", "eastness", "heat_load", "tpi", "tri", "curvature"]


@query("G09", f"""WITH {_Z}, e AS (SELECT max(r) AS rr, max(c) AS cc FROM g),
nb AS (SELECT a.r, a.c, a.z, n.z AS n, s.z AS s, w.z AS w, e.z AS e FROM g a LEFT JOIN g n ON n.r = a.r - 1 AND n.c = a.c LEFT JOIN g s ON s.r = a.r + 1 AND s.c = a.c LEFT JOIN g w ON w.r = a.r AND w.c = a.c - 1 LEFT JOIN g e ON e.r = a.r AND e.c = a.c + 1),
tp AS (SELECT a.r, a.c, avg(b.z) AS m FROM g a, e, range(-3, 4) i(i), range(-3, 4) j(j), g b WHERE b.r = greatest(0, least(rr, a.r + i)) AND b.c = greatest(0, least(cc, a.c + j)) GROUP BY ALL),
tr AS (SELECT a.r, a.c, sqrt(sum(pow(a.z - b.z, 2))) AS tri FROM g a, e, range(-1, 2) i(i), range(-1, 2) j(j), g b WHERE (i <> 0 OR j <> 0) AND b.r = (a.r + i + rr + 1) % (rr + 1) AND b.c = (a.c + j + cc + 1) % (cc + 1) GROUP BY ALL),
gr AS (SELECT r, c, z, CASE WHEN n IS NULL THEN (s - z) / 30 WHEN s IS NULL THEN (z - n) / 30 ELSE (s - n) / 60 END AS dy, CASE WHEN w IS NULL THEN (e - z) / 30 WHEN e IS NULL THEN (z - w) / 30 ELSE (e - w) / 60 END AS dx, (coalesce(n, z) + coalesce(s, z) + coalesce(e, z) + coalesce(w, z) - 4 * z) / 900 AS curvature FROM nb),
sl AS (SELECT *, atan(sqrt(dx * dx + dy * dy)) AS sr FROM gr), az AS (SELECT *, degrees(sr) AS slope, CASE WHEN degrees(sr) >= 0.5 THEN (90 - degrees(atan2(dy, -dx)) + 720) % 360 END AS aspect FROM sl)
SELECT r AS "row", c AS col, round(z, 6) AS z, round(slope, 4) AS slope, round(aspect, 4) AS aspect, round(cos(radians(aspect)), 4) + 0.0 AS northness, round(sin(radians(aspect)), 4) + 0.0 AS eastness, round(0.339 + 0.808 * cos(radians(35)) * cos(sr) - 0.196 * sin(radians(35)) * sin(sr) - 0.482 * cos(radians(abs(180 - abs(aspect - 315)))) * sin(sr), 4) AS heat_load, round(z - m, 4) + 0.0 AS tpi, round(tri, 4) AS tri, round(curvature, 6) + 0.0 AS curvature FROM az JOIN tp USING (r, c) JOIN tr USING (r, c)""")
def _(t):
    g = t.lineitem.groupBy((F.col("l_suppkey") % 10).alias("row"), (F.col("l_linenumber") - 1).alias("col")).agg(F.avg("l_quantity").alias("z"))
    out = rounded(rounded(G.terrain(g, 30.0, -35.0), 4, "slope", "aspect", "northness", "eastness", "heat_load", "tpi", "tri"), 6, "z", "curvature")
    return out.withColumns({c: F.col(c) + 0.0 for c in ("northness", "eastness", "tpi", "curvature")})


_BIO = ["map", "mat", "tmax_warmest", "tmin_coldest", "dtr", "p_seasonality_cv", "t_seasonality_sd", "p_driest_quarter", "p_wettest_quarter", "t_warmest_quarter", "t_coldest_quarter", "p_summer_frac", "demartonne", "p_interannual_cv"]


@query("A25", f"""WITH f AS (SELECT o_custkey % 10 AS cell, year(o_orderdate) AS y, month(o_orderdate)::INT AS month, sum(o_totalprice) / 1e5 AS pr, avg(o_totalprice) / 1e4 - 8 AS tmin, max(o_totalprice) / 1e4 - 4 AS tmax FROM orders GROUP BY ALL),
m AS (SELECT cell, month, avg(pr) AS pr, avg(tmin) AS tmin, avg(tmax) AS tmax, (avg(tmin) + avg(tmax)) / 2 AS t FROM f GROUP BY ALL), a AS (SELECT cell, stddev_samp(pr) / avg(pr) AS p_interannual_cv FROM (SELECT cell, y, sum(pr) AS pr FROM f GROUP BY ALL) GROUP BY 1),
q AS (SELECT cell, (month - 1 - k + 12) % 12 AS q, sum(pr) AS p, avg(t) AS t FROM m, range(3) r(k) GROUP BY ALL), qq AS (SELECT cell, min(p) AS p_driest_quarter, max(p) AS p_wettest_quarter, max(t) AS t_warmest_quarter, min(t) AS t_coldest_quarter FROM q GROUP BY 1),
b AS (SELECT cell, sum(pr) AS map, avg(t) AS mat, max(tmax) AS tmax_warmest, min(tmin) AS tmin_coldest, avg(tmax - tmin) AS dtr, stddev_samp(pr) / (sum(pr) / 12) AS p_seasonality_cv, stddev_samp(t) AS t_seasonality_sd, sum(pr) FILTER (month IN (12, 1, 2)) / sum(pr) AS p_summer_frac FROM m GROUP BY 1)
SELECT cell, {r_sql(5, *[c for c in _BIO if c != 'demartonne'])}, round(CASE WHEN mat > -10 THEN map / (mat + 10) END, 5) AS demartonne FROM b JOIN qq USING (cell) JOIN a USING (cell)""")
def _(t):
    key = [(F.col("o_custkey") % 10).alias("cell"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")]
    f = t.orders.groupBy(*key).agg((F.sum("o_totalprice") / 1e5).alias("pr"), (F.avg("o_totalprice") / 1e4 - 8).alias("tmin"), (F.max("o_totalprice") / 1e4 - 4).alias("tmax"))
    months = f.groupBy("cell", "month").agg(*[F.avg(c).alias(c) for c in ("pr", "tmin", "tmax")])
    return rounded(G.bioclim(months, f.groupBy("cell", "year").agg(F.sum("pr").alias("pr"))), 5, *_BIO)


# statistics ------------------------------------------------------------------------------------------

@query("A11", "WITH o AS (SELECT o_custkey, year(o_orderdate) AS y, dayofyear(o_orderdate) AS d, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS v FROM orders), v AS (SELECT *, d - lag(d) OVER (PARTITION BY o_custkey ORDER BY d) AS gap FROM o WHERE v IS NOT NULL), c AS (SELECT o_custkey, string_agg(y || ':' || n, ',' ORDER BY y) AS per_year FROM (SELECT o_custkey, y, count(*) AS n FROM v GROUP BY ALL) GROUP BY 1) SELECT a.o_custkey, a.n_obs, max_gap::INT AS max_gap, round(mean_gap, 6) AS mean_gap, round(a.frac, 6) AS frac_valid, coalesce(per_year, '') AS per_year FROM (SELECT o_custkey, count(v) AS n_obs, count(v) / count(*) AS frac FROM o GROUP BY 1) a LEFT JOIN (SELECT o_custkey, max(gap) AS max_gap, avg(gap) AS mean_gap FROM v GROUP BY 1) USING (o_custkey) LEFT JOIN c USING (o_custkey)")
def _(t):
    o = t.orders.select("o_custkey", F.year("o_orderdate").alias("y"), F.dayofyear("o_orderdate").alias("d"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v"))
    seen = o.where("v IS NOT NULL")
    gap = seen.select("o_custkey", (F.col("d") - F.lag("d").over(Window.partitionBy("o_custkey").orderBy("d"))).alias("g")).groupBy("o_custkey").agg(F.max("g").alias("max_gap"), r6(F.avg("g")).alias("mean_gap"))
    years = seen.groupBy("o_custkey", "y").agg(F.count("*").alias("n")).groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("y", "n"))).alias("a"))
    years = years.select("o_custkey", F.array_join(F.transform("a", lambda x: F.concat_ws(":", x["y"].cast("string"), x["n"].cast("string"))), ",").alias("per_year"))
    base = o.groupBy("o_custkey").agg(F.count("v").alias("n_obs"), r6(F.count("v") / F.count("*")).alias("frac_valid"))
    return base.join(gap, "o_custkey", "left").join(years, "o_custkey", "left").na.fill("", ["per_year"])


@query("A19", "WITH s AS (SELECT nullif(o_orderstatus, 'P') AS g, o_orderpriority AS target, o_totalprice / 1e5 AS x, o_custkey AS seed FROM orders), f AS (SELECT g, target, count(DISTINCT seed) AS seeds, avg(x) AS m, coalesce(stddev_samp(x), 0) AS sd, avg(x - 1.5) AS bias FROM s GROUP BY ALL) SELECT g, count(DISTINCT target) AS n_targets, round(avg(m), 6) AS mean, round(min(m), 6) AS min, round(max(m), 6) AS max, round(avg(sd), 6) AS sd, round(avg(bias), 6) AS bias, round(avg(abs(bias)), 6) AS bias_abs, max(seeds) AS seeds FROM f GROUP BY 1")
def _(t):
    """Means of each target, then of each group, null group included; a mean of absolute biases beside the bias."""
    s = t.orders.select(F.expr("nullif(o_orderstatus, 'P')").alias("g"), F.col("o_orderpriority").alias("target"), (F.col("o_totalprice") / 1e5).alias("x"), F.col("o_custkey").alias("seed"))
    f = s.groupBy("g", "target").agg(F.count_distinct("seed").alias("seeds"), F.avg("x").alias("m"), F.coalesce(F.stddev_samp("x"), F.lit(0.0)).alias("sd"), F.avg(F.col("x") - 1.5).alias("b"))
    return f.groupBy("g").agg(F.count_distinct("target").alias("n_targets"), r6(F.avg("m")).alias("mean"), r6(F.min("m")).alias("min"), r6(F.max("m")).alias("max"), r6(F.avg("sd")).alias("sd"), r6(F.avg("b")).alias("bias"), r6(F.avg(F.abs("b"))).alias("bias_abs"), F.max("seeds").alias("seeds"))


_OOF = "o AS (SELECT l_linenumber % 3 AS seed, l_suppkey AS owner, l_quantity AS obs, l_quantity * (1 - l_discount) AS pred FROM lineitem)"


@query("A28", f"""WITH {_OOF}, c AS (SELECT seed, obs, pred, avg(obs) OVER (PARTITION BY seed) AS mo, avg(obs) OVER (PARTITION BY seed, owner) AS go, avg(pred) OVER (PARTITION BY seed, owner) AS gp FROM o), s AS (SELECT seed, 1 - sum(pow(obs - pred, 2)) / sum(pow(obs - mo, 2)) AS total, 1 - sum(pow((obs - go) - (pred - gp), 2)) / sum(pow(obs - go, 2)) AS within, sum(pow(obs - go, 2)) AS wi, sum(pow(obs - mo, 2)) AS al FROM c GROUP BY 1),
g AS (SELECT seed, owner, avg(obs) AS o, avg(pred) AS p FROM o GROUP BY ALL), b AS (SELECT seed, 1 - sum(pow(o - p, 2)) / sum(pow(o - m, 2)) AS between_ FROM (SELECT *, avg(o) OVER (PARTITION BY seed) AS m FROM g) GROUP BY 1)
SELECT round(avg(total), 6) AS total, round(avg(within), 6) AS within, round(avg(between_), 6) AS between, round(sum(wi) / sum(al), 6) AS within_share FROM s JOIN b USING (seed)""")
def _(t):
    o = t.lineitem.select((F.col("l_linenumber") % 3).alias("seed"), F.col("l_suppkey").alias("owner"), F.col("l_quantity").alias("obs"), (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("pred"))
    s = V.variance_shares(o, "owner")
    return s.agg(r6(F.avg("total")).alias("total"), r6(F.avg("within")).alias("within"), r6(F.avg("between")).alias("between"), r6(F.sum("ss_within") / F.sum("ss_total")).alias("within_share"))


def paired_sql(by: str, family: str = "") -> str:
    """pt (by, n, mean, t, p_t, w, p_w, and by family) of dd (by, d)."""
    return f"""tt AS (SELECT {by}, count(*) AS n, avg(d) AS mean, avg(d) / nullif(stddev_samp(d) / sqrt(count(*)), 0) AS t FROM dd GROUP BY ALL),
rk AS (SELECT {by}, d, rank() OVER (PARTITION BY {by} ORDER BY abs(d)) + (count(*) OVER (PARTITION BY {by}, abs(d)) - 1) / 2 AS r, count(*) OVER (PARTITION BY {by}, abs(d)) AS c FROM dd WHERE d <> 0),
ww AS (SELECT {by}, count(*) AS m, coalesce(sum(r) FILTER (d > 0), 0) AS w, sum(c * c - 1) AS ties FROM rk GROUP BY ALL),
zz AS (SELECT *, abs(t * (1 - 1 / (4.0::DOUBLE * (n - 1))) / sqrt(1 + t * t / (2.0::DOUBLE * (n - 1)))) AS zt, abs((w - m * (m + 1) / 4) / sqrt(m * (m + 1) * (2 * m + 1) / 24 - ties / 48)) AS zw FROM tt JOIN ww USING ({by})),
pv AS (SELECT *, 2 * (1 - ({cdf_sql('zt')})) AS p_t, 2 * (1 - ({cdf_sql('zw')})) AS p_w FROM zz), pt AS (SELECT *, least(1, p_t * count(*) OVER ({'PARTITION BY ' + family if family else ''})) AS p_t_family, least(1, p_w * count(*) OVER ({'PARTITION BY ' + family if family else ''})) AS p_w_family FROM pv)"""


_TEST = ["p_t", "p_w", "p_t_family", "p_w_family"]


def _tested(df):
    return rounded(rounded(df, 5, "t", "w"), 6, "mean", *_TEST)


@query("A31", f"WITH s AS (SELECT l_linestatus AS family, l_returnflag AS model, l_suppkey AS k, avg(l_tax) AS v FROM lineitem GROUP BY ALL), dd AS (SELECT family, a.model AS a, b.model AS b, round(a.v - b.v, 9) AS d FROM s a JOIN s b USING (family, k) WHERE a.model < b.model), {paired_sql('family, a, b', 'family')} SELECT family, a, b, n, {r_sql(5, 't', 'w')}, {r_sql(6, 'mean', *_TEST)} FROM pt")
def _(t):
    s = t.lineitem.groupBy(F.col("l_linestatus").alias("family"), F.col("l_returnflag").alias("model"), F.col("l_suppkey").alias("k")).agg(F.avg("l_tax").alias("v"))
    j = s.select("family", "k", F.col("model").alias("a"), F.col("v").alias("x")).join(s.select("family", "k", F.col("model").alias("b"), F.col("v").alias("y")), ["family", "k"]).where("a < b")
    return _tested(V.paired_tests(j.select("family", "a", "b", F.round(F.col("x") - F.col("y"), 9).alias("d")), ["family", "a", "b"], ["family"]))


_MODELS = ("q", "q95", "flat")
_ERR = "m AS (SELECT l_partkey AS plot, avg(l_extendedprice) / 1e4 AS price, avg(l_extendedprice * (1 - l_discount)) / 1e4 AS net, avg(l_quantity * p_retailprice) / 1e4 AS q, avg(l_quantity * p_retailprice) * 0.95 / 1e4 AS q95, 3.8::DOUBLE AS flat FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)"


@query("A32", f"WITH {_ERR}, e AS (" + " UNION ALL ".join(f"SELECT '{k}' AS model, '{y}' AS target, plot, pow({k} - {y}, 2) AS e FROM m" for k in _MODELS for y in ("price", "net")) + f"), dd AS (SELECT a.model AS a, b.model AS b, target, round(a.e - b.e, 9) AS d FROM e a JOIN e b USING (target, plot) WHERE a.model < b.model), {paired_sql('a, b, target')} SELECT a, b, target, n, {r_sql(5, 't', 'w')}, {r_sql(6, 'mean', *_TEST)} FROM pt")
def _(t):
    """Paired tests of the squared errors of each plot, for pairs of models and each target."""
    q = F.avg(F.col("l_quantity") * F.col("p_retailprice"))
    m = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_partkey").alias("plot")).agg((F.avg("l_extendedprice") / 1e4).alias("price"), (F.avg(F.col("l_extendedprice") * (1 - F.col("l_discount"))) / 1e4).alias("net"), (q / 1e4).alias("q"), (q * 0.95 / 1e4).alias("q95"), F.lit(3.8).alias("flat"))
    e = m.select("plot", F.explode(F.array(*[F.struct(F.lit(k).alias("model"), F.lit(y).alias("target"), F.pow(F.col(k) - F.col(y), F.lit(2)).alias("e")) for k in _MODELS for y in ("price", "net")])).alias("x")).select("plot", "x.*")
    j = e.select("plot", "target", F.col("model").alias("a"), F.col("e").alias("x")).join(e.select("plot", "target", F.col("model").alias("b"), F.col("e").alias("y")), ["plot", "target"]).where("a < b")
    return _tested(V.paired_tests(j.select("a", "b", "target", F.round(F.col("x") - F.col("y"), 9).alias("d")), ["a", "b", "target"]))


_DOY = [(108 + k * 365 / 64) % 365 for k in range(64)]


@query("W09", "SELECT label, round(median(abs(embedding[47]::DOUBLE - embedding[46]::DOUBLE)), 6) AS boundary, any_value(typical) AS typical FROM embeddings JOIN (SELECT label, round(median(abs(embedding[k + 1]::DOUBLE - embedding[k]::DOUBLE)), 6) AS typical FROM embeddings, range(1, 64) r(k) GROUP BY 1) USING (label) GROUP BY 1")
def _(t):
    return rounded(S.year_boundary_step(t.embeddings, "label", "embedding", _DOY), 6, "boundary", "typical")


@query("F14", "SELECT p_partkey, lower(translate(replace(replace(regexp_replace(regexp_replace('RN_Los_Queñes ' || p_name || '_PL', '^RN_', ''), '_[A-Z]+$', ''), 'Los_Queñes', 'Queñes'), 'Los_Placeres', 'Los_Paceres'), 'áéíóúñÁÉÍÓÚÑ', 'aeiounAEIOUN')) AS base FROM part")
def _(t):
    s = F.concat(F.lit("RN_Los_Queñes "), F.col("p_name"), F.lit("_PL"))
    return t.part.select("p_partkey", folded_name(s, prefixes=["RN_"], suffix="_[A-Z]+", literals={"Los_Queñes": "Queñes", "Los_Placeres": "Los_Paceres"}).alias("base"))


# alignment and targets --------------------------------------------------------------------------------

@query("J26", "SELECT id, a, b, c FROM (SELECT o_custkey AS id, count(*) AS a FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) FULL JOIN (SELECT c_custkey AS id, c_acctbal AS b FROM customer WHERE c_acctbal < 0) USING (id) FULL JOIN (SELECT o_custkey AS id, round(max(o_totalprice), 2) AS c FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) USING (id)")
def _(t):
    a = t.orders.where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("a"))
    b = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("b"))
    c = t.orders.where("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("id")).agg(F.round(F.max("o_totalprice"), 2).alias("c"))
    return R.align([a, b, c], "id")


@query("J06", "SELECT id, a, b, c FROM (SELECT DISTINCT l_suppkey AS id FROM lineitem) LEFT JOIN (SELECT l_suppkey AS id, count(*) AS a FROM lineitem GROUP BY 1) USING (id) LEFT JOIN (SELECT l_suppkey AS id, round(avg(l_tax), 6) AS b FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (id) LEFT JOIN (SELECT l_suppkey AS id, max(l_quantity) AS c FROM lineitem WHERE l_linenumber = 7 GROUP BY 1) USING (id)")
def _(t):
    """Facets of all plots side by side; a plot that no facet has is an error."""
    key = F.col("l_suppkey").alias("id")
    a = t.lineitem.groupBy(key).agg(F.count("*").alias("a"))
    b = t.lineitem.where("l_returnflag = 'R'").groupBy(key).agg(r6(F.avg("l_tax")).alias("b"))
    c = t.lineitem.where("l_linenumber = 7").groupBy(key).agg(F.max("l_quantity").alias("c"))
    return R.aligned([a, b, c], t.lineitem.select(key).distinct(), "id")


#: Names of target sets on the tables here, one made of others, and names that are never targets.
TARGET_SETS = {"sizes": ["p_size", "p_retailprice"], "names": ["p_name", "p_brand"], "all": ["p_size", "p_retailprice", "p_name", "p_brand"]}
FORBIDDEN = {"p_type"}


@query("P15", "SELECT s AS target_set, i::INT AS place, n AS target FROM (VALUES ('sizes', 0, 'p_size'), ('sizes', 1, 'p_retailprice'), ('names', 0, 'p_name'), ('names', 1, 'p_brand'), ('all', 0, 'p_size'), ('all', 1, 'p_retailprice'), ('all', 2, 'p_name'), ('all', 3, 'p_brand')) v(s, i, n)")
def _(t):
    rows = [(s, i, n) for s in TARGET_SETS for i, n in enumerate(R.resolve_targets(s, TARGET_SETS, FORBIDDEN, t.part.columns))]
    return t.spark.createDataFrame(rows, "target_set string, place int, target string")


@query("O04", "WITH p AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_suppkey < b.s_suppkey) SELECT a, b FROM p QUALIFY row_number() OVER (ORDER BY md5('7|' || a || '|' || b), a, b) <= 500")
def _(t):
    """A random sample of pairs: as many as asked for, in the order of a digest."""
    s = t.supplier.select("s_suppkey")
    # the halves of what is digested are made once for each row, not for each pair
    x, y = s.select(F.col("s_suppkey").alias("a"), F.concat(F.lit("7|"), "s_suppkey", F.lit("|")).alias("_a")), s.select(F.col("s_suppkey").alias("b"), F.col("s_suppkey").cast("string").alias("_b"))
    n = s.count()
    return R.least_digests(R.pair_join(x, y, F.col("a") < F.col("b")), F.md5(F.concat("_a", "_b")), ["a", "b"], 500, n * (n - 1) // 2).select("a", "b")


# folds -------------------------------------------------------------------------------------------------

_FOLDS = "f AS (SELECT c_mktsegment AS s, row_number() OVER (ORDER BY c_mktsegment) - 1 AS fold FROM customer GROUP BY 1 HAVING count(*) >= 20)"


@query("V07", f"WITH {_FOLDS} SELECT fold, s AS held_out, count(*) FILTER (c_mktsegment <> s) AS n_train, count(*) FILTER (c_mktsegment = s) AS n_test, sum(c_custkey) FILTER (c_mktsegment = s)::BIGINT AS test_ids FROM customer, f GROUP BY ALL")
def _(t):
    """What a loop over the folds of a scheme would be given: train and test of each, from the long table."""
    folds = V.leave_one_group_out(t.customer, "c_custkey", "c_mktsegment", 20)
    n = lambda split: F.count(F.when(F.col("split") == split, 1))
    return folds.groupBy("fold", "held_out").agg(n("train").alias("n_train"), n("test").alias("n_test"), F.sum(F.when(F.col("split") == "test", F.col("c_custkey"))).alias("test_ids"))


_SCHEMES = "s AS (SELECT l_returnflag AS model, l_linenumber % 4 AS k, l_tax AS v FROM lineitem)"


@query("V14", f"WITH {_SCHEMES}, p AS (SELECT model, avg(v) FILTER (k = 0) AS base, avg(v) FILTER (k = 1) AS time, avg(v) FILTER (k = 2) AS place, avg(v) FILTER (k = 3) AS bo FROM s GROUP BY 1) SELECT model, round(base, 7) AS base, round(time - base, 7) AS d_time, round(place - base, 7) AS d_place, round(bo - base, 7) AS d_both, round((bo - base) - (time - base) - (place - base), 7) AS interaction FROM p")
def _(t):
    """Scores of the same models under four schemes: the drop by time, by place, by both, and their interaction."""
    s = t.lineitem.select(F.col("l_returnflag").alias("model"), F.element_at(F.array(*[F.lit(x) for x in ("base", "time", "place", "both")]), (F.col("l_linenumber") % 4 + 1).cast("int")).alias("scheme"), F.col("l_tax").alias("score"))
    return rounded(V.scheme_decomposition(s, "model", "base", "time", "place", "both"), 7, "base", "d_time", "d_place", "d_both", "interaction")


@query("V15", """WITH c AS (SELECT p_partkey, ln(p_retailprice) AS y, p_size::DOUBLE AS x, s AS seed, ('0x' || substr(md5(s || '|' || p_partkey), 1, 8))::BIGINT % 5 AS fold FROM part, range(3) r(s)),
m AS (SELECT a.seed, f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM c a, range(5) f(fold) WHERE a.fold <> f.fold GROUP BY ALL) SELECT c.seed::INT AS seed, c.fold::INT AS fold, p_partkey, round(y, 6) AS obs, round(m.a + m.b * x, 6) AS pred FROM c JOIN m ON m.seed = c.seed AND m.fold = c.fold""")
def _(t):
    """Out-of-fold predictions of a line, for each seed's folds: each fold's line is of all other folds."""
    c = t.part.select("p_partkey", F.log("p_retailprice").alias("y"), F.col("p_size").cast("double").alias("x"), F.explode(F.array(*[F.lit(s) for s in range(3)])).alias("seed"))
    c = c.withColumn("fold", (F.conv(F.substring(F.md5(F.concat_ws("|", "seed", "p_partkey")), 1, 8), 16, 10).cast("long") % 5).cast("int"))
    return rounded(V.out_of_fold_lines(c, "p_partkey", "x", "y", 5), 6, "obs", "pred").select("seed", "fold", "p_partkey", "obs", "pred")


# retransformation and dissimilarity models -------------------------------------------------------------

_KNOTS = "k AS (SELECT quantile_cont(p_retailprice, 0) AS a, quantile_cont(p_retailprice, 0.5) AS b, quantile_cont(p_retailprice, 1) AS c FROM part WHERE p_partkey % 3 <> 0)"


def _spline_sql(v: str) -> list[str]:
    part = lambda lo, hi: f"greatest(0, least(1, ({v} - {lo}) / ({hi} - {lo})))"
    u, w, z = part("a", "b"), part("a", "c"), part("b", "c")
    return [f"{u} * (2 - {u})", f"{w} * {w} * (3 - 2 * {w})", f"{z} * {z}"]


@query("M17", f"WITH {_KNOTS} SELECT p_partkey, {', '.join(f'round({e}, 6) AS i{i + 1}' for i, e in enumerate(_spline_sql('p_retailprice')))} FROM part, k")
def _(t):
    """Splines of all rows on knots at quantiles of the training rows alone."""
    knots = t.part.where("p_partkey % 3 != 0").agg(F.expr("percentile(p_retailprice, array(0.0, 0.5, 1.0))").alias("k"))
    p = t.part.crossJoin(F.broadcast(knots))
    return p.select("p_partkey", *[r6(c).alias(f"i{i + 1}") for i, c in enumerate(V.ispline_of(F.col("p_retailprice"), F.col("k")))])


_SPLINED = f"kk AS (SELECT quantile_cont(s_acctbal, 0) AS a, quantile_cont(s_acctbal, 0.5) AS b, quantile_cont(s_acctbal, 1) AS c FROM supplier), sp AS (SELECT s_suppkey AS id, s_nationkey AS g, {', '.join(f'{e} AS i{i + 1}' for i, e in enumerate(_spline_sql('s_acctbal')))} FROM supplier, kk)"


def _splined(t):
    knots = t.supplier.agg(F.expr("percentile(s_acctbal, array(0.0, 0.5, 1.0))").alias("k"))
    s = t.supplier.crossJoin(F.broadcast(knots))
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("g"), *[c.alias(f"i{i + 1}") for i, c in enumerate(V.ispline_of(F.col("s_acctbal"), F.col("k")))])


def _design(t):
    s = _splined(t)
    return V.pair_design(s, "id", ["i1", "i2", "i3"])


@query("M18", f"WITH {_SPLINED} SELECT a.id AS a, b.id AS b, 1.0::DOUBLE AS intercept, " + ", ".join(f"round(abs(a.i{i} - b.i{i}), 6) AS i{i}" for i in (1, 2, 3)) + " FROM sp a JOIN sp b ON a.id < b.id")
def _(t):
    # differences are not below zero; round() would make a decimal of each
    return _design(t).withColumns({c: F.floor(F.col(c) * 1e6 + 0.5) / 1e6 for c in ("i1", "i2", "i3")})


_BETA = (0.2, 0.5, 0.3, 0.4)


@query("M20", f"WITH {_SPLINED}, d AS (SELECT {_BETA[0]} + " + " + ".join(f"{b} * abs(a.i{i} - b.i{i})" for i, b in enumerate(_BETA[1:], 1)) + " AS eta, abs(a.g - b.g) / 25 AS y FROM sp a JOIN sp b ON a.id < b.id), q AS (SELECT y, 1 - exp(-greatest(0, least(50, eta))) AS p, avg(y) OVER () AS m FROM d), " + """v AS (SELECT 2 * (CASE WHEN y > 0 THEN y * ln(y / p) ELSE 0 END + CASE WHEN y < 1 THEN (1 - y) * ln((1 - y) / (1 - p)) ELSE 0 END) AS a, 2 * (CASE WHEN y > 0 THEN y * ln(y / m) ELSE 0 END + CASE WHEN y < 1 THEN (1 - y) * ln((1 - y) / (1 - m)) ELSE 0 END) AS b FROM q) SELECT count(*) AS pairs, round(1 - sum(a) / sum(b), 6) AS explained, (SELECT round(avg(p), 6) FROM q) AS mean_pred FROM v""")
def _(t):
    s = _splined(t)
    d = V.pair_design(s, "id", ["i1", "i2", "i3"], also=["g"])
    eta = F.col("intercept") * _BETA[0] + sum(F.col(f"i{i}") * b for i, b in enumerate(_BETA[1:], 1))
    own = d.select((F.abs(F.col("g_a") - F.col("g_b")) / 25).alias("y"), (1 - F.exp(-F.greatest(F.lit(0.0), F.least(F.lit(50.0), eta)))).alias("p"))
    return V.deviance_explained(own, "y", "p").crossJoin(own.agg(F.count("*").alias("pairs"), r6(F.avg("p")).alias("mean_pred"))).select("pairs", r6("explained").alias("explained"), "mean_pred")


_DRAWS = [-0.4, -0.15, 0.0, 0.1, 0.45]
_LAM, _LO, _HI, _STEPS = 0.5, -1.0, 12.0, 257


def _back_sql(z: str) -> str:
    return f"CASE WHEN {z} >= 0 THEN pow({z} * {_LAM} + 1, {1 / _LAM}) - 1 ELSE 1 - pow(1 - {2 - _LAM} * {z}, {1 / (2 - _LAM)!r}) END"


def _smeared_sql(z: str) -> str:
    return "(" + " + ".join(_back_sql(f"greatest({_LO}, least({_HI}, ({z}) + {r}))") for r in _DRAWS).replace("CASE", "(CASE").replace("END", "END)") + f") / {len(_DRAWS)}"


@query("M13", f"""WITH g AS (SELECT k, {_smeared_sql(f'({_LO} + {(_HI - _LO)!r} * k / {_STEPS - 1})')} AS v FROM range({_STEPS}) r(k)), x AS (SELECT s_suppkey, CASE WHEN s_suppkey % 11 <> 0 THEN (greatest({_LO}, least({_HI}, s_acctbal / 700)) - ({_LO})) * {(_STEPS - 1) / (_HI - _LO)!r} END AS pos FROM supplier),
y AS (SELECT s_suppkey, pos, least(floor(pos)::BIGINT, {_STEPS - 2}) AS i FROM x) SELECT s_suppkey, round(CASE WHEN pos IS NOT NULL THEN greatest(0.5, least(40, a.v + (b.v - a.v) * (pos - i))) END, 5) AS y FROM y LEFT JOIN g a ON a.k = i LEFT JOIN g b ON b.k = i + 1""")
def _(t):
    """The smearing estimate read off a table that is built once from the residual draws."""
    table = V.smearing_table(_DRAWS, _LAM, _LO, _HI, 0.5, 40.0, _STEPS)
    pred = F.when(F.col("s_suppkey") % 11 != 0, F.col("s_acctbal") / 700)
    return t.supplier.select("s_suppkey", F.round(V.from_table(pred, table, _LO, _HI, 0.5, 40.0), 5).alias("y"))


_SEEDS = ((0.9, 0.30), (1.0, 0.10), (1.1, -0.20))


@query("M14", "SELECT s_suppkey, round(avg(y), 5) AS mean, round(coalesce(stddev_samp(y), 0), 5) AS sd, count(y) AS members FROM (" + " UNION ALL ".join(f"SELECT s_suppkey, CASE WHEN s_suppkey % {5 + i} <> 0 THEN {_back_sql(f'({a} * s_acctbal / 1000 + {b})')} END AS y FROM supplier" for i, (a, b) in enumerate(_SEEDS)) + ") GROUP BY 1")
def _(t):
    """Members of an ensemble transformed back one by one, then averaged over those that have a value."""
    x = F.col("s_acctbal") / 1000
    members = [F.when(F.col("s_suppkey") % (5 + i) != 0, V.yeo_johnson_inverse(a * x + b, _LAM)) for i, (a, b) in enumerate(_SEEDS)]
    return rounded(V.ensemble(t.supplier, ["s_suppkey"], members), 5, "mean", "sd")


@query("M16", "SELECT s_suppkey, round(s_acctbal, 2) AS topo_elevation, CASE WHEN s_acctbal >= 1000 THEN round(s_acctbal / 1e4, 6) END AS topo_heat_load, (s_acctbal < 1000)::INT::DOUBLE AS topo_flat, round(log10(900), 6) AS area_log10, 0.0::DOUBLE AS area_stratum_shrub, 1.0::DOUBLE AS area_stratum_forest FROM supplier")
def _(t):
    """Context columns in the order that a model asks for: terrain, a flag where a measure of it is undefined, constant area and stratum."""
    s = t.supplier.select("s_suppkey", F.round("s_acctbal", 2).alias("elevation"), F.when(F.col("s_acctbal") >= 1000, r6(F.col("s_acctbal") / 1e4)).alias("heat_load"))
    cols = ["topo_elevation", "topo_heat_load", "topo_flat", "area_log10", "area_stratum_shrub", "area_stratum_forest"]
    out = R.context_columns(s, ["elevation", "heat_load"], "heat_load", 900.0, "forest", ["cover", "shrub", "forest"], cols, keep=["s_suppkey"])
    return out.withColumn("area_log10", r6("area_log10"))


_AREAS = (100.0, 900.0, 2500.0)


@query("M25", "WITH f AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM (SELECT ln(o_totalprice) AS x, year(o_orderdate) + month(o_orderdate) / 12 AS y FROM orders)), p AS (SELECT o_orderkey, a + b * ln(o_totalprice) AS own, " + ", ".join(f"a + b * {i}.0 * ln({x})" + f" AS p{i}" for i, x in enumerate(_AREAS, 1)) + " FROM orders, f), s AS (SELECT own, (SELECT stddev_samp(v) FROM (VALUES (p1), (p2), (p3)) t(v)) AS sd, greatest(p1, p2, p3) - least(p1, p2, p3) AS range FROM p) SELECT round(median(sd), 5) AS sd_median, round(quantile_cont(sd, 0.9), 5) AS sd_p90, round(median(range), 5) AS range_median, round(quantile_cont(range, 0.9), 5) AS range_p90, round(stddev_samp(own), 5) AS natural_sd FROM s")
def _(t):
    """How far predictions move when a predictor is set to reference values in their place, beside their own spread."""
    x = F.log("o_totalprice")
    fit = t.orders.agg(F.regr_slope(F.year("o_orderdate") + F.month("o_orderdate") / 12, x).alias("b"), F.regr_intercept(F.year("o_orderdate") + F.month("o_orderdate") / 12, x).alias("a"))
    p = t.orders.crossJoin(F.broadcast(fit))
    swapped = [F.col("a") + F.col("b") * float(i) * F.log(F.lit(v)) for i, v in enumerate(_AREAS, 1)]
    return rounded(V.counterfactual_spread(p, F.col("a") + F.col("b") * x, swapped), 5, "sd_median", "sd_p90", "range_median", "range_p90", "natural_sd")


# blocks ------------------------------------------------------------------------------------------------

_STATS = ["mean", "sd", "p10", "p25", "p50", "p75", "p90", "min", "max", "range", "iqr", "cv"]
_STAT_SQL = "st AS (SELECT plot, idx, avg(v) AS mean, stddev_samp(v) AS sd, quantile_cont(v, 0.1) AS p10, quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, quantile_cont(v, 0.9) AS p90, min(v) AS min, max(v) AS max FROM (SELECT vec_id // 5 AS plot, vec_id % 5 AS idx, unnest(embedding)::DOUBLE + 1 AS v FROM embeddings) GROUP BY ALL), sx AS (SELECT *, max - min AS range, p75 - p25 AS iqr, CASE WHEN abs(mean) > 1e-9 THEN sd / abs(mean) END AS cv FROM st)"


def _index_curves(t):
    return t.embeddings.select(F.floor(F.col("vec_id") / 5).alias("plot"), (F.col("vec_id") % 5).alias("idx"), F.transform("embedding", lambda v: v.cast("double") + 1).alias("curve"))


@query("B03", f"WITH {_STAT_SQL} SELECT a.plot, a.idx AS a, b.idx AS b, {', '.join(f'round(a.{c}, 6) AS {c}' for c in _STATS)}, round(a.mean - b.mean, 6) AS diff, round(CASE WHEN abs(b.mean) > 1e-6 THEN a.mean / b.mean END, 6) AS ratio, round(a.cv - b.cv, 6) AS cvdiff FROM sx a JOIN sx b ON a.plot = b.plot AND a.idx < b.idx")
def _(t):
    """Twelve statistics of each index's curve, and the contrasts of each pair of a plot's indices."""
    s = R.curve_statistics(_index_curves(t), ["plot", "idx"], "curve")
    c = R.index_contrasts(s, "plot", "idx")
    own = s.withColumnRenamed("idx", "a")
    return rounded(c.join(own, ["plot", "a"]).select("plot", "a", "b", *_STATS, "diff", "ratio", "cvdiff"), 6, *_STATS, "diff", "ratio", "cvdiff")


@query("B01", f"WITH {_STAT_SQL}, p AS (SELECT vec_id // 5 AS plot, vec_id % 5 AS idx, list_position(embedding, list_max(embedding)) * 365 / 64 AS peak, embedding FROM embeddings), q AS (SELECT plot, idx, sin(2 * pi() * peak / 365) AS s, cos(2 * pi() * peak / 365) AS c, array_to_string(list_transform(embedding, lambda v: round((v::DOUBLE + 1) * 10000)::BIGINT), ',') AS curve FROM p) SELECT plot, round(q.s, 6) + 0.0 AS lsp_peak_sin, round(q.c, 6) + 0.0 AS lsp_peak_cos, round(sx.range, 6) AS lsp_amplitude, curve AS curve_steps, (sx.cv > 0.12)::INT::DOUBLE AS qc_variable FROM q JOIN sx USING (plot, idx) WHERE idx = 2")
def _(t):
    """Blocks of one index: a date as sine and cosine, the amplitude, all steps of the curve, a flag of quality."""
    from quadrat.functions.calendar import circular
    from quadrat.plans.images import whole

    one = _index_curves(t).where("idx = 2")
    s = R.curve_statistics(one, ["plot", "idx"], "curve")
    peak = F.array_position("curve", F.array_max("curve")) * 365 / 64
    sin, cos = circular(peak, 365.0)
    own = one.select("plot", (r6(sin) + 0.0).alias("lsp_peak_sin"), (r6(cos) + 0.0).alias("lsp_peak_cos"), whole("curve").alias("curve_steps"))
    return own.join(s.select("plot", r6("range").alias("lsp_amplitude"), (F.col("cv") > 0.12).cast("int").cast("double").alias("qc_variable")), "plot")


@query("B02", "SELECT o_orderkey, round(log10(o_totalprice), 6) AS area_log10, (o_orderstatus = 'F')::INT::DOUBLE AS area_stratum_F, (o_orderstatus = 'P')::INT::DOUBLE AS area_stratum_P, c_acctbal AS geo_x, year(o_orderdate)::DOUBLE AS year, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS topo_heat, (c_acctbal < 0)::INT::DOUBLE AS topo_flat FROM orders JOIN customer ON c_custkey = o_custkey")
def _(t):
    """Blocks of context: area with strata but the first, coordinates, year, and terrain with a flag where it is undefined."""
    j = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    heat = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return j.select("o_orderkey", r6(F.log10("o_totalprice")).alias("area_log10"), *R.strata(F.col("o_orderstatus"), ["O", "F", "P"], "area_stratum_"), F.col("c_acctbal").alias("geo_x"), F.year("o_orderdate").cast("double").alias("year"), heat.alias("topo_heat"), heat.isNull().cast("int").cast("double").alias("topo_flat"))


@query("B04", "SELECT l_suppkey, round(median(l_tax), 6) AS gmA_gm_tax, round(median(l_discount), 6) AS gmA_gm_discount FROM lineitem GROUP BY 1")
def _(t):
    """One family of a wide table's columns: those of a prefix at one level of aggregation, under another prefix."""
    wide = t.lineitem.groupBy("l_suppkey").agg(*[r6(F.expr(f"percentile({c}, 0.5)")).alias(f"gm_{c[2:]}_median") for c in ("l_tax", "l_discount")], *[r6(F.avg(c)).alias(f"gm_{c[2:]}_mean") for c in ("l_tax", "l_discount")], r6(F.avg("l_quantity")).alias("obs_quantity_median"))
    return R.column_family(wide, ["l_suppkey"], ("gm_",), "median", "gmA_")


# runs --------------------------------------------------------------------------------------------------

@query("B15", "SELECT 'rf_base__' || p_brand || '__k' || (p_size % 3) AS run_id, count(*) AS n FROM part GROUP BY 1")
def _(t):
    """The identity of a run from what defines it, empty parts left out."""
    own = t.part.select(runs.run_id("rf", "base", index=F.col("p_brand"), substrate=F.lit(""), fusion=F.concat(F.lit("k"), F.col("p_size") % 3)).alias("run_id"))
    return own.groupBy("run_id").agg(F.count("*").alias("n"))


@query("B14", "SELECT 'job' || n_nationkey AS job, CASE WHEN n_nationkey % 4 = 0 THEN 'skipped' WHEN n_nationkey % 7 = 3 THEN 'failed' ELSE 'done' END AS status FROM nation")
def _(t):
    """A matrix of jobs: those whose result is there are skipped, a failure is recorded and the others go on."""
    jobs = [f"job{r['n_nationkey']}" for r in t.nation.select("n_nationkey").collect()]  # the matrix, some rows

    def work(job: str) -> None:
        if int(job[3:]) % 7 == 3:
            raise ValueError(job)

    return runs.run_matrix(t.spark, jobs, work, done=lambda job: int(job[3:]) % 4 == 0)


@query("B08", "SELECT l_suppkey AS tile, CASE WHEN count(*) FILTER (l_discount > 0.08) > 0.2 * count(*) THEN 'failed' ELSE 'ok' END AS status, CASE WHEN count(*) FILTER (l_discount > 0.08) <= 0.2 * count(*) THEN round(avg(l_tax), 6) END AS mean, count(*) AS n, CASE WHEN count(*) FILTER (l_discount > 0.08) > 0.2 * count(*) THEN 'too few clear observations' END AS error FROM lineitem GROUP BY 1")
def _(t):
    """Work on whole tiles, of which some fail for what their data are; a failure becomes a row."""
    def work(pdf):
        if (pdf["l_discount"] > 0.08).sum() > 0.2 * len(pdf):
            raise ValueError("too few clear observations")
        return {"mean": round(float(pdf["l_tax"].mean()), 6)}

    return runs.per_tile(t.lineitem.select("l_suppkey", "l_tax", "l_discount"), "l_suppkey", work, "mean double").withColumnRenamed("l_suppkey", "tile")


@query("B09", "SELECT s_suppkey AS tile, (row_number() OVER (ORDER BY s_suppkey) - 1) // 8 AS wave FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_linenumber = 1)")
def _(t):
    """Tiles that a resumed run has left to do, in waves of eight."""
    done = t.lineitem.where("l_quantity = 50 AND l_linenumber = 1").select(F.col("l_suppkey").alias("tile"))
    return runs.waves(t.supplier.select(F.col("s_suppkey").alias("tile")), done, "tile", 8)


@query("B07", "SELECT 'tile' || l_suppkey AS item, CASE WHEN min(l_linenumber) > 0 AND l_suppkey % 9 <> 4 THEN 'ok' ELSE 'error' END AS status, CASE WHEN l_suppkey % 9 <> 4 THEN count(*) END AS value FROM lineitem GROUP BY l_suppkey")
def _(t):
    """A function of each item on all cores; failures are recorded, not raised."""
    counts = t.lineitem.groupBy(F.concat(F.lit("tile"), F.col("l_suppkey")).alias("item")).agg(F.count("*").alias("n"))

    def work(item: str, n: int) -> int:
        if int(item[4:]) % 9 == 4:
            raise ValueError(item)
        return n

    return runs.fan_out(counts, "item", "n", work)


@query("S17", "SELECT o_custkey AS run_id, o_orderpriority AS scheme, round(o_totalprice, 2) AS score, c_mktsegment AS family, c_nationkey AS model FROM orders LEFT JOIN (SELECT DISTINCT c_custkey, c_mktsegment, c_nationkey FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey")
def _(t):
    """Pooled tables of all runs with what is known of each run."""
    meta = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("family"), F.col("c_nationkey").alias("model"))
    pooled = [t.orders.where(F.col("o_orderpriority") == p).select(F.col("o_custkey").alias("run_id"), F.lit(p).alias("scheme"), F.round("o_totalprice", 2).alias("score")) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]
    return runs.with_metadata(reduce(DataFrame.unionByName, pooled), meta, ["run_id"])


# series ------------------------------------------------------------------------------------------------

_ASOF = """s AS (SELECT {key}, count(*) AS n FROM o GROUP BY ALL), g AS (SELECT {key}, n, i, lo + (hi - lo) * i / {steps1} AS t FROM s JOIN w USING ({wkey}), range({steps}) r(i)), a AS (SELECT g.*, o.t AS t0, o.v AS v0 FROM g ASOF LEFT JOIN o ON {on} AND o.t <= g.t), b AS (SELECT a.*, o.t AS t1, o.v AS v1 FROM a ASOF LEFT JOIN o ON {ona} AND o.t >= a.t),
x AS (SELECT {key}, i, CASE WHEN n >= 5 THEN coalesce(v0 + (v1 - v0) * (t - t0) / nullif(t1 - t0, 0), v0, v1) END AS g FROM b)"""


@query("S15", "WITH m AS (SELECT c_custkey AS user_id FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IN ('BUILDING', 'MACHINERY', 'FURNITURE')), o AS (SELECT user_id, epoch(ts) AS t, value AS v FROM events SEMI JOIN m USING (user_id)), w AS (SELECT user_id, epoch(TIMESTAMP '2024-01-01') AS lo, epoch(TIMESTAMP '2024-01-30') AS hi FROM m), " + _ASOF.format(key="user_id", wkey="user_id", steps=12, steps1=11, on="o.user_id = g.user_id", ona="o.user_id = a.user_id") + " SELECT user_id, string_agg(round(g * 1000)::BIGINT::VARCHAR, ',' ORDER BY i) AS curve FROM x GROUP BY 1 HAVING count(g) = 12")
def _(t):
    """Series of the manifest's samples without an error and of some classes, gridded over their windows, complete ones only."""
    manifest = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("class"), F.when(F.col("c_acctbal") < 0, F.lit("no data")).alias("error"), F.lit("2024-01-01").cast("timestamp").cast("double").alias("lo"), F.lit("2024-01-30").cast("timestamp").cast("double").alias("hi"))
    g = S.pooled_curves(t.events.select("user_id", seconds().alias("t"), "value"), manifest, "user_id", "t", "value", 12, ["BUILDING", "MACHINERY", "FURNITURE"])
    return g.select("user_id", F.array_join(F.transform("curve", lambda v: F.round(v * 1000).cast("long").cast("string")), ",").alias("curve"))


@query("T03", "WITH o AS (SELECT user_id, user_id % 10 AS tile, y, epoch(ts) AS t, value AS v FROM events, (VALUES (10), (20)) z(y) WHERE day(ts) BETWEEN y - 4 AND y), w AS (SELECT tile, y, min(t) AS lo, max(t) AS hi FROM o GROUP BY ALL HAVING count(DISTINCT t) >= 2), " + _ASOF.format(key="user_id, tile, y", wkey="tile, y", steps=8, steps1=7, on="o.user_id = g.user_id AND o.y = g.y", ona="o.user_id = a.user_id AND o.y = a.y") + ", m AS (SELECT *, avg(g) OVER (PARTITION BY user_id, y ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS c FROM x) SELECT user_id, y::INT AS day, (i + 1)::INT AS step, round(c, 5) AS g FROM m")
def _(t):
    """Curves of each pixel for target days: the grid spans what the pixel's tile has in the window."""
    e = t.events.withColumn("day", F.explode(F.array(F.lit(10), F.lit(20)))).where(F.dayofmonth("ts").between(F.col("day") - 4, F.col("day")))
    o = e.select(F.struct("user_id", "day").alias("k"), (F.col("user_id") % 10).alias("tile"), "day", seconds().alias("t"), "value")
    span = o.groupBy("tile", "day").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.count_distinct("t").alias("n")).where("n >= 2")
    spans = o.select("k", "tile", "day").distinct().join(span, ["tile", "day"]).select("k", "lo", "hi")
    g = S.gridded(o, "k", "t", "value", 8, spans=spans)
    return S.moving_mean(g, ["k"], "step", "g", 3, "c").select("k.user_id", "k.day", "step", F.round("c", 5).alias("g"))


@query("T04", "WITH o AS (SELECT user_id, floor(epoch(ts) / 86400)::DOUBLE AS t, avg(value) AS v FROM events GROUP BY ALL), w AS (SELECT user_id, lo, hi FROM (SELECT DISTINCT user_id FROM o), (SELECT min(t) AS lo, max(t) AS hi FROM o)), c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1), " + _ASOF.format(key="user_id", wkey="user_id", steps=12, steps1=11, on="o.user_id = g.user_id", ona="o.user_id = a.user_id").replace("s AS (SELECT user_id, count(*) AS n FROM o GROUP BY ALL)", "s AS (SELECT * FROM c)") + ", m AS (SELECT *, avg(g) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS c FROM x) SELECT user_id, (i + 1)::INT AS step, round(c, 5) AS g, round((SELECT max(hi - lo) FROM w) * i / 11 + 1, 5) AS doy FROM m")
def _(t):
    """Each pixel's observations in calendar time over the whole window of a cube, not folded to a year, with the day of each step."""
    o = t.events.select("user_id", F.floor(seconds() / 86400).alias("t"), "value")
    return rounded(S.raw_series(o, "user_id", "t", "value", 12, 3), 5, "g", "doy")
