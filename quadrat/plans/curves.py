"""Queries of rarefaction, resampled curves, dark diversity and measures on a tree with shuffled labels."""

from __future__ import annotations

from pyspark.sql import functions as F


from quadrat.functions.special import NORMAL
from quadrat.operators import dark as K
from quadrat.operators import diversity as D
from quadrat.operators import phylo as P
from quadrat.operators import rarefaction as R
from quadrat.plans.catalog import query

#: Customers as plots and days (or months) of their orders as species; days in weeks in quarters, months in quarters in years.
DAYS = "occ AS (SELECT o_custkey AS plot, date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::BIGINT AS s, count(*) AS value FROM orders GROUP BY ALL)"
MONTHS = "occ AS (SELECT o_custkey AS plot, ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::BIGINT AS s, count(*) AS value FROM orders GROUP BY ALL)"
#: Lines of a supplier as individuals of 500 species, in genera of ten and families of a hundred.
PARTS = "occ AS (SELECT l_suppkey AS plot, (l_partkey % 500)::BIGINT AS s, count(*) AS value FROM lineitem GROUP BY ALL)"
LEVELS = {"days": (7, 13), "months": (3, 4), "parts": (10, 10)}


def days(t):
    s = F.datediff("o_orderdate", F.lit("1995-01-01")).cast("long")
    return t.orders.groupBy(F.col("o_custkey").alias("plot"), s.alias("s")).agg(F.count("*").alias("value"))


def months(t):
    s = ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1).cast("long")
    return t.orders.groupBy(F.col("o_custkey").alias("plot"), s.alias("s")).agg(F.count("*").alias("value"))


def parts(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("plot"), (F.col("l_partkey") % 500).alias("s")).agg(F.count("*").alias("value"))


def named(occ):
    return occ.withColumn("species", F.concat(F.lit("t"), F.col("s")))


def tree_of(occ, kind: str):
    """Edges of the tree of an occurrence table's species."""
    a, b = LEVELS[kind]
    s = occ.select("s").distinct()
    tip = s.select(F.concat(F.lit("t"), F.col("s")).alias("node"), F.concat(F.lit("g"), F.floor(F.col("s") / a)).alias("parent"), (1 + F.col("s") % a / float(a)).alias("length"))
    g = s.select(F.floor(F.col("s") / a).alias("g")).distinct()
    mid = g.select(F.concat(F.lit("g"), F.col("g")).alias("node"), F.concat(F.lit("f"), F.floor(F.col("g") / b)).alias("parent"), (2 + F.col("g") % 5 / 5.0).alias("length"))
    top = g.select(F.floor(F.col("g") / b).alias("f")).distinct().select(F.concat(F.lit("f"), F.col("f")).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(4.0).alias("length"))
    return tip.union(mid).union(top)


def closure_of(occ, kind: str):
    return D.ancestors(tree_of(occ, kind))


def _lengths(kind: str) -> tuple[str, str, str, str, str]:
    a, b = LEVELS[kind]
    return f"1 + s % {a} / {a}.0::DOUBLE", f"s // {a}", f"2 + s // {a} % 5 / 5.0::DOUBLE", f"s // {a} // {b}", "4.0::DOUBLE"


def units_sql(kind: str, more: str = "") -> str:
    """units (more, plot, unit, length, value) of occ."""
    l0, g, l1, f, l2 = _lengths(kind)
    return f"units AS (SELECT {more}plot, unit, length, sum(value)::BIGINT AS value FROM (SELECT {more}plot, 't' || s AS unit, {l0} AS length, value FROM occ UNION ALL SELECT {more}plot, 'g' || ({g}), {l1}, value FROM occ UNION ALL SELECT {more}plot, 'f' || ({f}), {l2}, value FROM occ) GROUP BY ALL)"


def units(occ, closure, more=()):
    """(more, plot, unit, length, value) of branches."""
    own = named(occ).select(*more, "plot", F.col("species").alias("node"), "value")
    return own.join(closure, "node").groupBy(*more, "plot", F.col("ancestor").alias("unit"), "length").agg(F.sum("value").alias("value"))


def spec(u, more=()):
    y = u.groupBy(*more, "unit", "length").agg(F.count("*").alias("y"))
    return R.spectrum(y, list(more))


def plots(occ, more=()):
    return occ.groupBy(*more).agg(F.count_distinct("plot").alias("n"))


SPEC = "y AS (SELECT unit, length, count(DISTINCT plot) AS y FROM units GROUP BY ALL), spec AS (SELECT 0 AS g, y, count(*) AS f, sum(length) AS l FROM y GROUP BY ALL), n AS (SELECT 0 AS g, count(DISTINCT plot) AS n FROM occ)"
#: From spec (g, y, f, l) and n (g, n).
SINGLE = """st0 AS (SELECT g, n, coalesce(sum(f) FILTER (y = 1), 0)::BIGINT AS f1, coalesce(sum(f) FILTER (y = 2), 0)::BIGINT AS f2, coalesce(sum(l) FILTER (y = 1), 0)::DOUBLE AS g1, coalesce(sum(l) FILTER (y = 2), 0)::DOUBLE AS g2 FROM spec JOIN n USING (g) GROUP BY ALL),
st AS (SELECT *, CASE WHEN f2 > 0 THEN 2 * f2 / ((n - 1) * f1 + 2 * f2) WHEN f1 > 0 THEN 2 / ((n - 1) * (f1 - 1) + 2) ELSE 1 END AS a, greatest(0, (n - 1) / n * CASE WHEN g2 > 0 THEN g1 * g1 / (2 * g2) ELSE g1 * (g1 - 1) / 2 END) AS g0 FROM st0)"""
ASYMPTOTE = """hh AS (SELECT j, sum(1.0::DOUBLE / j) OVER (ORDER BY j) AS h FROM range(1, (SELECT max(n) + 1 FROM n)) t(j)),
ts AS (SELECT g, sum(l) AS l0, sum(l * y) / any_value(n) AS t, coalesce(sum(l * y / n * (hn.h - coalesce(hy.h, 0))) FILTER (y <= n - 1), 0) AS h1, sum(l * y * (y - 1) / (n * (n - 1))) AS p, sum(l * y / n) AS x2 FROM spec JOIN n USING (g) JOIN hh hn ON hn.j = n - 1 LEFT JOIN hh hy ON hy.j = y - 1 GROUP BY g),
tl AS (SELECT g, sum(pow(1 - a, k + 1) / (n + k)) AS tail FROM st, range(0, 20000) r(k) GROUP BY g),
asy AS (SELECT g, l0 + g0 AS a0, t * exp((h1 + CASE WHEN a = 1 OR g1 = 0 THEN 0 ELSE g1 / n * tail END) / t) AS a1, t * t / nullif(p, 0) AS a2, t, p, x2 FROM ts JOIN st USING (g) JOIN tl USING (g))"""
_LC = "lgamma({0} + 1.0) - lgamma({1} + 1.0) - lgamma({0} - {1} + 1.0)"


def curve_sql(shares: list[float], sizes: str = "") -> str:
    """obs, rare and cv (g, m, method, q0, q1, q2) from spec and n; sizes may give sz (g, n, m)."""
    sizes = sizes or "sz AS (SELECT DISTINCT * FROM (SELECT g, n, unnest([" + ", ".join(f"floor(n * {s!r}::DOUBLE)::BIGINT" for s in shares) + "]) AS m FROM n) WHERE m >= 1)"
    return f"""{SINGLE}, {ASYMPTOTE}, {sizes}, atz AS (SELECT * FROM sz WHERE m < n UNION SELECT g, n, n - 1 FROM n WHERE n > 1),
ks AS (SELECT unnest(range(1, (SELECT max(y) + 1 FROM spec))) AS k),
gk AS (SELECT g, m, k, sum(l * exp({_LC.format('y', 'k')} + {_LC.format('(n - y)', '(m - k)')} - ({_LC.format('n', 'm')}))) AS w FROM spec JOIN atz USING (g) JOIN ks ON k <= y AND k <= m AND m - k <= n - y GROUP BY ALL),
rare AS (SELECT g, m, sum(w) AS q0, exp(ln(sum(k * w)) - sum(w * k * ln(k)) / sum(k * w)) AS q1, pow(sum(k * w), 2) / sum(k * k * w) AS q2 FROM gk GROUP BY ALL),
obs AS (SELECT g, sum(l) AS q0, exp(ln(sum(y * l)) - sum(l * y * ln(y)) / sum(y * l)) AS q1, pow(sum(y * l), 2) / sum(l * y * y) AS q2 FROM spec GROUP BY g),
bt AS (SELECT g, CASE WHEN a1 = r.q1 THEN 1 ELSE greatest(0, least(1, (o.q1 - r.q1) / (a1 - r.q1))) END AS beta FROM asy JOIN obs o USING (g) JOIN n USING (g) JOIN rare r ON r.g = asy.g AND r.m = n - 1),
cv AS (SELECT g, m, 'Rarefaction' AS method, rare.q0, rare.q1, rare.q2 FROM rare JOIN sz USING (g, m) UNION ALL SELECT g, m, 'Observed', q0, q1, q2 FROM obs JOIN sz USING (g) WHERE m = n
UNION ALL SELECT g, m, 'Extrapolation', CASE WHEN g0 <= 0 OR g1 <= 0 THEN q0 ELSE q0 + g0 * (1 - pow(1 - g1 / (st.n * g0 + g1), m - st.n)) END, q1 + (a1 - q1) * (1 - pow(1 - beta, m - st.n)), t * t / (x2 / m + (m - 1) / m * p) FROM obs JOIN sz USING (g) JOIN st USING (g) JOIN asy USING (g) JOIN bt USING (g) WHERE m > sz.n)"""


def rounded(df, places: int, *cols: str):
    return df.withColumns({c: F.round(c, places) for c in cols})


def r_sql(places: int, *cols: str) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in cols)


Q = ("q0", "q1", "q2")
SHARES = [0.001, 0.25, 0.5, 1.0, 1.5, 2.0]


@query("D15", f"WITH {DAYS} SELECT round(max(({_lengths('days')[0]}) + ({_lengths('days')[2]}) + 4), 9) AS depth FROM occ")
def _(t):
    return closure_of(days(t), "days").groupBy("node").agg(F.sum("length").alias("d")).agg(F.round(F.max("d"), 9).alias("depth"))


@query("D16", f"WITH {DAYS}, {units_sql('days')}, {SPEC} SELECT round(sum(l), 5) AS q0, round(exp(sum(-l * y / u * ln(y / u))), 5) AS q1, round(1 / sum(l * pow(y / u, 2)), 5) AS q2 FROM spec, (SELECT sum(y * l) AS u FROM spec)")
def _(t):
    o = days(t)
    return rounded(R.hill_of_incidence(spec(units(o, closure_of(o, "days"))), []), 5, *Q)


@query("D18", f"WITH {DAYS}, {units_sql('days')}, {SPEC}, {SINGLE} SELECT n, f1, f2, round(g1, 6) AS g1, round(g2, 6) AS g2, round(a, 9) AS a FROM st")
def _(t):
    o = days(t)
    s = R.singletons(spec(units(o, closure_of(o, "days"))), plots(o), [])
    return rounded(rounded(s, 6, "g1", "g2"), 9, "a")


@query("D19", f"WITH {DAYS}, {units_sql('days')}, {SPEC}, {SINGLE}, {ASYMPTOTE} SELECT round(a0, 4) AS q0, round(a1, 4) AS q1, round(a2, 4) AS q2 FROM asy")
def _(t):
    o = days(t)
    return rounded(R.asymptote(spec(units(o, closure_of(o, "days"))), plots(o), []), 4, *Q)


@query("D20", f"WITH {DAYS}, {units_sql('days')}, {SPEC}, {curve_sql(SHARES)} SELECT m, method, {r_sql(3, *Q)} FROM cv")
def _(t):
    o = days(t)
    n = plots(o)
    return rounded(R.curve(spec(units(o, closure_of(o, "days"))), n, R.sizes_table(n, [], SHARES), []), 3, *Q)


def _draws_sql(reps: int, sizes: str) -> str:
    """drawn (m, rep, plot) of the plots of occ; sizes gives the list of m from n."""
    return f"""nn AS (SELECT count(DISTINCT plot) AS n FROM occ), rk AS (SELECT rep, plot, row_number() OVER (PARTITION BY rep ORDER BY md5('42|' || rep || '|' || plot), plot) AS rank FROM (SELECT DISTINCT plot FROM occ), range({reps}) r(rep)),
zz AS (SELECT DISTINCT * FROM (SELECT n, unnest({sizes}) AS m FROM nn) WHERE m >= 1 AND m <= n), drawn AS (SELECT m, rep, plot FROM rk, zz WHERE rank <= m AND (m < n OR rep = 0))"""


def _band_sql(cols: tuple[str, ...], mean: bool = False) -> str:
    return ", ".join((f"round(avg({c}), 4) AS {c}_mean, " if mean else "") + f"round(quantile_cont({c}, 0.025), 4) AS {c}_lo, round(quantile_cont({c}, 0.975), 4) AS {c}_hi" for c in cols)


_BAND = f"""uy AS (SELECT m, rep, unit, length, count(*) AS y FROM units JOIN drawn USING (plot) GROUP BY ALL), uu AS (SELECT m, rep, sum(y * length) AS u FROM uy GROUP BY ALL),
uh AS (SELECT m, rep, sum(length) AS q0, exp(sum(-length * y / u * ln(y / u))) AS q1, 1 / sum(length * pow(y / u, 2)) AS q2 FROM uy JOIN uu USING (m, rep) GROUP BY ALL), band AS (SELECT m, count(*) AS reps, {_band_sql(Q)} FROM uh GROUP BY m)"""
BOUNDS = [f"{q}_{k}" for q in Q for k in ("lo", "hi")]
REPS = 12


def _banded(t):
    o = days(t)
    u = units(o, closure_of(o, "days"))
    n = plots(o)
    sizes = R.sizes_table(n, [], SHARES)
    drawn = R.draws(o.select("plot").distinct(), sizes, REPS, 42, [])
    return R.curve(spec(u), n, sizes, []), R.band(u.select("plot", "unit", "length"), drawn, [])


_SIZES = "[" + ", ".join(f"floor(n * {s!r}::DOUBLE)::BIGINT" for s in SHARES) + "]"


@query("D21", f"WITH {DAYS}, {units_sql('days')}, {_draws_sql(REPS, _SIZES)}, {_BAND} SELECT * FROM band")
def _(t):
    return rounded(_banded(t)[1], 4, *BOUNDS)


@query("D22", f"WITH {DAYS}, {units_sql('days')}, {SPEC}, {curve_sql(SHARES)}, {_draws_sql(REPS, _SIZES)}, {_BAND} SELECT m, method, {r_sql(3, *Q)}, {', '.join(BOUNDS)} FROM cv LEFT JOIN band USING (m)")
def _(t):
    c, b = _banded(t)
    return rounded(c, 3, *Q).join(rounded(b, 4, *BOUNDS).drop("reps"), "m", "left")


_TWO = "occ AS (SELECT o_orderstatus AS a, o_custkey AS plot, date_diff('day', DATE '1995-01-01', o_orderdate::DATE)::BIGINT AS s, count(*) AS value FROM orders GROUP BY ALL)"
_TWO_SPEC = "y AS (SELECT a, unit, length, count(DISTINCT plot) AS y FROM units GROUP BY ALL), spec AS (SELECT a || '/branches' AS g, y, count(*) AS f, sum(length) AS l FROM y GROUP BY ALL UNION ALL SELECT a || '/species', y, count(*), count(*)::DOUBLE FROM y WHERE unit LIKE 't%' GROUP BY ALL), n AS (SELECT a || k AS g, count(DISTINCT plot) AS n FROM occ, (VALUES ('/branches'), ('/species')) v(k) GROUP BY ALL)"


@query("D23", f"WITH {_TWO}, {units_sql('days', 'a, ')}, {_TWO_SPEC}, {curve_sql([0.5, 1.0, 2.0])} SELECT g, m, method, {r_sql(3, *Q)} FROM cv")
def _(t):
    s = F.datediff("o_orderdate", F.lit("1995-01-01")).cast("long")
    o = t.orders.groupBy(F.col("o_orderstatus").alias("a"), F.col("o_custkey").alias("plot"), s.alias("s")).agg(F.count("*").alias("value"))
    u = units(o, closure_of(o, "days"), ("a",))
    both = u.withColumn("g", F.concat("a", F.lit("/branches"))).unionByName(u.where("unit LIKE 't%'").withColumn("g", F.concat("a", F.lit("/species"))).withColumn("length", F.lit(1.0)))
    n = plots(o, ("a",)).select(F.explode(F.array(F.concat("a", F.lit("/branches")), F.concat("a", F.lit("/species")))).alias("g"), "n")
    return rounded(R.curve(spec(both, ("g",)), n, R.sizes_table(n, ["g"], [0.5, 1.0, 2.0]), ["g"]), 3, *Q)


@query("D32", f"WITH c AS (SELECT l_partkey, count(*) AS y FROM lineitem GROUP BY 1), spec AS (SELECT 0 AS g, y, count(*) AS f, count(*)::DOUBLE AS l FROM c GROUP BY y), n AS (SELECT 0 AS g, sum(y)::BIGINT AS n FROM c), {curve_sql([0.001, 0.05, 0.5, 1.0, 2.0])} SELECT m, method, {r_sql(2, *Q)} FROM cv")
def _(t):
    c = t.lineitem.groupBy(F.col("l_partkey").alias("unit")).agg(F.count("*").alias("y")).withColumn("length", F.lit(1.0))
    n = c.agg(F.sum("y").alias("n"))
    return rounded(R.curve(R.spectrum(c, []), n, R.sizes_table(n, [], [0.001, 0.05, 0.5, 1.0, 2.0]), []), 2, *Q)


_LEVEL = 0.5
_COVER = f"""sp AS (SELECT plot, value AS y, count(*) AS f FROM occ GROUP BY ALL), pn AS (SELECT plot, sum(value)::BIGINT AS n, count(*) AS s FROM occ GROUP BY plot HAVING count(*) >= 5),
cc AS (SELECT plot, n, m, 1 - sum(CASE WHEN n - y >= m THEN f * y / n * exp(lgamma(n - y + 1.0) - lgamma(n - y - m + 1.0) + lgamma(n - m + 0.0) - lgamma(n + 0.0)) ELSE 0 END) AS c FROM sp JOIN pn USING (plot), range(1, 4000) r(m) WHERE m < n GROUP BY ALL),
sz AS (SELECT plot AS g, n, min(m) AS m FROM cc WHERE c >= {_LEVEL} - 1e-12 GROUP BY ALL), n AS (SELECT plot AS g, n FROM pn)"""


def _standardised(t, phylo: bool):
    o = parts(t)
    counts = R.spectrum(o.select("plot", F.col("value").alias("y"), F.lit(1.0).alias("length")), ["plot"])
    enough = o.groupBy("plot").agg(F.count("*").alias("s")).where("s >= 5").select("plot")
    size = R.coverage_size(counts.join(enough, "plot"), ["plot"], _LEVEL)
    if phylo:
        u = units(o, closure_of(o, "parts")).select("plot", "unit", "length", F.col("value").alias("y"))
        counts = R.spectrum(u, ["plot"])
    return rounded(R.curve(counts.join(enough, "plot"), size.select("plot", "n"), size.select("plot", "m"), ["plot"]), 4, *Q)


@query("D12", f"WITH {PARTS}, {_COVER}, spec AS (SELECT plot AS g, y, f, f::DOUBLE AS l FROM sp JOIN pn USING (plot)), {curve_sql([], 'sx AS (SELECT 1)')} SELECT g AS plot, m, method, {r_sql(4, *Q)} FROM cv")
def _(t):
    """Hill numbers of each plot of five species or more at one sample coverage."""
    return _standardised(t, False)


@query("D13", f"WITH {PARTS}, {_COVER}, {units_sql('parts')}, spec AS (SELECT plot AS g, value AS y, count(*) AS f, sum(length) AS l FROM units JOIN pn USING (plot) GROUP BY ALL), {curve_sql([], 'sx AS (SELECT 1)')} SELECT g AS plot, m, method, {r_sql(4, *Q)} FROM cv")
def _(t):
    """Hill numbers of each plot's branches at one sample coverage of its species."""
    return _standardised(t, True)


_PARTITION = f"""p AS (SELECT plot, s, value / sum(value) OVER (PARTITION BY plot) AS p FROM occ), pl AS (SELECT plot, count(*) AS s, -sum(p * ln(p)) AS h, sum(p * p) AS d FROM p GROUP BY 1),
al AS (SELECT m, rep, avg(s)::DOUBLE AS a0, exp(avg(h)) AS a1, 1 / avg(d) AS a2 FROM drawn JOIN pl USING (plot) GROUP BY ALL), po AS (SELECT m, rep, s, sum(p) / any_value(m) AS p FROM drawn JOIN p USING (plot) GROUP BY ALL),
ga AS (SELECT m, rep, count(*)::DOUBLE AS g0, exp(-sum(p * ln(p))) AS g1, 1 / sum(p * p) AS g2 FROM po GROUP BY ALL), ea AS (SELECT m, rep, q::INT AS q, CASE q WHEN 0 THEN a0 WHEN 1 THEN a1 ELSE a2 END AS alpha, CASE q WHEN 0 THEN g0 WHEN 1 THEN g1 ELSE g2 END AS gamma FROM al JOIN ga USING (m, rep), range(3) r(q)),
eb AS (SELECT *, gamma / alpha AS beta FROM ea) SELECT m, q, count(*) AS reps, {_band_sql(('alpha', 'beta', 'gamma'), True)} FROM eb GROUP BY ALL"""
_PARTED = [f"{c}_{k}" for c in ("alpha", "beta", "gamma") for k in ("mean", "lo", "hi")]


def _partition_curve(t, sizes, reps):
    c = named(months(t)).select("plot", "species", "value")
    drawn = R.draws(c.select("plot").distinct(), sizes, reps, 42, [])
    return rounded(R.partition_curve(c, drawn), 4, *_PARTED)


@query("D26", f"WITH {MONTHS}, {_draws_sql(10, '[2, 5, 20, n]')}, {_PARTITION}")
def _(t):
    n = months(t).agg(F.count_distinct("plot").alias("n"))
    return _partition_curve(t, n.select(F.explode(F.array(*[F.lit(k).cast("long") for k in (2, 5, 20)], "n")).alias("m")), 10)


@query("D41", f"WITH {MONTHS}, {_draws_sql(6, 'list_transform(range(4), lambda k: round_even(exp(ln(10.0) + (ln(n) - ln(10.0)) * k / 3), 0)::BIGINT)')}, {_PARTITION}")
def _(t):
    n = months(t).agg(F.count_distinct("plot")).first()[0]
    sizes = t.spark.createDataFrame([(m,) for m in R.log_sizes(10, n, 4)], "m long")
    return _partition_curve(t, sizes, 6)


_R, *_B = NORMAL


def cdf_sql(z: str) -> str:
    k = f"(1 / (1 + {_R} * abs({z})))"
    tail = f"exp(-({z}) * ({z}) / 2) / sqrt(2 * pi()) * {k} * ({_B[0]} + {k} * ({_B[1]} + {k} * ({_B[2]} + {k} * ({_B[3]} + {k} * {_B[4]}))))"
    return f"CASE WHEN {z} >= 0 THEN 1 - {tail} ELSE {tail} END"


def dark_sql(by: str = "") -> str:
    """dk (by, plot, species, prob, favour) from cm (by, plot, species)."""
    k = by.strip(", ")
    on = lambda a, b: f"{a}.{k} = {b}.{k} AND " if k else ""
    return f"""nn0 AS (SELECT {by}count(DISTINCT plot)::DOUBLE AS n FROM cm {'GROUP BY ' + k if k else ''}), ci AS (SELECT {by}species, count(*)::DOUBLE AS c FROM cm GROUP BY ALL),
mm AS (SELECT {'x.' + k + ' AS ' + k + ', ' if k else ''}x.species AS i, y.species AS s, count(*) AS k FROM cm x JOIN cm y ON {on('x', 'y')}x.plot = y.plot AND x.species <> y.species GROUP BY ALL),
zz0 AS (SELECT {'a.' + k + ' AS ' + k + ', ' if k else ''}a.species AS i, b.species AS s, (coalesce(mm.k, 0) - a.c * b.c / n) / nullif(sqrt(a.c * b.c * (n - a.c) * (n - b.c) / (n * n * (n - 1))), 0) AS z FROM ci a JOIN ci b ON {on('a', 'b')}a.species <> b.species JOIN nn0 ON {on('nn0', 'a')}TRUE LEFT JOIN mm ON {on('mm', 'a')}mm.i = a.species AND mm.s = b.species),
bb AS (SELECT {by}i, s, coalesce({cdf_sql('z')}, 0.5) AS b FROM zz0), pp AS (SELECT {'cm.' + k + ' AS ' + k + ', ' if k else ''}cm.plot, bb.s AS species, avg(b) AS prob FROM cm JOIN bb ON {on('cm', 'bb')}bb.i = cm.species GROUP BY ALL),
dk AS (SELECT pp.*, (prob / (1 - prob)) / (c / (n - c) + prob / (1 - prob)) AS favour FROM pp JOIN ci ON {on('ci', 'pp')}ci.species = pp.species JOIN nn0 ON {on('nn0', 'pp')}TRUE ANTI JOIN cm ON {on('cm', 'pp')}cm.plot = pp.plot AND cm.species = pp.species)"""


CM = "cm AS (SELECT plot, 't' || s AS species FROM occ)"
_THRESHOLDS = [0.4, 0.5, 0.6, 0.9]
_DARK = ", ".join(f"coalesce(d{round(x * 100)}, 0) AS dark_{round(x * 100)}" for x in _THRESHOLDS)
_DARK_N = ", ".join(f"count(*) FILTER (prob > {x}) AS d{round(x * 100)}" for x in _THRESHOLDS)


def comm_of(occ):
    return named(occ).select("plot", "species").distinct()


def _dark_query(occ):
    c = comm_of(occ)
    prob = K.dark_probabilities(c)
    favour = prob.groupBy("plot").agg(F.round(F.avg("prob"), 5).alias("prob"), F.round(F.avg("favour"), 5).alias("favour"))
    return K.dark_counts(c, prob, _THRESHOLDS).join(favour, "plot", "left")


_DARK_SQL = f"{CM}, {dark_sql()}, dc AS (SELECT plot, round(avg(prob), 5) AS prob, round(avg(favour), 5) AS favour, {_DARK_N} FROM dk GROUP BY 1) SELECT plot, n, {_DARK}, prob, favour FROM (SELECT plot, count(*) AS n FROM cm GROUP BY 1) LEFT JOIN dc USING (plot)"


@query("D28", f"WITH {MONTHS}, {_DARK_SQL}")
def _(t):
    return _dark_query(months(t))


def _distance(kind: str) -> str:
    """The distance along the tree of two tips with s = x and y."""
    at = lambda e, v: e.replace("s ", f"{v} ")
    l0, g, l1, f, _ = _lengths(kind)
    one = lambda v: (at(l0, v), at(g, v), at(l1, v), at(f, v))
    (a0, ag, a1, af), (b0, bg, b1, bf) = one("x"), one("y")
    return f"(({a0}) + ({b0}) + CASE WHEN {ag} = {bg} THEN 0 ELSE ({a1}) + ({b1}) END + CASE WHEN {af} = {bf} THEN 0 ELSE 8 END)"


_DARK_SET = 0.45


def _dark_mpd(occ, kind):
    c = comm_of(occ)
    dark = K.dark_probabilities(c).where(F.col("prob") > _DARK_SET).select("plot", "species")
    m = P.phylo_measures(dark, P.depths(closure_of(occ, kind)), ["plot"])
    return c.select("plot").distinct().join(m, "plot", "left").select("plot", F.coalesce("n", F.lit(0)).alias("dark_n"), F.round("mpd", 5).alias("dark_mpd"), F.round(F.coalesce("pd", F.lit(0.0)), 5).alias("dark_pd"))


def _dark_mpd_sql(kind: str) -> str:
    l0, g, l1, f, l2 = _lengths(kind)
    return f"""{CM}, {dark_sql()}, ds AS (SELECT plot, substr(species, 2)::BIGINT AS s FROM dk WHERE prob > {_DARK_SET}), dp AS (SELECT a.plot, avg({_distance(kind)}) AS mpd FROM (SELECT plot, s AS x FROM ds) a JOIN (SELECT plot, s AS y FROM ds) b ON a.plot = b.plot AND x < y GROUP BY 1),
db AS (SELECT plot, sum(l) AS pd FROM (SELECT plot, 't' || s AS u, {l0} AS l FROM ds UNION SELECT plot, 'g' || ({g}), {l1} FROM ds UNION SELECT plot, 'f' || ({f}), {l2} FROM ds) GROUP BY 1), dn AS (SELECT plot, count(*) AS n FROM ds GROUP BY 1)
SELECT plot, coalesce(n, 0) AS dark_n, round(mpd, 5) AS dark_mpd, round(coalesce(pd, 0), 5) AS dark_pd FROM (SELECT DISTINCT plot FROM cm) LEFT JOIN dn USING (plot) LEFT JOIN dp USING (plot) LEFT JOIN db USING (plot)"""


@query("D30", f"WITH {MONTHS}, {_dark_mpd_sql('months')}")
def _(t):
    return _dark_mpd(months(t), "months")


_D31_REPS, _D31_SIZES = 3, (20, 60, 100)


@query("D31", f"WITH {MONTHS}, {_draws_sql(_D31_REPS, str(list(_D31_SIZES)))}, cm AS (SELECT m || '/' || rep AS g, plot, 't' || s AS species FROM occ JOIN drawn USING (plot)), {dark_sql('g, ')}, dc AS (SELECT g, plot, count(*) FILTER (prob > {_DARK_SET}) AS d FROM dk GROUP BY ALL), each AS (SELECT split_part(g, '/', 1)::BIGINT AS m, g, avg(coalesce(d, 0))::DOUBLE AS mean, quantile_cont(coalesce(d, 0), 0.5)::DOUBLE AS mid FROM (SELECT DISTINCT g, plot FROM cm) LEFT JOIN dc USING (g, plot) GROUP BY ALL) SELECT m, count(*) AS reps, {_band_sql(('mean', 'mid'), True)} FROM each GROUP BY m")
def _(t):
    c = comm_of(months(t))
    sizes = t.spark.createDataFrame([(m,) for m in _D31_SIZES], "m long")
    drawn = R.draws(c.select("plot").distinct(), sizes, _D31_REPS, 42, [])
    some = c.join(drawn, "plot").select("m", "rep", "plot", "species")
    by = ["m", "rep"]
    counts = K.dark_counts(some, K.dark_probabilities(some, by), [_DARK_SET], by).withColumnRenamed(f"dark_{round(_DARK_SET * 100)}", "d")
    each = counts.groupBy(*by).agg(F.avg("d").alias("mean"), F.expr("percentile(d, 0.5)").alias("mid"))
    return rounded(R._bounds(each, ["m"], ["mean", "mid"], 0.95, True), 4, *[f"{c}_{k}" for c in ("mean", "mid") for k in ("mean", "lo", "hi")])


#: Two sources in one pool, with prefixed ids of plots.
POOL = "occ AS (SELECT 'C' || o_custkey AS plot, ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::BIGINT AS s, count(*) AS value FROM orders GROUP BY ALL UNION ALL SELECT 'S' || l_suppkey, ((year(l_shipdate) - 1995) * 12 + month(l_shipdate) - 1)::BIGINT, count(*) FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1 GROUP BY ALL)"


def pool(t):
    s = lambda c: ((F.year(c) - 1995) * 12 + F.month(c) - 1).cast("long")
    a = t.orders.groupBy(F.concat(F.lit("C"), "o_custkey").alias("plot"), s("o_orderdate").alias("s")).agg(F.count("*").alias("value"))
    b = t.lineitem.where("l_returnflag = 'R' AND l_linenumber = 1").groupBy(F.concat(F.lit("S"), "l_suppkey").alias("plot"), s("l_shipdate").alias("s")).agg(F.count("*").alias("value"))
    return a.union(b)


@query("D40", f"WITH {POOL}, {_dark_mpd_sql('months')}")
def _(t):
    """The phylogeny of the dark sets of a pool of two sources."""
    return _dark_mpd(pool(t), "months")


#: Shuffles of labels, as many as the reference takes.
_RUNS = 499
_MEASURES = f"""n AS (SELECT run, plot, count(*) AS n FROM cx GROUP BY ALL), dist AS (SELECT a.run, a.plot, x, y, {_distance('months')} AS d FROM (SELECT run, plot, s AS x FROM cx) a JOIN (SELECT run, plot, s AS y FROM cx) b ON a.run = b.run AND a.plot = b.plot AND x <> y),
mp AS (SELECT run, plot, avg(d) AS mpd FROM dist GROUP BY ALL), mn AS (SELECT run, plot, avg(d) AS mntd FROM (SELECT run, plot, x, min(d) AS d FROM dist GROUP BY ALL) GROUP BY ALL),
br AS (SELECT run, plot, sum(l) AS pd FROM (SELECT run, plot, 't' || s AS u, {_lengths('months')[0]} AS l FROM cx UNION SELECT run, plot, 'g' || ({_lengths('months')[1]}), {_lengths('months')[2]} FROM cx UNION SELECT run, plot, 'f' || ({_lengths('months')[3]}), 4.0 FROM cx) GROUP BY ALL),
me AS (SELECT run, plot, n, pd, mpd, mntd FROM n JOIN br USING (run, plot) LEFT JOIN mp USING (run, plot) LEFT JOIN mn USING (run, plot)),
nu AS (SELECT plot, {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in ('pd', 'mpd', 'mntd'))} FROM me WHERE run > 0 GROUP BY 1)
SELECT plot, n, {', '.join(f'round({c}, 5) AS {c}' for c in ('pd', 'mpd', 'mntd'))}, {', '.join(f'round(({c} - m_{c}) / CASE WHEN s_{c} > 1e-12 THEN s_{c} END, 4) AS ses_{c}' for c in ('pd', 'mpd', 'mntd'))} FROM me JOIN nu USING (plot) WHERE run = 0"""


@query("D27", f"""WITH {MONTHS}, sp AS (SELECT DISTINCT s, 't' || s AS species FROM occ), fx AS (SELECT s, species, row_number() OVER (ORDER BY species) AS k FROM sp), sh AS (SELECT run, s AS label, row_number() OVER (PARTITION BY run ORDER BY md5('42|' || run || '|' || species), species) AS k FROM sp, range(1, {_RUNS + 1}) r(run)),
cx AS (SELECT 0 AS run, plot, s FROM occ UNION ALL SELECT run, plot, label FROM occ JOIN fx USING (s) JOIN sh USING (k)), {_MEASURES}""")
def _(t):
    o = months(t)
    out = P.standardised_effects(named(o), P.depths(closure_of(o, "months")), _RUNS, 42)
    return rounded(rounded(out, 5, "pd", "mpd", "mntd"), 4, "ses_pd", "ses_mpd", "ses_mntd")
