"""Queries of time series and of curves as images."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrat.functions.arrays import total
from quadrat.operators import series as S
from quadrat.plans.catalog import query
from quadrat.plans.relational import r6

def seconds():
    return F.unix_micros(F.col("ts").cast("timestamp")) / 1e6


@query("W01", "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS m FROM events")
def _(t):
    return S.moving_mean(t.events, ["user_id"], "ts", "value", 5, "m").select("event_id", r6("m").alias("m"))


@query("W06", "SELECT event_id, last_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS back, first_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead FROM events")
def _(t):
    w = Window.partitionBy("user_id").orderBy("ts")
    hit = F.when(F.col("event_type") == "click", F.col("event_id"))
    return t.events.select("event_id", F.last(hit, True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("back"), F.first(hit, True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("ahead"))


@query("W07", "SELECT label, max(CASE WHEN vec_id % 25 = 12 THEN vec_id END) AS centre FROM embeddings GROUP BY 1")
def _(t):
    return t.embeddings.groupBy("label").agg(F.max(F.when(F.col("vec_id") % 25 == 12, F.col("vec_id"))).alias("centre"))


_GRID = """WITH o AS (SELECT user_id, epoch(ts) AS t, value AS v FROM events), s AS (SELECT user_id, min(t) AS lo, max(t) AS hi, count(*) AS n FROM o GROUP BY 1),
g AS (SELECT user_id, n, i, lo + (hi - lo) * i / 23 AS t FROM s, range(24) r(i)),
a AS (SELECT g.user_id, g.n, g.i, g.t, o.t AS t0, o.v AS v0 FROM g ASOF JOIN o ON o.user_id = g.user_id AND o.t <= g.t),
b AS (SELECT a.*, o.t AS t1, o.v AS v1 FROM a ASOF LEFT JOIN o ON o.user_id = a.user_id AND o.t >= a.t)
SELECT user_id, (i + 1)::INT AS step, round(CASE WHEN n >= 5 THEN coalesce(v0 + (v1 - v0) * (t - t0) / nullif(t1 - t0, 0), v0, v1) END, 4) AS g FROM b"""


@query("T01", _GRID)
def _(t):
    return S.gridded(t.events.select("user_id", seconds().alias("t"), "value"), "user_id", "t", "value", 24).select("user_id", "step", F.round("g", 4).alias("g"))


@query("T02", "WITH x AS (" + _GRID.replace("round(CASE", "(CASE").replace("END, 4)", "END)") + ") SELECT user_id, step, round(avg(g) OVER (PARTITION BY user_id ORDER BY step ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 4) AS m FROM x")
def _(t):
    g = S.gridded(t.events.select("user_id", seconds().alias("t"), "value"), "user_id", "t", "value", 24)
    return S.moving_mean(g, ["user_id"], "step", "g", 3, "m").select("user_id", "step", F.round("m", 4).alias("m"))


def _trend_sql() -> str:
    from quadrat.plans.curves import cdf_sql

    return f"""WITH o AS (SELECT user_id, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, value) AS i FROM events), p AS (SELECT a.user_id, sign(b.v - a.v) AS s, (b.v - a.v) / (b.i - a.i) AS d FROM o a JOIN o b ON a.user_id = b.user_id AND a.i < b.i), n AS (SELECT user_id, count(*) AS n FROM o GROUP BY 1),
q AS (SELECT user_id, any_value(n) AS n, sum(s)::BIGINT AS s, median(d) AS slope FROM p JOIN n USING (user_id) GROUP BY 1), z AS (SELECT *, (s - sign(s)) / sqrt(n * (n - 1) * (2 * n + 5) / 18) AS z FROM q) SELECT user_id, n::INT AS n, s::INT AS s, round(s / (n * (n - 1) / 2), 6) AS tau, round(z, 6) AS z, round(slope, 6) AS slope, round(2 * (1 - ({cdf_sql('abs(z)')})), 6) AS p FROM z"""


@query("T12", _trend_sql())
def _(t):
    out = S.mann_kendall(t.events, "user_id", "ts", "value")
    return out.withColumns({c: F.round(c, 6) for c in ("tau", "z", "slope", "p")})


@query("T13", "WITH x AS (SELECT p_partkey, round((p_retailprice % 1000) / 1000 * (p_partkey % 97) / 97, 9) AS p FROM part), r AS (SELECT p, rank() OVER (ORDER BY p) + count(*) OVER (PARTITION BY p) - 1 AS r, count(*) OVER () AS n FROM x) SELECT p_partkey, coalesce(p <= (SELECT max(p) FROM r WHERE p <= r * 0.2 / n), false) AS rejected FROM x")
def _(t):
    x = t.part.select("p_partkey", F.round((F.col("p_retailprice") % 1000) / 1000 * (F.col("p_partkey") % 97) / 97, 9).alias("p"))
    return S.false_discovery(x, "p", 0.2).select("p_partkey", "rejected")


@query("T14", "SELECT vec_id, bool_and(abs(e) < 0.35) AS stable FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS e FROM embeddings) GROUP BY 1")
def _(t):
    return t.embeddings.select("vec_id", F.forall("embedding", lambda e: F.abs(e.cast("double")) < 0.35).alias("stable"))


@query("T15", "SELECT event_id, round((greatest(-2.5, least(2.5, (value - avg(value) OVER w) / stddev_pop(value) OVER w)) + 2.5) / 5, 6) AS z FROM events WINDOW w AS (PARTITION BY event_type)")
def _(t):
    g = t.events.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    z = (F.col("value") - F.col("m")) / F.col("s")
    return t.events.join(g, "event_type").select("event_id", r6((F.greatest(F.lit(-2.5), F.least(F.lit(2.5), z)) + 2.5) / 5).alias("z"))


@query("T05", "SELECT vec_id, round(a + (b - a) * f, 6) AS v FROM (SELECT vec_id, embedding[i + 1]::DOUBLE AS a, embedding[(i + 1) % 64 + 1]::DOUBLE AS b, CASE WHEN i + 1 < 64 THEN x - i ELSE (x - 63) / (365 / 5.75 - 63) END AS f FROM (SELECT *, least(floor(x)::BIGINT, 63) AS i FROM (SELECT vec_id, embedding, (vec_id % 365) / 5.75 AS x FROM embeddings)))")
def _(t):
    curve = F.transform("embedding", lambda x: x.cast("double"))
    return t.embeddings.select("vec_id", r6(S.at_day(curve, F.col("vec_id") % 365, 5.75)).alias("v"))


@query("F21", "SELECT vec_id, round(list_sum(list_transform(range(64), lambda i: (0.75 * embedding[(i + 2) % 64 + 1]::DOUBLE + 0.25 * embedding[(i + 3) % 64 + 1]::DOUBLE) * i)), 5) AS s FROM embeddings")
def _(t):
    e, n = F.col("embedding"), 64
    at = lambda i, k: e[F.pmod(i + k, F.lit(n))].cast("double")
    shifted = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (0.75 * at(i, 2) + 0.25 * at(i, 3)) * i)
    return t.embeddings.select("vec_id", F.round(total(shifted), 5).alias("s"))


@query("F23", "SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: i * s[i].v)), 5) AS w FROM (SELECT vec_id, list_sort(list_transform(range(64), lambda i: {'d': (i * 37) % 64, 'v': embedding[i + 1]::DOUBLE})) AS s FROM embeddings)")
def _(t):
    s = F.array_sort(F.transform("embedding", lambda x, i: F.struct(((i * 37) % 64).alias("d"), x.cast("double").alias("v"))))
    return t.embeddings.select("vec_id", F.round(total(F.transform(s, lambda x, i: (i + 1) * x["v"])), 5).alias("w"))


@query("I02", "SELECT vec_id, round(list_sum(list_transform(range(64), lambda c: (c + 1) * embedding[CASE WHEN (c // 8) % 2 = 0 THEN c ELSE c // 8 * 8 + 7 - c % 8 END + 1]::DOUBLE)), 5) AS s FROM embeddings")
def _(t):
    image = S.arranged(F.col("embedding"), S.serpentine_order(8))
    return t.embeddings.select("vec_id", F.round(total(F.transform(image, lambda x, c: (c + 1) * x.cast("double"))), 5).alias("s"))
