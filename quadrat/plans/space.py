"""Queries of neighbours, overlaps, components, tiles and applicability."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrat.operators import space as G
from quadrat.plans.catalog import query
from quadrat.plans.relational import r6

POINTS = "p AS (SELECT vec_id AS id, label AS fold, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)"


def points(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("label").alias("fold"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))


@query("J10", f"WITH {POINTS} SELECT id, round(min(d), 6) AS dist FROM (SELECT a.id, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d FROM p a JOIN p b ON a.id <> b.id) GROUP BY 1")
def _(t):
    p = points(t)
    return G.nearest(p, p, 0.02).select("id", r6("dist").alias("dist"))


@query("J11", f"WITH {POINTS} SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.id < b.id AND abs(a.x - b.x) < 0.01 AND abs(a.y - b.y) < 0.01")
def _(t):
    return G.band_pairs(points(t), 0.01)


@query("J12", f"WITH {POINTS} SELECT id, round(min(d), 6) AS dist FROM (SELECT a.id, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) AS d FROM p a JOIN p b ON a.fold <> b.fold) GROUP BY 1")
def _(t):
    p = points(t)
    return G.nearest(p, p, 0.02, unlike="fold").select("id", r6("dist").alias("dist"))


@query("J13", f"WITH {POINTS} SELECT fold, round(avg(d), 6) AS mean FROM (SELECT a.id, a.fold, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS d FROM p a JOIN p b ON a.fold <> b.fold GROUP BY ALL) GROUP BY 1")
def _(t):
    p = points(t)
    return G.nearest(p, p, 0.02, unlike="fold").join(p.select("id", "fold"), "id").groupBy("fold").agg(r6(F.avg("dist")).alias("mean"))


@query("J17", f"WITH {POINTS} SELECT a.id, count(DISTINCT b.fold) AS pool, max(b.id) AS top FROM p a JOIN p b ON pow(a.x - b.x, 2) + pow(a.y - b.y, 2) < 0.0004 GROUP BY 1")
def _(t):
    p = points(t)
    pairs = G.band_pairs(p, 0.02)
    both = pairs.union(pairs.select("b", "a")).union(p.select("id", "id"))
    a, b = p.select(F.col("id").alias("a"), "x", "y"), p.select(F.col("id").alias("b"), F.col("x").alias("xb"), F.col("y").alias("yb"), "fold")
    near = both.join(a, "a").join(b, "b").where("pow(x - xb, 2) + pow(y - yb, 2) < 0.0004")
    return near.groupBy(F.col("a").alias("id")).agg(F.count_distinct("fold").alias("pool"), F.max("b").alias("top"))


@query("J18", f"WITH {POINTS} SELECT id FROM p a WHERE fold > 4 AND NOT EXISTS (SELECT 1 FROM p b WHERE b.fold <= 4 AND pow(a.x - b.x, 2) + pow(a.y - b.y, 2) < 0.0001)")
def _(t):
    p = points(t)
    pairs = G.band_pairs(p, 0.01)
    both = pairs.union(pairs.select("b", "a"))
    a, b = p.where("fold > 4").select(F.col("id").alias("a"), "x", "y"), p.where("fold <= 4").select(F.col("id").alias("b"), F.col("x").alias("xb"), F.col("y").alias("yb"))
    near = both.join(a, "a").join(b, "b").where("pow(x - xb, 2) + pow(y - yb, 2) < 0.0001").select(F.col("a").alias("id"))
    return p.where("fold > 4").select("id").join(near, "id", "left_anti")


@query("J20", "SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_suppkey < b.s_suppkey AND a.s_nationkey = b.s_nationkey")
def _(t):
    s = t.supplier
    return s.select("s_nationkey", F.col("s_suppkey").alias("a")).join(s.select("s_nationkey", F.col("s_suppkey").alias("b")), "s_nationkey").where("a < b").select("a", "b")


@query("G01", f"WITH RECURSIVE {POINTS}, e AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON a.id <> b.id AND abs(a.x - b.x) < 0.004 AND abs(a.y - b.y) < 0.004), r(id, c) AS (SELECT id, id FROM p UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.id) SELECT id, min(c) AS component FROM r GROUP BY 1")
def _(t):
    return G.overlap_components(points(t), 0.004)


@query("G02", """WITH RECURSIVE v AS (SELECT DISTINCT 'a:' || (p_size % 10 + 10 * (p_partkey % 3)) AS a, 'b:' || (p_partkey % 3 * 100 + p_partkey % 12) AS b FROM part), e AS (SELECT a, b FROM v UNION SELECT b, a FROM v), r(x, c) AS (SELECT a, a FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.x)
SELECT p_partkey, c AS component FROM part JOIN (SELECT x, min(c) AS c FROM r GROUP BY 1) ON x = 'a:' || (p_size % 10 + 10 * (p_partkey % 3))""")
def _(t):
    p = t.part.select("p_partkey", (F.col("p_size") % 10 + 10 * (F.col("p_partkey") % 3)).alias("a"), (F.col("p_partkey") % 3 * 100 + F.col("p_partkey") % 12).alias("b"))
    return G.shared_label_groups(p, "p_partkey", "a", "b")


@query("G03", f"WITH {POINTS} SELECT round(avg(m) / (0.5 / sqrt(count(*) / 0.25)), 6) AS r FROM (SELECT a.id, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS m FROM p a JOIN p b ON a.id <> b.id GROUP BY 1)")
def _(t):
    p = points(t)
    return G.nearest(p, p, 0.02).agg(r6(F.avg("dist") / (0.5 / F.sqrt(F.count("*") / 0.25))).alias("r"))


@query("G05", "WITH s AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS sd FROM lineitem WHERE l_suppkey % 5 <> 0) SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - m) / CASE WHEN sd > 0 THEN sd ELSE 1 END, 6) AS z FROM lineitem, s")
def _(t):
    s = t.lineitem.where("l_suppkey % 5 != 0").agg(F.avg("l_quantity").alias("m"), F.stddev_pop("l_quantity").alias("sd"))
    return t.lineitem.crossJoin(F.broadcast(s)).select("l_orderkey", "l_linenumber", "l_partkey", r6((F.col("l_quantity") - F.col("m")) / F.when(F.col("sd") > 0, F.col("sd")).otherwise(1.0)).alias("z"))


@query("G07", f"WITH {POINTS}, d AS (SELECT a.id, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS d FROM p a JOIN p b ON a.fold <> b.fold GROUP BY 1) SELECT round(quantile_cont(d, 0.75) + 1.5 * (quantile_cont(d, 0.75) - quantile_cont(d, 0.25)), 6) AS threshold FROM d")
def _(t):
    p = points(t)
    q = lambda k: F.expr(f"percentile(dist, {k})")
    return G.nearest(p, p, 0.02, unlike="fold").agg(r6(q(0.75) + 1.5 * (q(0.75) - q(0.25))).alias("threshold"))


@query("G10", "SELECT i || '_' || j AS tile_id, i * 10.0::DOUBLE AS xmin, j * 10.0::DOUBLE AS ymin, (i + 1) * 10.0::DOUBLE AS xmax, (j + 1) * 10.0::DOUBLE AS ymax FROM range(5) a(i), range(3) b(j)")
def _(t):
    return G.tiles(0.0, 0.0, 45.0, 30.0, 10.0, t.spark)


@query("G11", "SELECT floor(l_quantity / 10)::BIGINT AS tx, floor(l_linenumber / 2)::BIGINT AS ty, bool_or(l_returnflag = 'R' AND l_tax = 0) AS native FROM lineitem GROUP BY ALL")
def _(t):
    return t.lineitem.groupBy(F.floor(F.col("l_quantity") / 10).alias("tx"), F.floor(F.col("l_linenumber") / 2).alias("ty")).agg(F.bool_or((F.col("l_returnflag") == "R") & (F.col("l_tax") == 0)).alias("native"))


@query("G13", "SELECT min(l_quantity) - 2 AS x0, max(l_quantity) + 2 AS x1, min(l_linenumber) - 2 AS y0, max(l_linenumber) + 2 AS y1 FROM lineitem")
def _(t):
    return t.lineitem.agg((F.min("l_quantity") - 2).alias("x0"), (F.max("l_quantity") + 2).alias("x1"), (F.min("l_linenumber") - 2).alias("y0"), (F.max("l_linenumber") + 2).alias("y1"))
