"""Queries of composed blocks: designs, climate, terrain, images, pools."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrat.functions.geo import piecewise, to_utm
from quadrat.functions.names import genus
from quadrat.functions.spectral import kndvi, nbr, ndvi
from quadrat.operators import diversity as D
from quadrat.operators import images, space as G
from quadrat.operators import relational as R
from quadrat.operators import series as S
from quadrat.operators import validation as V
from quadrat.plans.catalog import query
from quadrat.plans.relational import COMM, comm, r6
from quadrat.plans.space import POINTS, points
from quadrat.plans.validation import RANDOM, packed_sql


@query("S11", "SELECT r_regionkey, r_name, r_regionkey IN (1, 3) AS native FROM region")
def _(t):
    return t.region.select("r_regionkey", "r_name", F.col("r_regionkey").isin(1, 3).alias("native"))


@query("S20", "SELECT plot, species, 1 AS present FROM (SELECT l_suppkey AS plot, l_partkey AS species FROM lineitem WHERE l_quantity > 47 UNION SELECT l_suppkey, l_partkey FROM lineitem WHERE l_tax = 0.08)")
def _(t):
    one = lambda c: t.lineitem.where(c).select(F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species"))
    return one("l_quantity > 47").union(one("l_tax = 0.08")).distinct().withColumn("present", F.lit(1))


@query("S22", "SELECT label, round(avg((coalesce(v, 0) - m) / s), 6) + 0.0 AS z FROM (SELECT label, embedding[3]::DOUBLE AS v FROM embeddings), (SELECT avg(embedding[3]::DOUBLE) AS m, stddev_pop(embedding[3]::DOUBLE) AS s FROM embeddings) GROUP BY 1")
def _(t):
    e = t.embeddings.select("label", F.coalesce(F.col("embedding")[2].cast("double"), F.lit(0.0)).alias("v"))
    return e.crossJoin(F.broadcast(e.agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")))).groupBy("label").agg((r6(F.avg((F.col("v") - F.col("m")) / F.col("s"))) + 0.0).alias("z"))


@query("J07", "SELECT s_suppkey, n, mean, s_acctbal FROM supplier LEFT JOIN (SELECT l_suppkey AS s_suppkey, count(*) AS n FROM lineitem WHERE l_quantity > 48 GROUP BY 1) USING (s_suppkey) LEFT JOIN (SELECT l_suppkey AS s_suppkey, round(avg(l_tax), 6) AS mean FROM lineitem WHERE l_discount = 0.1 GROUP BY 1) USING (s_suppkey)")
def _(t):
    own = t.lineitem.withColumnRenamed("l_suppkey", "s_suppkey")
    a, b = own.where("l_quantity > 48").groupBy("s_suppkey").agg(F.count("*").alias("n")), own.where("l_discount = 0.1").groupBy("s_suppkey").agg(r6(F.avg("l_tax")).alias("mean"))
    return t.supplier.select("s_suppkey", "s_acctbal").join(a, "s_suppkey", "left").join(b, "s_suppkey", "left")


@query("J08", "SELECT s_suppkey, m FROM supplier LEFT JOIN (SELECT l_suppkey AS s_suppkey, round(avg(l_tax), 6) AS m FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49 GROUP BY 1) USING (s_suppkey)")
def _(t):
    m = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 49").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(r6(F.avg("l_tax")).alias("m"))
    return R.pad(m, t.supplier, "s_suppkey")


@query("J14", "WITH f AS (SELECT o_custkey % 5 AS fold, min(year(o_orderdate)) - 2 AS lo, max(year(o_orderdate)) - 4 AS hi FROM orders GROUP BY 1) SELECT fold, count(*) AS n FROM orders, f WHERE o_custkey % 5 <> fold AND NOT (year(o_orderdate) >= lo AND year(o_orderdate) - 2 <= hi) GROUP BY 1")
def _(t):
    o = t.orders.select((F.col("o_custkey") % 5).alias("own"), F.year("o_orderdate").alias("y"))
    f = o.groupBy(F.col("own").alias("fold")).agg((F.min("y") - 2).alias("lo"), (F.max("y") - 4).alias("hi"))  # five rows
    return o.join(F.broadcast(f), F.col("own") != F.col("fold")).where("NOT (y >= lo AND y - 2 <= hi)").groupBy("fold").agg(F.count("*").alias("n"))


@query("A20", "SELECT l_returnflag, round(avg(l_tax) FILTER (l_linenumber IN (1, 2)), 6) AS a, round(avg(l_tax) FILTER (l_linenumber IN (3, 4)), 6) AS b, round(avg(l_tax), 6) AS every FROM lineitem GROUP BY 1")
def _(t):
    part = lambda *k: r6(F.avg(F.when(F.col("l_linenumber").isin(*k), F.col("l_tax"))))
    return t.lineitem.groupBy("l_returnflag").agg(part(1, 2).alias("a"), part(3, 4).alias("b"), r6(F.avg("l_tax")).alias("every"))


@query("A27", "SELECT bin, count(*) AS n, round(median(a - b), 6) AS diff FROM (SELECT l_suppkey, floor(l_quantity / 10)::BIGINT AS bin, avg(l_tax) FILTER (l_linestatus = 'F') AS a, avg(l_tax) FILTER (l_linestatus = 'O') AS b FROM lineitem GROUP BY ALL) WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1 HAVING count(*) >= 10")
def _(t):
    p = t.lineitem.groupBy("l_suppkey", F.floor(F.col("l_quantity") / 10).alias("bin")).pivot("l_linestatus", ["F", "O"]).agg(F.avg("l_tax")).dropna()
    return p.groupBy("bin").agg(F.count("*").alias("n"), r6(F.expr("percentile(F - O, 0.5)")).alias("diff")).where("n >= 10")


@query("A33", "SELECT l_suppkey, round(avg(l_tax) FILTER (l_linenumber = 1) - avg(l_tax), 6) AS delta FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(r6(F.avg(F.when(F.col("l_linenumber") == 1, F.col("l_tax"))) - F.avg("l_tax")).alias("delta"))


@query("A36", "SELECT regexp_extract(p_name, '([0-9]+)$', 1)::BIGINT % 10 AS step, round(avg(p_retailprice) FILTER (p_size <= 25), 4) AS low, round(avg(p_retailprice) FILTER (p_size > 25), 4) AS high FROM part WHERE regexp_matches(p_name, '[0-9]+$') GROUP BY 1")
def _(t):
    p = t.part.where(F.col("p_name").rlike("[0-9]+$")).withColumn("step", F.regexp_extract("p_name", "([0-9]+)$", 1).cast("long") % 10)
    mean = lambda c: F.round(F.avg(F.when(c, F.col("p_retailprice"))), 4)
    return p.groupBy("step").agg(mean(F.col("p_size") <= 25).alias("low"), mean(F.col("p_size") > 25).alias("high"))


@query("A37", "SELECT label, round(median(p), 4) AS mid, round(avg(p), 4) AS mean FROM (SELECT label, list_position(embedding, list_max(embedding)) * 5.7::DOUBLE AS p FROM embeddings) GROUP BY 1")
def _(t):
    p = F.array_position("embedding", F.array_max("embedding")) * 5.7
    return t.embeddings.select("label", p.alias("p")).groupBy("label").agg(F.round(F.expr("percentile(p, 0.5)"), 4).alias("mid"), F.round(F.avg("p"), 4).alias("mean"))


@query("O01", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey")
def _(t):
    return t.nation.select("n_nationkey", "n_name").orderBy("n_nationkey")


@query("U02", "SELECT 0 AS fold, c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT 1, c_custkey FROM customer WHERE c_acctbal < 0")
def _(t):
    none = t.spark.createDataFrame([], "fold int, c_custkey long")
    a, b = (t.customer.where(c).select(F.lit(i).alias("fold"), "c_custkey") for i, c in enumerate(("c_mktsegment = 'BUILDING'", "c_acctbal < 0")))
    return none.union(a).union(b)


@query("F02", "SELECT vec_id, round(CASE WHEN n + r <> 0 THEN greatest(-1, least(1, (n - r) / (n + r))) END, 6) AS ndvi, round(CASE WHEN n + s <> 0 THEN greatest(-1, least(1, (n - s) / (n + s))) END, 6) AS nbr, round(tanh(pow(greatest(-1, least(1, (n - r) / nullif(n + r, 0))), 2)), 6) AS kndvi FROM (SELECT vec_id, embedding[1]::DOUBLE + 1 AS n, embedding[2]::DOUBLE + 1 AS r, embedding[3]::DOUBLE + 1 AS s FROM embeddings)")
def _(t):
    n, r, s = (F.col("embedding")[i].cast("double") + 1 for i in range(3))
    return t.embeddings.select("vec_id", r6(ndvi(n, r)).alias("ndvi"), r6(nbr(n, s)).alias("nbr"), r6(kndvi(n, r)).alias("kndvi"))


@query("F03", "SELECT event_id, round(value - CASE WHEN event_type <> 'click' THEN 0 WHEN value <= 10 THEN 1.0 WHEN value <= 40 THEN 1.0 + (value - 10) * 2.0 / 30 WHEN value <= 80 THEN 3.0 - (value - 40) * 1.0 / 40 ELSE 2.0 END, 6) AS v FROM events")
def _(t):
    off = F.when(F.col("event_type") == "click", piecewise(F.col("value"), [(10, 1.0), (40, 3.0), (80, 2.0)])).otherwise(0.0)
    return t.events.select("event_id", r6(F.col("value") - off).alias("v"))


@query("F15", "SELECT p_partkey, nullif(regexp_extract('Quercus alba ' || p_name, '^([A-Z][a-z-]+) [a-z-]{2,}', 1), '') AS genus FROM part")
def _(t):
    return t.part.select("p_partkey", genus(F.concat(F.lit("Quercus alba "), F.col("p_name"))).alias("genus"))


@query("F17", "SELECT s_suppkey, 'b' || s_nationkey AS bucket, s_name AS key FROM supplier")
def _(t):
    uri = F.concat(F.lit("s3://b"), F.col("s_nationkey"), F.lit("/"), F.col("s_name"))
    return t.supplier.select("s_suppkey", F.regexp_extract(uri, r"^\w+://([^/]+)/(.*)$", 1).alias("bucket"), F.regexp_extract(uri, r"^\w+://([^/]+)/(.*)$", 2).alias("key"))


@query("G08", f"WITH {POINTS}, d AS (SELECT a.id, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS d FROM p a JOIN p b ON a.fold < 7 AND b.fold >= 7 GROUP BY 1) SELECT id, round(d, 6) AS di, d <= 0.01 AS inside FROM d")
def _(t):
    p = points(t)
    return G.nearest(p.where("fold < 7"), p.where("fold >= 7"), 0.02).select("id", r6("dist").alias("di"), (F.col("dist") <= 0.01).alias("inside"))


def _utm_sql() -> str:
    n = 1 / 298.257223563 / (2 - 1 / 298.257223563)
    e, radius = 2 * math.sqrt(n) / (1 + n), 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    term = lambda f, g: " + ".join(f"{a!r}::DOUBLE * {f}({2 * j} * xi) * {g}({2 * j} * eta)" for j, a in enumerate(alpha, 1))
    return f"""WITH s AS (SELECT s_suppkey, -73 + s_nationkey / 5 AS lon, (-30 - s_suppkey % 20)::DOUBLE AS lat FROM supplier), a AS (SELECT *, sin(radians(lat)) AS q, radians(lon + 69) AS lam FROM s), b AS (SELECT *, sinh(atanh(q) - {e!r}::DOUBLE * atanh({e!r}::DOUBLE * q)) AS t FROM a),
c AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM b) SELECT s_suppkey, lon, lat, round(500000 + {0.9996 * radius!r}::DOUBLE * (eta + {term("cos", "sinh")}), 3) AS x, round(10000000 + {0.9996 * radius!r}::DOUBLE * (xi + {term("sin", "cosh")}), 3) AS y FROM c"""


@query("G14", _utm_sql())
def _(t):
    s = t.supplier.select("s_suppkey", (-73 + F.col("s_nationkey") / 5).alias("lon"), (-30 - F.col("s_suppkey") % 20).cast("double").alias("lat"))
    x, y = to_utm(F.col("lon"), F.col("lat"), 19, True)
    return s.select("s_suppkey", "lon", "lat", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("G15", "SELECT i AS col, j AS row, 10 + (i + 0.5::DOUBLE) * 2.5::DOUBLE AS x, 50 - (j + 0.5::DOUBLE) * 2.0::DOUBLE AS y FROM range(4) a(i), range(5) b(j)")
def _(t):
    g = t.spark.range(20).select((F.col("id") % 4).alias("col"), F.floor(F.col("id") / 4).alias("row"))
    return g.select("col", "row", (10 + (F.col("col") + 0.5) * 2.5).alias("x"), (50 - (F.col("row") + 0.5) * 2.0).alias("y"))


@query("G18", "WITH g AS (SELECT floor(l_quantity / 5)::BIGINT AS cx, l_linenumber AS cy, max(l_returnflag) AS class FROM lineitem WHERE year(l_shipdate) = 1998 GROUP BY ALL) SELECT l_orderkey, l_linenumber, l_partkey, class FROM lineitem LEFT JOIN g ON cx = floor(l_quantity / 5) AND cy = l_linenumber WHERE l_tax = 0.03")
def _(t):
    cell = [F.floor(F.col("l_quantity") / 5).alias("cx"), F.col("l_linenumber").alias("cy")]
    g = t.lineitem.where("year(l_shipdate) = 1998").groupBy(*cell).agg(F.max("l_returnflag").alias("class"))
    return t.lineitem.where("l_tax = 0.03").select("l_orderkey", "l_linenumber", "l_partkey", *cell).join(g, ["cx", "cy"], "left").drop("cx", "cy")


@query("D24", "SELECT 'PCL_' || plot AS plot, species, value FROM (SELECT l_suppkey AS plot, l_partkey AS species, count(*) AS value FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)")
def _(t):
    c = t.lineitem.where("l_returnflag != 'R'").groupBy(F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species")).agg(F.count("*").alias("value"))
    return c.select(F.concat(F.lit("PCL_"), F.col("plot")).alias("plot"), "species", "value")


@query("V08", f"WITH RECURSIVE {packed_sql('c_nationkey % 5 <> 0')} SELECT c_custkey, CASE WHEN fold = 2 THEN 'val' ELSE 'fit' END AS split FROM customer JOIN r ON key = c_nationkey WHERE c_nationkey % 5 <> 0")
def _(t):
    train = t.customer.where("c_nationkey % 5 != 0")
    return V.grouped_kfold(train, "c_custkey", "c_nationkey", 5).select("c_custkey", F.when(F.col("fold") == 42 % 5, "val").otherwise("fit").alias("split"))


@query("V12", f"SELECT 'lodo' AS scheme, g.fold::INT AS fold, c_custkey, CASE WHEN c_mktsegment = g.s THEN 'test' ELSE 'train' END AS split FROM customer, (SELECT c_mktsegment AS s, row_number() OVER (ORDER BY c_mktsegment) - 1 AS fold FROM customer GROUP BY 1 HAVING count(*) >= 20) g UNION ALL SELECT 'random', f::INT, c_custkey, CASE WHEN {RANDOM} = f THEN 'test' ELSE 'train' END FROM customer, range(5) r(f)")
def _(t):
    own = V.leave_one_group_out(t.customer, "c_custkey", "c_mktsegment", 20).select(F.lit("lodo").alias("scheme"), F.col("fold").cast("int").alias("fold"), "c_custkey", "split")
    k = V.random_kfold(t.customer, "c_custkey", 5, 42)
    rnd = k.withColumn("f", F.explode(F.array(*[F.lit(i) for i in range(5)]))).select(F.lit("random").alias("scheme"), F.col("f").alias("fold"), "c_custkey", F.when(F.col("fold") == F.col("f"), "test").otherwise("train").alias("split"))
    return own.unionByName(rnd)
