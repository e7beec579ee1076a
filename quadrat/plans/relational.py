"""Queries of sources, filters, joins, aggregates, windows, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrat.operators import relational as R
from quadrat.plans.catalog import query

COMM = "comm AS (SELECT l_suppkey AS plot, l_partkey AS species, sum(l_quantity) AS value FROM lineitem GROUP BY ALL)"


def r6(c):
    return F.round(c, 6)


def comm(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species")).agg(F.sum("l_quantity").alias("value"))


@query("S12", "SELECT (l_suppkey % 5)::INT AS fold, count(DISTINCT l_suppkey) AS plots FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy((F.col("l_suppkey") % 5).cast("int").alias("fold")).agg(F.count_distinct("l_suppkey").alias("plots"))


@query("S13", "SELECT label, vec_id, round(list_sum(embedding[1:8]::DOUBLE[]), 6) AS s FROM embeddings WHERE label IN (1, 3)")
def _(t):
    first = F.aggregate(F.transform(F.slice("embedding", 1, 8), lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return t.embeddings.where(F.col("label").isin(1, 3)).select("label", "vec_id", r6(first).alias("s"))


@query("S14", "SELECT label, count(*) AS n, (list(vec_id ORDER BY m, vec_id))[1] AS lowest FROM (SELECT label, vec_id, round(list_avg(embedding::DOUBLE[]), 9) AS m FROM embeddings) GROUP BY label")
def _(t):
    m = F.round(F.aggregate(F.transform("embedding", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x) / F.size("embedding"), 9)
    return t.embeddings.select("label", "vec_id", m.alias("m")).groupBy("label").agg(F.count("*").alias("n"), F.min(F.struct("m", "vec_id"))["vec_id"].alias("lowest"))


@query("S21", "SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_discount) AS y0, max(l_discount) AS y1, count(DISTINCT year(l_shipdate)) AS years, count(*) AS n FROM lineitem")
def _(t):
    return t.lineitem.agg(F.min("l_quantity").alias("x0"), F.max("l_quantity").alias("x1"), F.min("l_discount").alias("y0"), F.max("l_discount").alias("y1"), F.count_distinct(F.year("l_shipdate")).alias("years"), F.count("*").alias("n"))


@query("S23", "SELECT 'price' AS target, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem UNION ALL SELECT 'total', min(o_totalprice), max(o_totalprice) FROM orders")
def _(t):
    one = lambda df, name, c: df.agg(F.lit(name).alias("target"), F.min(c).alias("lo"), F.max(c).alias("hi"))
    return one(t.lineitem, "price", "l_extendedprice").unionByName(one(t.orders, "total", "o_totalprice"))


@query("S24", "SELECT event_type, count(*) AS n, min(k) AS lo, max(k) AS hi FROM (SELECT event_type, (props::JSON->>'k')::INT AS k FROM events) GROUP BY event_type")
def _(t):
    k = F.from_json("props", "map<string,int>")["k"]
    return t.events.select("event_type", k.alias("k")).groupBy("event_type").agg(F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi"))


@query("P01", """SELECT * FROM (
  SELECT 'dated' AS step, count(*) FILTER (l_shipdate IS NOT NULL) AS n FROM lineitem
  UNION ALL SELECT 'range', count(*) FILTER (l_quantity BETWEEN 5 AND 45) FROM lineitem
  UNION ALL SELECT 'since', count(*) FILTER (l_quantity BETWEEN 5 AND 45 AND year(l_shipdate) >= 1997) FROM lineitem
  UNION ALL SELECT 'flag', count(*) FILTER (l_quantity BETWEEN 5 AND 45 AND year(l_shipdate) >= 1997 AND l_returnflag = 'R') FROM lineitem)""")
def _(t):
    return R.filter_cascade(t.lineitem, [("dated", F.col("l_shipdate").isNotNull()), ("range", F.col("l_quantity").between(5, 45)), ("since", F.year("l_shipdate") >= 1997), ("flag", F.col("l_returnflag") == "R")])


@query("P02", "SELECT coalesce(CASE l_returnflag WHEN 'A' THEN 'forest' WHEN 'N' THEN 'shrub' END, 'unknown') AS stratum, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(R.mapped(F.col("l_returnflag"), {"A": "forest", "N": "shrub"}, "unknown").alias("stratum")).agg(F.count("*").alias("n"))


@query("P03", "SELECT round_even(l_quantity / 4, 0)::BIGINT || '_' || round_even(l_linenumber / 2, 0)::BIGINT AS cell, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(F.concat_ws("_", F.bround(F.col("l_quantity") / 4).cast("long"), F.bround(F.col("l_linenumber") / 2).cast("long")).alias("cell")).agg(F.count("*").alias("n"))


@query("P04", "SELECT floor(l_quantity / 10)::BIGINT || '_' || floor(l_linenumber / 3)::BIGINT AS block, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(F.concat_ws("_", F.floor(F.col("l_quantity") / 10), F.floor(F.col("l_linenumber") / 3)).alias("block")).agg(F.count("*").alias("n"))


@query("P05", "SELECT repeated, count(*) AS n FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS repeated FROM lineitem) GROUP BY 1")
def _(t):
    return R.repeated(t.lineitem.select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], "repeated").groupBy("repeated").agg(F.count("*").alias("n"))


@query("P06", "SELECT o_orderkey, (year(o_orderdate) - 2)::INT AS win_start, year(o_orderdate)::INT AS win_end FROM orders")
def _(t):
    y = F.year("o_orderdate")
    return t.orders.select("o_orderkey", (y - 2).alias("win_start"), y.alias("win_end"))


@query("P07", "SELECT p_partkey, p_size IN (1, 7, 15, 23) AS native FROM part")
def _(t):
    return t.part.select("p_partkey", F.col("p_size").isin(1, 7, 15, 23).alias("native"))


@query("P08", "SELECT l_orderkey, l_linenumber, l_partkey, (l_orderkey & 2) = 0 AND (l_orderkey & 8) = 0 AND (l_linestatus <> 'O' OR (l_orderkey & 32) = 0) AS clear FROM lineitem")
def _(t):
    bit = lambda b: F.col("l_orderkey").bitwiseAND(1 << b) == 0
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (bit(1) & bit(3) & ((F.col("l_linestatus") != "O") | bit(5))).alias("clear"))


@query("P09", "SELECT l_suppkey, count(v) AS n, round(sum(v), 4) AS s FROM (SELECT l_suppkey, CASE WHEN l_quantity > 10 AND l_returnflag <> 'R' THEN l_quantity * 0.0000275 - 0.2 END AS v FROM lineitem) GROUP BY 1")
def _(t):
    v = F.when((F.col("l_quantity") > 10) & (F.col("l_returnflag") != "R"), F.col("l_quantity") * 0.0000275 - 0.2)
    return t.lineitem.groupBy("l_suppkey").agg(F.count(v).alias("n"), F.round(F.sum(v), 4).alias("s"))


@query("P10", "SELECT count(*) FILTER (p_partkey IS NULL) AS unmatched, count(*) AS n FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_brand <> 'Brand#11'")
def _(t):
    known = t.part.where("p_brand != 'Brand#11'").select(F.col("p_partkey").alias("l_partkey"))
    own = t.lineitem.select("l_partkey")
    return own.join(known.withColumn("k", F.lit(1)), "l_partkey", "left").agg(F.count(F.when(F.col("k").isNull(), 1)).alias("unmatched"), F.count("*").alias("n"))


@query("P11", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def _(t):
    return t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query("P12", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 5)")
def _(t):
    some = t.supplier.where("s_nationkey < 5").select(F.col("s_suppkey").alias("l_suppkey"))
    return t.lineitem.join(some, "l_suppkey", "left_semi").select("l_orderkey", "l_linenumber", "l_partkey")


@query("P13", "SELECT i::INT AS step, round(avg(embedding[i]::DOUBLE), 6) AS mean FROM embeddings, range(1, 65) r(i) GROUP BY i")
def _(t):
    return t.embeddings.select(F.posexplode("embedding")).groupBy((F.col("pos") + 1).alias("step")).agg(r6(F.avg(F.col("col").cast("double"))).alias("mean"))


@query("P14", "SELECT count(*) AS n FROM (SELECT nullif(l_discount, 0) AS a, nullif(l_tax, 0) AS b FROM lineitem) WHERE a IS NOT NULL AND b IS NOT NULL")
def _(t):
    return t.lineitem.selectExpr("nullif(l_discount, 0) a", "nullif(l_tax, 0) b").dropna(subset=["a", "b"]).agg(F.count("*").alias("n"))


@query("P16", "SELECT o_orderkey, (nullif(o_orderstatus, 'O') IS NOT NULL)::INT::FLOAT AS mask FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.expr("nullif(o_orderstatus, 'O')").isNotNull().cast("int").cast("float").alias("mask"))


@query("P17", "SELECT c_custkey, n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_totalprice > 300000 GROUP BY 1) ON o_custkey = c_custkey")
def _(t):
    some = t.orders.where("o_totalprice > 300000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return R.pad(some, t.customer, "c_custkey")


@query("P18", "SELECT s_suppkey, regexp_replace(s_name, '^Supplier#0*', 'S') AS twin, regexp_extract(s_name, '([0-9]+)$', 1) AS number FROM supplier")
def _(t):
    return t.supplier.select("s_suppkey", F.regexp_replace("s_name", "^Supplier#0*", "S").alias("twin"), F.regexp_extract("s_name", "([0-9]+)$", 1).alias("number"))


@query("P19", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) >= 1996 AND year(o_orderdate) - 2 <= 1995")
def _(t):
    return t.orders.where((F.year("o_orderdate") >= 1996) & (F.year("o_orderdate") - 2 <= 1995)).select("o_orderkey")


@query("J01", "SELECT * FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) USING (o_custkey)")
def _(t):  # one aggregate says what the joined ones would
    open_top = F.max(F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")))
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), open_top.alias("top")).where("top IS NOT NULL")


@query("J02", "SELECT count(*) AS n, count(b.k) AS met FROM (SELECT l_quantity AS x, l_tax AS y FROM lineitem) a LEFT JOIN (SELECT DISTINCT l_quantity AS x, l_tax AS y, 1 AS k FROM lineitem WHERE l_discount = 0.05) b USING (x, y)")
def _(t):
    a = t.lineitem.select(F.col("l_quantity").alias("x"), F.col("l_tax").alias("y"))
    b = t.lineitem.where("l_discount = 0.05").select(F.col("l_quantity").alias("x"), F.col("l_tax").alias("y")).distinct().withColumn("k", F.lit(1))
    return a.join(b, ["x", "y"], "left").agg(F.count("*").alias("n"), F.count("k").alias("met"))


@query("J03", "SELECT count(*) AS unmatched FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def _(t):
    return t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti").agg(F.count("*").alias("unmatched"))


@query("J04", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_nationkey <> 3")
def _(t):
    return t.supplier.join(t.nation.where("n_nationkey != 3"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")


@query("J05", f"WITH {COMM} SELECT plot, species, coalesce(better, value) AS value FROM comm LEFT JOIN (SELECT plot, species, 1.5 * value AS better FROM comm WHERE species % 7 = 0) USING (plot, species)")
def _(t):
    c = comm(t)
    better = c.where("species % 7 = 0").withColumn("value", F.col("value") * 1.5)
    return R.override(c, better, ["plot", "species"], "value").select("plot", "species", "value")


@query("J09", "SELECT count(*) AS n, round(avg(a.x - b.x), 6) AS diff FROM (SELECT l_suppkey AS id, avg(nullif(l_tax, 0)) AS x FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a JOIN (SELECT l_suppkey AS id, avg(l_discount) AS x FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) b USING (id) WHERE a.x IS NOT NULL AND b.x IS NOT NULL")
def _(t):
    one = lambda flag, c, name: t.lineitem.where(F.col("l_returnflag") == flag).groupBy(F.col("l_suppkey").alias("id")).agg(F.avg(F.expr(c)).alias(name))
    return one("A", "nullif(l_tax, 0)", "a").join(one("N", "l_discount", "b"), "id").dropna().agg(F.count("*").alias("n"), r6(F.avg(F.col("a") - F.col("b"))).alias("diff"))


@query("J16", """SELECT o_orderkey, y::INT AS map_year, (y - yr)::INT AS delta FROM (
  SELECT o_orderkey, yr, y, row_number() OVER (PARTITION BY o_orderkey ORDER BY abs(y - yr), y) AS r
  FROM (SELECT o_orderkey, year(o_orderdate) AS yr FROM orders), (VALUES (1995), (1998), (2000)) v(y)) WHERE r = 1""")
def _(t):
    years = t.spark.createDataFrame([(1995,), (1998,), (2000,)], "map_year int")
    own = t.orders.select("o_orderkey", F.year("o_orderdate").alias("yr"))
    return R.nearest_year(own, years, "yr", "map_year").select("o_orderkey", "map_year", "delta")


@query("J21", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS plots, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 3) GROUP BY 1")
def _(t):
    full = t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_returnflag").alias("k")).where("k = 3").select("l_suppkey")
    return t.lineitem.join(full, "l_suppkey", "left_semi").groupBy("l_returnflag").agg(F.count_distinct("l_suppkey").alias("plots"), F.count("*").alias("n"))


@query("J22", "SELECT DISTINCT l_suppkey AS tile, year(l_shipdate)::INT AS year FROM lineitem EXCEPT SELECT DISTINCT l_suppkey, year(l_shipdate)::INT FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40")
def _(t):
    work = t.lineitem.select(F.col("l_suppkey").alias("tile"), F.year("l_shipdate").alias("year")).distinct()
    done = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 40").select(F.col("l_suppkey").alias("tile"), F.year("l_shipdate").alias("year"))
    return work.join(done, ["tile", "year"], "left_anti")


@query("J23", "SELECT l_partkey AS species FROM lineitem WHERE l_suppkey % 2 = 0 AND l_quantity > 45 INTERSECT SELECT l_partkey FROM lineitem WHERE l_suppkey % 2 = 1 AND l_quantity > 45")
def _(t):
    one = lambda k: t.lineitem.where(f"l_suppkey % 2 = {k} AND l_quantity > 45").select(F.col("l_partkey").alias("species"))
    return one(0).intersect(one(1))


@query("J24", "SELECT l_suppkey, round(avg(l_tax) FILTER (l_returnflag = 'A'), 6) AS a, round(avg(l_tax) FILTER (l_returnflag = 'N'), 6) AS n, round(avg(l_tax) FILTER (l_returnflag = 'R'), 6) AS r FROM lineitem GROUP BY 1")
def _(t):
    p = t.lineitem.groupBy("l_suppkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.avg("l_tax"))
    return p.select("l_suppkey", *[r6(F.col(x)).alias(x.lower()) for x in "ANR"])


@query("A01", "SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first, count(DISTINCT o_orderpriority) AS kinds, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.min_by("o_orderpriority", "o_orderkey").alias("first"), F.count_distinct("o_orderpriority").alias("kinds"), F.count("*").alias("n"))


@query("A02", "SELECT l_suppkey, string_agg(DISTINCT l_returnflag || l_linestatus, ',' ORDER BY l_returnflag || l_linestatus) AS kinds, min(year(l_shipdate))::INT AS y0, count(*) AS n, row_number() OVER (ORDER BY l_suppkey)::INT AS id FROM lineitem GROUP BY l_suppkey")
def _(t):
    sites = t.lineitem.groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_set(F.concat("l_returnflag", "l_linestatus"))), ",").alias("kinds"), F.min(F.year("l_shipdate")).alias("y0"), F.count("*").alias("n"))
    return sites.withColumn("id", F.row_number().over(Window.orderBy("l_suppkey")))  # one row for each site, after the aggregate


@query("A03", f"WITH {COMM} SELECT plot, species, value FROM comm")
def _(t):
    return comm(t)


@query("A04", "SELECT l_suppkey AS plot, l_partkey AS species, sum(l_quantity) AS value, arg_min(l_returnflag, (l_orderkey, l_linenumber, l_returnflag)) AS first FROM lineitem GROUP BY ALL")
def _(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species")).agg(F.sum("l_quantity").alias("value"), F.min(F.struct("l_orderkey", "l_linenumber", "l_returnflag"))["l_returnflag"].alias("first"))


@query("A05", "SELECT l_suppkey, round(sum(pi() / 4 * pow(l_quantity / 100, 2) * (1 + l_tax)), 6) AS basal FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(r6(F.sum(F.pi() / 4 * F.pow(F.col("l_quantity") / 100, 2) * (1 + F.col("l_tax")))).alias("basal"))


@query("A06", "SELECT l_suppkey AS plot, l_partkey AS species, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species")).agg(F.count("*").alias("n"))


@query("A07", """SELECT user_id, round(median(value), 6) AS median, round(avg(value), 6) AS mean, round(list_avg(list_sort(list(value))[k + 1 : count(*) - k]), 6) AS trimmed,
  round(stddev_samp(value), 6) AS sd, round(stddev_samp(value) / avg(value), 6) AS cv, max(CASE WHEN event_id % 25 = 12 THEN value END) AS centre, count(value) AS n
FROM events, (SELECT user_id AS u, floor(count(*) * 0.2)::BIGINT AS k FROM events GROUP BY 1) WHERE u = user_id GROUP BY user_id, k""")
def _(t):
    g = t.events.groupBy("user_id").agg(F.expr("percentile(value, 0.5)").alias("median"), F.avg("value").alias("mean"), R.trimmed_mean(F.collect_list("value")).alias("trimmed"), F.stddev_samp("value").alias("sd"), F.max(F.when(F.col("event_id") % 25 == 12, F.col("value"))).alias("centre"), F.count("value").alias("n"))
    return g.select("user_id", r6("median").alias("median"), r6("mean").alias("mean"), r6("trimmed").alias("trimmed"), r6("sd").alias("sd"), r6(F.col("sd") / F.col("mean")).alias("cv"), "centre", "n")


_STATS = "round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd, " + ", ".join(f"round(quantile_cont(v, {q / 100}), 6) AS p{q}" for q in (10, 25, 50, 75, 90)) + ", round(min(v), 6) AS min, round(max(v), 6) AS max, round(max(v) - min(v), 6) AS range, round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 6) AS iqr, round(stddev_samp(v) / avg(v), 6) AS cv"


@query("A08", f"SELECT vec_id, {_STATS} FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY vec_id")
def _(t):
    g = t.embeddings.select("vec_id", F.explode("embedding").alias("e")).select("vec_id", F.col("e").cast("double").alias("v")).groupBy("vec_id").agg(*R.order_free("v"))
    return g.select("vec_id", *[r6(c).alias(c) for c in g.columns[1:]])


@query("A09", f"SELECT user_id, event_type, {_STATS} FROM (SELECT user_id, event_type, value AS v FROM events) GROUP BY ALL HAVING count(v) >= 3")
def _(t):
    g = t.events.withColumnRenamed("value", "v").groupBy("user_id", "event_type").agg(*R.order_free("v"), F.count("v").alias("n")).where("n >= 3").drop("n")
    return g.select("user_id", "event_type", *[r6(c).alias(c) for c in g.columns[2:]])


@query("A10", """SELECT user_id, round(djf, 6) AS djf, round(jja, 6) AS jja, round(djf - jja, 6) AS contrast, round(greatest(djf, mam, jja) - least(djf, mam, jja), 6) AS amplitude FROM (
  SELECT user_id, CASE WHEN count(*) FILTER (s = 0) >= 3 THEN median(value) FILTER (s = 0) END AS djf, CASE WHEN count(*) FILTER (s = 1) >= 3 THEN median(value) FILTER (s = 1) END AS mam,
    CASE WHEN count(*) FILTER (s = 2) >= 3 THEN median(value) FILTER (s = 2) END AS jja FROM (SELECT user_id, value, day(ts) % 3 AS s FROM events) GROUP BY 1)""")
def _(t):
    e = t.events.withColumn("s", F.dayofmonth("ts") % 3)
    med = lambda k: F.when(F.count(F.when(F.col("s") == k, 1)) >= 3, F.expr(f"percentile(CASE WHEN s = {k} THEN value END, 0.5)"))
    g = e.groupBy("user_id").agg(med(0).alias("djf"), med(1).alias("mam"), med(2).alias("jja"))
    return g.select("user_id", r6("djf").alias("djf"), r6("jja").alias("jja"), r6(F.col("djf") - F.col("jja")).alias("contrast"), r6(F.greatest("djf", "mam", "jja") - F.least("djf", "mam", "jja")).alias("amplitude"))


@query("A12", """SELECT fold, round(median(v) FILTER (test), 6) AS test_median, round(avg(v) FILTER (NOT test), 6) AS train_mean, round(stddev_samp(v) FILTER (NOT test), 6) AS train_sd, count(*) FILTER (test) AS n_test
FROM (SELECT f AS fold, l_suppkey % 5 = f AS test, l_quantity AS v FROM lineitem, range(5) r(f)) GROUP BY fold""")
def _(t):
    e = t.lineitem.select(F.explode(F.array(*[F.lit(i).cast("long") for i in range(5)])).alias("fold"), "l_suppkey", F.col("l_quantity").alias("v")).withColumn("test", F.col("l_suppkey") % 5 == F.col("fold"))
    return e.groupBy("fold").agg(r6(F.expr("percentile(CASE WHEN test THEN v END, 0.5)")).alias("test_median"), r6(F.avg(F.when(~F.col("test"), F.col("v")))).alias("train_mean"), r6(F.stddev_samp(F.when(~F.col("test"), F.col("v")))).alias("train_sd"), F.count(F.when(F.col("test"), 1)).alias("n_test"))


@query("A13", "SELECT o_custkey, count(*) AS n, min(year(o_orderdate)) || '-' || max(year(o_orderdate)) AS years, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS strata, median(o_totalprice) AS mid FROM orders GROUP BY 1")
def _(t):
    y = F.year("o_orderdate")
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.concat_ws("-", F.min(y), F.max(y)).alias("years"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("strata"), F.expr("percentile(o_totalprice, 0.5)").alias("mid"))


@query("A14", "SELECT count(*) AS orders, count(*) FILTER (k > 1) AS mixed, sum(n)::BIGINT AS lines FROM (SELECT l_orderkey, count(DISTINCT l_returnflag) AS k, count(*) AS n FROM lineitem GROUP BY 1)")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.count_distinct("l_returnflag").alias("k"), F.count("*").alias("n")).agg(F.count("*").alias("orders"), F.count(F.when(F.col("k") > 1, 1)).alias("mixed"), F.sum("n").alias("lines"))


@query("A15", "SELECT count(*) AS keys, count(*) FILTER (n > 1) AS many FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)")
def _(t):
    return t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n")).agg(F.count("*").alias("keys"), F.count(F.when(F.col("n") > 1, 1)).alias("many"))


@query("A16", "SELECT l_orderkey AS plot, round(avg(l_quantity * p_retailprice), 4) AS pred, min(l_extendedprice) AS obs FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1")
def _(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("l_orderkey").alias("plot")).agg(F.round(F.avg(F.col("l_quantity") * F.col("p_retailprice")), 4).alias("pred"), F.min("l_extendedprice").alias("obs"))


@query("A17", "SELECT round(avg(m), 6) AS mean_of_facets, count(*) AS facets FROM (SELECT f, avg(m) AS m FROM (SELECT l_returnflag AS f, l_suppkey, avg(l_discount) AS m FROM lineitem GROUP BY ALL) GROUP BY f)")
def _(t):
    targets = t.lineitem.groupBy("l_returnflag", "l_suppkey").agg(F.avg("l_discount").alias("m"))
    return targets.groupBy("l_returnflag").agg(F.avg("m").alias("m")).agg(r6(F.avg("m")).alias("mean_of_facets"), F.count("*").alias("facets"))


@query("A18", "SELECT l_suppkey, round(avg(m), 6) AS mean, round(stddev_samp(m), 6) AS sd FROM (SELECT l_suppkey, l_linenumber % 3 AS seed, avg(l_tax) AS m FROM lineitem GROUP BY ALL) GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey", F.col("l_linenumber") % 3).agg(F.avg("l_tax").alias("m")).groupBy("l_suppkey").agg(r6(F.avg("m")).alias("mean"), r6(F.stddev_samp("m")).alias("sd"))


@query("A21", "SELECT l_suppkey, round(avg(l_tax) FILTER (l_returnflag = 'A') - avg(l_tax) FILTER (l_returnflag = 'R'), 6) AS gap FROM lineitem GROUP BY 1")
def _(t):
    p = t.lineitem.groupBy("l_suppkey").pivot("l_returnflag", ["A", "R"]).agg(F.avg("l_tax"))
    return p.select("l_suppkey", r6(F.col("A") - F.col("R")).alias("gap"))


@query("A22", "SELECT p_brand, round(sum(v) FILTER (p_size < 25), 6) AS small, round(sum(v) FILTER (p_size >= 25), 6) AS large FROM (SELECT p_brand, p_size, p_retailprice / sum(p_retailprice) OVER (PARTITION BY p_brand) AS v FROM part) GROUP BY 1")
def _(t):
    v = F.col("p_retailprice") / F.sum("p_retailprice").over(Window.partitionBy("p_brand"))
    return t.part.select("p_brand", "p_size", v.alias("v")).groupBy("p_brand").agg(r6(F.sum(F.when(F.col("p_size") < 25, F.col("v")))).alias("small"), r6(F.sum(F.when(F.col("p_size") >= 25, F.col("v")))).alias("large"))


@query("A23", "SELECT floor(l_quantity / 5)::BIGINT AS cx, floor(l_discount * 100 / 3)::BIGINT AS cy, count(*) AS n, round(avg(l_tax), 6) AS mean FROM lineitem GROUP BY ALL")
def _(t):
    return t.lineitem.groupBy(F.floor(F.col("l_quantity") / 5).alias("cx"), F.floor(F.col("l_discount") * 100 / 3).alias("cy")).agg(F.count("*").alias("n"), r6(F.avg("l_tax")).alias("mean"))


@query("A24", "SELECT year(o_orderdate)::INT AS year, round(count(*) / sum(count(*)) OVER (), 6) AS weight FROM orders GROUP BY 1")
def _(t):
    g = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("all")))).select("year", r6(F.col("n") / F.col("all")).alias("weight"))


@query("A26", "SELECT m::INT AS m, round((v + lead(v) OVER w + lead(v, 2) OVER w), 2) AS quarter FROM (SELECT m, v FROM (SELECT month(o_orderdate) AS m, sum(o_totalprice) AS v FROM orders GROUP BY 1) UNION ALL SELECT m + 12, v FROM (SELECT month(o_orderdate) AS m, sum(o_totalprice) AS v FROM orders GROUP BY 1) WHERE m <= 2) WINDOW w AS (ORDER BY m) QUALIFY m <= 12")
def _(t):
    m = t.orders.groupBy(F.month("o_orderdate").alias("m")).agg(F.sum("o_totalprice").alias("v"))
    # each month goes to the three circular quarters that hold it
    return m.select(F.explode(F.array(*[F.pmod(F.col("m") - 1 - k, F.lit(12)) + 1 for k in range(3)])).alias("m"), "v").groupBy("m").agg(F.round(F.sum("v"), 2).alias("quarter"))


@query("A29", "SELECT l_returnflag, count(*) AS n, round(avg((l_quantity <= 25)::INT), 6) AS inside FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count("*").alias("n"), r6(F.avg((F.col("l_quantity") <= 25).cast("int"))).alias("inside"))


@query("A30", "SELECT year(o_orderdate)::INT AS year, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def _(t):
    return t.orders.groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.count("*").alias("n"))


@query("A34", "SELECT p_type, arg_max(p_brand, (m, p_brand)) AS best, round(max(m), 4) AS top FROM (SELECT p_type, p_brand, round(avg(p_retailprice), 6) AS m FROM part GROUP BY ALL) GROUP BY 1")
def _(t):
    m = t.part.groupBy("p_type", "p_brand").agg(r6(F.avg("p_retailprice")).alias("m"))
    return m.groupBy("p_type").agg(F.max(F.struct("m", "p_brand"))["p_brand"].alias("best"), F.round(F.max("m"), 4).alias("top"))


@query("A35", "SELECT a.l_returnflag, round(a.m - b.m, 6) AS diff FROM (SELECT l_returnflag, avg(l_tax) AS m FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) a JOIN (SELECT l_returnflag, avg(l_tax) AS m FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) b USING (l_returnflag)")
def _(t):
    m = t.lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.avg("l_tax"))
    return m.where("F IS NOT NULL AND O IS NOT NULL").select("l_returnflag", r6(F.col("F") - F.col("O")).alias("diff"))


@query("A39", "SELECT i::INT AS step, round(median(embedding[i]::DOUBLE), 6) AS mid FROM embeddings, range(1, 65) r(i) GROUP BY i")
def _(t):
    return t.embeddings.select(F.posexplode("embedding")).groupBy((F.col("pos") + 1).alias("step")).agg(r6(F.expr("percentile(cast(col AS double), 0.5)")).alias("mid"))


@query("A40", "SELECT p_brand, round(count(*) / sum(count(*)) OVER (), 6) AS w FROM part WHERE p_size IN (1, 7, 15, 23) GROUP BY 1")
def _(t):
    g = t.part.where(F.col("p_size").isin(1, 7, 15, 23)).groupBy("p_brand").agg(F.count("*").alias("n"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("all")))).select("p_brand", r6(F.col("n") / F.col("all")).alias("w"))


@query("W02", "SELECT event_id, round(avg(value) OVER (PARTITION BY user_id), 6) AS m FROM events")
def _(t):
    return t.events.select("event_id", r6(F.avg("value").over(Window.partitionBy("user_id"))).alias("m"))


@query("W03", "SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1")
def _(t):
    return R.best_of(t.events, ["user_id"], [F.desc("value"), F.col("event_id")]).select("user_id", "event_id", "value")


@query("W04", "SELECT event_type, user_id, round(m, 6) AS m FROM (SELECT event_type, user_id, m, row_number() OVER (PARTITION BY event_type ORDER BY round(m, 6) DESC, user_id) AS r FROM (SELECT event_type, user_id, avg(value) AS m FROM events GROUP BY ALL)) WHERE r = 1")
def _(t):
    m = t.events.groupBy("event_type", "user_id").agg(r6(F.avg("value")).alias("m"))
    return R.best_of(m, ["event_type"], [F.desc("m"), F.col("user_id")])


@query("W05", "SELECT event_type, user_id, r::INT AS r FROM (SELECT event_type, user_id, rank() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS r FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)) WHERE r <= 2")
def _(t):
    n = t.events.groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return n.withColumn("r", F.rank().over(Window.partitionBy("event_type").orderBy(F.desc("n"), "user_id"))).where("r <= 2").select("event_type", "user_id", "r")


@query("W08", "SELECT user_id FROM (SELECT user_id FROM (SELECT user_id, round(avg(value), 6) AS m FROM events GROUP BY 1 ORDER BY m DESC, user_id LIMIT 8)) UNION SELECT user_id FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, user_id LIMIT 1)")
def _(t):
    g = t.events.groupBy("user_id").agg(r6(F.avg("value")).alias("m"), F.count("*").alias("n"))
    return g.orderBy(F.desc("m"), "user_id").limit(8).select("user_id").union(g.orderBy(F.desc("n"), "user_id").limit(1).select("user_id")).distinct()


@query("W10", """WITH s AS (SELECT l_returnflag AS run, l_suppkey % 5 AS fold, sum(l_tax) AS sm, count(*) AS n FROM lineitem GROUP BY ALL),
o AS (SELECT run, fold, sm / n AS own, round((sum(sm) OVER w - sm) / (sum(n) OVER w - n), 9) AS rest FROM s WINDOW w AS (PARTITION BY run))
SELECT fold, arg_max(run, (rest, run)) AS winner, round(arg_max(own, (rest, run)), 6) AS held FROM o GROUP BY fold""")
def _(t):
    s = t.lineitem.groupBy(F.col("l_returnflag").alias("run"), (F.col("l_suppkey") % 5).alias("fold")).agg(F.sum("l_tax").alias("sm"), F.count("*").alias("n"))
    w = Window.partitionBy("run")
    o = s.select("run", "fold", (F.col("sm") / F.col("n")).alias("own"), F.round((F.sum("sm").over(w) - F.col("sm")) / (F.sum("n").over(w) - F.col("n")), 9).alias("rest"))
    return o.groupBy("fold").agg(F.max(F.struct("rest", "run", "own")).alias("b")).select("fold", F.col("b.run").alias("winner"), r6("b.own").alias("held"))


@query("O02", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def _(t):
    return t.customer.select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey")


@query("O03", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t):
    return t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey")


@query("U01", "SELECT c_custkey AS id, c_acctbal AS v, 'c' AS source FROM customer UNION ALL SELECT s_suppkey, s_acctbal, 's' FROM supplier")
def _(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("v"), F.lit("c").alias("source")).unionByName(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("v"), F.lit("s").alias("source")))


@query("U03", "SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0 EXCEPT SELECT o_custkey FROM orders WHERE o_totalprice > 250000")
def _(t):
    big = t.orders.where("o_totalprice > 250000").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.where("c_custkey % 5 != 0").select("c_custkey").join(big, "c_custkey", "left_anti")


@query("U04", "SELECT count(*) AS leaks FROM (SELECT o_orderkey FROM orders WHERE o_custkey % 5 = 0 INTERSECT SELECT o_orderkey FROM orders WHERE o_custkey % 5 <> 0)")
def _(t):
    one = lambda c: t.orders.where(c).select("o_orderkey")
    return one("o_custkey % 5 = 0").intersect(one("o_custkey % 5 != 0")).agg(F.count("*").alias("leaks"))


@query("U05", "SELECT l_suppkey, bool_or(l_quantity = 50) AS any_year FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.bool_or(F.col("l_quantity") == 50).alias("any_year"))


@query("U06", "SELECT l_suppkey, bool_and(has) AS every_year, string_agg(y::VARCHAR, ',' ORDER BY y) AS used FROM (SELECT l_suppkey, year(l_shipdate) AS y, bool_or(l_quantity >= 49) AS has FROM lineitem GROUP BY ALL) GROUP BY 1")
def _(t):
    y = t.lineitem.groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(F.bool_or(F.col("l_quantity") >= 49).alias("has"))
    return y.groupBy("l_suppkey").agg(F.bool_and("has").alias("every_year"), F.array_join(F.array_sort(F.collect_list("y")), ",").alias("used"))


@query("U07", "SELECT DISTINCT l_partkey AS species FROM lineitem WHERE l_quantity > 40 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 10)")
def _(t):
    return t.lineitem.where("l_quantity > 40").select(F.col("l_partkey").alias("species")).join(t.part.where("p_size < 10").select(F.col("p_partkey").alias("species")), "species", "left_anti").distinct()


@query("F01", """SELECT event_id, round((n - r) / nullif(n + r, 0), 6) AS ndvi, round(greatest(-1, least(1, 2.5 * (n - r) / nullif(n + 6 * r - 7.5 * b + 1, 0))), 6) AS evi,
  round(tanh(pow((n - r) / nullif(n + r, 0), 2)), 6) AS kndvi, round(greatest(-1.5, least(1.5, 1.5 * (n - r) / nullif(n + r + 0.5, 0))), 6) AS savi FROM (SELECT event_id, abs(value) / 100 AS n, (event_id % 50) / 100 AS r, (event_id % 20) / 100 AS b FROM events)""")
def _(t):
    from quadrat.functions.spectral import evi, kndvi, ndvi, savi

    e = t.events.select("event_id", (F.abs("value") / 100).alias("n"), ((F.col("event_id") % 50) / 100).alias("r"), ((F.col("event_id") % 20) / 100).alias("b"))
    n, r, b = F.col("n"), F.col("r"), F.col("b")
    return e.select("event_id", r6(ndvi(n, r)).alias("ndvi"), r6(evi(n, r, b)).alias("evi"), r6(kndvi(n, r)).alias("kndvi"), r6(savi(n, r)).alias("savi"))


@query("F04", "SELECT event_id, round(epoch(ts) / 86400, 6) AS days FROM events")
def _(t):
    return t.events.select("event_id", r6(F.unix_micros(F.col("ts").cast("timestamp")) / 86400e6).alias("days"))


@query("F05", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'")
def _(t):
    return t.orders.where("o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1999-01-01'").select("o_orderkey")


@query("F06", "SELECT CASE WHEN y > 1994 AND y <= 1996 THEN 'b0' WHEN y <= 1998 THEN 'b1' WHEN y <= 2001 THEN 'b2' END AS block, count(*) AS n FROM (SELECT year(o_orderdate) AS y FROM orders) GROUP BY 1")
def _(t):
    from quadrat.functions.calendar import right_closed

    return t.orders.groupBy(right_closed(F.year("o_orderdate"), [1994, 1996, 1998, 2001], "b").alias("block")).agg(F.count("*").alias("n"))


@query("F07", "SELECT user_id, CASE WHEN count(*) >= 2 THEN round(365 / (2 * pi()) * sqrt(-2 * ln(sqrt(pow(avg(sin(2 * pi() * d / 365)), 2) + pow(avg(cos(2 * pi() * d / 365)), 2)))), 4) END AS sd FROM (SELECT user_id, dayofyear(ts) AS d FROM events) GROUP BY 1")
def _(t):
    from quadrat.functions.calendar import circular_sd

    return t.events.groupBy("user_id").agg(F.round(circular_sd(F.dayofyear("ts")), 4).alias("sd"))


@query("F08", "SELECT event_id, round(sin(2 * pi() * dayofyear(ts) / 365), 6) AS s, round(cos(2 * pi() * dayofyear(ts) / 365), 6) AS c FROM events")
def _(t):
    a = 2 * F.pi() * F.dayofyear("ts") / 365
    return t.events.select("event_id", r6(F.sin(a)).alias("s"), r6(F.cos(a)).alias("c"))


@query("F09", "SELECT vec_id, p::INT AS peak, CASE WHEN p * 5 BETWEEN 120 AND 260 THEN 'winter_peaking' ELSE 'summer_peaking' END AS phase FROM (SELECT vec_id, list_position(embedding, list_max(embedding)) AS p FROM embeddings)")
def _(t):
    p = F.array_position("embedding", F.array_max("embedding"))
    e = t.embeddings.select("vec_id", p.cast("int").alias("peak"))
    return e.withColumn("phase", F.when((F.col("peak") * 5).between(120, 260), "winter_peaking").otherwise("summer_peaking"))


@query("F10", "SELECT l_orderkey, l_linenumber, l_partkey, ((dayofyear(l_shipdate) - 100) % 365 + 365) % 365 AS lag FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.pmod(F.dayofyear("l_shipdate") - 100, F.lit(365)).cast("long").alias("lag"))


@query("F11", "SELECT o_orderkey, round(log10(o_totalprice), 6) AS area FROM orders")
def _(t):
    return t.orders.select("o_orderkey", r6(F.log10("o_totalprice")).alias("area"))


@query("F12", "SELECT o_orderkey, (o_orderstatus = 'O')::INT::DOUBLE AS s_o, (o_orderstatus = 'P')::INT::DOUBLE AS s_p FROM orders")
def _(t):
    return t.orders.select("o_orderkey", *[(F.col("o_orderstatus") == x).cast("int").cast("double").alias(f"s_{x.lower()}") for x in "OP"])


@query("F19", "SELECT l_orderkey, string_agg(DISTINCT l_suppkey::VARCHAR, ',' ORDER BY l_suppkey::VARCHAR) AS csv FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set(F.col("l_suppkey").cast("string"))), ",").alias("csv"))


@query("F18", "SELECT y::INT AS year FROM range(2000, 2027) r(y)")
def _(t):
    from quadrat.functions.calendar import year_list

    return t.spark.createDataFrame([("2000-2026",)], "spec string").select(F.explode(year_list(F.col("spec"))).alias("year"))


@query("F20", "SELECT vec_id, round(list_sum((embedding || embedding)[1:80]::DOUBLE[]), 5) AS s FROM embeddings")
def _(t):
    from quadrat.functions.arrays import total, wrap

    return t.embeddings.select("vec_id", F.round(total(wrap(F.col("embedding"), 80)), 5).alias("s"))


@query("F22", "SELECT vec_id, round((embedding[11:] || embedding[:10])[1]::DOUBLE, 6) AS first, round((embedding[11:] || embedding[:10])[60]::DOUBLE, 6) AS late FROM embeddings")
def _(t):
    from quadrat.functions.arrays import rotate

    r = rotate(F.col("embedding"), 10)
    return t.embeddings.select("vec_id", r6(r[0].cast("double")).alias("first"), r6(r[59].cast("double")).alias("late"))
