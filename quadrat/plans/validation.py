"""Queries of folds, scores and retransformation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quadrat.operators import validation as V
from quadrat.plans.catalog import query
from quadrat.plans.relational import r6

OOF = "o AS (SELECT l_suppkey % 5 AS fold, l_linenumber % 3 AS seed, l_extendedprice AS obs, l_quantity * p_retailprice AS pred FROM lineitem JOIN part ON p_partkey = l_partkey)"


def oof(t):
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select((F.col("l_suppkey") % 5).alias("fold"), (F.col("l_linenumber") % 3).alias("seed"), F.col("l_extendedprice").alias("obs"), (F.col("l_quantity") * F.col("p_retailprice")).alias("pred"))


@query("V01", "SELECT g.fold, g.s::VARCHAR AS held_out, c_custkey, CASE WHEN c_mktsegment = g.s THEN 'test' ELSE 'train' END AS split FROM customer, (SELECT c_mktsegment AS s, row_number() OVER (ORDER BY c_mktsegment) - 1 AS fold FROM customer GROUP BY 1 HAVING count(*) >= 20) g")
def _(t):
    return V.leave_one_group_out(t.customer, "c_custkey", "c_mktsegment", 20).withColumn("fold", F.col("fold").cast("long"))


def packed_sql(where: str = "TRUE") -> str:
    """r (key, fold): nations packed into five folds, the largest first."""
    return f"""g AS (SELECT c_nationkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, c_nationkey::VARCHAR) AS k FROM customer WHERE {where} GROUP BY 1),
r AS (SELECT 0::BIGINT AS k, [0, 0, 0, 0, 0]::BIGINT[] AS loads, NULL::INT AS key, NULL::INT AS fold UNION ALL SELECT g.k, list_transform(range(1, 6), lambda i: loads[i] + CASE WHEN i = pos THEN n ELSE 0 END), g.c_nationkey, (pos - 1)::INT FROM r JOIN g ON g.k = r.k + 1, LATERAL (SELECT list_position(loads, list_min(loads)) AS pos) p)"""


@query("V02", f"WITH RECURSIVE {packed_sql()} SELECT c_custkey, fold FROM customer JOIN r ON key = c_nationkey")
def _(t):
    return V.grouped_kfold(t.customer, "c_custkey", "c_nationkey", 5)


RANDOM = "(('0x' || substr(md5('42|' || c_custkey), 1, 8))::BIGINT % 5)::INT"


@query("V03", f"SELECT c_custkey, {RANDOM} AS fold FROM customer")
def _(t):
    return V.random_kfold(t.customer, "c_custkey", 5, 42)


_TIME = """WITH b AS (SELECT * FROM (VALUES (0, 1994, 1996), (1, 1996, 1998), (2, 1998, 2001)) v(fold, lo, hi)), y AS (SELECT o_orderkey, year(o_orderdate) AS y FROM orders),
s AS (SELECT fold, min(y) - 2 AS w0, max(y) AS w1 FROM y JOIN b ON y > lo AND y <= hi GROUP BY 1)
SELECT fold, o_orderkey, CASE WHEN y > lo AND y <= hi THEN 'test' ELSE 'train' END AS split FROM y, b JOIN s USING (fold) WHERE (y > lo AND y <= hi) OR NOT (y >= w0 AND y - 2 <= w1)"""


@query("V04", _TIME)
def _(t):
    return V.time_folds(t.orders.select("o_orderkey", F.year("o_orderdate").alias("y")), "o_orderkey", "y", [1994, 1996, 1998, 2001])


@query("V05", f"SELECT place::INT AS place, fold, split, count(*) AS n FROM (SELECT p.place, x.fold, CASE WHEN x.split = 'test' AND o_custkey % 3 = p.place THEN 'test' WHEN x.split = 'train' AND o_custkey % 3 <> p.place THEN 'train' END AS split FROM ({_TIME}) x JOIN orders USING (o_orderkey), range(3) p(place)) WHERE split IS NOT NULL GROUP BY ALL")
def _(t):
    o = t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"), (F.col("o_custkey") % 3).alias("own"))
    x = V.time_folds(o, "o_orderkey", "y", [1994, 1996, 1998, 2001]).join(o.select("o_orderkey", "own"), "o_orderkey").withColumn("place", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    same = F.col("own") == F.col("place")
    s = F.when((F.col("split") == "test") & same, "test").when((F.col("split") == "train") & ~same, "train")
    return x.withColumn("split", s).where("split IS NOT NULL").groupBy("place", "fold", "split").agg(F.count("*").alias("n"))


@query("V06", "SELECT o_custkey FROM orders GROUP BY 1 HAVING bool_or(year(o_orderdate) <= 1996) AND bool_or(year(o_orderdate) > 1996)")
def _(t):
    y = F.year("o_orderdate")
    return t.orders.groupBy("o_custkey").agg(F.bool_or(y <= 1996).alias("i"), F.bool_or(y > 1996).alias("o")).where("i AND o").select("o_custkey")


@query("V10", "SELECT count(*) AS keys, count(*) FILTER (n > 1) AS twice FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)")
def _(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).agg(F.count("*").alias("keys"), F.count(F.when(F.col("n") > 1, 1)).alias("twice"))


@query("V11", """WITH a AS (SELECT event_id, user_id % 5 AS fold, CASE WHEN event_id % 7 <> 0 THEN value END AS v FROM events), m AS (SELECT median(v) AS m FROM a WHERE fold <> 0),
f AS (SELECT event_id, fold, coalesce(v, m) AS v, (v IS NULL)::INT::DOUBLE AS na FROM a, m), s AS (SELECT avg(v) AS a, stddev_pop(v) AS s FROM f WHERE fold <> 0) SELECT event_id, round((v - a) / s, 6) AS v, na AS v_isna FROM f, s""")
def _(t):
    e = t.events.select("event_id", (F.col("user_id") % 5).alias("fold"), F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"))
    return V.imputed(e, F.col("fold") != 0, ["v"]).select("event_id", r6("v").alias("v"), "v_isna")


@query("V13", f"WITH {OOF} SELECT round(avg(r2), 6) AS r2 FROM (SELECT seed, 1 - avg(pow(pred - obs, 2)) / var_pop(obs) AS r2 FROM o WHERE fold IN (0, 2) GROUP BY 1)")
def _(t):
    return V.scores(oof(t).where("fold IN (0, 2)"), ["seed"]).agg(r6(F.avg("r2")).alias("r2"))


@query("M07", f"WITH {OOF} SELECT round(avg(CASE WHEN e <= 1 THEN e * e / 2 ELSE e - 0.5 END), 4) AS loss FROM (SELECT abs(pred / 1000 - obs / 1000) AS e, obs FROM o WHERE obs > 2000)")
def _(t):
    obs = F.when(F.col("obs") > 2000, F.col("obs") / 1000)
    return oof(t).agg(F.round(V.masked_huber(F.col("pred") / 1000, obs), 4).alias("loss"))


@query("M08", "SELECT p_partkey, round(p_retailprice / 500 - 3, 6) + 0.0 AS back FROM part")
def _(t):
    """The fitted transformation and its inverse, which gives back what there was."""
    x = t.part.select("p_partkey", (F.col("p_retailprice") / 500 - 3).alias("x"))
    lam = V.fit_lambda(x, "x")
    return x.select("p_partkey", (r6(V.yeo_johnson_inverse(V.yeo_johnson(F.col("x"), lam), lam)) + 0.0).alias("back"))


@query("M09", "SELECT s_suppkey, round(greatest(0, least(60, list_avg(list_transform([-0.5, -0.1, 0.0, 0.2, 0.4], lambda r: greatest(0, least(60, CASE WHEN z + r >= 0 THEN pow((z + r) * 0.5 + 1, 2) - 1 ELSE 1 - pow(1 - 1.5 * (z + r), 1 / 1.5) END)))))), 5) AS y FROM (SELECT s_suppkey, s_acctbal / 1000 AS z FROM supplier)")
def _(t):
    return t.supplier.select("s_suppkey", F.round(V.smeared(F.col("s_acctbal") / 1000, [-0.5, -0.1, 0.0, 0.2, 0.4], 0.5, 0.0, 60.0), 5).alias("y"))


@query("M10", f"WITH {OOF} SELECT fold, count(*) AS n, round(1 - avg(pow(pred - obs, 2)) / var_pop(obs), 6) AS r2, round(sqrt(avg(pow(pred - obs, 2))), 3) AS rmse, round(sqrt(avg(pow(pred - obs, 2))) / (quantile_cont(obs, 0.99) - quantile_cont(obs, 0.01)), 6) AS nrmse, round(avg(abs(pred - obs)), 3) AS mae, round(avg(pred - obs), 3) AS bias, round(corr(obs, pred), 6) AS pearson FROM o GROUP BY fold")
def _(t):
    s = V.scores(oof(t), ["fold"])
    return s.select("fold", "n", r6("r2").alias("r2"), F.round("rmse", 3).alias("rmse"), r6("nrmse").alias("nrmse"), F.round("mae", 3).alias("mae"), F.round("bias", 3).alias("bias"), r6("pearson").alias("pearson"))


@query("M11", "SELECT event_type, round(corr(ra, rb), 6) AS rho FROM (SELECT event_type, rank() OVER (PARTITION BY event_type ORDER BY a) + (count(*) OVER (PARTITION BY event_type, a) - 1) / 2 AS ra, rank() OVER (PARTITION BY event_type ORDER BY b) + (count(*) OVER (PARTITION BY event_type, b) - 1) / 2 AS rb FROM (SELECT event_type, floor(value) AS a, user_id AS b FROM events)) GROUP BY 1")
def _(t):
    e = t.events.select("event_type", F.floor("value").alias("a"), F.col("user_id").alias("b"))
    return V.spearman(e, ["event_type"], "a", "b").select("event_type", r6("rho").alias("rho"))


@query("M12", "WITH s AS (SELECT l_returnflag AS model, l_suppkey AS k, avg(l_tax) AS v FROM lineitem GROUP BY ALL) SELECT a.model AS a, b.model AS b, count(*) AS n, round(avg(a.v - b.v) / (stddev_samp(a.v - b.v) / sqrt(count(*))), 5) AS t FROM s a JOIN s b ON a.k = b.k AND a.model < b.model GROUP BY ALL")
def _(t):
    s = t.lineitem.groupBy(F.col("l_returnflag").alias("model"), F.col("l_suppkey").alias("k")).agg(F.avg("l_tax").alias("v"))
    j = s.select("k", F.col("model").alias("a"), F.col("v").alias("x")).join(s.select("k", F.col("model").alias("b"), F.col("v").alias("y")), "k").where("a < b")
    d = F.col("x") - F.col("y")
    return j.groupBy("a", "b").agg(F.count("*").alias("n"), F.round(F.avg(d) / (F.stddev_samp(d) / F.sqrt(F.count("*"))), 5).alias("t"))


@query("B11", "SELECT s_suppkey AS tile, y::INT AS year FROM supplier, range(1995, 2002) r(y) EXCEPT SELECT DISTINCT l_suppkey, year(l_shipdate)::INT FROM lineitem WHERE l_quantity >= 48")
def _(t):
    want = t.supplier.select(F.col("s_suppkey").alias("tile"), F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("year"))
    return want.join(t.lineitem.where("l_quantity >= 48").select(F.col("l_suppkey").alias("tile"), F.year("l_shipdate").alias("year")), ["tile", "year"], "left_anti")


@query("V09", "SELECT c_custkey, floor(c_acctbal / 1000)::BIGINT || '_' || floor(c_nationkey / 5)::BIGINT AS block FROM customer")
def _(t):
    return t.customer.select("c_custkey", F.concat_ws("_", F.floor(F.col("c_acctbal") / 1000), F.floor(F.col("c_nationkey") / 5)).alias("block"))


@query("M15", f"WITH {OOF} SELECT fold, round(avg(obs - pred), 3) AS mean, count(*) AS n FROM o WHERE seed = 0 GROUP BY 1")
def _(t):
    o = oof(t)
    w = o.agg(F.min("seed").alias("s"))
    return o.join(F.broadcast(w), F.col("seed") == F.col("s")).groupBy("fold").agg(F.round(F.avg(F.col("obs") - F.col("pred")), 3).alias("mean"), F.count("*").alias("n"))
