"""Pairs of plots are made where their lists lie; rounds, plots that share nothing, and few rows under a bound lose none."""

from pyspark.sql import functions as F

from quadrat.operators import diversity as D
from quadrat.operators import relational as R


def brute(rows, kind):
    own = {}
    for p, s, v in rows:
        own.setdefault(p, {})[s] = v
    out = {}
    for a in own:
        for b in own:
            if a < b:
                x, y = own[a], own[b]
                both = set(x) & set(y)
                w = len(both) if kind == "jaccard" else sum(min(x[s], y[s]) for s in both)
                t = len(x) + len(y) if kind == "jaccard" else sum(x.values()) + sum(y.values())
                out[a, b] = 1 - w / (t - w) if kind == "jaccard" else 1 - 2 * w / t
    return out


def test_dissimilarity_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(D, "MEETINGS", 50)
    rows = [(f"p{i}", k, float(1 + (i * k) % 5)) for i in range(30) for k in range(12) if (i * 7 + k * 5) % 4 == 0] + [("alone", 99, 2.0)]
    c = spark.createDataFrame(rows, "plot string, species long, value double")
    for kind in ("jaccard", "bray"):
        df = D.dissimilarity(c, kind)
        assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
        got = {(r["plot_a"], r["plot_b"]): r["d"] for r in df.collect()}
        want = brute(rows, kind)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_pair_join_deals_one_file_to_tasks(spark):
    s = spark.range(0, 300, 1, 1)
    x, y = s.select(F.col("id").alias("a")), s.select(F.col("id").alias("b"))
    for most in (500, 10):
        j = R.pair_join(x, y, F.col("a") < F.col("b"), 1000, most)
        assert j.rdd.getNumPartitions() > 1 and j.count() == 300 * 299 // 2


def test_least_digests(spark):
    rows = spark.range(2000).select("id", F.md5(F.col("id").cast("string")).alias("d"))
    want = [r["id"] for r in rows.orderBy("d", "id").limit(20).collect()]
    assert [r["id"] for r in R.least_digests(rows, F.col("d"), ["id"], 20, 2000).select("id", "d").orderBy("d").collect()] == want
    # a total that is far too large puts too few under the bound: all are sorted
    assert R.least_digests(rows, F.col("d"), ["id"], 20, 10**9).count() == 20


def test_centred_pairs_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = spark.range(40).selectExpr("id AS plot_a", "explode(sequence(id + 1, 40)) AS plot_b").where("plot_a < plot_b").withColumn("d2", F.lit(1.0))
        plan = D.gower_centred(d)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
