"""Queries of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from quadrat.operators import models as M
from quadrat.plans.catalog import query
from quadrat.scratch import materialize


@query("M01")
def _(t):
    e = t.embeddings.select("vec_id", (F.col("vec_id") % 3).cast("int").alias("fold"), F.col("label").cast("double").alias("y"), *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(64)])
    return M.forest_out_of_fold(e, [f"x{i}" for i in range(64)], "y", "fold", "vec_id", trees=20)


@query("M24")
def _(t):
    e = t.embeddings.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(64)])
    return M.principal_components(e, "vec_id", [f"x{i}" for i in range(64)], 2)


@query("M19")
def _(t):
    whole = t.lineitem.groupBy(F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species")).agg(F.sum("l_quantity").alias("value"))
    bal = t.supplier.select(F.col("s_suppkey").alias("plot"), (F.col("s_acctbal") / 10000).alias("x"))
    d = materialize(M.bray_by_difference(whole, bal, 6), "differences")
    b = M.fit_dissimilarity(d, ["dx"], "d", weight="n")
    return t.spark.createDataFrame([(n, x) for n, x in zip(("intercept", "dx"), b, strict=True)], "term string, beta double")
