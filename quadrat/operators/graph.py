"""Connected components of graphs that are tables of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrat.scratch import drop_scratch, materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star contraction; edges are (u, v), u > v.

    The least neighbour of each vertex comes from an aggregate that Spark combines before shuffling,
    and meets the edges again in an equi-join between plain exchanges, which adaptive execution can
    split where one vertex has most of the edges.
    """
    if large:
        around = edges.union(edges.select("v", "u"))
    else:
        around = edges
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(vertex, component) of every vertex that has an edge; edges has two columns of one comparable type.

    component is the least vertex that can be reached.  Loops (u, u), repeated edges, either direction
    and null ends (which are left out) are allowed.  Large-star and small-star steps alternate until the
    edges stay as they are, which takes a number of rounds that grows with the logarithm of the longest
    path; each round is written to the shared folder, so a lost executor does not go back to the start.
    """
    u, v = edges.columns
    a, b = F.col(f"`{u}`"), F.col(f"`{v}`")
    own = edges.where(a.isNotNull() & b.isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    loops = own.where("u = v").select("u").distinct()
    now = materialize(own.where("u != v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        after = materialize(_stars(_stars(now, True), False), "edges")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_scratch(now)
        now = after
        if seen == mark:
            break
        seen = mark
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    members = now.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    alone = loops.select(F.col("u").alias("vertex")).join(members.select("vertex").union(roots.select("vertex")), "vertex", "left_anti")
    return members.union(roots).union(alone.select("vertex", F.col("vertex").alias("component")))
