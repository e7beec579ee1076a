"""Queries of feature blocks, families of tests, curves of rarefaction and tile work."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quadrat.operators import diversity as D
from quadrat.operators import series as S
from quadrat.operators import validation as V
from quadrat.plans.catalog import query
from quadrat.plans.diversity import BRANCHES, TIPS, closure, tips
from quadrat.plans.relational import COMM, comm, r6
from quadrat.plans.validation import OOF, oof


@query("T07", "SELECT vec_id, d::INT AS day, round(a + (b - a) * f, 6) AS v FROM (SELECT vec_id, d, embedding[i + 1]::DOUBLE AS a, embedding[(i + 1) % 64 + 1]::DOUBLE AS b, CASE WHEN i + 1 < 64 THEN x - i ELSE (x - 63) / (365 / 5.75 - 63) END AS f FROM (SELECT *, least(floor(x)::BIGINT, 63) AS i FROM (SELECT vec_id, embedding, d, ((108 + d) % 365) / 5.75 AS x FROM embeddings, (VALUES (0), (7), (140), (259)) v(d))))")
def _(t):
    curve = F.transform("embedding", lambda x: x.cast("double"))
    e = t.embeddings.select("vec_id", curve.alias("c"), F.explode(F.array(*[F.lit(d) for d in (0, 7, 140, 259)])).alias("day"))
    return e.select("vec_id", "day", r6(S.at_day(F.col("c"), F.col("day") + 108, 5.75)).alias("v"))


def _subset_partition(t, k: int):
    return D.partition(comm(t).where(f"plot <= {k}")).withColumn("size", F.lit(k))
