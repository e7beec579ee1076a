"""Cubes and rasters in long form: fitted curves, predictors of pixels, windows, classes and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrat.operators import diversity as D
from quadrat.operators import relational as R
from quadrat.operators import series as S


def refit(obs: DataFrame, steps: int, width: int) -> DataFrame:
    """(plot, step, centre, mean, pixels, n_obs) from observations (plot, pixel, t, v): each pixel gridded over its plot's window and smoothed; the centre is the plot's least pixel."""
    ends = obs.groupBy("plot").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.min("pixel").alias("_centre"), F.count("*").alias("n_obs"))
    spans = obs.select("plot", "pixel").distinct().join(ends, "plot")
    m = S.moving_mean(S.gridded(obs, "pixel", "t", "v", steps, spans=spans.select("pixel", "lo", "hi")), ["pixel"], "step", "g", width, "c")
    both = m.join(spans.select("plot", "pixel", "_centre", "n_obs"), "pixel")
    return both.groupBy("plot", "step", "n_obs").agg(F.max(F.when(F.col("pixel") == F.col("_centre"), F.col("c"))).alias("centre"), F.avg("c").alias("mean"), F.count("c").alias("pixels"))


def extracted(obs: DataFrame, steps: int, width: int, least: int) -> DataFrame:
    """(plot, idx, n_obs, max_gap, curve, vpos, ampl) of each plot's indices with `least` observations (plot, idx, t, value) or more."""
    keys = ["plot", "idx"]
    gap = F.col("t") - F.lag("t").over(Window.partitionBy(*keys).orderBy("t"))
    quality = obs.withColumn("_g", gap).groupBy(*keys).agg(F.count("*").alias("n_obs"), F.max("_g").alias("max_gap")).where(F.col("n_obs") >= least)
    own = obs.select(F.struct(*keys).alias("k"), "t", "value")
    m = S.moving_mean(S.gridded(own, "k", "t", "value", steps), ["k"], "step", "g", width, "c")
    curve = F.transform(F.sort_array(F.collect_list(F.struct("step", "c"))), lambda x: x["c"])
    fits = m.groupBy("k").agg(curve.alias("curve"), F.max("c").alias("vpos"), (F.max("c") - F.min("c")).alias("ampl")).select("k.*", "curve", "vpos", "ampl")
    return quality.join(fits, keys)


def pixel_predictors(obs: DataFrame, key: str, bands: str, index: str, month: str, least: int = 10) -> DataFrame:
    """One row for each key: the geometric median of its bands and the median distances to it (null below `least` observations), statistics of an index, and its medians by season with their contrast."""
    n = obs.groupBy(key).agg(F.count("*").alias("gm_count"))
    enough = obs.join(n.where(F.col("gm_count") >= least).select(key), key, "left_semi")
    gm = D.geometric_medians(enough, key, bands).select(key, F.aggregate("gm", F.lit(0.0), lambda a, v: a + v).alias("gm_sum"), F.col("euclid").alias("gm_emad"), F.col("cosine").alias("gm_smad"), F.col("bray").alias("gm_bcmad"))
    stats = R.curve_statistics(obs.select(key, F.array(index).alias("c")), [key], "c")
    stats = stats.select(key, *[F.col(c).alias(f"obs_{c}") for c in stats.columns if c != key])
    seasons = {"djf": (12, 1, 2), "mam": (3, 4, 5), "jja": (6, 7, 8), "son": (9, 10, 11)}
    seas = obs.groupBy(key).agg(*[F.percentile(F.when(F.col(month).isin(*m), F.col(index)), 0.5).alias(f"seas_{s}") for s, m in seasons.items()])
    seas = seas.withColumn("seas_contrast", F.col("seas_djf") - F.col("seas_jja"))
    return n.join(gm, key, "left").join(stats, key).join(seas, key)


def window_of(cells: DataFrame, rows: tuple[int, int], cols: tuple[int, int]) -> DataFrame:
    """The cells (row, col, ..) between bounds, both included."""
    return cells.where(F.col("row").between(*rows) & F.col("col").between(*cols))


def class_at(pixels: DataFrame, maps: DataFrame, year: int, size: float, native: list[str]) -> DataFrame:
    """pixels (x, y, ..) with year, class and native from the map (cx, cy, year, class) of the nearest year (the earlier of two): the class of the cell that a pixel's centre is in."""
    best = maps.agg(F.min(F.struct(F.abs(F.col("year") - year).alias("d"), F.col("year").alias("y")))["y"].alias("_y"))
    one = maps.join(F.broadcast(best), F.col("year") == F.col("_y")).drop("_y")
    own = pixels.withColumns({"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)})
    return own.join(one, ["cx", "cy"], "left").withColumn("native", F.coalesce(F.col("class").isin(*native), F.lit(False)))


def audited(rows: DataFrame, key: str, valid: Column, band: str, checks: dict[str, Column], least_valid: float) -> DataFrame:
    """(key, n, valid, constant, checks, passed) of each tile in one pass: the share of valid rows, whether a band never changes, further aggregates, and whether all is well."""
    out = rows.groupBy(key).agg(F.count("*").alias("n"), F.avg(valid.cast("int")).alias("valid"), (F.min(band) == F.max(band)).alias("constant"), *[c.alias(k) for k, c in checks.items()])
    fine = reduce(lambda a, b: a & b, [F.col(k) for k in checks], (F.col("n") > 0) & (F.col("valid") >= least_valid) & ~F.col("constant"))
    return out.withColumn("passed", fine)
