"""Projections, filters, joins and aggregates that plot tables need."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrat.scratch import materialize


def filter_cascade(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """(step, n): rows that are left after each condition and all before it, in one pass over df."""
    conds, so_far = [], F.lit(True)
    for _, c in steps:
        so_far = so_far & F.coalesce(c, F.lit(False))
        conds.append(so_far)
    one = df.agg(*[F.count(F.when(c, 1)).alias(f"n{i}") for i, c in enumerate(conds)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("step"), F.col(f"n{i}").alias("n")) for i, (name, _) in enumerate(steps)])).alias("s")).select("s.*")


def mapped(code: Column, values: dict[str, str], default: str) -> Column:
    """The value of a code, or default."""
    return F.coalesce(reduce(lambda acc, kv: acc.when(code == kv[0], kv[1]), list(values.items())[1:], F.when(code == next(iter(values)), next(iter(values.values())))), F.lit(default))


def rounded_cell(x: Column, y: Column, size: float) -> Column:
    """Key of the nearest grid node; halves go to the even node."""
    return F.concat_ws("_", F.bround(x / size).cast("long"), F.bround(y / size).cast("long"))


def floored_cell(x: Column, y: Column, size: float) -> Column:
    return F.concat_ws("_", F.floor(x / size), F.floor(y / size))


def repeated(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """df and whether a row's values in cols occur more than once; counted by an aggregate that Spark combines before shuffling."""
    many = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    cond = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in cols])
    return df.alias("l").join(many.alias("r"), cond).select("l.*", (F.col("_n") > 1).alias(name))


def override(df: DataFrame, better: DataFrame, keys: list[str], value: str) -> DataFrame:
    """df with the values of better where it has one."""
    b = better.select(*keys, F.col(value).alias("_better"))
    return df.join(b, keys, "left").withColumn(value, F.coalesce("_better", value)).drop("_better")


def unmatched(df: DataFrame, other: DataFrame, keys: list[str]) -> int:
    """How many rows of df have no partner; a check that costs one anti-join."""
    return df.join(other, keys, "left_anti").count()


def align(tables: list[DataFrame], key: str) -> DataFrame:
    """Full outer alignment on a key; what a table lacks is null."""
    return reduce(lambda a, b: a.join(b, key, "full_outer"), tables)


def pad(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """One row for every id, null where df has none."""
    return ids.select(key).join(df, key, "left")


def nearest_year(left: DataFrame, years: DataFrame, year: str, other: str) -> DataFrame:
    """left with the nearest of a few years (a tie goes to the earlier) and the signed difference.

    years is a dimension of at most some hundred rows: it is gathered into one array, so each row looks
    it up without a join.
    """
    arr = years.agg(F.array_sort(F.collect_set(other)).alias("_years"))
    best = F.array_min(F.transform("_years", lambda y: F.struct(F.abs(y - F.col(year)).alias("d"), y.alias("y"))))
    return left.crossJoin(F.broadcast(arr)).withColumn("_b", best).withColumn(other, F.col("_b.y")).withColumn("delta", F.col(other) - F.col(year)).drop("_b", "_years")


def trimmed_mean(values: Column, share: float = 0.2, least: int = 3) -> Column:
    """Mean of an array without a share of its sorted values at either end; null below `least` values."""
    v = F.array_sort(F.filter(values, lambda x: x.isNotNull()))
    n = F.size(v)
    k = F.floor(n * F.lit(share)).cast("int")
    kept = F.slice(v, k + 1, F.greatest(n - 2 * k, F.lit(0)))
    return F.when(n >= least, F.aggregate(kept, F.lit(0.0), lambda a, x: a + x) / F.size(kept))


def order_free(value: str) -> list[Column]:
    """Twelve statistics of a column that do not depend on the order of rows."""
    p = lambda q: F.expr(f"percentile({value}, {q})")
    mean, sd = F.avg(value), F.stddev_samp(value)
    return [mean.alias("mean"), sd.alias("sd"), *[p(q / 100).alias(f"p{q}") for q in (10, 25, 50, 75, 90)], F.min(value).alias("min"), F.max(value).alias("max"),
            (F.max(value) - F.min(value)).alias("range"), (p(0.75) - p(0.25)).alias("iqr"), (sd / F.when(F.abs(mean) > 0, mean)).alias("cv")]


def best_of(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in an order that must not leave ties open."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")


def aligned(tables: list[DataFrame], ids: DataFrame, key: str) -> DataFrame:
    """align() for exactly the ids given; an id that no table has is an error, which costs one anti-join to see."""
    every = align(tables, key)
    missing = ids.select(key).join(every.select(key), key, "left_anti").limit(5).collect()
    if missing:
        raise KeyError(f"no table has {[r[key] for r in missing]}")
    return ids.select(key).distinct().join(every, key)


def resolve_targets(name: str | list[str], sets: dict[str, list[str]], forbidden: set[str], there: list[str]) -> list[str]:
    """The columns of a named set, or of a list; names that are forbidden or not there are refused."""
    names = sets[name] if isinstance(name, str) else list(name)
    if bad := sorted(set(names) & forbidden):
        raise ValueError(f"{bad} must not be targets")
    if bad := [n for n in names if n not in there]:
        raise ValueError(f"{bad} are not there")
    return names


def context_columns(df: DataFrame, terrain: list[str], undefined: str, area: float, stratum: str, strata_names: list[str], columns: list[str], keep: list[str]) -> DataFrame:
    """df's terrain as topo_*, topo_flat where `undefined` is null, and constant area and stratum, in the order of columns; one that is not built here is an error."""
    import math

    if stratum not in strata_names:
        raise ValueError(f"no stratum {stratum!r}")
    made = {f"topo_{v}": F.col(v) for v in terrain} | {"topo_flat": F.col(undefined).isNull().cast("int").cast("double"), "area_log10": F.lit(math.log10(area))}
    made |= {f"area_stratum_{s}": F.lit(float(s == stratum)) for s in strata_names[1:]}
    if missing := [c for c in columns if c not in made]:
        raise ValueError(f"{missing} are not built here")
    return df.select(*keep, *[made[c].alias(c) for c in columns])


def strata(column: Column, names: list[str], prefix: str) -> list[Column]:
    """Indicators of a column's values but the first, which is the reference."""
    return [(column == n).cast("int").cast("double").alias(f"{prefix}{n}") for n in names[1:]]


def column_family(df: DataFrame, keys: list[str], prefixes: tuple[str, ...], suffix: str, rename: str) -> DataFrame:
    """The columns that begin with a prefix and end with _suffix, without the suffix and with another prefix before; none is an error."""
    end = f"_{suffix}"
    cols = [c for c in df.columns if c.endswith(end) and c.startswith(prefixes)]
    if not cols:
        raise ValueError(f"no columns {prefixes} at {suffix!r}")
    return df.select(*keys, *[F.col(c).alias(rename + c[: -len(end)]) for c in cols])


def curve_statistics(df: DataFrame, keys: list[str], curve: str) -> DataFrame:
    """(keys, mean, sd, p10, p25, p50, p75, p90, min, max, range, iqr, cv) of the values of each curve, nulls left out."""
    v = df.select(*keys, F.explode(curve).alias("v"))
    q = F.expr("percentile(v, array(0.1, 0.25, 0.5, 0.75, 0.9))")
    s = v.groupBy(*keys).agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"), q.alias("_q"), F.min("v").alias("min"), F.max("v").alias("max"))
    s = s.select(*keys, "mean", "sd", *[F.col("_q")[i].alias(n) for i, n in enumerate(("p10", "p25", "p50", "p75", "p90"))], "min", "max")
    return s.withColumns({"range": F.col("max") - F.col("min"), "iqr": F.col("p75") - F.col("p25"), "cv": F.when(F.abs("mean") > 1e-9, F.col("sd") / F.abs("mean"))})


def index_contrasts(statistics: DataFrame, key: str, index: str) -> DataFrame:
    """(key, a, b, diff, ratio, cvdiff) of the means and variations of each pair of indices a < b of a key."""
    side = lambda n: statistics.select(key, F.col(index).alias(n), F.col("mean").alias(f"m{n}"), F.col("cv").alias(f"c{n}"))
    j = side("a").join(side("b"), key).where("a < b")
    return j.select(key, "a", "b", (F.col("ma") - F.col("mb")).alias("diff"), (F.col("ma") / F.when(F.abs("mb") > 1e-6, F.col("mb"))).alias("ratio"), (F.col("ca") - F.col("cb")).alias("cvdiff"))


def nearest_of(x: Column, axis: list[float]) -> Column:
    """The value of an axis that is nearest to x, the first of two."""
    values = F.array(*[F.lit(float(v)) for v in axis])
    return F.array_min(F.transform(values, lambda v, i: F.struct(F.abs(x - v).alias("d"), i.alias("i"), v.alias("v"))))["v"]


def pair_join(left: DataFrame, right: DataFrame, on: Column, tile: int = 5_000_000, most: int = 500_000) -> DataFrame:
    """All rows of left and right for which `on` holds, where no column is equal in both: dealt to tasks of about `tile` pairs.

    Files alone would give as many tasks as the tables have, often one.  A right side of up to `most`
    rows is broadcast; a larger one is dealt as well, and every part of left meets every part of it.
    """
    n, m = left.count(), right.count()
    parts = max(1, min(10_000, -(-n * m // tile), n))
    if m <= most:
        return left.repartition(parts).join(F.broadcast(right), on)
    side = max(1, math.isqrt(parts))
    return left.repartition(side).join(right.repartition(side), on)


def least_digests(rows: DataFrame, digest: Column, ties: list[str], n: int, total: int) -> DataFrame:
    """The n rows of the least md5 digest in hexadecimal, ties by the columns, of about `total` rows.

    Digests are even, so a bound that some times n rows are expected under spares the sort all others; where
    fewer than n are under it, all rows are sorted.
    """
    own = rows.withColumn("_d", digest)
    bound = f"{min(2**32 - 1, int(2**32 * 20 * n / max(1, total))):08x}" + "g"  # behind all digests that begin like this
    under = materialize(own.where(F.col("_d") < bound), "digests") if total > 40 * n else own
    if total > 40 * n and under.count() < n:
        under = own
    return under.orderBy("_d", *ties).limit(n).drop("_d")
