"""Years, bins and days of a circular year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def right_closed(x: Column, edges: list[float], prefix: str) -> Column:
    """The bin (lo, hi] that holds x, as prefix and number; null outside."""
    out = None
    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        cond = (x > lo) & (x <= hi)
        out = F.when(cond, f"{prefix}{k}") if out is None else out.when(cond, f"{prefix}{k}")
    return out


def circular_sd(day: Column, period: float = 365.0) -> Column:
    """An aggregate: the circular standard deviation of days; null below two of them."""
    a = 2 * F.pi() * day / period
    r = F.sqrt(F.pow(F.avg(F.sin(a)), F.lit(2)) + F.pow(F.avg(F.cos(a)), F.lit(2)))
    return F.when(F.count(day) >= 2, period / (2 * F.pi()) * F.sqrt(-2 * F.log(F.least(r, F.lit(1.0)))))


def year_list(spec: Column) -> Column:
    """'2000-2003' or '1999,2001' as an array of years."""
    parts = F.split(spec, r"\s*,\s*")
    one = lambda p: F.sequence(F.split(p, "-")[0].cast("int"), F.element_at(F.split(p, "-"), -1).cast("int"))
    return F.flatten(F.transform(parts, one))


def circular(day: Column, period: float = 365.0) -> tuple[Column, Column]:
    """A day of the year as sine and cosine."""
    a = 2 * F.pi() * day / period
    return F.sin(a), F.cos(a)
