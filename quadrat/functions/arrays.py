"""Curves as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(a: Column) -> Column:
    return F.aggregate(F.transform(a, lambda x: x.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def wrap(a: Column, n: int) -> Column:
    """The circular array repeated up to n elements."""
    times = F.ceil(F.lit(n) / F.size(a)).cast("int")
    return F.slice(F.flatten(F.array_repeat(a, times)), 1, n)


def rotate(a: Column, by: int) -> Column:
    """The circular array so that element by+1 comes first."""
    k = F.pmod(F.lit(by), F.size(a))
    return F.concat(F.slice(a, k + 1, F.size(a) - k), F.slice(a, F.lit(1), k))
