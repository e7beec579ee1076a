"""Special functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def lgamma(x: Column) -> Column:
    """Logarithm of the gamma function for x > 0: Stirling's series after a shift by eight."""
    y = x + 8
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def digamma(x: Column) -> Column:
    """Derivative of lgamma for x > 0: its series after a shift by eight."""
    y = x + 8
    z = 1 / (y * y)
    out = F.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132))))
    for k in range(8):
        out = out - 1 / (x + k)
    return out


def lchoose(n: Column, k: Column) -> Column:
    """Logarithm of n over k, for 0 <= k <= n."""
    return lgamma(n + 1.0) - lgamma(k + 1.0) - lgamma(n - k + 1.0)


#: Coefficients of the rational approximation 26.2.17 of Abramowitz and Stegun.
NORMAL = (0.2316419, 0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal_cdf(x: Column) -> Column:
    """The standard normal distribution function, to 7.5e-8."""
    r, *b = NORMAL
    t = 1 / (1 + r * F.abs(x))
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * t * (b[0] + t * (b[1] + t * (b[2] + t * (b[3] + t * b[4]))))
    return F.when(x >= 0, 1 - tail).otherwise(tail)


def uniform(seed: int, *key: Column) -> Column:
    """A number in (0, 1) that follows from a seed and a key: the first 32 bits of a digest."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def normal(seed: int, *key: Column) -> Column:
    """A standard normal number that follows from a seed and a key, by Box and Muller's transform."""
    return F.sqrt(-2 * F.log(uniform(seed, *key, F.lit("r")))) * F.cos(2 * math.pi * uniform(seed, *key, F.lit("a")))


def draw_order(seed: int, *key: Column) -> Column:
    """What to sort by for a random order that follows from a seed."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key]))
