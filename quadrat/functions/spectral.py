"""Spectral indices of reflectances; null on a zero denominator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def _clip(c: Column, most: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(-most), F.least(F.lit(most), c)))


def ndvi(nir: Column, red: Column) -> Column:
    return _clip(_ratio(nir - red, nir + red), 1.0)


def evi(nir: Column, red: Column, blue: Column) -> Column:
    return _clip(_ratio(2.5 * (nir - red), nir + 6 * red - 7.5 * blue + 1), 1.0)


def kndvi(nir: Column, red: Column) -> Column:
    v = ndvi(nir, red)
    return F.tanh(v * v)


def nbr(nir: Column, swir: Column) -> Column:
    return _clip(_ratio(nir - swir, nir + swir), 1.0)


def savi(nir: Column, red: Column, soil: float = 0.5) -> Column:
    return _clip(_ratio((1 + soil) * (nir - red), nir + red + soil), 1.5)
