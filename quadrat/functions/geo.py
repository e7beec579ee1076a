"""Map projection and piecewise lines as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996


def to_utm(lon: Column, lat: Column, zone: int, south: bool) -> tuple[Column, Column]:
    """Easting and northing on WGS84 by Krueger's series to the third order (well below a centimetre inside a zone)."""
    n = _F / (2 - _F)
    radius = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    phi, lam = F.radians(lat), F.radians(lon - (6 * zone - 183))
    e = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(alpha, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000 + _K0 * radius * x, (10000000 if south else 0) + _K0 * radius * y


def piecewise(x: Column, knots: list[tuple[float, float]]) -> Column:
    """Linear between knots (x, y) in rising order of x, flat outside."""
    out = F.when(x <= knots[0][0], F.lit(float(knots[0][1])))
    for (x0, y0), (x1, y1) in zip(knots, knots[1:], strict=False):
        out = out.when(x <= x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0)))
    return out.otherwise(F.when(x.isNotNull(), float(knots[-1][1])))
