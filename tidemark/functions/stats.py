"""Normal distribution: quantiles are plain numbers, tail probabilities are column arithmetic."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz & Stegun 26.2.17, absolute error below 7.5e-8.
_P = 0.2316419
_B = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def two_sided_p(z: Column) -> Column:
    """Two-sided tail probability of a standard normal z."""
    a = F.abs(z)
    t = 1.0 / (1.0 + _P * a)
    poly = F.lit(0.0)
    for b in reversed(_B):
        poly = (poly + F.lit(b)) * t
    density = F.exp(-a * a / 2.0) / F.sqrt(F.lit(2.0) * F.pi())
    return 2.0 * density * poly
