"""Value rules for counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def null_if_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def null_if_not_positive(c: Column) -> Column:
    return F.when(c > 0, c)


def sum_or_zero(c: Column) -> Column:
    """Total in which an all-missing group counts as zero."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def sum_if_enough(c: Column, min_count: int) -> Column:
    """Total only when at least ``min_count`` values were reported."""
    return F.when(F.count(c) >= min_count, F.sum(c))


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0: shifted Stirling series, about 1e-12 absolute error."""
    shift = 8
    z = x + F.lit(float(shift))
    series = (
        (z - 0.5) * F.ln(z)
        - z
        + F.lit(0.9189385332046727)  # ln(2 pi) / 2
        + F.lit(1 / 12) / z
        - F.lit(1 / 360) / F.pow(z, F.lit(3.0))
        + F.lit(1 / 1260) / F.pow(z, F.lit(5.0))
        - F.lit(1 / 1680) / F.pow(z, F.lit(7.0))
    )
    product = x
    for i in range(1, shift):
        product = product * (x + F.lit(float(i)))
    return series - F.ln(product)
