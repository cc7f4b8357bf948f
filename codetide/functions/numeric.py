"""Rounding and ratios with the conventions the reports need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_EPSILON = 1e-9


def half_even(value: Column, digits: int) -> Column:
    """Round a double half to even at ``digits`` decimals, as floating-point libraries do."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    return numerator / (denominator + F.lit(RATIO_EPSILON))


def share(part: Column, total: Column) -> Column:
    """``part / total``, and 0 for an empty total."""
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))
