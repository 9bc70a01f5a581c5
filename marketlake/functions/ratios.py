"""Null-safe ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator``; NULL when either is NULL or the denominator is zero."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def ratio_pct(numerator: Column | str, denominator: Column | str) -> Column:
    """The ratio as a percentage."""
    return ratio(numerator, denominator) * 100


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
