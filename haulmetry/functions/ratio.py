"""Ratios that never divide by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """Double ratio, NULL when the denominator is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    """Share in percent, optionally rounded."""
    value = ratio(part.cast("double") * F.lit(100.0), whole)
    return value if digits is None else F.round(value, digits)
