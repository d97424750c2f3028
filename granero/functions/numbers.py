"""Arithmetic whose edge cases matter to the business rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VAT = 1.19  # fixed value: gross to net


def net_of_vat(gross: Column) -> Column:
    return F.round(gross / F.lit(VAT), 0).cast("long")


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Clamp; NULL stays NULL (``greatest`` and ``least`` would skip it)."""
    bounded = value
    if high is not None:
        bounded = F.least(F.lit(high), bounded)
    if low is not None:
        bounded = F.greatest(F.lit(low), bounded)
    return F.when(value.isNotNull(), bounded)


def truncate(value: Column) -> Column:
    return F.signum(value) * F.floor(F.abs(value))


def ratio(part: Column, whole: Column) -> Column:
    """Double quotient, NULL on a zero divisor."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def is_true(flag: Column) -> Column:
    return flag.eqNullSafe(F.lit(True))


def count_when(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))
