"""Calendar and clock helpers. Dates are always arguments, never the wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Santiago"


def as_date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def as_ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def to_local(ts: Column) -> Column:
    return F.from_utc_timestamp(ts, LOCAL_ZONE)


def epoch_local(seconds: Column) -> Column:
    return to_local(F.timestamp_seconds(seconds))


def hhmm(ts: Column) -> Column:
    return F.date_format(ts, "HHmm")


def sunday_zero(day: Column) -> Column:
    """Weekday with Sunday as 0."""
    return F.dayofweek(day) - 1


def iso_year(day: Column) -> Column:
    """Year that owns the ISO week of ``day``: the year of that week's Thursday."""
    return F.year(F.date_add(F.date_trunc("week", day).cast("date"), 3))
