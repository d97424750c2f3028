"""Calendar dimension with offsets relative to a reference day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date


def _long_years(first: Column, last: Column) -> Column:
    """Number of years in [first, last) whose December reaches week 53."""
    years = F.when(first < last, F.sequence(first, last - 1)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(years, lambda y: F.weekofyear(F.make_date(y, F.lit(12), F.lit(31))) == 53))


def relative_calendar(days: DataFrame, today) -> DataFrame:
    """Year, half, quarter, month, week and day offsets of each ``day`` from ``today``.

    Weeks add one per 53-week year between the two; the first days of January that still belong to week 52
    or 53 count as week 0 of their calendar year.
    """
    base, day = as_date(today), F.col("day")
    year, month, week = F.year(day), F.month(day), F.weekofyear(day)
    years = year - F.year(base)
    weeks = F.when((week >= 52) & (month == 1), 0).otherwise(week)
    extra = _long_years(F.least(year, F.year(base)), F.greatest(year, F.year(base)))
    return days.withColumns({
        "year": year, "month": month, "week": week, "week_label": F.concat(year, F.lit("W"), week),
        "relative_year": years,
        "relative_half": years * 2 + F.ceil(month / 6).cast("int") - F.ceil(F.month(base) / 6).cast("int"),
        "relative_quarter": years * 4 + F.quarter(day) - F.quarter(base),
        "relative_month": years * 12 + month - F.month(base),
        "relative_week": years * 52 + F.signum(years).cast("int") * extra + weeks - F.weekofyear(base),
        "relative_day": years * 365 + F.dayofyear(day) - F.dayofyear(base),
    })


def category_levels(raw: DataFrame, closed: tuple[int, ...] = (0, 8)) -> DataFrame:
    """Flatten a parent-child table to three named levels, one row per category at its own depth."""
    children = raw.where(F.col("ref_parent").isNotNull())
    closed_status = F.when(F.col("status").isin(*closed), "inactive").otherwise("active")

    def level(df: DataFrame, depth: int) -> DataFrame:
        return df.select(
            "id", "ref_id", closed_status.alias("status"),
            *[F.col(f"n{i}") if i <= depth else F.lit(None).cast("string").alias(f"n{i}") for i in (1, 2, 3)],
        )

    def below(parents: DataFrame, depth: int) -> DataFrame:
        names = [F.col(f"n{i}") for i in range(1, depth)]
        up = parents.select(F.col("ref_id").alias("ref_parent"), *names)
        return children.join(up, "ref_parent").select("id", "ref_id", "status", *names, F.col("name").alias(f"n{depth}"))

    first = raw.where(F.col("ref_parent").isNull()).select("id", "ref_id", "status", F.col("name").alias("n1"))
    second = below(first, 2)
    third = below(second, 3)
    return level(first, 1).unionByName(level(second, 2)).unionByName(level(third, 3))
