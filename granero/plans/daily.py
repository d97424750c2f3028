"""Tables of one row per key and day that are kept up to date by recomputing changed days only.

A day's rows follow from that day's inputs alone, so replacing whole days is exact and may be repeated after a failure. The
tables are snapshot tables with files by day: a refresh rewrites the files that hold a changed day and leaves the others.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.operators.merge import Merged, merge_files
from granero.sources import snapshots

KEY = ["sku", "store_id", "day"]


def daily_sales(sales: DataFrame) -> DataFrame:
    """Per product, store and day: what weekday means, comparable days, promotion windows and limits are made from.

    ``most`` is the largest sale line and ``squares`` the sum of squared units, so maxima and deviations by line follow too.
    Every measure but ``most`` adds up over days and stores. The planning operators take this table in place of sales.
    """
    return sales.groupBy(*KEY).agg(
        F.sum("units").alias("units"), F.sum("net").alias("net"), F.count("units").alias("lines"), F.max("units").alias("most"),
        F.sum(F.col("units") * F.col("units")).alias("squares"),
    )


def line_deviation(units: str = "units", lines: str = "lines", squares: str = "squares"):
    """Standard deviation of the units of single lines, from summed ``daily_sales`` measures."""
    total, count = F.sum(units), F.sum(lines)
    return F.sqrt(F.greatest((F.sum(squares) - total * total / count) / count, F.lit(0.0)))


def days_of(keys: DataFrame, key: str, *tables: DataFrame) -> DataFrame:
    """The days on which changed ``keys`` stand in any of these tables, such as the orders before and after a change."""
    found = [table.join(keys.select(key), key, "left_semi").select("day") for table in tables]
    return reduce(DataFrame.unionByName, found).distinct()


def create(rows: DataFrame, path: str, key: Sequence[str]) -> None:
    """Start a table with files by day."""
    snapshots.append(rows, path, ["day", *[c for c in key if c != "day"]])


def refresh_days(spark: SparkSession, path: str, schema, days: DataFrame, build: Callable[[list[date]], DataFrame]) -> Merged:
    """Replace all rows of ``days`` by ``build(days)``, which gets them as a list to filter its inputs by.

    A day that has no rows any more loses them. Days, not rows, pass the driver. Rows that ``build`` returns for other
    days would stand twice, so they are left out.
    """
    listed = sorted(r["day"] for r in days.where("day IS NOT NULL").distinct().collect())
    fresh = build(listed).where(F.col("day").isin(listed))
    doomed = spark.createDataFrame([(one,) for one in listed], "day date")
    return merge_files(spark, path, schema, fresh, ["day"], null_safe=True, doomed=doomed)
