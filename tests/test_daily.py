"""Tables by day: a refresh reads and rewrites changed days only and equals a full run."""

import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from granero.plans import daily, planning
from granero.sources import snapshots

SCHEMA = "sku long, store_id long, day date, units long, net long, version int"
DAY0 = dt.date(2024, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.fixture
def sales(spark):
    rows = [(k % 7, k % 3, day(k % 40), k % 11, 10 * k, 2 if k % 80 == 17 else 1) for k in range(2000)]
    rows += [(1, 1, None, 3, 3, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def values(df):
    return sorted(map(str, df.collect()))


def test_only_changed_days_are_read_and_only_their_files_rewritten(spark, sales, tmp_path):
    path = str(tmp_path / "daily")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        daily.create(daily.daily_sales(sales.where("version = 1")), path, daily.KEY)
        full = daily.daily_sales(sales)
        asked = []

        def build(days):
            asked.append(days)
            return daily.daily_sales(sales.where(F.col("day").isin(days)))

        done = daily.refresh_days(spark, path, full.schema, sales.where("version = 2").select("day"), build)
        assert asked == [[day(17)]] and 1 <= done.replaced <= 2 < done.kept + done.replaced
        assert values(snapshots.read(spark, path, full.schema)) == values(full)
        daily.refresh_days(spark, path, full.schema, sales.where("version = 2").select("day"), build)  # once more
        assert values(snapshots.read(spark, path, full.schema)) == values(full)
        gone = spark.createDataFrame([(day(17),), (day(18),)], "day date")
        daily.refresh_days(spark, path, full.schema, gone, lambda days: daily.daily_sales(sales.where("day = DATE'2024-01-18' AND store_id = 99")))
        assert values(snapshots.read(spark, path, full.schema)) == values(full.where("day IS NULL OR day NOT IN (DATE'2024-01-18', DATE'2024-01-19')"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_days_of_changed_keys_before_and_after(spark):
    before = spark.createDataFrame([(1, day(0)), (2, day(1)), (3, day(2))], "order_id long, day date")
    after = spark.createDataFrame([(1, day(5)), (2, day(1)), (4, day(6))], "order_id long, day date")
    changed = spark.createDataFrame([(1,), (4,)], "order_id long")
    assert sorted(r.day for r in daily.days_of(changed, "order_id", before, after).collect()) == [day(0), day(5), day(6)]


def test_planning_from_daily_sums_equals_planning_from_lines(spark, sales):
    table = daily.daily_sales(sales)
    promoted = spark.createDataFrame([(k,) for k in range(5)], "sku long")
    windows = spark.createDataFrame([(k, day(k), day(k + 9)) for k in range(6)], "sku long, start_day date, end_day date")
    for build in (
        lambda s: planning.supply_forecast(promoted, windows, s, str(day(39))), lambda s: planning.promo_safety_stock(promoted, windows, s, str(day(39))),
        lambda s: planning.comparable_mean(s, str(day(39))), planning.weekday_profile,
    ):
        assert values(build(table)) == values(build(sales))
    for r in table.groupBy("sku").agg(daily.line_deviation().alias("dev")).collect():
        lines = [s.units for s in sales.where(F.col("sku") == r.sku).collect()]
        assert math.isclose(r.dev, statistics.pstdev(lines), abs_tol=1e-9)
