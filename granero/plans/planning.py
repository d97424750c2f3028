"""Rankings, safety stock, replenishment, forecasts, slotting and staffing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date, iso_year, sunday_zero
from granero.functions.keys import WEIGHT_UNITS
from granero.functions.numbers import ratio
from granero.operators.joins import validity_join
from granero.operators.ranking import composite_rank, positions

PAIR = ["sku", "store_id"]
WEEKDAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")


def product_ranking(sales: DataFrame, within: Sequence[str] = (), **options) -> DataFrame:
    """Products by 0.5 x frequency, 0.3 x units and 0.2 x revenue ranks; ``within`` restarts the numbering."""
    totals = sales.groupBy(*within, "sku").agg(
        F.count("sku").alias("frequency"), F.sum("units").alias("units"), F.sum("net").alias("revenue")
    )
    weights = {"frequency": 5, "units": 3, "revenue": 2}
    return composite_rank(totals, weights, ["sku"], within=within, **options)


def without_event_weeks(sales: DataFrame, weeks: Sequence[tuple[int, int]]) -> DataFrame:
    """Drop sales of the given (ISO year, week) pairs so events do not distort averages."""
    hit = reduce(
        lambda a, b: a | b,
        [(iso_year(F.col("day")) == y) & (F.weekofyear("day") == w) for y, w in weeks], F.lit(False),
    )
    return sales.where(~hit)


def _floor_to(value: Column, minimum: float, otherwise: float) -> Column:
    return F.when(value >= minimum, value).otherwise(otherwise)


def safety_stock(
    assortment: DataFrame, sales: DataFrame, minima: DataFrame, exempt: DataFrame, weights: DataFrame,
    excluded: DataFrame, as_of, event_weeks: Sequence[tuple[int, int]] = (), days: int = 15, share: float = 0.25,
    cap: int = 50, skipped_stores: Sequence[int] = (),
) -> DataFrame:
    """Safety stock per SKU-store from the mean of weekday sales of the last ``days`` days.

    A share of the mean, nothing below one, rounded half-even twice; a display minimum caps it unless the SKU
    is exempt; the store weight, the floor of one, the general cap and the exclusions follow in that order.
    """
    recent = without_event_weeks(sales.where(F.col("day") >= F.date_sub(as_date(as_of), days)), event_weeks)
    weekday = recent.groupBy(*PAIR, sunday_zero(F.col("day")).alias("dow")).agg(F.sum("units").alias("units"))
    mean = weekday.groupBy(*PAIR).agg(F.avg("units").alias("mean"))
    rows = (
        assortment.select(*PAIR).distinct().join(mean, PAIR, "left").join(minima.select(*PAIR, "minimum"), PAIR, "left")
        .join(exempt.select(*PAIR).distinct().withColumn("_exempt", F.lit(True)), PAIR, "left")
        .join(excluded.select(*PAIR).distinct().withColumn("_excluded", F.lit(True)), PAIR, "left")
        .join(weights.select("store_id", "weight"), "store_id", "left")
        .where(~F.col("store_id").isin(*skipped_stores))
    )
    base = F.bround(F.bround(_floor_to(F.coalesce("mean", F.lit(0.0)) * share, 1, 0), 2), 0)
    minimum = F.coalesce("minimum", F.lit(0))
    shown = F.when(F.col("_exempt").isNull() & (minimum > 0) & (base > minimum), minimum).otherwise(base)
    weighted = F.bround(shown * F.coalesce("weight", F.lit(1.0)), 0)
    final = F.when(F.col("_excluded"), 0).otherwise(F.least(_floor_to(weighted, 1, 0), F.lit(cap)))
    return rows.select(*PAIR, final.cast("long").alias("safety_stock"))


def _weekday_weeks(sales: DataFrame, dow: Column) -> DataFrame:
    """Weekly totals of one weekday per SKU-store."""
    day = F.col("day")
    return (
        sales.where(sunday_zero(day) == dow).groupBy(*PAIR, iso_year(day).alias("year"), F.weekofyear(day).alias("week"))
        .agg(F.sum("units").alias("units"))
    )


def weekday_safety_stock(
    assortment: DataFrame, sales: DataFrame, promoted: DataFrame, weights: DataFrame, as_of, share: float = 0.5,
    floor: int = 2, cap: int | None = None,
) -> DataFrame:
    """Safety stock from the weekly mean of the same weekday; promoted SKUs take the weekday maximum.

    Listed SKUs without sales on that weekday get the floor.
    """
    weekly = _weekday_weeks(sales, sunday_zero(as_date(as_of)))
    stats = weekly.groupBy(*PAIR).agg(F.avg("units").alias("mean"), F.max("units").alias("most"))
    rows = (
        assortment.select(*PAIR).distinct().join(stats, PAIR, "left").join(weights.select("store_id", "weight"), "store_id", "left")
        .join(promoted.select("sku").distinct().withColumn("_promo", F.lit(True)), "sku", "left")
    )
    base = F.bround(F.bround(_floor_to(F.col("mean") * share, floor, floor), 2), 0)
    weighted = _floor_to(F.bround(base * F.coalesce("weight", F.lit(1.0)), 0), floor, floor)
    chosen = _floor_to(F.when(F.col("_promo"), F.col("most")).otherwise(weighted), floor, floor)
    final = F.when(F.col("mean").isNull(), floor).otherwise(chosen)
    if cap is not None:
        final = F.least(final, F.lit(cap))
    return rows.select(*PAIR, final.cast("long").alias("safety_stock"))


def regular_price_sales(sales: DataFrame, as_of, days: int = 70, share: float = 0.8) -> DataFrame:
    """Sales of the last ``days`` days sold above ``share`` of the list price."""
    recent = sales.where((F.col("day") >= F.date_sub(as_date(as_of), days)) & (F.col("units") > 0) & (F.col("gross") != 0))
    unit_price = F.round(F.col("gross") / F.col("units"))
    return recent.where(unit_price / F.col("list_price") > share)


def last_windows(promotions: DataFrame, as_of, days: int, mechanics: Sequence[int], events: Sequence[int] = (551,)) -> DataFrame:
    """Latest start and end of the promotions each SKU finished in the last ``days`` days."""
    day = as_date(as_of)
    finished = promotions.where(
        (F.col("end_day") < day) & (F.col("start_day") >= F.date_sub(day, days))
        & ~F.col("mechanic").isin(*mechanics) & ~F.col("event").isin(*events)
    )
    return finished.groupBy("sku").agg(F.max("start_day").alias("start_day"), F.max("end_day").alias("end_day"))


def promo_safety_stock(promoted: DataFrame, windows: DataFrame, sales: DataFrame, as_of, days: int = 15) -> DataFrame:
    """Mean daily sale of the last promotion (rounded up, at least 2), else the recent maximum.

    Then halved, floored at 2, rounded up, capped at 100 and halved again, in that order. ``sales`` may be daily sums,
    with the largest line in ``most``.
    """
    largest = "most" if "most" in sales.columns else "units"
    span = F.datediff("end_day", "start_day")
    wanted = sales.join(promoted.select("sku").distinct(), "sku", "left_semi")
    during = validity_join(wanted, windows, ["sku"], "day", "start_day", "end_day")
    mean = during.groupBy(*PAIR).agg(F.ceil(ratio(F.sum("units"), F.max(span))).alias("mean"))
    most = wanted.where(F.col("day") >= F.date_sub(as_date(as_of), days)).groupBy(*PAIR).agg(F.max(largest).alias("most"))
    start = F.when(F.col("mean").isNull(), F.col("most")).otherwise(F.greatest(F.col("mean"), F.lit(2))).cast("double")
    halved = F.ceil(F.greatest(start * 0.5, F.lit(2.0)))
    return most.join(mean, PAIR, "left").select(*PAIR, (F.least(halved, F.lit(100)) * 0.5).alias("safety_stock"))


def supply_forecast(promoted: DataFrame, windows: DataFrame, sales: DataFrame, as_of, days: int = 45) -> DataFrame:
    """Weekday forecast: mean of the last promotion window, else the weekday maximum of recent weeks."""
    key = [*PAIR, "dow", "week"]
    dated = sales.join(promoted.select("sku").distinct(), "sku", "left_semi").withColumns(
        {"dow": sunday_zero(F.col("day")), "week": F.weekofyear("day")}
    )
    during = validity_join(dated, windows, ["sku"], "day", "start_day", "end_day")
    mean = during.groupBy(*key).agg(F.sum("units").alias("u")).groupBy(*PAIR, "dow").agg(F.avg("u").alias("mean"))
    recent = dated.where(F.col("day") >= F.date_sub(as_date(as_of), days))
    most = recent.groupBy(*key).agg(F.sum("units").alias("u")).groupBy(*PAIR, "dow").agg(F.max("u").alias("most"))
    mean_or_zero = F.coalesce("mean", F.lit(0.0))
    return most.join(mean, [*PAIR, "dow"], "left").select(
        *PAIR, "dow", F.when(mean_or_zero == 0, F.col("most").cast("double")).otherwise(mean_or_zero).alias("forecast")
    )


def weekday_profile(sales: DataFrame, divisor: int = 10) -> DataFrame:
    """Seven columns per SKU: units sold on each weekday over ``divisor`` weeks."""
    daily = sales.withColumn("dow", sunday_zero(F.col("day")))
    return daily.groupBy("sku").agg(
        *[(F.sum(F.when(F.col("dow") == i, F.col("units")).otherwise(0)) / divisor).alias(d) for i, d in enumerate(WEEKDAYS)]
    )


def cyclic_demand(profile: Column, start: Column, lead_time: Column) -> Column:
    """Sum of ``lead_time`` consecutive weekdays of a seven-value array, wrapping around the week."""
    whole = F.aggregate(profile, F.lit(0.0), lambda a, x: a + x)
    rest = F.slice(F.concat(profile, profile), start + 1, lead_time % 7)
    part = F.aggregate(rest, F.lit(0.0), lambda a, x: a + x)
    return F.floor(lead_time / 7) * whole + part


def replenishment(masters: DataFrame, as_of) -> DataFrame:
    """Units to order per SKU: lead-time demand, trigger, target, clamp, pack rounding."""
    today = sunday_zero(as_date(as_of)).cast("int")
    profile = F.array(*[F.coalesce(F.col(d).cast("double"), F.lit(0.0)) for d in WEEKDAYS])
    stock = F.coalesce(F.col("stock"), F.lit(0))
    rows = masters.withColumns({
        "demand": cyclic_demand(profile, today, F.coalesce("lead_time", F.lit(0))),
        "today_sale": F.element_at(profile, today + 1), "stock": stock,
    })
    target = F.col("doh") * F.col("today_sale") + F.col("demand") - F.col("stock")
    clamped = F.when(target > F.col("maximum"), F.col("maximum")).when(target < F.col("minimum"), F.col("minimum")).otherwise(target)
    room = F.col("maximum") - F.col("stock")
    bounded = F.when((F.col("clamped") == F.col("maximum")) | (F.col("clamped") + F.col("stock") >= F.col("maximum")), room).otherwise(F.col("clamped"))
    # Rounded first, so that float noise does not order one pack too many.
    packed = F.ceil(F.round("bounded", 6) / F.col("multiplier")) * F.col("multiplier")
    due = (F.col("demand") > F.col("minimum")) & (F.col("stock") <= F.col("demand"))
    return (
        rows.where(due).withColumn("clamped", clamped.cast("double")).withColumn("bounded", bounded.cast("double"))
        .withColumn("requested", packed.cast("double")).where("requested > 0").select("sku", "demand", "stock", "requested")
    )


def comparable_mean(sales: DataFrame, as_of, weeks: int = 4) -> DataFrame:
    """Mean of the same weekday of the last four weeks (the sum over four, rounded)."""
    recent = sales.where(F.col("day").isin(*[F.date_sub(as_date(as_of), 7 * w) for w in range(1, weeks + 1)]))
    return recent.groupBy(*PAIR).agg(
        F.round(F.sum("net") / weeks).alias("net"), F.round(F.sum("units") / weeks).alias("units")
    )


def statistical_limits(sales: DataFrame, as_of, above: int, days: int = 30) -> DataFrame:
    """Purchase limit per SKU: mean plus two deviations of the units per sale line, where above the floor."""
    recent = sales.where(F.col("day") >= F.date_sub(as_date(as_of), days))
    limits = recent.groupBy("sku").agg(
        F.round(F.avg("units")).alias("mean_units"),
        F.round(F.avg("units") + 2 * F.stddev_pop("units")).alias("purchase_limit"),
    )
    return limits.where(F.col("purchase_limit") > above)


def area_stock(inventory: DataFrame) -> DataFrame:
    """Stock per SKU in the dynamic, manual and automatic storage areas."""
    area = F.upper("area")
    kind = F.when(area.like("%DYNAMIC%"), "dynamic").when(area.like("%MANUAL%"), "manual").when(area.like("%OSR%"), "osr")
    rows = inventory.select("sku", "stock", kind.alias("kind")).distinct()
    return rows.groupBy("sku").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("stock")).otherwise(0)).alias(f"stock_{k}") for k in ("manual", "osr", "dynamic")],
        (F.count("kind") > 0).alias("has_stock"),
    )


def storage_list(sales: DataFrame, promoted: DataFrame, inventory: DataFrame, as_of, days: int = 60) -> DataFrame:
    """Mean daily sale per SKU-store outside promotions with stock by area and a seven-day target."""
    recent = sales.where((F.col("day") >= F.date_sub(as_date(as_of), days)) & (F.col("units") > 0))
    daily = recent.join(promoted.select("sku"), "sku", "left_anti").groupBy(*PAIR, "day").agg(F.sum("units").alias("units"))
    mean = daily.groupBy(*PAIR).agg(F.round(F.avg("units"), 2).alias("mean_units"))
    joined = mean.join(area_stock(inventory), "sku", "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("stock_manual", "stock_osr", "stock_dynamic")]
    return joined.select(
        *PAIR, "mean_units", F.coalesce("has_stock", F.lit(False)).alias("has_stock"), *zero,
        (F.col("mean_units") * 7).alias("target_stock"),
    )


def slotting_master(
    assortment: DataFrame, places: DataFrame, ranking: DataFrame, base: DataFrame, totes: DataFrame,
    inventory: DataFrame, promoted: DataFrame, restricted: DataFrame,
) -> DataFrame:
    """Slotting attributes per SKU and store: weekday sales, tote equivalents, area stock, size flags and targets.

    ``base`` is the regular-sales base without deep promotions; sales averages and ranking are the store's own.
    ``totes`` has one row per stored load unit with its share (1, 1/2, 1/4 or 1/8 of a tote).
    """
    daily = base.where("NOT deep AND discount < 0.3").groupBy(*PAIR, "day").agg(F.sum("units").alias("units"))
    dow = sunday_zero(F.col("day"))
    week = daily.groupBy(*PAIR).agg(
        *[F.round(F.avg(F.when(dow == i, F.col("units"))), 2).alias(d) for i, d in enumerate(WEEKDAYS)],
        F.count("units").alias("sale_days"),
    )
    stored = totes.groupBy("sku").agg(
        F.sum("share").alias("tote_equivalents"), F.sum("quantity").alias("stored_units"),
        F.count("unit").alias("places"), F.count_distinct("unit").alias("load_units"),
    )
    total = sum((F.col(d) for d in WEEKDAYS[1:]), F.col(WEEKDAYS[0]))
    volume, case = F.col("length") * F.col("height") * F.col("width"), F.col("case_quantity")
    weekly = F.round(total, 2)
    joined = (
        assortment.select(*PAIR, "uom").distinct().join(week, PAIR, "left").join(ranking.select(*PAIR, "ranking"), PAIR, "left")
        .join(places, "sku", "left").join(stored, "sku", "left")
        .join(area_stock(inventory), "sku", "left")
        .join(promoted.select("sku").distinct().withColumn("_promo", F.lit(True)), "sku", "left")
        .join(restricted.select("sku").distinct().withColumn("_held", F.lit(True)), "sku", "left")
    )
    return joined.withColumns({
        "volume": F.round(volume, 2),
        "conveyable": F.when(F.col("length") > 55.5, "No conveyable 1").when(F.col("width") > 35.6, "No conveyable 2").otherwise("conveyable"),
        "bulky": F.coalesce(volume / 100000 > 0.073, F.lit(False)), "weighable": F.col("uom").isin(*WEIGHT_UNITS),
        "grams": F.when(F.col("weight_unit") == "G", F.col("weight")).when(F.col("weight_unit") == "KG", F.col("weight") * 1000).otherwise(0),
        "promoted": F.col("_promo").isNotNull(), "restricted": F.col("_held").isNotNull(),
        "waste_safe": F.coalesce(F.col("shelf_life") * 0.7 * F.round(total / 7, 2) >= case * 0.9, F.lit(False)),
        "mean_sale": F.round(total / 7, 2), "stock_total": F.col("stock_manual") + F.col("stock_osr"),
        "target": weekly, "target_cases": F.ceil(weekly / case) * case,
    }).drop("_promo", "_held")


def units_per_order(sales: DataFrame, as_of, days: int = 30) -> Column:
    """Rounded units per order of the last ``days`` days, as a scalar subquery."""
    recent = sales.where(F.col("day") >= F.date_sub(as_date(as_of), days))
    return recent.agg(F.round(ratio(F.sum("units"), F.count_distinct("order_id")))).scalar()


def staffing(tasks: DataFrame, productivity: DataFrame, forecast: DataFrame, waves: DataFrame, mean_units: Column,
             capped_task: int = 4, floored_task: int = 6) -> DataFrame:
    """Operators per task: the busiest wave's orders x shares x units over productivity, with task rules."""
    load = productivity.join(forecast.select("store_id", "orders"), "store_id").join(waves, "store_id")
    people = F.ceil(F.round(F.col("orders") * F.col("share") * F.col("wave_share") * mean_units) / F.col("productivity"))
    rated = load.withColumn("_people", people)
    people = F.col("_people")
    needed = (
        F.when(F.col("task") == capped_task, F.least(people, F.lit(2)))
        .when((F.col("task") == floored_task) & (people - 2 < 1), 1).otherwise(people)
    )
    most = rated.groupBy("task").agg(F.max(needed).cast("long").alias("people"))
    known = F.col("people").isNotNull()
    top = F.when(known & (F.col("task") == capped_task), 2).when(known, F.col("people") + 2).otherwise(F.col("max_operators"))
    return tasks.join(most, "task", "left").select(
        "task", F.coalesce("people", "min_operators").alias("min_operators"), top.alias("max_operators")
    )


def operators_available(shifts: DataFrame, day, blocks: Sequence[str] = ("M", "T", "N", "S")) -> DataFrame:
    """Operators per block and shift of ``day``."""
    today = shifts.where((F.col("day") == as_date(day)) & F.col("block").isin(*blocks))
    return today.groupBy("day", "block", "shift").agg(F.count("operator").alias("operators"))


def roster(operators: DataFrame, matrix: DataFrame, first, last) -> DataFrame:
    """Expand a rotating matrix: operator i starts at row i mod n, and each row covers seven days.

    ``matrix`` has one row per (row, weekday 0-6); its row count is read from the matrix itself.
    """
    placed = positions(operators, [F.col("operator").asc()], "_rank")
    rows = matrix.agg(F.max("row") + 1).scalar()
    dated = placed.withColumn("day", F.explode(F.sequence(as_date(first), as_date(last))))
    offset = F.datediff("day", as_date(first))
    keyed = dated.withColumns({
        "row": ((F.col("_rank") - 1 + F.floor(offset / 7)) % rows).cast("long"), "weekday": (offset % 7).cast("int"),
    })
    return keyed.join(matrix, ["row", "weekday"]).select("operator", "day", "block", "shift")


def waves_forecast(forecast: DataFrame, waves: DataFrame, mean_units: Column, day) -> DataFrame:
    """Expected orders and units of each delivery wave of ``day``."""
    today = forecast.where(F.col("day") == as_date(day)).join(waves, "store_id")
    orders = F.col("wave_share") * F.col("orders")
    return today.where(orders > 0).select(
        "store_id", "wave", F.round(orders).cast("long").alias("wave_orders"),
        F.round(orders * mean_units).cast("long").alias("wave_units"),
    )
