"""Order cost base, picking and guarantee costs, tariffed logistics cost and trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date
from granero.functions.geo import haversine_km
from granero.functions.numbers import ratio
from granero.operators.joins import rate_join
from granero.operators.ranking import latest_per_key
from granero.operators.sets import packed_list

# Change states that count as picking work, and the dispatched state.
DISPATCHED = 70
# Overhead rules.
COORDINATOR_RATE, DAYS_PER_MONTH, MAX_GRAMS, MAX_LITRES = 1.08, 30, 80_000, 500
# Distances above the limit count as the cap (km, both ways).
DISTANCE_LIMIT, DISTANCE_CAP = 80.0, 81.0


def order_cost_base(
    orders: DataFrame, dispatches: DataFrame, carriers: DataFrame, changes: DataFrame, delivered: DataFrame,
    trips: DataFrame, factors: DataFrame, picking_states: Sequence[int], day,
) -> DataFrame:
    """Cost base of the orders created on ``day``: flags, delivery day and billed kilometres.

    Kilometres are metres times the operator's factor valid on the delivery day, else the default factor.
    """
    today = orders.where(F.col("day") == as_date(day))
    flags = changes.join(today.select("order_id"), "order_id", "left_semi").groupBy("order_id").agg(
        F.bool_or((F.col("new_state").isin(*picking_states)) & (F.col("created").cast("date") == as_date(day))).alias("picked"),
        F.bool_or(F.col("new_state") == DISPATCHED).alias("dispatched"),
    )
    last = latest_per_key(dispatches.select("order_id", "id", "carrier", "promised"), ["order_id"], "id")
    base = (
        today.join(last.drop("id"), "order_id", "left").join(delivered, "order_id", "left")
        .join(flags, "order_id", "left").join(trips, "order_id", "left").join(carriers, "carrier", "left")
        .withColumns({
            "delivery_day": F.coalesce("delivered_on", "promised"), "picked": F.coalesce("picked", F.lit(False)),
            "dispatched": F.coalesce("dispatched", F.lit(False)),
        })
    )
    dated = factors.where("operator <> 'default'").withColumnRenamed("factor", "_dated")
    matched = rate_join(base, dated, ["operator"], "delivery_day", "from_day", "to_day", "left")
    fallback = factors.where("operator = 'default'").agg(F.max("factor")).scalar()
    km = F.round(F.coalesce("_dated", fallback) * F.col("metres") / 1000, 1)
    return matched.withColumn("km", km).drop("_dated", "from_day", "to_day")


def picking_costs(base: DataFrame, tariffs: DataFrame, forecast: DataFrame) -> DataFrame:
    """Base fee, fee per SKU and, for dispatched orders, per kilometre, where the forecast staffs the carrier."""
    staffed = forecast.where("headcount > 0").select(
        F.col("day").alias("delivery_day"), "store_id", "carrier", "model", "operator", "headcount", "shared"
    )
    joined = base.where("picked").drop("operator").join(tariffs, "carrier").join(
        staffed, ["delivery_day", "store_id", "carrier", "model", "operator"]
    )
    km_cost = F.when(F.col("dispatched"), F.coalesce(F.col("km") * F.col("per_km"), F.lit(0))).otherwise(0)
    return joined.withColumns({
        "sku_cost": F.col("per_sku") * F.col("skus"), "km_cost": km_cost,
        "cost": F.col("base") + F.col("per_sku") * F.col("skus") + km_cost,
    })


def guarantee_topup(costs: DataFrame, factors: DataFrame, forecast: DataFrame, tariffs: DataFrame, day) -> DataFrame:
    """Missing amount to the guaranteed minimum: headcount x rate x factor minus the billed cost, at least 0.

    Shared carriers add up per store, unshared ones per carrier and headcount; staffed groups without orders get
    the whole minimum of the tariff that is valid on the day.
    """
    day = as_date(day)
    group = ["delivery_day", "store_id", "model", "operator"]
    today = costs.where(F.col("delivery_day") == day)
    rates = factors.select("operator", "model", "pay", "guarantee_factor", "from_day", "to_day")

    # One pass: unshared carriers keep their own group, shared ones fall together.
    alone = F.col("shared") == 0
    own, crew = F.when(alone, F.col("carrier")), F.when(alone, F.col("headcount"))
    totals = today.groupBy(*group, "guarantee", "shared", own.alias("_own"), crew.alias("_crew")).agg(
        F.sum("cost").alias("_cost"), F.min("headcount").alias("headcount"), packed_list(F.col("carrier"), ", ").alias("_list")
    )
    rated = rate_join(totals, rates, ["operator", "model"], "delivery_day", "from_day", "to_day", "left")
    paid = F.col("_cost") * F.coalesce("pay", F.lit(1))
    floor = F.col("headcount") * F.col("guarantee") * F.coalesce("guarantee_factor", F.lit(1))
    together = F.col("shared") == 1
    billed = rated.select(
        *group, F.when(~together, F.col("_own").cast("string")).alias("carrier"), F.when(together, F.col("_list")).alias("carriers"),
        paid.alias("paid"), floor.alias("minimum"), F.greatest(floor - paid, F.lit(0)).alias("topup"),
        F.when(together, "duplicado").otherwise("no_duplicado").alias("source"),
    )
    text = F.col("carrier").cast("string")
    staffed = forecast.where((F.col("day") == day) & (F.col("headcount") > 0)).withColumnRenamed("day", "delivery_day")
    idle = staffed.join(today.select(*group), group, "left_anti").groupBy(*group).agg(
        F.max("shared").alias("_shared"), packed_list(F.col("carrier"), ", ").alias("_list"),
        F.max("carrier").alias("carrier"), F.min("headcount").alias("headcount"),
    )
    dated = tariffs.select("carrier", "guarantee", F.col("from_day").alias("_from"), F.col("to_day").alias("_to"))
    priced = rate_join(idle, dated, ["carrier"], "delivery_day", "_from", "_to", "left")
    rated = rate_join(priced, rates, ["operator", "model"], "delivery_day", "from_day", "to_day", "left")
    minimum = F.col("headcount") * F.coalesce("guarantee", F.lit(0)) * F.coalesce("guarantee_factor", F.lit(1))
    empty = rated.select(
        *group, F.when(F.col("_shared") != 1, text).alias("carrier"), F.when(F.col("_shared") == 1, F.col("_list")).alias("carriers"),
        (minimum * 0).alias("paid"), minimum.alias("minimum"), minimum.alias("topup"), F.lit("sin_pedido").alias("source"),
    )
    return billed.unionByName(empty)


def overheads(base: DataFrame, coordinators: DataFrame, fixed: DataFrame, costs: DataFrame, loads: DataFrame, operator: str, day) -> DataFrame:
    """Daily coordinator and fixed cost per store and operator, plus the surcharge for overweight orders.

    An order over 80 kg or 500 litres delivered by ``operator`` adds its base and kilometre cost.
    """
    key = ["store_id", "operator"]
    groups = base.where(F.col("delivery_day") == as_date(day)).select("delivery_day", *key).distinct()
    heavy = (
        loads.groupBy("order_id").agg(F.sum("grams").alias("_g"), F.sum("litres").alias("_l"))
        .where((F.col("_g") > MAX_GRAMS) | (F.col("_l") > MAX_LITRES))
    )
    surcharge = (
        costs.where((F.col("operator") == operator) & F.col("dispatched")).join(heavy, "order_id", "left_semi")
        .groupBy("store_id", "delivery_day", "operator").agg(F.sum(F.col("base") + F.col("km_cost")).alias("overweight"))
    )
    return (
        groups.join(coordinators, key, "left").join(fixed, key, "left").join(surcharge, ["delivery_day", *key], "left")
        .select(
            "delivery_day", *key, (F.lit(COORDINATOR_RATE) * F.col("coordinator_cost") / DAYS_PER_MONTH).alias("coordinator"),
            (F.col("fixed_cost") / DAYS_PER_MONTH).alias("fixed"), "overweight",
        )
    )


def billing_month(day: Column) -> Column:
    """Month a day is billed in: days after the 25th belong to the next month."""
    return F.date_format(F.when(F.dayofmonth(day) <= 25, day).otherwise(F.add_months(F.trunc(day, "month"), 1)), "yyyyMM").cast("int")


def logistics_cost(trips: DataFrame, tariffs: DataFrame, attendance: DataFrame) -> DataFrame:
    """Store-day logistics cost from per-order tariffs.

    Months after the last one with tariffs take that month's. ``attendance`` has the hours of a shopper, day and
    store; pickers by the hour cost the longest of them, else the store's mean hours. Costs that are NULL add 0.
    Distance is the real one, else the geodesic one scaled by the store's ratio of real to geodesic distance,
    else geodesic. Shoppers are topped up to the guarantee; the coordinator is split over days and shoppers.
    """
    geodesic = 2 * haversine_km(F.col("store_lat"), F.col("store_lng"), F.col("lat"), F.col("lng"))
    capped = F.when(geodesic > DISTANCE_LIMIT, DISTANCE_CAP).otherwise(geodesic)
    rows = trips.withColumns({"geo_km": F.round(capped, 6), "month": billing_month(F.col("day"))})
    known = rows.where("real_km IS NOT NULL").groupBy("store_id").agg(
        F.sum("real_km").alias("_real"), F.sum("geo_km").alias("_geo")
    )
    mean = known.where("_real > 0").agg(ratio(F.sum("_real"), F.sum("_geo"))).scalar()
    scale = F.when(ratio(F.col("_real"), F.col("_geo")) > 1, ratio(F.col("_real"), F.col("_geo"))).otherwise(mean)
    ratios = known.select("store_id", scale.alias("_ratio"))
    scaled = F.col("geo_km") * F.col("_ratio")
    km = F.when(F.col("real_km") > 0, F.col("real_km")).when(F.col("real_km").isNull() & (scaled > 0), scaled).otherwise(F.col("geo_km"))
    last = tariffs.agg(F.max("month")).scalar()
    rates = tariffs.withColumnRenamed("month", "_rated")
    priced = (
        rows.join(ratios, "store_id", "left").withColumn("km", km).withColumn("_rated", F.least("month", last))
        .join(rates, ["store_id", "_rated"], "left")
        .withColumns({
            "picking": F.when(F.col("per_unit") > 0, F.col("units") * F.col("per_unit")).otherwise(F.col("products") * F.col("per_sku")),
            "delivery": F.when(F.col("truck") > 0, F.col("truck")).otherwise(F.col("per_km") * F.col("km") * F.when(F.col("one_way"), 0.5).otherwise(1.0)),
        })
        .withColumn("order_cost", F.col("base") + F.col("picking") + F.col("delivery") - F.col("truck"))
    )
    shopper = priced.groupBy("day", "store_id", "month", "shopper").agg(
        F.sum("order_cost").alias("shoppers"), F.sum("truck").alias("trucks"), F.max("guarantee").alias("_guarantee"),
        F.max("coordinator").alias("_coordinator"), F.max("picker_rate").alias("_rate"),
    )
    present = attendance.groupBy("day", "store_id", "shopper").agg(F.max("hours").alias("_hours"))
    shopper = shopper.join(present, ["day", "store_id", "shopper"], "left")
    usual = shopper.groupBy("store_id").agg(F.avg("_hours").alias("_usual"))
    shopper = shopper.join(usual, "store_id", "left").withColumn("_picker", F.coalesce("_hours", "_usual") * F.col("_rate"))
    topup = F.greatest(F.col("_guarantee") - F.col("shoppers"), F.lit(0.0))
    days = F.dayofmonth(F.last_day(F.add_months(F.to_date(F.col("month").cast("string"), "yyyyMM"), -1)))
    per_day = shopper.groupBy("day", "store_id").agg(
        F.sum("shoppers").alias("shoppers"), F.sum(topup).alias("guarantee"), F.sum("trucks").alias("trucks"),
        F.sum("_picker").alias("pickers"), F.max(F.col("_coordinator") / days).alias("coordinator"),
    )
    parts = ("shoppers", "guarantee", "trucks", "pickers", "coordinator")
    return per_day.withColumn("total", sum((F.coalesce(c, F.lit(0)) for c in parts), F.lit(0)))


def order_trips(
    orders: DataFrame, stores: DataFrame, dispatches: DataFrame, changes: DataFrame, day, days: int = 1
) -> DataFrame:
    """Store and customer coordinates, distance and dispatch time of the orders dispatched for delivery."""
    recent = orders.where((F.col("day") >= F.date_sub(as_date(day), days)) & (F.col("day") < as_date(day)))
    last = latest_per_key(dispatches, ["order_id"], "id").where("type <> 'pickup'").select("order_id", "lat", "lng")
    left = changes.where(F.col("new_state") == DISPATCHED).groupBy("order_id").agg(F.max("created").alias("dispatched_at"))
    joined = recent.select("order_id", "store_id").join(stores, "store_id", "left").join(last, "order_id").join(left, "order_id")
    km = haversine_km(F.col("store_lat"), F.col("store_lng"), F.col("lat"), F.col("lng"))
    return joined.withColumn("km", km)


def dispatch_types(dispatches: DataFrame, carriers: DataFrame) -> DataFrame:
    """Fill missing dispatch types from the carrier: 1 delivery, 2 pickup, anything else error."""
    kinds = carriers.select("carrier", F.col("kind").alias("_kind"))
    named = F.when(F.col("_kind") == 1, "delivery").when(F.col("_kind") == 2, "pickup").otherwise("error")
    joined = dispatches.join(kinds.withColumn("_known", F.lit(True)), "carrier", "left")
    return joined.withColumn("type", F.when(F.col("type").isNull() & F.col("_known"), named).otherwise(F.col("type"))).drop("_kind", "_known")
