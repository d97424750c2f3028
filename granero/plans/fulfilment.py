"""Order fulfilment: line states, delivery promises, store boards and shortage alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date, as_ts, hhmm
from granero.functions.numbers import clip, count_when, ratio
from granero.operators.ranking import composite_rank, latest_per_key, top_k_by_column

COMPLETE, SUBSTITUTED, MISSING = 3, 2, 1  # line states
CANCELLED, ON, EARLY, LATE, PENDING, ERROR = 0, 10, 20, 30, 40, 999  # promise codes
GRACE = "INTERVAL '20' MINUTE"


def line_states(
    lines: DataFrame, weights: DataFrame, products: DataFrame, meat: Sequence[str], with_original: bool = False
) -> DataFrame:
    """Classify order lines: NULL for a substitute, 3 complete, 2 substituted, 1 missing.

    Pieces are complete when all asked units were picked; weighed lines at 80 % of the asked weight, meat at
    70 %. Lines, scale readings and substitution marks meet on the line id, so lines are shuffled once.
    ``with_original`` adds the product each substitute stands in for.
    """
    weighed = weights.groupBy("line_id").agg((F.sum("weight_g") / 1000).alias("weight_kg"))
    replaced = (
        lines.where(F.col("substitute_of").isNotNull())
        .select(F.col("substitute_of").alias("line_id")).distinct().withColumn("substituted", F.lit(True))
    )
    uom = F.col("uom")
    asked = (
        F.when(uom == "un", F.col("asked"))
        .when(uom == "kg", F.round(F.col("asked") * F.col("multiplier"), 4)).otherwise(-1)
    )
    picked = (
        F.when(uom == "un", F.coalesce("picked", F.lit(0)))
        .when(uom == "kg", F.round(F.coalesce("weight_kg", F.lit(0)), 4)).otherwise(-1)
    )
    keyed = lines.join(weighed, "line_id", "left").join(replaced, "line_id", "left")
    if with_original:
        keyed = keyed.join(_original_skus(lines), "line_id", "left")
    merged = (
        keyed.join(products.select("sku", "category"), "sku", "left")
        .withColumns({
            "substitute": F.col("substitute_of").isNotNull(),
            "substituted": F.coalesce("substituted", F.lit(False)),
            "asked": asked.cast("decimal(18,4)"), "picked": picked.cast("decimal(18,4)"),
        })
    )
    # Compared as products so that exactly 70 % and 80 % count as complete.
    def reached(tenths: int) -> Column:
        return (F.col("asked") > 0) & (F.col("picked") * 10 >= F.col("asked") * tenths)

    complete = (
        ((uom == "kg") & F.col("category").isin(*meat) & reached(7))
        | ((uom == "kg") & reached(8))
        | ((uom == "un") & (F.col("picked") >= F.col("asked")))
    )
    state = (
        F.when(F.col("substitute"), F.lit(None))
        .when(F.col("substituted"), SUBSTITUTED).when(complete, COMPLETE).otherwise(MISSING)
    )
    return merged.withColumn("state", state.cast("int"))


def _original_skus(lines: DataFrame) -> DataFrame:
    """Original product per substitute line.

    Only the substitutes look up their original and come back on the line id, so NULL references never pile
    up in one task.
    """
    originals = lines.select(F.col("line_id").alias("substitute_of"), F.col("sku").alias("original_sku"))
    marks = lines.where(F.col("substitute_of").isNotNull()).select("line_id", "substitute_of")
    return marks.join(originals, "substitute_of").select("line_id", "original_sku")


def promise_codes(dispatches: DataFrame, orders: DataFrame, changes: DataFrame, now, excluded_state: int = 80) -> DataFrame:
    """Day and time codes of the latest dispatch of each order against its latest delivery change.

    Times compare as HHMM text with 20 minutes of grace, so a window that crosses midnight misclassifies.
    """
    now = as_ts(now)
    last_dispatch = latest_per_key(dispatches, ["order_id"], "id")
    delivered = latest_per_key(
        changes.where(F.col("new_state") == 90).select("order_id", "id", "created"), ["order_id"], "id"
    ).select("order_id", F.col("created").alias("delivered"))
    kept = orders.where(F.col("state") != excluded_state).select("order_id", "state")
    joined = last_dispatch.join(kept, "order_id").join(delivered, "order_id", "left")
    promised, arrived, clock = F.col("promised"), F.col("delivered").cast("date"), hhmm(F.col("delivered"))
    opens, closes = hhmm(F.col("window_start")), hhmm(F.col("window_end") + F.expr(GRACE))
    today = now.cast("date")
    cancelled, same_day = F.col("state") >= 100, promised == arrived
    on_day = (
        F.when(cancelled, CANCELLED).when(same_day, ON).when(promised > arrived, EARLY)
        .when(promised < arrived, LATE).when(promised >= today, PENDING).otherwise(ERROR)
    )
    window_open = (promised == today) & (hhmm(F.col("window_end")) > hhmm(now + F.expr("INTERVAL '30' MINUTE")))
    on_time = (
        F.when(cancelled, CANCELLED)
        .when(same_day & clock.between(opens, closes), ON)
        .when(same_day & (clock < opens), EARLY).when(promised > arrived, EARLY)
        .when(same_day & (clock > closes), LATE).when(promised < arrived, LATE)
        .when(window_open, PENDING).when(promised > today, PENDING).otherwise(ERROR)
    )
    return joined.withColumns({"on_day": on_day, "on_time": on_time})


def expire_pending(promises: DataFrame, now) -> DataFrame:
    """Pending codes become errors once the window ended within the last day."""
    now = as_ts(now)
    today = now.cast("date").cast("timestamp")

    def expired(code: str, until: Column) -> Column:
        ended = F.col("window_end").between(until - F.expr("INTERVAL '1' DAY"), until)
        return F.when((F.col(code) == PENDING) & ended, ERROR).otherwise(F.col(code))

    return promises.withColumns({"on_day": expired("on_day", today), "on_time": expired("on_time", now)})


def store_board(sales: DataFrame, states: DataFrame, promises: DataFrame, floor_sales: DataFrame) -> DataFrame:
    """Store-day figures. ``states`` and ``promises`` carry the store and day of their order."""
    key = ["store_id", "day"]
    sold = sales.groupBy(*key).agg(F.sum("net").alias("net_sales"), F.count_distinct("order_id").alias("orders"))
    per_order = states.groupBy(*key, "order_id").agg(
        count_when(~F.col("substitute")).alias("requested"), count_when(F.col("state") == COMPLETE).alias("complete"),
        count_when(F.col("substituted")).alias("substituted"), F.min("state").alias("worst"),
    )
    filled = per_order.groupBy(*key).agg(
        F.sum("complete").alias("complete_items"), F.sum("substituted").alias("substituted_items"),
        F.sum("requested").alias("requested_items"), count_when(F.col("worst") == COMPLETE).alias("perfect_orders"),
    )
    kept = promises.groupBy(*key).agg(
        count_when(F.col("on_time") == ON).alias("on_time_orders"),
        count_when(F.col("on_time") == EARLY).alias("early_orders"),
    )
    in_store = floor_sales.groupBy(*key).agg(F.sum("net").alias("floor_sales"))
    board = sold.join(filled, key).join(kept, key).join(in_store, key)
    return board.withColumn("average_ticket", ratio(F.col("net_sales"), F.col("orders")))


def stockout_ranking(lines: DataFrame, orders: DataFrame, stores: DataFrame, as_of, days: int = 15, **options) -> DataFrame:
    """Per active store, products by missing units and affected orders, over invoiced orders picked in the last ``days`` days.

    ``orders`` has order_id, store_id, picked_on and invoiced_on; ``stores`` has store_id and status.
    """
    active = stores.where("status = 1").select("store_id")
    done = orders.where((F.col("picked_on") >= F.date_sub(as_date(as_of), days)) & F.col("invoiced_on").isNotNull())
    recent = done.join(active, "store_id", "left_semi").select("order_id", "store_id")
    short = lines.where(F.col("asked") > F.col("picked")).drop("store_id").join(recent, "order_id")
    totals = short.groupBy("store_id", "sku").agg(
        F.sum(F.col("asked") - F.col("picked")).alias("missing_units"),
        F.count_distinct("order_id").alias("affected_orders"),
    )
    return composite_rank(
        totals, {"missing_units": 5, "affected_orders": 5}, ["sku"], within=["store_id"], **options
    )


def shortage_alerts(
    states: DataFrame, limits: DataFrame, alerts: DataFrame, since, until, default_limit: int = 5, cap: int = 15,
    horizon_days: int = 90,
) -> DataFrame:
    """Most affected products per store, up to the store's own limit, with a cool-down.

    A product alerted in the ``horizon_days`` before the day of ``until`` returns only when its last alert was
    resolved and the picking is later.
    """
    recent = alerts.where(F.col("started") >= F.date_sub(as_ts(until).cast("date"), horizon_days).cast("timestamp"))
    last = latest_per_key(recent, ["store_id", "sku"], "started").select(
        "store_id", "sku", "started", "resolved"
    )
    window = states.where(F.col("picked_at").between(as_ts(since), as_ts(until)) & (F.col("state") != COMPLETE))
    open_again = F.col("started").isNull() | (F.col("resolved") & (F.col("picked_at") > F.col("started")))
    counted = (
        window.join(last, ["store_id", "sku"], "left").where(open_again)
        .groupBy("store_id", "sku")
        .agg(F.count("*").alias("orders"), F.sum(F.col("asked") - F.col("picked")).alias("missing_units"))
        .join(limits.select("store_id", "limit"), "store_id", "left")
    )
    return top_k_by_column(
        counted, ["store_id"], [F.col("orders").desc(), F.col("missing_units").desc()], [F.col("sku").asc()],
        F.coalesce("limit", F.lit(default_limit)), cap,
    ).drop("limit")


def missing_by_block(states: DataFrame, products: DataFrame, brands: Sequence[str] | None = None) -> DataFrame:
    """Missing items per product, store, brand and half-hour block of the picking time."""
    block = F.window("picked_at", "30 minutes")
    named = states.where(F.col("state") == MISSING).join(products.select("sku", "brand"), "sku")
    if brands:
        named = named.where(F.col("brand").isin(*brands))
    return (
        named.groupBy(block.alias("block"), "sku", "store_id", "brand")
        .agg(F.count_distinct("order_id").alias("orders"), F.sum(F.col("asked") - F.col("picked")).alias("missing_units"))
        .select(
            F.col("block.start").alias("block_start"), F.col("block.end").alias("block_end"),
            "sku", "store_id", "brand", "orders", "missing_units",
        )
    )


def missing_now(states: DataFrame, now, minutes: int = 30) -> DataFrame:
    """Unfulfilled products picked in the last minutes, for the service desk."""
    now = as_ts(now)
    recent = states.where(
        F.col("state").isin(MISSING, SUBSTITUTED)
        & (F.col("picked_at") >= now - F.expr(f"INTERVAL '{minutes}' MINUTE")) & (F.col("picked_at") <= now)
    )
    return recent.groupBy("picked_at", "sku").agg(
        F.sum(F.col("asked") - F.col("picked")).alias("missing_units"), F.count_distinct("order_id").alias("orders")
    )


def audits_per_store(orders: DataFrame, changes: DataFrame, dispatches: DataFrame, day) -> DataFrame:
    """Distinct audited orders (state 5) invoiced on ``day`` per store and carrier."""
    today = orders.where(F.col("day") == as_date(day)).select("order_id", "store_id")
    audited = changes.where(F.col("new_state") == 5).select("order_id").distinct()
    carriers = dispatches.select("order_id", "carrier").distinct()
    return (
        today.join(audited, "order_id", "left_semi").join(carriers, "order_id", "left")
        .groupBy("store_id", "carrier").agg(F.count_distinct("order_id").alias("audits"))
    )


def inventory_movements(states: DataFrame, robot: int, day) -> DataFrame:
    """Movement rows for lines picked by hand on ``day``; weights are moved in grams."""
    by_hand = states.where((F.col("day") == as_date(day)) & (F.col("picker") != robot) & (F.col("picked") > 0))
    weighed = F.col("uom") == "kg"
    return by_hand.select(
        F.col("order_id").alias("reference"), "sku", F.lit("inc").alias("operation"),
        F.when(weighed, "XX").otherwise("JN").alias("reason"),
        F.floor(F.when(weighed, F.col("picked") * 1000).otherwise(F.col("picked"))).cast("long").alias("quantity"),
    )


def verify_alerts(alerts: DataFrame, stock: DataFrame) -> DataFrame:
    """System stock of the products with a live alert, one join instead of a query per store."""
    live = alerts.where("in_system").select("store_id", "sku")
    return stock.join(live, ["store_id", "sku"], "left_semi")


def upcoming_floor_items(lines: DataFrame, dispatches: DataFrame, locations: DataFrame, start, minutes: int = 5) -> DataFrame:
    """Lines stored on the sales floor whose window starts within ``minutes`` of ``start``."""
    slack = F.expr(f"INTERVAL '{minutes}' MINUTE")
    near = dispatches.where(F.col("window_start").between(as_ts(start) - slack, as_ts(start) + slack))
    floor = locations.where(F.col("side") == "FLO").select("sku")
    windows = near.select("order_id", "window_start", "window_end").distinct()
    return (
        lines.join(floor, "sku", "left_semi").join(windows, "order_id")
        .withColumn("asked_kg", F.col("asked") * F.col("multiplier"))
    )


def store_weights(states: DataFrame, stored: DataFrame, monday, weeks: int = 3) -> DataFrame:
    """Weekly found rate and safety-stock weight per store, plus a row for the current week.

    Past weeks aim at 98.6 %, the current one at 98 % of the rolling three-week rate; the latest past week
    keeps the stored weight. Weeks without lines count as empty instead of shifting the rolling window.
    """
    monday = as_date(monday)
    age = F.floor((F.datediff(monday, "day") - 1) / 7).cast("int") + 1
    weekly = (
        states.where(F.col("day").between(F.date_sub(monday, 7 * weeks), F.date_sub(monday, 1))).withColumn("age", age)
        .groupBy("store_id", "age").agg(
            count_when(F.col("state") == COMPLETE).alias("complete"), count_when(~F.col("substitute")).alias("requested")
        )
        .join(stored, "store_id")
    )

    def weight(target: float, rate: Column) -> Column:
        return F.round(clip(F.lit(0.3) + (F.lit(target) - rate) * 0.1, 0.3, 1.5), 2)

    rate = ratio(F.col("complete"), F.col("requested")) * 100
    past = weekly.select(
        "store_id", "age", "complete", "requested", F.round(rate, 2).alias("rate"),
        F.when(F.col("age") == 1, F.col("weight")).otherwise(weight(98.6, rate)).alias("weight"),
    )
    total = weekly.groupBy("store_id").agg((ratio(F.sum("complete"), F.sum("requested")) * 100).alias("_rate"))
    current = total.select(
        "store_id", F.lit(0).alias("age"), F.lit(None).cast("long").alias("complete"),
        F.lit(None).cast("long").alias("requested"), F.round("_rate", 2).alias("rate"),
        weight(98.0, F.col("_rate")).alias("weight"),
    )
    return past.unionByName(current)
