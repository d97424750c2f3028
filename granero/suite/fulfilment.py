"""Fulfilment queries."""

import uuid

from pyspark.sql import functions as F

from granero.plans import daily
from granero.plans import fulfilment as plan
from granero.session import shared_folder, track
from granero.sources import snapshots
from granero.suite.registry import QUERIES, feed, query

NOW = "1998-06-15 13:10:00"
MEAT = ("PROMO",)

# The classified lines written the long way round, as the shared start of several oracles.
STATES = """
w AS (SELECT line_id, SUM(weight_g) / 1000 AS kg FROM weights GROUP BY 1),
c AS (SELECT l.*, s.category, l.substitute_of IS NOT NULL AS substitute,
        EXISTS (SELECT 1 FROM lines x WHERE x.substitute_of = l.line_id) AS substituted,
        CASE WHEN uom = 'kg' THEN l.asked * CAST(multiplier AS DOUBLE) ELSE l.asked END AS a,
        CASE WHEN uom = 'kg' THEN coalesce(w.kg, 0) ELSE coalesce(l.picked, 0) END AS p
      FROM lines l LEFT JOIN w USING (line_id) LEFT JOIN skus s ON s.sku = l.sku),
states AS (SELECT c.* EXCLUDE (asked, picked), a AS asked, p AS picked,
   CASE WHEN substitute THEN NULL WHEN substituted THEN 2
        WHEN uom = 'kg' AND p * 1000 >= a * (CASE WHEN category = 'PROMO' THEN 700 ELSE 800 END) THEN 3
        WHEN uom = 'un' AND p >= a THEN 3 ELSE 1 END AS state,
   CAST(day AS TIMESTAMP) + INTERVAL 1 MINUTE * (480 + (order_id * 7 + sku) % 600) AS picked_at FROM c)"""


def _states(lines, weights, skus):
    states = plan.line_states(lines, weights, skus, MEAT)
    minute = F.expr("INTERVAL '1' MINUTE * (480 + (order_id * 7 + sku) % 600)")
    return states.withColumn("picked_at", F.col("day").cast("timestamp") + minute)


@query("d01_line_states", "lines weights skus", f"""
WITH {STATES} SELECT line_id, sku, substitute, substituted, CAST(asked AS DOUBLE) AS asked, CAST(picked AS DOUBLE) AS picked,
 state, (SELECT any_value(o.sku) FROM lines o WHERE o.line_id = states.substitute_of) AS original_sku FROM states""", prepared="lines")
def _(lines, weights, skus):
    states = plan.line_states(lines, weights, skus, MEAT, with_original=True)
    return states.select("line_id", "sku", "substitute", "substituted", "asked", "picked", "state", "original_sku")


PROMISES = """
d AS (SELECT * FROM dispatches QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY id DESC) = 1),
e AS (SELECT order_id, created FROM changes WHERE new_state = 90 QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY id DESC) = 1),
j AS (SELECT d.*, b.state, b.store_id, b.day, CAST(e.created AS DATE) AS dd, strftime(e.created, '%H%M') AS t, strftime(window_start, '%H%M') AS o,
        strftime(window_end + INTERVAL 20 MINUTE, '%H%M') AS c, strftime(window_end, '%H%M') AS c0
      FROM d JOIN baskets b USING (order_id) LEFT JOIN e USING (order_id) WHERE b.state <> 80),
promises AS (SELECT *, CASE WHEN state >= 100 THEN 0 WHEN dd = promised THEN 10 WHEN dd < promised THEN 20 WHEN dd > promised THEN 30
   WHEN promised >= DATE '1998-06-15' THEN 40 ELSE 999 END AS on_day,
 CASE WHEN state >= 100 THEN 0
      WHEN dd < promised THEN 20 WHEN dd > promised THEN 30
      WHEN dd = promised THEN CASE WHEN t < o THEN 20 WHEN t > c THEN 30 ELSE 10 END
      WHEN promised = DATE '1998-06-15' AND c0 > '1340' THEN 40 WHEN promised > DATE '1998-06-15' THEN 40 ELSE 999 END AS on_time FROM j)"""


@query("d02_promise_codes", "baskets dispatches changes", f"""
WITH {PROMISES} SELECT order_id, id, on_day, on_time FROM promises""")
def _(baskets, dispatches, changes):
    return plan.promise_codes(dispatches, baskets, changes, NOW).select("order_id", "id", "on_day", "on_time")


@query("d03_expire_pending", "baskets dispatches changes", f"""
WITH {PROMISES} SELECT order_id, CASE WHEN on_day = 40 AND window_end BETWEEN TIMESTAMP '1998-06-15' AND TIMESTAMP '1998-06-16' THEN 999 ELSE on_day END AS on_day,
 CASE WHEN on_time = 40 AND window_end BETWEEN TIMESTAMP '1998-06-15 16:10:00' AND TIMESTAMP '1998-06-16 16:10:00' THEN 999 ELSE on_time END AS on_time FROM promises""")
def _(baskets, dispatches, changes):
    codes = plan.promise_codes(dispatches, baskets, changes, NOW)
    return plan.expire_pending(codes, "1998-06-16 16:10:00").select("order_id", "on_day", "on_time")


@query("d07_store_board", "sales baskets lines weights skus dispatches changes", f"""
WITH {STATES}, {PROMISES},
s AS (SELECT b.store_id, b.day, SUM(net)::BIGINT AS net_sales, count(DISTINCT order_id) AS orders FROM sales JOIN baskets b USING (order_id) GROUP BY 1, 2),
o AS (SELECT b.store_id, b.day, order_id, SUM((NOT substitute)::INT) AS r, SUM((states.state = 3)::INT) AS k, SUM(substituted::INT) AS u, MIN(states.state) AS m
      FROM states JOIN baskets b USING (order_id) GROUP BY 1, 2, 3),
f AS (SELECT store_id, day, coalesce(SUM(k), 0)::BIGINT AS complete_items, SUM(u)::BIGINT AS substituted_items, SUM(r)::BIGINT AS requested_items, coalesce(count_if(m = 3), 0)::BIGINT AS perfect_orders FROM o GROUP BY 1, 2),
p AS (SELECT store_id, day, count_if(on_time = 10)::BIGINT AS on_time_orders, count_if(on_time = 20)::BIGINT AS early_orders FROM promises GROUP BY 1, 2),
x AS (SELECT store_id, day, SUM(net)::BIGINT AS floor_sales FROM sales GROUP BY 1, 2)
SELECT s.store_id, CAST(s.day AS VARCHAR) AS day, net_sales, orders, complete_items, substituted_items, requested_items, perfect_orders,
 on_time_orders, early_orders, floor_sales, net_sales / orders AS average_ticket
FROM s JOIN f USING (store_id, day) JOIN p USING (store_id, day) JOIN x ON x.store_id = s.store_id AND x.day = s.day""", prepared="lines")
def _(sales, baskets, lines, weights, skus, dispatches, changes):
    owner = baskets.select("order_id", F.col("store_id").cast("int").alias("store_id"), "day")
    return plan.store_board(
        sales.drop("store_id", "day").join(owner, "order_id"),
        _states(lines, weights, skus).drop("store_id", "day").join(owner, "order_id"),
        plan.promise_codes(dispatches, baskets, changes, NOW).join(owner, "order_id"),
        sales.withColumn("store_id", F.col("store_id").cast("int")),
    )


@query("d07_store_board_refresh", "sales baskets lines weights skus dispatches changes", QUERIES["d07_store_board"].oracle, prepared="lines")
def _(sales, baskets, lines, weights, skus, dispatches, changes):
    """A board made before a week's open orders came in, then refreshed on their days only."""
    spark = baskets.sparkSession
    path = f"{shared_folder(spark)}/granero-{uuid.uuid4().hex}"
    track(spark, path)
    known = baskets.where("NOT (status = 'P' AND day BETWEEN DATE'1998-06-08' AND DATE'1998-06-15')")

    def board(orders, floor):
        owner = orders.select("order_id", F.col("store_id").cast("int").alias("store_id"), "day")
        own = lines.join(owner.select("order_id"), "order_id", "left_semi")
        return plan.store_board(
            sales.drop("store_id", "day").join(owner, "order_id"),
            _states(own, weights, skus).drop("store_id", "day").join(owner, "order_id"),
            plan.promise_codes(dispatches, orders, changes, NOW).join(owner, "order_id"),
            floor.withColumn("store_id", F.col("store_id").cast("int")),
        )

    first = board(known, sales)
    daily.create(first, path, ["store_id", "day"])
    arrived = baskets.join(known, "order_id", "left_anti").select("order_id")
    daily.refresh_days(
        spark, path, first.schema, daily.days_of(arrived, "order_id", known, baskets),
        lambda days: board(baskets.where(F.col("day").isin(days)), sales.where(F.col("day").isin(days))),
    )
    return snapshots.read(spark, path, first.schema)


@query("d09_stockout_ranking", "lines baskets stores", """
WITH t AS (SELECT b.store_id, sku, SUM(asked - picked)::BIGINT AS missing_units, count(DISTINCT order_id) AS affected_orders
  FROM lines JOIN baskets b USING (order_id) WHERE asked > picked AND b.day + 1 >= DATE '1998-06-15' - 400 AND b.status <> 'P' AND b.store_id IN (SELECT store_id FROM stores WHERE status = 1) GROUP BY 1, 2),
r AS (SELECT *, dense_rank() OVER (ORDER BY missing_units DESC) AS missing_units_rank, dense_rank() OVER (ORDER BY affected_orders DESC) AS affected_orders_rank FROM t)
SELECT *, 5 * missing_units_rank + 5 * affected_orders_rank AS score,
 row_number() OVER (PARTITION BY store_id ORDER BY 5 * missing_units_rank + 5 * affected_orders_rank, sku) AS ranking FROM r""")
def _(lines, baskets, stores):
    orders = baskets.select(
        "order_id", "store_id", F.date_add("day", 1).alias("picked_on"), F.when(F.col("status") != "P", F.col("day")).alias("invoiced_on")
    )
    return plan.stockout_ranking(lines, orders, stores.withColumn("store_id", F.col("store_id").cast("int")), "1998-06-15", 400)


ALERTS = """SELECT item AS sku, id % 100 AS store_id, CAST('1998-01-01' AS TIMESTAMP) + INTERVAL '1' DAY * (id % 300) AS started,
 kind IN ('view', 'click') AS resolved, kind <> 'error' AS in_system FROM moves"""
feed("alerts", ["moves"], ALERTS)


@query("d49_shortage_alerts", "lines weights skus alerts stores", f"""
WITH {STATES}, a AS (SELECT * FROM alerts WHERE started >= TIMESTAMP '1998-06-03' QUALIFY row_number() OVER (PARTITION BY store_id, sku ORDER BY started DESC) = 1),
t AS (SELECT s.store_id, s.sku, count(*) AS orders, SUM(asked - picked) AS missing_units FROM states s LEFT JOIN a ON a.store_id = s.store_id AND a.sku = s.sku
  WHERE picked_at BETWEEN TIMESTAMP '1998-03-01' AND TIMESTAMP '1998-09-01' AND state <> 3 AND (a.started IS NULL OR (a.resolved AND picked_at > a.started)) GROUP BY 1, 2),
k AS (SELECT t.*, coalesce(CASE WHEN st.status = 1 THEN 2 + district % 9 END, 5) AS k,
  dense_rank() OVER (PARTITION BY t.store_id ORDER BY orders DESC, missing_units DESC) AS dense,
  row_number() OVER (PARTITION BY t.store_id ORDER BY orders DESC, missing_units DESC, sku) AS row_in_group FROM t LEFT JOIN stores st USING (store_id))
SELECT store_id, sku, orders, CAST(missing_units AS DOUBLE) AS missing_units, dense, row_in_group FROM k WHERE dense <= k AND row_in_group <= 15""")
def _(lines, weights, skus, alerts, stores):
    limits = stores.select("store_id", F.when(F.col("status") == 1, 2 + F.col("district") % 9).alias("limit"))
    return plan.shortage_alerts(_states(lines, weights, skus), limits, alerts, "1998-03-01", "1998-09-01")


@query("d50_missing_by_block", "lines weights skus", f"""
WITH {STATES} SELECT strftime(time_bucket(INTERVAL 30 MINUTE, picked_at), '%Y-%m-%d %H:%M:%S') AS block_start,
 strftime(time_bucket(INTERVAL 30 MINUTE, picked_at) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS block_end,
 sku, store_id, brand, count(DISTINCT order_id) AS orders, CAST(SUM(asked - picked) AS DOUBLE) AS missing_units
FROM states JOIN skus USING (sku) WHERE state = 1 GROUP BY ALL""")
def _(lines, weights, skus):
    return plan.missing_by_block(_states(lines, weights, skus), skus)


@query("d50_missing_now", "lines weights skus", f"""
WITH {STATES} SELECT strftime(picked_at, '%Y-%m-%d %H:%M:%S') AS picked_at, sku, CAST(SUM(asked - picked) AS DOUBLE) AS missing_units,
 count(DISTINCT order_id) AS orders FROM states WHERE state IN (1, 2)
 AND picked_at BETWEEN TIMESTAMP '1998-06-15 13:10:00' - INTERVAL 43200 MINUTE AND TIMESTAMP '1998-06-15 13:10:00' GROUP BY 1, 2""")
def _(lines, weights, skus):
    return plan.missing_now(_states(lines, weights, skus), NOW, minutes=43200)


@query("d90_audits", "baskets changes dispatches", """
SELECT b.store_id, d.carrier, count(DISTINCT b.order_id) AS audits FROM baskets b JOIN changes c ON c.order_id = b.order_id AND c.new_state = 5
LEFT JOIN dispatches d ON d.order_id = b.order_id WHERE b.day = DATE '1998-06-15' GROUP BY 1, 2""")
def _(baskets, changes, dispatches):
    return plan.audits_per_store(baskets, changes, dispatches, "1998-06-15")


@query("d92_inventory_movements", "lines weights skus", f"""
WITH {STATES} SELECT order_id AS reference, sku, 'inc' AS operation, CASE uom WHEN 'kg' THEN 'XX' ELSE 'JN' END AS reason,
 CAST(floor(CASE uom WHEN 'kg' THEN picked * 1000 ELSE picked END) AS BIGINT) AS quantity FROM states
WHERE day = DATE '1998-06-15' AND line_no <> 1 AND picked > 0""")
def _(lines, weights, skus):
    states = _states(lines, weights, skus).withColumn("picker", F.col("line_no"))
    return plan.inventory_movements(states, 1, "1998-06-15")


@query("d95_verify_alerts", "alerts assortment", """
SELECT store_id, sku, stock FROM assortment a WHERE EXISTS (SELECT 1 FROM alerts x WHERE x.in_system AND x.store_id = a.store_id AND x.sku = a.sku)""")
def _(alerts, assortment):
    return plan.verify_alerts(alerts, assortment).select("store_id", "sku", "stock")


@query("d97_upcoming_floor_items", "lines dispatches skus", """
SELECT l.line_id, strftime(w.window_start, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(l.asked * l.multiplier AS DOUBLE) AS asked_kg
FROM lines l JOIN (SELECT DISTINCT order_id, window_start FROM dispatches WHERE window_start BETWEEN TIMESTAMP '1998-06-15 09:55:00' AND TIMESTAMP '1998-06-15 10:05:00') w USING (order_id)
WHERE l.sku IN (SELECT sku FROM skus WHERE size > 20)""")
def _(lines, dispatches, skus):
    places = skus.select("sku", F.when(F.col("size") > 20, "FLO").otherwise("REG").alias("side"))
    items = plan.upcoming_floor_items(lines, dispatches, places, "1998-06-15 10:00:00")
    return items.select("line_id", "window_start", "asked_kg")


@query("d47_store_weights", "lines weights skus stores", f"""
WITH {STATES}, k AS (SELECT s.store_id, CASE WHEN day >= DATE '1998-06-08' THEN 1 WHEN day >= DATE '1998-06-01' THEN 2 ELSE 3 END AS age,
   coalesce(count_if(state = 3), 0)::BIGINT AS complete, count_if(NOT substitute)::BIGINT AS requested, any_value(1 + st.district / 100) AS stored FROM states s JOIN stores st USING (store_id)
   WHERE day BETWEEN DATE '1998-05-25' AND DATE '1998-06-14' GROUP BY 1, 2)
SELECT store_id, age, complete, requested, round(complete / nullif(requested, 0) * 100, 2) AS rate,
  CASE WHEN age = 1 THEN stored WHEN requested > 0 THEN round(least(1.5::DOUBLE, greatest(0.3::DOUBLE, 0.3::DOUBLE + (98.6::DOUBLE - complete / requested * 100) * 0.1::DOUBLE)), 2) END AS weight FROM k
UNION ALL SELECT store_id, 0, NULL, NULL, round(SUM(complete)::BIGINT / nullif(SUM(requested), 0)::BIGINT * 100, 2),
  CASE WHEN SUM(requested) > 0 THEN round(least(1.5::DOUBLE, greatest(0.3::DOUBLE, 0.3::DOUBLE + (98::DOUBLE - SUM(complete)::BIGINT / SUM(requested)::BIGINT * 100) * 0.1::DOUBLE)), 2) END FROM k GROUP BY 1""")
def _(lines, weights, skus, stores):
    stored = stores.select("store_id", (1 + F.col("district") / 100).alias("weight"))
    return plan.store_weights(_states(lines, weights, skus), stored, "1998-06-15")
