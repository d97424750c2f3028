"""Margin and logistics queries."""

from pyspark.sql import functions as F

from granero.functions import dates
from granero.plans import logistics
from granero.plans import margin as plan
from granero.session import cut_lineage
from granero.suite.registry import feed, query

DAY = "1998-06-15"

feed("deals", ["lineitem"], """
SELECT (l_orderkey * 10 + l_linenumber) * 100 + 1 AS line_id, l_partkey AS sku, l_partkey * 100 + l_suppkey % 50 AS n_promo,
 CASE CAST((l_partkey + l_suppkey) % 5 AS INT) WHEN 0 THEN 'Gratis DESPACHO' WHEN 1 THEN 'flete' WHEN 2 THEN 'Beneficio Colaborador' WHEN 3 THEN 'Cupon referido' ELSE 'Oferta' END AS name,
 CAST(round(l_discount * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) AS value, l_suppkey % 9 AS promo_id FROM lineitem""")
feed("funding", ["promos"], """
SELECT sku, sku * 100 + mechanic AS n_promo, channel, funding, negotiated, event, start_day - 300 AS start_day, end_day AS end_day FROM promos""")
feed("order_lines", ["lines"], """
SELECT line_id, order_id, sku, store_id, day, uom, substitute_of, CASE WHEN substitute_of IS NULL THEN asked ELSE 0 END AS asked, coalesce(picked, 0) AS picked,
 CASE WHEN uom = 'kg' THEN 'KG' ELSE 'UN' END AS unit, price, price + 50 AS list_price FROM lines""")

MARGIN = """
w AS (SELECT line_id, CAST(SUM(weight_g) * 0.001 AS DECIMAL(18, 3)) AS kg, SUM(weight_g)::BIGINT * 3 AS sp FROM weights GROUP BY 1),
cost AS (SELECT l.sku, b.store_id, b.day, SUM(price * asked)::BIGINT AS cogs, SUM(picked)::BIGINT AS sold FROM order_lines l JOIN baskets b USING (order_id) WHERE b.status <> 'P' GROUP BY 1, 2, 3),
o AS (SELECT l.line_id, l.order_id, l.sku, b.day, l.asked = 0 AS substitute, coalesce(w.kg, CAST(l.picked AS DECIMAL(18, 3))) AS units, coalesce(w.sp, l.price) AS unit_price,
  CASE WHEN l.unit = 'KG' AND picked <> 0 THEN coalesce(w.sp, l.price) ELSE least(l.price * picked, coalesce((SELECT any_value(q.price * q.asked) FROM order_lines q WHERE q.line_id = l.substitute_of), l.price * picked)) END AS gross,
  coalesce((CASE WHEN sold = 0 THEN 0 ELSE round(cogs / sold) END)::BIGINT * (1 + s.size % 3), 0) AS unit_cost
  FROM order_lines l JOIN baskets b USING (order_id) JOIN skus s USING (sku) LEFT JOIN w USING (line_id) LEFT JOIN cost c ON c.sku = l.sku AND c.store_id = b.store_id AND c.day = b.day),
g AS (SELECT line_id, CASE WHEN name IN ('Gratis DESPACHO', 'flete') THEN value ELSE 0 END AS ds, funding, channel, MIN(CASE WHEN name IN ('Gratis DESPACHO', 'flete') THEN 0 ELSE value END) AS sv, MIN(negotiated) AS ng, bool_and(negotiated IS NOT NULL) AS al
  FROM deals LEFT JOIN funding USING (n_promo, sku) GROUP BY 1, 2, 3, 4),
p AS (SELECT line_id, MIN(ds) AS ds, SUM(CASE WHEN coalesce(channel, '') <> '70' THEN sv ELSE 0 END)::BIGINT AS cs, SUM(CASE WHEN channel = '70' THEN sv ELSE 0 END)::BIGINT AS es, SUM(ng)::BIGINT AS ng,
  SUM(CASE WHEN funding = 'SELL OUT' AND coalesce(channel, '') <> '70' THEN ng ELSE 0 END)::BIGINT AS cf, SUM(CASE WHEN funding = 'SELL OUT' AND channel = '70' THEN ng ELSE 0 END)::BIGINT AS ef, bool_or(al) AS al FROM g GROUP BY 1),
m AS (SELECT o.* EXCLUDE (gross), CAST(gross AS BIGINT) AS gross, CAST(round(gross / 1.19::DOUBLE) AS BIGINT) AS net, coalesce(ds, 0) AS ds, coalesce(cs, 0) AS cs, coalesce(es, 0) AS es, coalesce(cf, 0) * units AS cf, coalesce(ef, 0) * units AS ef, coalesce(ng, 0) AS ng, coalesce(al, false) AS promoted FROM o LEFT JOIN p USING (line_id)),
m1 AS (SELECT *, net - units * unit_cost AS margin_1, net - units * unit_cost + units * ng AS margin_2 FROM m)"""
MARGIN_FEEDS = "order_lines baskets weights skus deals funding"


def _margins(order_lines, baskets, weights, skus, deals, funding):
    scale = weights.withColumn("price", F.col("weight_g") * 3)
    orders = baskets.select("order_id", "store_id", "day")
    costs = (
        order_lines.drop("store_id", "day").join(baskets.where("status <> 'P'").select("order_id", "store_id", "day"), "order_id")
        .groupBy("sku", "store_id", "day").agg(F.sum(F.col("price") * F.col("asked")).alias("cogs"), F.sum("picked").alias("sold"))
    )
    packs = skus.select("sku", (1 + F.col("size") % 3).alias("pack"))
    return plan.line_margins(orders, order_lines, scale, costs, packs, deals, funding.drop("start_day", "end_day", "event"))


@query("d12_line_margins", MARGIN_FEEDS, f"""
WITH {MARGIN} SELECT line_id, sku, substitute, CAST(units AS DOUBLE) AS units, unit_price, gross, net, unit_cost, ds AS delivery_saving, cs AS chain_saving, es AS ecommerce_saving, CAST(cf AS DOUBLE) AS chain_funding, CAST(ef AS DOUBLE) AS ecommerce_funding,
 CAST(margin_1 AS DOUBLE) AS margin_1, CAST(margin_2 AS DOUBLE) AS margin_2, promoted FROM m1""", prepared="lines")
def _(order_lines, baskets, weights, skus, deals, funding):
    return _margins(order_lines, baskets, weights, skus, deals, funding).drop("order_id", "day")


LATE = """f AS (SELECT m1.line_id, SUM(r.negotiated)::BIGINT AS n FROM m1 JOIN funding r ON r.sku = m1.sku AND r.funding = 'SELL OUT' AND r.event <> 402 AND m1.day BETWEEN r.start_day AND r.end_day WHERE substitute AND NOT promoted GROUP BY 1),
m2 AS (SELECT m1.*, coalesce(n, 0) * units AS late_funding, margin_2 + coalesce(n, 0) * units AS final_2 FROM m1 LEFT JOIN f USING (line_id))"""


@query("d12_fund_substitutes", MARGIN_FEEDS, f"WITH {MARGIN}, {LATE} SELECT line_id, CAST(late_funding AS DOUBLE) AS late_funding, CAST(final_2 AS DOUBLE) AS margin_2 FROM m2", prepared="lines")
def _(order_lines, baskets, weights, skus, deals, funding):
    margins = _margins(order_lines, baskets, weights, skus, deals, funding)
    needed = margins.select("line_id", "sku", "day", "substitute", "promoted", "units", "margin_2")
    return plan.fund_substitutes(needed, funding, (402,)).select("line_id", "late_funding", "margin_2")


@query("d12_fill_zero_cost", MARGIN_FEEDS, f"""
WITH {MARGIN}, z AS (SELECT m1.*, CASE WHEN unit_cost = 0 THEN s.list_price END AS c FROM m1 JOIN skus s USING (sku))
SELECT line_id, coalesce(c, unit_cost) AS unit_cost, CAST(round(margin_1 - coalesce(c, 0) * units) AS DOUBLE) AS margin_1, CAST(round(margin_2 - coalesce(c, 0) * units) AS DOUBLE) AS margin_2 FROM z""", prepared="lines")
def _(order_lines, baskets, weights, skus, deals, funding):
    margins = _margins(order_lines, baskets, weights, skus, deals, funding)
    return plan.fill_zero_cost(margins, skus.select("sku", F.col("list_price").alias("cost"))).select(
        "line_id", "unit_cost", "margin_1", "margin_2"
    )


@query("d14_margin_losses", "order_lines baskets deals funding", """
WITH s AS (SELECT l.* EXCLUDE (day), b.day FROM order_lines l JOIN baskets b USING (order_id) WHERE b.day >= DATE '1998-06-15' - 700),
d AS (SELECT s.day, s.picked, x.name, x.value, x.promo_id, f.end_day, f.funding, f.negotiated FROM s JOIN deals x USING (line_id) LEFT JOIN funding f ON f.n_promo = x.n_promo AND f.sku = x.sku WHERE x.name NOT ILIKE '%despacho%'),
a AS (SELECT day, SUM(CASE WHEN name ILIKE '%colaborador%' THEN value ELSE 0 END)::BIGINT AS staff, SUM(CASE WHEN name ILIKE '%referido%' THEN value ELSE 0 END)::BIGINT AS referral, SUM(CASE WHEN promo_id IN (1, 2) THEN value ELSE 0 END)::BIGINT AS gold,
  coalesce(SUM(CASE WHEN day > end_day AND funding NOT ILIKE '%SIN FINANCIAMIENTO%' AND name NOT ILIKE '%cupon%' AND name NOT ILIKE '%colaborador%' AND promo_id NOT IN (1, 2) THEN -negotiated * picked ELSE 0 END), 0)::BIGINT AS sell_out_gap FROM d GROUP BY 1),
l AS (SELECT t.day, -SUM(t.list_price * t.picked - q.list_price * q.asked)::BIGINT AS loss FROM s t JOIN s q ON t.substitute_of = q.line_id WHERE q.asked > 0 AND q.uom <> 'kg' AND t.uom <> 'kg' AND t.list_price * t.picked > q.list_price * q.asked GROUP BY 1),
v AS (SELECT day, floor(SUM(coalesce(CASE WHEN line_id % 7 = 0 THEN price END, list_price * picked))::BIGINT / 1.19::DOUBLE)::BIGINT AS nu, floor(SUM(coalesce(CASE WHEN line_id % 7 = 0 THEN price END, price * picked))::BIGINT / 1.19::DOUBLE)::BIGINT AS ns FROM s GROUP BY 1)
SELECT CAST(a.day AS VARCHAR) AS day, staff, referral, gold, sell_out_gap, coalesce(loss, 0) AS substitution_loss, nu AS net_undiscounted, ns AS net_sales FROM a LEFT JOIN l USING (day) LEFT JOIN v USING (day)""")
def _(order_lines, baskets, deals, funding):
    lines = order_lines.withColumn("scale_price", F.expr("CASE WHEN line_id % 7 = 0 THEN price END"))
    programmes = {
        "staff": F.col("name").ilike("%Colaborador%"), "referral": F.col("name").ilike("%referido%"), "gold": F.col("promo_id").isin(1, 2),
    }
    return plan.margin_losses(lines, baskets, deals, funding, programmes, ("%Cupon%",), DAY, 700)


@query("d48_regular_sales", "sales order_lines skus", """
WITH p AS (SELECT DISTINCT order_id, sku, list_price, price AS sale_price FROM order_lines), j AS (SELECT s.order_id, s.sku, s.units, p.list_price, sale_price, CASE k.unit WHEN 'ST' THEN 'UN' ELSE k.unit END AS unit FROM sales s JOIN p USING (order_id, sku) JOIN skus k USING (sku)),
d AS (SELECT *, 1 - (CASE WHEN unit IN ('KG', 'KGV') THEN sale_price / units WHEN unit = 'UN' THEN CAST(sale_price AS DOUBLE) END) / list_price AS discount FROM j)
SELECT order_id, sku, units, discount, coalesce(discount >= 0.34, false) AS deep FROM d""")
def _(sales, order_lines, skus):
    units = skus.select("sku", F.when(F.col("unit") == "ST", "UN").otherwise(F.col("unit")).alias("unit"))
    lines = order_lines.select("order_id", "sku", "list_price", F.col("price").alias("sale_price"))
    rows = plan.regular_sales(sales.join(units, "sku"), lines)
    return rows.select("order_id", "sku", "units", "discount", "deep")


@query("d68_profit_and_loss", "sales skus stores", """
SELECT s.sku, s.store_id, s.order_id, s.net, k.brand, k.category FROM sales s LEFT JOIN skus k ON k.sku = s.sku WHERE s.day = DATE '1998-06-15' AND s.store_id NOT IN (SELECT store_id FROM stores WHERE status = 0)""")
def _(sales, skus, stores):
    rows = plan.profit_and_loss(sales, skus, stores.where("status = 0").select("store_id"), DAY)
    return rows.select("sku", "store_id", "order_id", "net", "brand", "category")


@query("d69_cost_facts", "sales skus stores", """
SELECT CAST(day AS VARCHAR) AS day, s.units AS sold, s.gross AS cogs, st.label, k.name FROM sales s LEFT JOIN stores st USING (store_id) LEFT JOIN (SELECT * FROM skus WHERE size > 3) k ON k.sku = s.sku""")
def _(sales, skus, stores):
    facts = sales.select("day", F.col("units").alias("sold"), F.col("gross").alias("cogs"), F.col("store_id").alias("store_key"), F.col("sku").alias("sku_key"))
    return plan.cost_facts(
        facts, stores.select(F.col("store_id").alias("store_key"), "label"), skus.where("size > 3").select(F.col("sku").alias("sku_key"), "name")
    )


@query("d99_cost_of_sales", "sales skus", """
WITH a AS (SELECT sku, store_id, day, MIN(units - 1) AS bu, MIN(gross) AS c FROM sales WHERE pct <> 3 GROUP BY 1, 2, 3), s AS (SELECT sku, store_id, day, SUM(net)::BIGINT AS net, SUM(units)::BIGINT AS units, count(DISTINCT order_id) AS baskets FROM sales GROUP BY 1, 2, 3)
SELECT s.sku, s.store_id, CAST(s.day AS VARCHAR) AS day, net, (CASE WHEN bu = 0 THEN 0.0::DOUBLE ELSE c / bu END) * ((1 + size % 4) / (1 + size % 3)) * units AS cost, baskets FROM s JOIN skus USING (sku) LEFT JOIN a ON a.sku = s.sku AND a.store_id = s.store_id AND a.day = s.day""")
def _(sales, skus):
    books = sales.where("pct <> 3").select("sku", "store_id", "day", (F.col("units") - 1).alias("base_units"), F.col("gross").alias("cost"))
    units = skus.selectExpr("sku", "1 + size % 4 AS numerator", "1 + size % 3 AS denominator")
    return plan.cost_of_sales(sales, books, units)


# ---------------------------------------------------------------- logistics

feed("carriers", ["stores"], """
SELECT store_id AS carrier, district AS store_id, 'OP' || CAST(district % 4 AS VARCHAR(2)) AS operator, 'M' || CAST(store_id % 2 AS VARCHAR(2)) AS model, CAST(1 + store_id % 3 AS INT) AS kind, 900 + store_id AS base, 30 + store_id % 7 AS per_sku,
 100 + district AS per_km, 20000 + 1000 * (store_id % 5) AS guarantee FROM stores""")
feed("factors", ["nation"], """
SELECT CASE WHEN n_nationkey = 0 THEN 'default' ELSE 'OP' || CAST(n_nationkey % 3 AS VARCHAR(2)) END AS operator, 'M' || CAST(CAST(floor(n_nationkey / 3) AS INT) % 2 AS VARCHAR(2)) AS model, 100 + n_nationkey AS factor, 1 + n_nationkey % 2 AS pay, 1 + n_nationkey % 3 AS guarantee_factor,
 CAST('1994-01-01' AS DATE) + 300 * CAST(floor(n_nationkey / 6) AS INT) AS from_day, CASE WHEN n_nationkey < 19 THEN CAST('1994-01-01' AS DATE) + 300 * CAST(floor(n_nationkey / 6) AS INT) + 299 END AS to_day FROM nation""")
feed("staffed", ["dispatches", "carriers"], """
SELECT d.promised AS day, c.store_id, d.carrier, c.model, c.operator, MAX(d.order_id) % 4 AS headcount, CAST(MIN(d.order_id) % 2 AS INT) AS shared FROM dispatches d JOIN carriers c ON c.carrier = d.carrier
GROUP BY d.promised, c.store_id, d.carrier, c.model, c.operator""")

BASE = """dl AS (SELECT * FROM dispatches QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY id DESC) = 1),
fl AS (SELECT order_id, bool_or(new_state IN (5, 90)) AS picked, bool_or(new_state = 70) AS dispatched FROM changes GROUP BY 1),
bs AS (SELECT b.order_id, dl.carrier, c.store_id, c.operator, dl.promised AS delivery_day, b.total % 30 AS skus, coalesce(fl.picked, false) AS picked, coalesce(fl.dispatched, false) AS dispatched, b.total % 90000 AS metres FROM baskets b LEFT JOIN dl USING (order_id) LEFT JOIN carriers c ON c.carrier = dl.carrier LEFT JOIN fl USING (order_id)),
base AS (SELECT bs.*, round(coalesce(f.factor, (SELECT MAX(factor) FROM factors WHERE operator = 'default')) * metres / 1000, 1) AS km FROM bs LEFT JOIN (SELECT operator, from_day, to_day, MAX(factor) AS factor FROM factors WHERE operator <> 'default' AND to_day IS NOT NULL GROUP BY 1, 2, 3) f ON f.operator = bs.operator AND delivery_day BETWEEN f.from_day AND coalesce(f.to_day, DATE '9999-12-31'))"""
BASE_FEEDS = "baskets dispatches carriers changes factors"


def _base(baskets, dispatches, carriers, changes, factors):
    """All orders as one day's load, so the plan runs over the whole tables."""
    orders = baskets.select("order_id", F.lit(DAY).cast("date").alias("day"), (F.col("total") % 30).alias("skus"), (F.col("total") % 90000).alias("metres"))
    moved = changes.withColumn("created", dates.as_ts(DAY))
    nothing = baskets.where("total < 0").select("order_id", F.col("day").alias("delivered_on"))
    dated = factors.where("operator = 'default' OR to_day IS NOT NULL")
    rates = dated.groupBy("operator", "from_day", "to_day").agg(F.max("factor").alias("factor"))
    return logistics.order_cost_base(
        orders.drop("metres"), dispatches, carriers.select("carrier", "store_id", "operator"), moved, nothing,
        orders.select("order_id", "metres"), rates, (5, 90), DAY,
    )


@query("d15_order_cost_base", BASE_FEEDS, f"WITH {BASE} SELECT order_id, carrier, store_id, operator, CAST(delivery_day AS VARCHAR) AS delivery_day, picked, dispatched, km FROM base")
def _(baskets, dispatches, carriers, changes, factors):
    rows = _base(baskets, dispatches, carriers, changes, factors)
    return rows.select("order_id", "carrier", "store_id", "operator", "delivery_day", "picked", "dispatched", "km")


COSTS = BASE + """, costs AS (SELECT b.order_id, b.delivery_day, b.store_id, b.carrier, c.model, c.operator, c.guarantee, c.base AS fee, f.headcount, f.shared, b.dispatched, CASE WHEN dispatched THEN coalesce(round(km) * per_km, 0) ELSE 0 END AS km_cost, c.base + per_sku * skus + CASE WHEN dispatched THEN coalesce(round(km) * per_km, 0) ELSE 0 END AS cost
 FROM base b JOIN carriers c ON c.carrier = b.carrier JOIN staffed f ON f.day = b.delivery_day AND f.store_id = b.store_id AND f.carrier = b.carrier AND f.headcount > 0 WHERE b.picked)"""


def _tariffs(carriers):
    return carriers.select("carrier", "operator", "model", "base", "per_sku", "per_km", "guarantee")


def _costs(baskets, dispatches, carriers, changes, factors, staffed):
    base = _base(baskets, dispatches, carriers, changes, factors).withColumn("km", F.round("km"))
    return logistics.picking_costs(base, _tariffs(carriers), staffed)


@query("d16_picking_costs", BASE_FEEDS + " staffed", f"WITH {COSTS} SELECT order_id, carrier, km_cost, cost FROM costs")
def _(baskets, dispatches, carriers, changes, factors, staffed):
    return _costs(baskets, dispatches, carriers, changes, factors, staffed).select("order_id", "carrier", "km_cost", "cost")


@query("d17_guarantee_topup", BASE_FEEDS + " staffed", f"""
WITH {COSTS}, t AS (SELECT * REPLACE (DATE '1998-06-15' AS delivery_day) FROM costs), r AS (SELECT * FROM factors WHERE operator <> 'default' AND DATE '1998-06-15' BETWEEN from_day AND coalesce(to_day, DATE '9999-12-31')),
s1 AS (SELECT store_id, model, operator, guarantee, SUM(cost) AS c, MIN(headcount) AS h, string_agg(DISTINCT carrier::VARCHAR, ', ' ORDER BY carrier::VARCHAR) AS l FROM t WHERE shared = 1 GROUP BY 1, 2, 3, 4),
s2 AS (SELECT store_id, model, operator, guarantee, carrier, headcount AS h, SUM(cost) AS c FROM t WHERE shared = 0 GROUP BY 1, 2, 3, 4, 5, 6),
s3 AS (SELECT store_id, model, operator, MAX(shared) AS sh, string_agg(DISTINCT carrier::VARCHAR, ', ' ORDER BY carrier::VARCHAR) AS l, MAX(carrier) AS carrier, MIN(headcount) AS h FROM staffed f WHERE headcount > 0 AND NOT EXISTS (SELECT 1 FROM t WHERE t.store_id = f.store_id AND t.model = f.model AND t.operator = f.operator) GROUP BY 1, 2, 3)
SELECT s1.store_id, s1.model, s1.operator, NULL::VARCHAR AS carrier, l AS carriers, c * coalesce(pay, 1) AS paid, h * guarantee * coalesce(guarantee_factor, 1) AS minimum, greatest(h * guarantee * coalesce(guarantee_factor, 1) - c * coalesce(pay, 1), 0) AS topup, 'duplicado' AS source FROM s1 LEFT JOIN r ON r.operator = s1.operator AND r.model = s1.model
UNION ALL SELECT s2.store_id, s2.model, s2.operator, carrier::VARCHAR, NULL, c * coalesce(pay, 1), h * guarantee * coalesce(guarantee_factor, 1), greatest(h * guarantee * coalesce(guarantee_factor, 1) - c * coalesce(pay, 1), 0), 'no_duplicado' FROM s2 LEFT JOIN r ON r.operator = s2.operator AND r.model = s2.model
UNION ALL SELECT s3.store_id, s3.model, s3.operator, CASE WHEN sh <> 1 THEN s3.carrier::VARCHAR END, CASE WHEN sh = 1 THEN l END, 0, h * coalesce(guarantee, 0) * coalesce(guarantee_factor, 1), h * coalesce(guarantee, 0) * coalesce(guarantee_factor, 1), 'sin_pedido' FROM s3 LEFT JOIN carriers c ON c.carrier = s3.carrier LEFT JOIN r ON r.operator = s3.operator AND r.model = s3.model""", prepared="lines staffed")
def _(baskets, dispatches, carriers, changes, factors, staffed):
    # The costs are read twice, and are small beside what they are made from.
    costs = cut_lineage(_costs(baskets, dispatches, carriers, changes, factors, staffed).withColumn("delivery_day", F.lit(DAY).cast("date")))
    plans = staffed.withColumn("day", F.lit(DAY).cast("date"))
    tariffs = _tariffs(carriers).selectExpr("carrier", "guarantee", "DATE'1994-01-01' AS from_day", "CAST(NULL AS DATE) AS to_day")
    expired = carriers.selectExpr("carrier", "guarantee + 5 AS guarantee", "DATE'1990-01-01' AS from_day", "DATE'1993-12-31' AS to_day")
    rows = logistics.guarantee_topup(costs, factors.where("operator <> 'default'"), plans, tariffs.unionByName(expired), DAY)
    return rows.drop("delivery_day")


@query("d18_overheads", BASE_FEEDS + " staffed lines stores", f"""
WITH {COSTS}, hv AS (SELECT order_id FROM (SELECT order_id, SUM(asked * 900) AS g, SUM(asked * 5) AS l FROM lines GROUP BY 1) WHERE g > 80000 OR l > 500),
sc AS (SELECT store_id, operator, SUM(fee + km_cost) AS overweight FROM costs WHERE operator = 'OP1' AND dispatched AND order_id IN (FROM hv) GROUP BY 1, 2),
gr AS (SELECT DISTINCT store_id, operator FROM base WHERE carrier IS NOT NULL), k AS (SELECT district, MAX(balance) AS b FROM stores GROUP BY 1)
SELECT '1998-06-15' AS delivery_day, gr.store_id, gr.operator, 1.08::DOUBLE * b / 30 AS coordinator, b * 2 / 30 AS fixed, overweight FROM gr LEFT JOIN k ON k.district = gr.store_id LEFT JOIN sc ON sc.store_id = gr.store_id AND sc.operator = gr.operator""", prepared="lines")
def _(baskets, dispatches, carriers, changes, factors, staffed, lines, stores):
    day = F.lit(DAY).cast("date")
    whole = cut_lineage(_base(baskets, dispatches, carriers, changes, factors))
    base = whole.where("carrier IS NOT NULL").withColumn("delivery_day", day)
    costs = logistics.picking_costs(whole.withColumn("km", F.round("km")), _tariffs(carriers), staffed).withColumn("delivery_day", day)
    loads = lines.select("order_id", (F.col("asked") * 900).alias("grams"), (F.col("asked") * 5).alias("litres"))
    rates = stores.groupBy(F.col("district").alias("store_id")).agg(F.max("balance").alias("b"))
    keyed = carriers.select("store_id", "operator").distinct().join(rates, "store_id")
    coordinators = keyed.select("store_id", "operator", F.col("b").alias("coordinator_cost"))
    fixed = keyed.select("store_id", "operator", (F.col("b") * 2).alias("fixed_cost"))
    return logistics.overheads(base, coordinators, fixed, costs, loads, "OP1", DAY)


feed("trips", ["baskets"], """
SELECT order_id, day, CAST(store_id AS BIGINT) AS store_id, customer_id % 12 AS shopper, 1 + total % 40 AS units, 1 + total % 9 AS products, CASE WHEN total % 3 = 0 THEN CAST(total % 25 AS DOUBLE) END AS real_km,
 CAST(store_id % 7 AS DOUBLE) / 10 AS store_lat, CAST(store_id % 5 AS DOUBLE) / 10 AS store_lng, CAST(customer_id % 9 AS DOUBLE) / 10 AS lat, CAST(customer_id % 8 AS DOUBLE) / 10 AS lng FROM baskets""")
GEO = "2 * 2 * 6371.0088::DOUBLE * asin(sqrt(pow(sin(radians(lat - store_lat) / 2), 2) + cos(radians(store_lat)) * cos(radians(lat)) * pow(sin(radians(lng - store_lng) / 2), 2)))"


@query("d19_logistics_cost", "trips", f"""
WITH g AS (SELECT *, {GEO} AS raw, CASE WHEN day(day) <= 25 THEN year(day) * 100 + month(day) ELSE year(day + INTERVAL 6 DAY) * 100 + month((date_trunc('month', day) + INTERVAL 1 MONTH)::DATE) END AS mth FROM trips),
r AS (SELECT *, round(CASE WHEN raw > 80 THEN 81 ELSE raw END, 6) AS geo FROM g), k AS (SELECT store_id, SUM(real_km) AS a, SUM(geo) AS b FROM r WHERE real_km IS NOT NULL GROUP BY 1), q AS (SELECT store_id, CASE WHEN a / b > 1 THEN a / b ELSE (SELECT SUM(a) / SUM(b) FROM k WHERE a > 0) END AS ra FROM k),
d AS (SELECT r.*, CASE WHEN real_km > 0 THEN real_km WHEN real_km IS NULL AND geo * ra > 0 THEN geo * ra ELSE geo END AS km, CASE WHEN store_id % 4 = 0 THEN 2500 ELSE 0 END AS truck, CASE WHEN store_id % 2 = 0 THEN units * 20 ELSE products * 50 END AS picking, CASE WHEN store_id % 3 = 0 THEN 0.5 ELSE 1 END AS way FROM r LEFT JOIN q USING (store_id)),
o AS (SELECT *, CASE WHEN mth >= 199806 THEN 1007 ELSE 1000 END + picking + CASE WHEN truck > 0 THEN truck ELSE 90 * km * way END - truck AS cost FROM d), s AS (SELECT day, store_id, mth, shopper, SUM(cost) AS shoppers, SUM(truck)::BIGINT AS trucks FROM o GROUP BY 1, 2, 3, 4),
z0 AS (SELECT s.*, day(last_day((make_date((mth // 100)::BIGINT, (mth % 100)::BIGINT, 1) - INTERVAL 1 MONTH)::DATE)) AS dm, h.hours FROM s LEFT JOIN (SELECT day, store_id, shopper, MAX(units % 9) AS hours FROM trips WHERE shopper % 3 <> 0 GROUP BY 1, 2, 3) h USING (day, store_id, shopper)),
z AS (SELECT z0.*, coalesce(hours, AVG(hours) OVER (PARTITION BY store_id)) * 11 AS picker FROM z0)
SELECT CAST(day AS VARCHAR) AS day, store_id, round(SUM(shoppers), 6) AS shoppers, round(SUM(greatest(9000 - shoppers, 0)), 6) AS guarantee, SUM(trucks)::BIGINT AS trucks, round(SUM(picker), 6) AS pickers, MAX(60000 / dm) AS coordinator, round(SUM(shoppers) + SUM(greatest(9000 - shoppers, 0)) + SUM(trucks) + coalesce(SUM(picker), 0) + MAX(60000 / dm), 6) AS total FROM z GROUP BY 1, 2""")
def _(trips):
    months = trips.select("store_id", logistics.billing_month(F.col("day")).alias("month")).where("month < 199806").distinct()
    months = months.unionByName(trips.select("store_id", F.lit(199806).alias("month")).distinct())
    tariffs = months.selectExpr(
        "store_id", "month", "CASE WHEN month = 199806 THEN 1007 ELSE 1000 END AS base", "11 AS picker_rate", "CASE WHEN store_id % 2 = 0 THEN 20 ELSE 0 END AS per_unit", "50 AS per_sku", "90 AS per_km",
        "store_id % 3 = 0 AS one_way", "CASE WHEN store_id % 4 = 0 THEN 2500 ELSE 0 END AS truck", "9000 AS guarantee", "60000 AS coordinator",
    )
    attendance = trips.where("shopper % 3 <> 0").select("day", "store_id", "shopper", (F.col("units") % 9).alias("hours"))
    rows = logistics.logistics_cost(trips, tariffs, attendance)
    rounded = {c: F.round(c, 6) for c in ("shoppers", "guarantee", "pickers", "total")}
    return rows.withColumns(rounded)


@query("d83_order_trips", "baskets dispatches changes nation", """
WITH l AS (SELECT * FROM dispatches QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY id DESC) = 1), c AS (SELECT order_id, MAX(created) AS t FROM changes WHERE new_state = 70 GROUP BY 1),
j AS (SELECT b.order_id, c.t, b.store_id % 7 / 10 AS store_lat, b.store_id % 5 / 10 AS store_lng, l.id % 9 / 10 AS lat, l.id % 8 / 10 AS lng FROM baskets b JOIN l USING (order_id) JOIN c USING (order_id) WHERE b.day >= DATE '1998-06-15' - 365 AND b.day < DATE '1998-06-15' AND l.type <> '2')
SELECT order_id, round(2 * 6371.0088::DOUBLE * asin(sqrt(pow(sin(radians(lat - store_lat) / 2), 2) + cos(radians(store_lat)) * cos(radians(lat)) * pow(sin(radians(lng - store_lng) / 2), 2))), 6) AS km, strftime(t, '%Y-%m-%d %H:%M:%S') AS dispatched_at FROM j""")
def _(baskets, dispatches, changes, nation):
    stores = nation.selectExpr("n_nationkey AS store_id", "n_nationkey % 7 / 10 AS store_lat", "n_nationkey % 5 / 10 AS store_lng")
    sent = dispatches.select(
        "order_id", "id", F.when(F.col("type") == "2", "pickup").otherwise(F.col("type")).alias("type"),
        (F.col("id") % 9 / 10).alias("lat"), (F.col("id") % 8 / 10).alias("lng"),
    )
    rows = logistics.order_trips(baskets, stores, sent, changes, DAY, 365)
    return rows.select("order_id", F.round("km", 6).alias("km"), "dispatched_at")


@query("d84_dispatch_types", "dispatches carriers", """
SELECT id, CASE WHEN type IS NULL AND c.carrier IS NOT NULL THEN CASE kind WHEN 1 THEN 'delivery' WHEN 2 THEN 'pickup' ELSE 'error' END ELSE type END AS type FROM dispatches d LEFT JOIN (SELECT * FROM carriers WHERE per_sku <> 33) c ON c.carrier = d.carrier""")
def _(dispatches, carriers):
    return logistics.dispatch_types(dispatches, carriers.where("per_sku <> 33")).select("id", "type")
