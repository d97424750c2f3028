"""Calendar, forecasting and planning queries."""

import uuid

from pyspark.sql import functions as F

from granero.functions import dates
from granero.functions.keys import normal_unit
from granero.plans import calendar as calendar_plan
from granero.plans import daily
from granero.plans import planning as plan
from granero.plans.promotions import SUPPLY_MECHANICS
from granero.session import shared_folder, track
from granero.sources import snapshots
from granero.suite.registry import QUERIES, feed, query


@query("d60_relative_calendar", "baskets", """
WITH d AS (SELECT DISTINCT day FROM baskets), y AS (SELECT day, year(day) AS y, month(day) AS m, weekofyear(day) AS w, DATE '1998-06-15' AS b FROM d),
l AS (SELECT *, (SELECT count(*) FROM generate_series(1990, 2010) g(v) WHERE v >= least(y, 1998) AND v < greatest(y, 1998) AND weekofyear(make_date(v, 12, 31)) = 53) AS x FROM y)
SELECT CAST(day AS VARCHAR) AS day, y::INT AS year, m::INT AS month, w::INT AS week, y || 'W' || w AS week_label, (y - 1998)::INT AS relative_year,
 ((y - 1998) * 2 + (CASE WHEN m <= 6 THEN 1 ELSE 2 END) - 1)::INT AS relative_half, ((y - 1998) * 4 + quarter(day) - 2)::INT AS relative_quarter,
 ((y - 1998) * 12 + m - 6)::INT AS relative_month, ((y - 1998) * 52 + sign(y - 1998) * x + CASE WHEN w >= 52 AND m = 1 THEN 0 ELSE w END - weekofyear(b))::INT AS relative_week,
 ((y - 1998) * 365 + dayofyear(day) - dayofyear(b))::INT AS relative_day FROM l""")
def _(baskets):
    return calendar_plan.relative_calendar(baskets.select("day").distinct(), "1998-06-15")


@query("d61_category_levels", "category_rows", """
WITH s AS (SELECT *, CASE WHEN status IN (0, 8) THEN 'inactive' ELSE 'active' END AS st FROM category_rows)
SELECT a.id, a.ref_id, a.st AS status, coalesce(c.name, b.name, a.name) AS n1, CASE WHEN c.id IS NOT NULL THEN b.name WHEN b.id IS NOT NULL THEN a.name END AS n2,
 CASE WHEN c.id IS NOT NULL THEN a.name END AS n3 FROM s a LEFT JOIN s b ON a.ref_parent = b.ref_id LEFT JOIN s c ON b.ref_parent = c.ref_id""")
def _(category_rows):
    return calendar_plan.category_levels(category_rows)


# ---------------------------------------------------------------- rankings and stock planning

DAY = "1998-06-15"


def _ranking_sql(within: str = "") -> str:
    lead = f"{within}, " if within else ""
    part = f"PARTITION BY {within} " if within else ""
    score = "5 * frequency_rank + 3 * units_rank + 2 * revenue_rank"
    return f"""WITH t AS (SELECT {lead}sku, count(*) AS frequency, SUM(units)::BIGINT AS units, SUM(net)::BIGINT AS revenue FROM sales GROUP BY {lead}sku),
r AS (SELECT *, dense_rank() OVER (ORDER BY frequency DESC) AS frequency_rank, dense_rank() OVER (ORDER BY units DESC) AS units_rank, dense_rank() OVER (ORDER BY revenue DESC) AS revenue_rank FROM t)
SELECT *, {score} AS score, row_number() OVER ({part}ORDER BY {score}, sku) AS ranking FROM r"""


for _name, _within in (("d08_product_ranking", ""), ("d08_store_ranking", "store_id"), ("d08_channel_ranking", "flag")):
    query(_name, "sales", _ranking_sql(_within))(
        lambda sales, w=_within: plan.product_ranking(sales, [w] if w else [])
    )

SAFE_FEEDS = "assortment sales stores"


def _weights(stores):
    return stores.where("status = 1").select("store_id", (F.lit(0.5) + F.col("district") / 10).alias("weight"))


@query("d31a_safety_stock", SAFE_FEEDS, """
WITH s AS (SELECT sku, store_id, dayofweek(day) AS dow, SUM(units * 9)::BIGINT AS u FROM sales WHERE day >= DATE '1998-06-15' - 200 AND NOT (isoyear(day) = 1998 AND weekofyear(day) = 23) GROUP BY 1, 2, 3),
m AS (SELECT sku, store_id, AVG(u) AS mean FROM s GROUP BY 1, 2),
b AS (SELECT a.sku, a.store_id, coalesce(mean, 0) * 0.25::DOUBLE AS q, CASE WHEN a.stock > 40 THEN a.stock % 30 END AS minimum, a.listed AS ex, a.excluded AS ou FROM assortment a LEFT JOIN m USING (sku, store_id) WHERE a.store_id NOT IN (1, 7)),
n AS (SELECT *, CASE WHEN q >= 1 THEN round_even(round_even(q, 2), 0) ELSE 0 END AS v FROM b),
w AS (SELECT n.*, round_even((CASE WHEN NOT ex AND coalesce(minimum, 0) > 0 AND v > minimum THEN minimum ELSE v END) * coalesce(CASE WHEN status = 1 THEN 0.5::DOUBLE + district / 10 END, 1), 0) AS x FROM n LEFT JOIN stores USING (store_id))
SELECT sku, store_id, CAST(CASE WHEN ou THEN 0 WHEN x < 1 THEN 0 WHEN x >= 50 THEN 50 ELSE x END AS BIGINT) AS safety_stock FROM w""")
def _(assortment, sales, stores):
    minima = assortment.where("stock > 40").select("sku", "store_id", (F.col("stock") % 30).alias("minimum"))
    busy = sales.withColumn("units", F.col("units") * 9)
    return plan.safety_stock(
        assortment, busy, minima, assortment.where("listed"), _weights(stores), assortment.where("excluded"), DAY,
        event_weeks=[(1998, 23)], days=200, skipped_stores=(1, 7),
    )


@query("d31b_weekday_safety_stock", SAFE_FEEDS + " promos", """
WITH s AS (SELECT sku, store_id, yearweek(day) AS w, SUM(units)::BIGINT AS u FROM sales WHERE dayofweek(day) = 1 GROUP BY 1, 2, 3), m AS (SELECT sku, store_id, AVG(u) AS mean, MAX(u) AS most FROM s GROUP BY 1, 2),
b AS (SELECT a.sku, a.store_id, mean, most, a.sku IN (SELECT sku FROM promos WHERE type = 1) AS promo, round_even(round_even(greatest(mean * 0.5::DOUBLE, 2), 2), 0) * coalesce(CASE WHEN status = 1 THEN 0.5::DOUBLE + district / 10 END, 1) AS w
 FROM assortment a LEFT JOIN m USING (sku, store_id) LEFT JOIN stores USING (store_id))
SELECT sku, store_id, CAST(CASE WHEN mean IS NULL THEN 2 WHEN promo THEN greatest(most, 2) ELSE greatest(round_even(w, 0), 2) END AS BIGINT) AS safety_stock FROM b""")
def _(assortment, sales, stores, promos):
    return plan.weekday_safety_stock(assortment, sales, promos.where("type = 1"), _weights(stores), DAY)


@query("d112_regular_price_safety_stock", "assortment sales stores skus", """
WITH r AS (SELECT s.* FROM sales s JOIN skus k USING (sku) WHERE day >= DATE '1998-06-15' - 700 AND round(gross / units) / (list_price * 10) > 0.8),
s AS (SELECT sku, store_id, yearweek(day) AS w, SUM(units)::BIGINT AS u FROM r WHERE dayofweek(day) = 1 GROUP BY 1, 2, 3), m AS (SELECT sku, store_id, AVG(u) AS mean FROM s GROUP BY 1, 2)
SELECT a.sku, a.store_id, CAST(CASE WHEN mean IS NULL THEN 2 ELSE least(greatest(round_even(round_even(greatest(mean * 0.5::DOUBLE, 2), 2), 0), 2), 200) END AS BIGINT) AS safety_stock FROM assortment a LEFT JOIN m USING (sku, store_id)""")
def _(assortment, sales, stores, skus):
    priced = sales.join(skus.select("sku", (F.col("list_price") * 10).alias("list_price")), "sku")
    regular = plan.regular_price_sales(priced, DAY, 700)
    nobody = stores.where("status = 9").select("store_id", F.lit(1.0).alias("weight"))
    return plan.weekday_safety_stock(assortment, regular, skus.where("size < 0"), nobody, DAY, cap=200)


@query("d33_replenishment", "sales skus", """
WITH p AS (SELECT sku, """ + ", ".join(f"SUM(CASE WHEN dayofweek(day) = {i} THEN units ELSE 0 END)::BIGINT / 10 AS d{i}" for i in range(7)) + """ FROM sales GROUP BY 1),
m AS (SELECT sku, size % 10 AS lead, CAST(size % 25 AS DOUBLE) AS mn, CAST(40 + size * 4 AS DOUBLE) AS mx, 1 + size % 3 AS doh, CASE WHEN size <> 6 THEN size % 20 END AS st, 1 + sku % 6 AS mult, [d0, d1, d2, d3, d4, d5, d6] AS d FROM skus JOIN p USING (sku)),
f AS (SELECT *, coalesce(st, 0) AS stock, coalesce((SELECT SUM(d[(1 + i) % 7 + 1]) FROM range(lead) g(i)), 0) AS demand FROM m),
t AS (SELECT *, doh * d[2] + demand - stock AS target FROM f WHERE demand > mn AND stock <= demand),
c AS (SELECT *, CASE WHEN target > mx THEN mx WHEN target < mn THEN mn ELSE target END AS cl FROM t),
b AS (SELECT *, CASE WHEN cl = mx OR cl + stock >= mx THEN mx - stock ELSE cl END AS bo FROM c)
SELECT sku, round(demand, 6) AS demand, stock, CAST(ceil(round(bo, 6) / mult) * mult AS DOUBLE) AS requested FROM b WHERE ceil(round(bo, 6) / mult) * mult > 0""")
def _(sales, skus):
    masters = skus.selectExpr(
        "sku", "size % 10 AS lead_time", "CAST(size % 25 AS DOUBLE) AS minimum", "CAST(40 + size * 4 AS DOUBLE) AS maximum",
        "1 + size % 3 AS doh", "CASE WHEN size <> 6 THEN size % 20 END AS stock", "1 + sku % 6 AS multiplier",
    )
    proposal = plan.replenishment(masters.join(plan.weekday_profile(sales), "sku"), DAY)
    return proposal.withColumn("demand", F.round("demand", 6))


WINDOWS = """w AS (SELECT sku, MAX(start_day) AS a, MAX(end_day) AS z FROM promos WHERE end_day < DATE '1998-07-25' AND start_day >= DATE '1998-07-25' - 60 AND mechanic NOT IN (12, 22, 25, 27, 36, 50, 37) GROUP BY 1),
live AS (SELECT DISTINCT sku FROM promos WHERE type IN (1, 4)), v AS (SELECT * FROM sales WHERE sku IN (FROM live)), h AS (SELECT v.*, a, z FROM v JOIN w USING (sku) WHERE day BETWEEN a AND z)"""


def _windows(promos):
    return plan.last_windows(promos, "1998-07-25", 60, SUPPLY_MECHANICS)


@query("d34_supply_forecast", "promos sales", f"""
WITH {WINDOWS}, m AS (SELECT sku, store_id, dow, AVG(u) AS mean FROM (SELECT sku, store_id, dayofweek(day)::INT AS dow, weekofyear(day) AS k, SUM(units)::BIGINT AS u FROM h GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
x AS (SELECT sku, store_id, dow, MAX(u) AS most FROM (SELECT sku, store_id, dayofweek(day)::INT AS dow, weekofyear(day) AS k, SUM(units)::BIGINT AS u FROM v WHERE day >= DATE '1998-07-25' - 45 GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3)
SELECT sku, store_id, dow, CAST(CASE WHEN coalesce(mean, 0) = 0 THEN most ELSE mean END AS DOUBLE) AS forecast FROM x LEFT JOIN m USING (sku, store_id, dow)""")
def _(promos, sales):
    return plan.supply_forecast(promos.where("type IN (1, 4)"), _windows(promos), sales, "1998-07-25")


@query("d93_promo_safety_stock", "promos sales", f"""
WITH {WINDOWS}, m AS (SELECT sku, store_id, ceil(SUM(units)::BIGINT / MAX(z - a)) AS mean FROM h GROUP BY 1, 2), x AS (SELECT sku, store_id, MAX(units) AS most FROM v WHERE day >= DATE '1998-07-25' - 15 GROUP BY 1, 2)
SELECT sku, store_id, CAST(least(ceil(greatest((CASE WHEN mean IS NULL THEN most ELSE greatest(mean, 2) END) * 0.5, 2)), 100) * 0.5 AS DOUBLE) AS safety_stock FROM x LEFT JOIN m USING (sku, store_id)""")
def _(promos, sales):
    return plan.promo_safety_stock(promos.where("type IN (1, 4)"), _windows(promos), sales, "1998-07-25")


@query("d44_weekday_profile", "sales", "SELECT sku, " + ", ".join(
    f"SUM(CASE WHEN dayofweek(day) = {i} THEN units ELSE 0 END)::BIGINT / 10 AS {d}" for i, d in enumerate(plan.WEEKDAYS)) + " FROM sales GROUP BY 1")
def _(sales):
    return plan.weekday_profile(sales)


@query("d105_comparable_mean", "sales", """
SELECT sku, store_id, round(SUM(net)::BIGINT / 4) AS net, round(SUM(units)::BIGINT / 4) AS units FROM sales WHERE DATE '1998-06-15' - day IN (7, 14, 21, 28) GROUP BY 1, 2""")
def _(sales):
    return plan.comparable_mean(sales, DAY)


@query("d87_statistical_limits", "sales", """
SELECT sku, round(AVG(units)) AS mean_units, round(AVG(units) + 2 * stddev_pop(units)) AS purchase_limit FROM sales WHERE day >= DATE '1998-06-15' - 30 GROUP BY 1 HAVING round(AVG(units) + 2 * stddev_pop(units)) > 45""")
def _(sales):
    return plan.statistical_limits(sales, DAY, 45)


def _daily(sales):
    """Daily sums of all sales as a table, in which the days of returned products were missing first and were refreshed."""
    spark = sales.sparkSession
    path = f"{shared_folder(spark)}/granero-{uuid.uuid4().hex}"
    track(spark, path)
    first = daily.daily_sales(sales.where("NOT (flag = 'R' AND day BETWEEN DATE'1998-05-01' AND DATE'1998-05-31')"))
    daily.create(first, path, daily.KEY)
    late = sales.where("flag = 'R' AND day BETWEEN DATE'1998-05-01' AND DATE'1998-05-31'").select("day").distinct()
    daily.refresh_days(spark, path, first.schema, late, lambda days: daily.daily_sales(sales.where(F.col("day").isin(days))))
    return snapshots.read(spark, path, first.schema)


_BY_LINE = {name: QUERIES[name].oracle for name in ("d34_supply_forecast", "d93_promo_safety_stock", "d105_comparable_mean", "d44_weekday_profile")}


@query("d34_from_daily", "promos sales", _BY_LINE["d34_supply_forecast"])
def _(promos, sales):
    return plan.supply_forecast(promos.where("type IN (1, 4)"), _windows(promos), _daily(sales), "1998-07-25")


@query("d93_from_daily", "promos sales", _BY_LINE["d93_promo_safety_stock"])
def _(promos, sales):
    return plan.promo_safety_stock(promos.where("type IN (1, 4)"), _windows(promos), _daily(sales), "1998-07-25")


@query("d105_from_daily", "sales", _BY_LINE["d105_comparable_mean"])
def _(sales):
    return plan.comparable_mean(_daily(sales), DAY)


@query("d44_from_daily", "sales", _BY_LINE["d44_weekday_profile"])
def _(sales):
    return plan.weekday_profile(_daily(sales))


@query("d87_from_daily", "sales", """
SELECT sku, round(AVG(units)) AS mean_units, round(stddev_pop(units), 6) AS deviation FROM sales WHERE day >= DATE '1998-06-15' - 30 GROUP BY 1""")
def _(sales):
    """Means and deviations of single lines, from daily sums."""
    recent = _daily(sales).where(F.col("day") >= F.date_sub(dates.as_date(DAY), 30))
    return recent.groupBy("sku").agg(F.round(F.sum("units") / F.sum("lines")).alias("mean_units"), F.round(daily.line_deviation(), 6).alias("deviation"))


feed("inventory", ["lineitem"], """
SELECT l_partkey AS sku, CAST(l_quantity AS BIGINT) AS stock, CASE l_returnflag WHEN 'A' THEN 'Zone MANUAL 1' WHEN 'N' THEN 'osr rack' ELSE CASE l_linestatus WHEN 'O' THEN 'DYNAMIC' ELSE 'yard' END END AS area,
 l_orderkey AS unit, CASE CAST(l_linenumber % 4 AS INT) WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 ELSE 0.125 END AS share FROM lineitem""")

AREAS = """ar AS (SELECT sku, SUM(CASE WHEN k = 'm' THEN stock ELSE 0 END)::BIGINT AS stock_manual, SUM(CASE WHEN k = 'o' THEN stock ELSE 0 END)::BIGINT AS stock_osr, SUM(CASE WHEN k = 'd' THEN stock ELSE 0 END)::BIGINT AS stock_dynamic, count(k) > 0 AS has_stock
 FROM (SELECT DISTINCT sku, stock, CASE WHEN area LIKE '%DYNAMIC%' THEN 'd' WHEN area LIKE '%MANUAL%' THEN 'm' WHEN area LIKE 'osr%' THEN 'o' END AS k FROM inventory) GROUP BY 1)"""


@query("d88_storage_list", "sales promos inventory", f"""
WITH {AREAS}, v AS (SELECT sku, store_id, round(AVG(u), 2) AS mean_units FROM (SELECT sku, store_id, day, SUM(units)::BIGINT AS u FROM sales WHERE day >= DATE '1998-06-15' - 60 AND sku NOT IN (SELECT sku FROM promos WHERE type = 2) GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT sku, store_id, mean_units, coalesce(has_stock, false) AS has_stock, coalesce(stock_manual, 0) AS stock_manual, coalesce(stock_osr, 0) AS stock_osr, coalesce(stock_dynamic, 0) AS stock_dynamic, mean_units * 7 AS target_stock FROM v LEFT JOIN ar USING (sku)""")
def _(sales, promos, inventory):
    return plan.storage_list(sales, promos.where("type = 2"), inventory, DAY)


@query("d45_slotting_master", "assortment skus sales inventory promos", f"""
WITH {AREAS}, a AS (SELECT DISTINCT sku, store_id, CASE unit WHEN 'ST' THEN 'UN' WHEN 'CS' THEN 'CJ' ELSE unit END AS uom FROM assortment JOIN skus USING (sku)),
dd AS (SELECT sku, store_id, day, SUM(units)::BIGINT AS u FROM sales WHERE pct < 8 AND flag <> 'R' GROUP BY 1, 2, 3), w AS (SELECT sku, store_id, """ + ", ".join(
    f"round(AVG(CASE WHEN dayofweek(day) = {i} THEN u END), 2) AS d{i}" for i in range(7)) + """, count(*) AS sale_days FROM dd GROUP BY 1, 2),
t AS (SELECT sku, CAST(SUM(share) AS DOUBLE) AS tote_equivalents, SUM(stock)::BIGINT AS stored_units, count(unit) AS places, count(DISTINCT unit) AS load_units FROM inventory GROUP BY 1),
j AS (SELECT a.*, s.size, round(d0 + d1 + d2 + d3 + d4 + d5 + d6, 2) AS wk, round((d0 + d1 + d2 + d3 + d4 + d5 + d6) / 7, 2) AS mean_sale, sale_days, tote_equivalents, stored_units, places, load_units, stock_manual, stock_osr,
  s.sku % 70 AS len, s.size * 2 AS wid, 30 AS hei FROM a JOIN skus s USING (sku) LEFT JOIN w USING (sku, store_id) LEFT JOIN t USING (sku) LEFT JOIN ar USING (sku))
SELECT sku, store_id, CAST(len * wid * hei AS BIGINT) AS volume, CASE WHEN len > 55.5 THEN 'No conveyable 1' WHEN wid > 35.6 THEN 'No conveyable 2' ELSE 'conveyable' END AS conveyable, len * wid * hei / 100000 > 0.073 AS bulky, uom IN ('KG', 'KGV') AS weighable,
 CAST(CASE WHEN size % 2 = 0 THEN size ELSE size * 1000 END AS BIGINT) AS grams, sku IN (SELECT sku FROM promos WHERE type = 7) AS promoted, size > 40 AS restricted, coalesce(size * 0.7::DOUBLE * mean_sale >= (1 + size % 12) * 0.9::DOUBLE, false) AS waste_safe,
 mean_sale, sale_days, tote_equivalents, stored_units, places, load_units, stock_manual + stock_osr AS stock_total, wk AS target, CAST(ceil(wk / (1 + size % 12)) * (1 + size % 12) AS BIGINT) AS target_cases FROM j""")
def _(assortment, skus, sales, inventory, promos):
    units = assortment.join(skus.select("sku", normal_unit(F.col("unit")).alias("uom")), "sku")
    places = skus.selectExpr(
        "sku", "sku % 70 AS length", "size * 2 AS width", "30 AS height", "1 + size % 12 AS case_quantity", "size AS shelf_life",
        "CASE WHEN size % 2 = 0 THEN 'G' ELSE 'KG' END AS weight_unit", "CAST(size AS BIGINT) AS weight",
    )
    base = sales.select("sku", "store_id", "day", "units", (F.col("flag") == "R").alias("deep"), F.when(F.col("pct") < 8, 0.1).otherwise(0.3).alias("discount"))
    totes = inventory.select("sku", "share", F.col("stock").alias("quantity"), "unit")
    ranking = assortment.select("sku", "store_id", (F.col("stock") % 9).alias("ranking"))
    rows = plan.slotting_master(
        units, places, ranking, base, totes, inventory, promos.where("type = 7"), skus.where("size > 40")
    )
    return rows.select(
        "sku", "store_id", F.col("volume").cast("long").alias("volume"), "conveyable", "bulky", "weighable", F.col("grams").cast("long").alias("grams"),
        "promoted", "restricted", "waste_safe", "mean_sale", "sale_days", "tote_equivalents", "stored_units", "places", "load_units",
        "stock_total", "target", F.col("target_cases").cast("long").alias("target_cases"),
    )


feed("forecast", ["baskets"], """
SELECT day, CAST(store_id AS BIGINT) AS store_id, count(*) * 40 AS orders FROM baskets GROUP BY day, store_id""")
MEAN = "u AS (SELECT round(SUM(units)::BIGINT / count(DISTINCT order_id)) AS m FROM sales WHERE day >= DATE '1998-06-15' - 30)"
WAVES = "wv AS (SELECT n_nationkey::BIGINT AS store_id, 8 + 4 * i AS wave, (10 + n_nationkey + 5 * i) / 100 AS wave_share FROM nation, (VALUES (0), (1), (2)) v(i))"


def _waves(nation):
    spread = nation.select(F.col("n_nationkey").cast("long").alias("store_id"), F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("i"))
    return spread.selectExpr("store_id", "8 + 4 * i AS wave", "(10 + store_id + 5 * i) / 100 AS wave_share")


@query("d80_staffing", "forecast sales nation skus", f"""
WITH {MEAN}, {WAVES}, t AS (SELECT DISTINCT size % 10 AS task, 1 AS mn, 3 AS mx FROM skus), p AS (SELECT DISTINCT size % 8 AS task, CAST(size % 25 AS BIGINT) AS store_id, 0.2 + size % 3 / 10 AS share, 50 + size AS productivity FROM skus),
c AS (SELECT task, ceil(round(orders * share * wave_share * (SELECT m FROM u)) / productivity) AS n FROM p JOIN (SELECT * FROM forecast WHERE day BETWEEN DATE '1998-06-01' AND DATE '1998-06-30') f USING (store_id) JOIN wv USING (store_id)),
m AS (SELECT task, CAST(MAX(CASE WHEN task = 4 THEN least(n, 2) WHEN task = 6 AND n - 2 < 1 THEN 1 ELSE n END) AS BIGINT) AS people FROM c GROUP BY 1)
SELECT task, coalesce(people, mn) AS min_operators, CASE WHEN people IS NULL THEN mx WHEN task = 4 THEN 2 ELSE people + 2 END AS max_operators FROM t LEFT JOIN m USING (task)""")
def _(forecast, sales, nation, skus):
    tasks = skus.selectExpr("size % 10 AS task", "CAST(1 AS BIGINT) AS min_operators", "CAST(3 AS BIGINT) AS max_operators").distinct()
    productivity = skus.selectExpr(
        "size % 8 AS task", "CAST(size % 25 AS BIGINT) AS store_id", "0.2D + size % 3 / 10 AS share", "50 + size AS productivity"
    ).distinct()
    month = forecast.where("day BETWEEN DATE'1998-06-01' AND DATE'1998-06-30'")
    return plan.staffing(tasks, productivity, month, _waves(nation), plan.units_per_order(sales, DAY))


@query("d91_waves_forecast", "forecast sales nation", f"""
WITH {MEAN}, {WAVES} SELECT store_id, wave, CAST(round(wave_share * orders) AS BIGINT) AS wave_orders, CAST(round(wave_share * orders * (SELECT m FROM u)) AS BIGINT) AS wave_units
FROM forecast JOIN wv USING (store_id) WHERE day = DATE '1998-06-15'""")
def _(forecast, sales, nation):
    return plan.waves_forecast(forecast, _waves(nation), plan.units_per_order(sales, DAY), DAY)


ROSTER = """WITH o AS (SELECT c_custkey AS operator, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer), d AS (SELECT k, DATE '1998-06-01' + k::INT AS day FROM range(28) g(k)),
r AS (SELECT operator, day, (i + k // 7) % 6 AS rw, (k % 7)::INT AS wd FROM o, d) SELECT {}"""


def _roster(customer):
    cells = F.expr("explode(sequence(0, 41))")
    matrix = customer.groupBy().agg(F.count("*").alias("n")).select(cells.alias("c")).selectExpr(
        "CAST(c div 7 AS BIGINT) AS row", "c % 7 AS weekday", "CASE WHEN (c div 7 + c) % 5 = 0 THEN 'L' ELSE substring('MTNS', 1 + c div 7 % 4, 1) END AS block",
        "CASE WHEN c div 7 < 3 THEN 'full' ELSE 'part' END AS shift",
    )
    return plan.roster(customer.select(F.col("c_custkey").alias("operator")), matrix, "1998-06-01", "1998-06-28")


_BLOCK = "CASE WHEN (rw + rw * 7 + wd) % 5 = 0 THEN 'L' ELSE substring('MTNS', (1 + rw % 4)::INT, 1) END"


@query("d81_roster", "customer", ROSTER.format(f"operator, CAST(day AS VARCHAR) AS day, {_BLOCK} AS block, CASE WHEN rw < 3 THEN 'full' ELSE 'part' END AS shift FROM r"))
def _(customer):
    return _roster(customer)


@query("d80_operators_available", "customer", ROSTER.format(
    f"CAST(day AS VARCHAR) AS day, {_BLOCK} AS block, CASE WHEN rw < 3 THEN 'full' ELSE 'part' END AS shift, count(*) AS operators FROM r WHERE day = DATE '1998-06-15' AND {_BLOCK} <> 'L' GROUP BY 1, 2, 3"))
def _(customer):
    return plan.operators_available(_roster(customer), DAY)
