"""Marketplace and pricing queries."""

from pyspark.sql import functions as F

from granero.plans import marketplace as plan
from granero.plans import pricing
from granero.suite.registry import feed, query

DAY = "1998-06-20"
UOM = "CASE unit WHEN 'ST' THEN 'UN' WHEN 'CS' THEN 'CJ' ELSE unit END"

feed("prices", ["lineitem"], """
SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey AS sku, l_suppkey AS store_id, CAST(1 + l_linenumber % 3 * 3 AS INT) AS min_qty,
 CAST(round(l_extendedprice / l_quantity / 10) AS BIGINT) * 10 AS price, CAST(round(l_extendedprice / l_quantity / 10) AS BIGINT) * 10 + 500 AS list_price,
 CAST(l_shipdate AS DATE) AS valid_from, CASE WHEN l_returnflag = 'N' THEN CAST(l_shipdate AS DATE) + 900 END AS valid_to FROM lineitem""")

BEST = """best AS (SELECT sku, MIN(promo_price) AS promo_price FROM promos WHERE DATE '1998-06-20' BETWEEN start_day AND end_day AND type IN (1, 4)
 AND mechanic NOT IN (25, 27, 36, 37, 50) AND valid AND organisation = '1000' AND channel = '10' AND name NOT LIKE '%ZONA%' AND name NOT LIKE '%MFC%' AND name NOT LIKE '%BANCO%' AND name NOT LIKE '%UNIPAY%' AND name NOT LIKE '%TERCERA%' AND name NOT LIKE '%917%' AND name NOT LIKE '%ESTADO%' AND name NOT LIKE '% LOC%' AND name NOT LIKE '%LIQ%' AND name NOT LIKE '%CYBER%' AND name NOT ILIKE '%REGIO%'
 AND NOT regexp_matches(name, 'L(0[0-9]{2}|[1-9][0-9]{0,2})') GROUP BY 1)"""
SHELF = f"""goods AS (SELECT sku, name, nullif(brand, 'Brand#4') AS brand, category, {UOM} AS uom, 1 + size % 5 AS multiplier FROM skus),
pp AS (SELECT sku, store_id, price FROM assortment),
active AS (SELECT store_id FROM stores WHERE status = 1),
sp AS (SELECT * FROM pp WHERE store_id IN (FROM active) AND (sku, store_id) IN (SELECT sku, store_id FROM assortment WHERE NOT excluded AND blocked_store IS NULL AND blocked_format IS NULL)
  AND sku IN (SELECT sku FROM skus WHERE category <> 'SMALL'))"""
FEEDS = "assortment skus stores promos"


def _goods(skus):
    return skus.selectExpr("sku", "name", "nullif(brand, 'Brand#4') AS brand", "category", f"{UOM} AS uom", "1 + size % 5 AS multiplier")


def _offers(assortment, skus, stores, promos):
    prices = plan.store_prices(assortment.select("sku", "store_id", "price"), assortment, stores, skus, ("SMALL",))
    return plan.offers(assortment.select("sku", "store_id", "stock"), _goods(skus), prices, plan.best_simple_promotion(promos, DAY))


@query("d25_store_offers", FEEDS, f"""
WITH {BEST}, {SHELF} SELECT a.sku, a.store_id, a.stock, uom, sp.price, promo_price FROM assortment a JOIN goods USING (sku) JOIN sp ON sp.sku = a.sku AND sp.store_id = a.store_id LEFT JOIN best ON best.sku = a.sku
WHERE brand IS NOT NULL AND a.stock >= multiplier""")
def _(assortment, skus, stores, promos):
    return _offers(assortment, skus, stores, promos).select("sku", "store_id", "stock", "uom", "price", "promo_price")


@query("d25_other_store_offers", FEEDS, f"""
WITH {BEST}, {SHELF}, m AS (SELECT sku, MAX(price) AS price FROM sp GROUP BY 1)
SELECT a.sku, a.store_id, a.stock, uom, m.price, promo_price FROM assortment a JOIN goods USING (sku) JOIN m USING (sku) LEFT JOIN best USING (sku)
WHERE brand IS NOT NULL AND a.stock >= multiplier AND a.store_id NOT IN (FROM active)""")
def _(assortment, skus, stores, promos):
    prices = plan.store_prices(assortment.select("sku", "store_id", "price"), assortment, stores, skus, ("SMALL",))
    stock = assortment.select("sku", "store_id", "stock")
    others = plan.other_store_prices(prices, stock, stores)
    rows = plan.offers(stock, _goods(skus), others, plan.best_simple_promotion(promos, DAY))
    return rows.select("sku", "store_id", "stock", "uom", "price", "promo_price")


@query("d25_parent_child_offers", FEEDS, f"""
WITH {BEST}, {SHELF}, e AS (SELECT sku - sku % 4 AS parent, sku AS child FROM skus WHERE sku - sku % 4 <> sku),
st AS (SELECT child AS sku, store_id, stock FROM assortment JOIN e ON parent = assortment.sku)
SELECT st.sku, st.store_id, st.stock, uom, sp.price, promo_price FROM st JOIN goods USING (sku) JOIN sp ON sp.sku = st.sku AND sp.store_id = st.store_id LEFT JOIN best ON best.sku = st.sku
WHERE brand IS NOT NULL AND st.stock >= multiplier""")
def _(assortment, skus, stores, promos):
    equivalents = skus.selectExpr("sku - sku % 4 AS purchase_sku", "sku AS sale_sku").where("purchase_sku <> sale_sku")
    stock = plan.translate_parent_stock(assortment.select("sku", "store_id", "stock"), equivalents)
    prices = plan.store_prices(assortment.select("sku", "store_id", "price"), assortment, stores, skus, ("SMALL",))
    rows = plan.offers(stock, _goods(skus), prices, plan.best_simple_promotion(promos, DAY))
    return rows.select("sku", "store_id", "stock", "uom", "price", "promo_price")


@query("d25_other_parent_child_offers", FEEDS, f"""
WITH {BEST}, {SHELF}, m AS (SELECT sku, MAX(price) AS price FROM sp GROUP BY 1), e AS (SELECT sku - sku % 4 AS parent, sku AS child FROM skus WHERE sku - sku % 4 <> sku),
st AS (SELECT child AS sku, store_id, stock FROM assortment JOIN e ON parent = assortment.sku WHERE store_id NOT IN (FROM active))
SELECT st.sku, st.store_id, st.stock, uom, m.price, promo_price FROM st JOIN goods USING (sku) JOIN m USING (sku) LEFT JOIN best USING (sku) WHERE brand IS NOT NULL AND st.stock >= multiplier""")
def _(assortment, skus, stores, promos):
    equivalents = skus.selectExpr("sku - sku % 4 AS purchase_sku", "sku AS sale_sku").where("purchase_sku <> sale_sku")
    stock = plan.translate_parent_stock(assortment.select("sku", "store_id", "stock"), equivalents)
    prices = plan.store_prices(assortment.select("sku", "store_id", "price"), assortment, stores, skus, ("SMALL",))
    others = plan.other_store_prices(prices, stock, stores)
    rows = plan.offers(stock, _goods(skus), others, plan.best_simple_promotion(promos, DAY))
    return rows.select("sku", "store_id", "stock", "uom", "price", "promo_price")


@query("d26_format_offers", "sales skus stores promos prices", f"""
WITH st AS (SELECT sku, store_id, MAX(units) AS stock, bool_or(pct = 10) AS blocked FROM sales WHERE flag = (SELECT MAX(flag) FROM sales) GROUP BY 1, 2),
g AS (SELECT sku, brand, {UOM} AS uom, nullif(size, 13) AS ean FROM skus),
mp AS (SELECT p.sku, uom, price, row_number() OVER (PARTITION BY p.sku, uom ORDER BY (min_qty = 4) DESC, (min_qty = 1) DESC, valid_from DESC, price) AS r FROM prices p JOIN g USING (sku)),
w AS (SELECT sku, CASE uom WHEN 'ST' THEN 'UN' WHEN 'CS' THEN 'CJ' ELSE uom END AS uom, MIN(promo_price) AS promo_price FROM promos WHERE type IN (1, 4) GROUP BY 1, 2)
SELECT st.sku, st.store_id, g.uom, stock, price, promo_price, ean FROM st JOIN g USING (sku) JOIN mp ON mp.sku = st.sku AND mp.uom = g.uom AND r = 1 LEFT JOIN w ON w.sku = st.sku AND w.uom = g.uom
WHERE NOT blocked AND stock > 0 AND ean IS NOT NULL AND store_id IN (SELECT store_id FROM stores WHERE status = 1)""")
def _(sales, skus, stores, promos, prices):
    units = skus.select("sku", F.concat(F.lit(" "), F.lower("unit")).alias("uom"))
    stock = sales.groupBy("sku", "store_id", F.col("flag").alias("loaded_on")).agg(
        F.max("units").alias("stock"), F.bool_or(F.col("pct") == 10).alias("blocked")
    ).join(units, "sku")
    modal = prices.join(units, "sku").select(
        "sku", "uom", "price", F.when(F.col("min_qty") == 4, "09").when(F.col("min_qty") == 1, "02").otherwise("01").alias("format"),
        F.col("valid_from").alias("week"),
    )
    masters = skus.selectExpr("sku", "brand", "nullif(size, 13) AS ean")
    rows = plan.format_offers(stock, stores.where("status = 1"), modal, promos.where("type IN (1, 4)"), masters)
    return rows.select("sku", "store_id", "uom", "stock", "price", "promo_price", "ean")


@query("d27_marketplace_catalogue", "assortment skus", """
WITH l AS (SELECT sku, MAX(price) AS price FROM assortment WHERE NOT excluded AND blocked_store IS NULL AND blocked_format IS NULL GROUP BY 1),
r AS (SELECT sku // 3 AS material, sku AS ref_id, name, size / nullif(size % 6, 0) AS quantity, CASE unit WHEN 'KGV' THEN 'VERDADERO' ELSE '' END AS weighable,
  CASE WHEN size <> 20 THEN 'https://img.example/' || brand END AS image, price FROM skus JOIN l USING (sku) WHERE category <> 'SMALL')
SELECT * FROM (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY material ORDER BY ref_id) = 1) WHERE image IS NOT NULL""")
def _(assortment, skus):
    goods = skus.selectExpr(
        "sku", "sku div 3 AS material", "sku AS ref_id", "name", "category", "unit AS uom", "size AS content", "size % 6 AS pack"
    )
    images = skus.where("size <> 20").select("sku", F.lit(1).alias("position"), F.col("brand").alias("image"))
    rows = plan.marketplace_catalogue(assortment, goods, images, "https://img.example/", ("SMALL",))
    return rows.select("material", "ref_id", "name", "quantity", "weighable", "image", "price")


SAFETY = "sf AS (SELECT sku, store_id, MIN(units) % 9 AS safety FROM sales WHERE flag = 'A' GROUP BY 1, 2)"


def _safety(sales):
    return sales.where("flag = 'A'").groupBy("sku", "store_id").agg((F.min("units") % 9).alias("safety"))


@query("d28_availability_feed", FEEDS + " sales", f"""
WITH {BEST}, {SHELF}, {SAFETY}, o AS (SELECT a.sku, a.store_id, a.stock, uom, multiplier, sp.price, promo_price FROM assortment a JOIN goods USING (sku) JOIN sp ON sp.sku = a.sku AND sp.store_id = a.store_id LEFT JOIN best ON best.sku = a.sku
 WHERE brand IS NOT NULL AND a.stock >= multiplier),
u AS (SELECT o.*, coalesce(safety, 2) AS safety, CASE WHEN uom IN ('KG', 'KGV') THEN CAST(stock AS DOUBLE) ELSE stock / multiplier END AS units FROM o LEFT JOIN sf ON sf.sku = o.sku AND sf.store_id = o.store_id)
SELECT store_id, sku || CASE WHEN multiplier > 1 AND uom NOT IN ('KG', 'KGV') THEN '_' || multiplier ELSE '' END AS id, CAST(round(units) AS BIGINT) AS stock, price, least(promo_price, price) AS discount_price,
 CASE WHEN uom IN ('KG', 'KGV') THEN 'WW' ELSE 'U' END AS sale_type, (units >= safety)::INT AS active FROM u""")
def _(assortment, skus, stores, promos, sales):
    return plan.availability_feed(_offers(assortment, skus, stores, promos), _safety(sales))


@query("d28_net_stock_feed", FEEDS + " sales", f"""
WITH {SHELF}, {SAFETY}, o AS (SELECT a.sku, a.store_id, a.stock, uom, multiplier, sp.price, CASE WHEN a.store_id IN (1, 2, 3) THEN coalesce(safety, 0) ELSE 0 END AS h
 FROM assortment a JOIN goods USING (sku) JOIN sp ON sp.sku = a.sku AND sp.store_id = a.store_id LEFT JOIN sf ON sf.sku = a.sku AND sf.store_id = a.store_id WHERE brand IS NOT NULL AND a.stock >= multiplier)
SELECT sku, store_id, uom, CASE uom WHEN 'KGV' THEN 1 ELSE multiplier END AS units_per_sale, greatest(CASE uom WHEN 'KGV' THEN stock - h * multiplier ELSE (stock - h) * multiplier END, 0) AS quantity, price FROM o""")
def _(assortment, skus, stores, promos, sales):
    return plan.net_stock_feed(_offers(assortment, skus, stores, promos), _safety(sales), (1, 2, 3))


FULL = f"""full_feed AS (SELECT a.store_id, a.sku, a.stock, a.price, least(coalesce(promo_price, a.price), a.price) AS discount_price, brand, CASE WHEN uom IN ('KG', 'KGV') THEN 'WW' ELSE 'U' END AS sale_type
 FROM assortment a LEFT JOIN goods USING (sku) LEFT JOIN best ON best.sku = a.sku WHERE listed)"""


def _full_feed(assortment, skus, promos):
    stock = assortment.select("sku", "store_id", "stock", F.col("listed").alias("ecommerce"))
    return plan.full_stock_feed(stock, assortment.select("sku", "store_id", "price"), _goods(skus), plan.best_simple_promotion(promos, DAY))


@query("d28_full_feed", FEEDS, f"WITH {BEST}, {SHELF}, {FULL} SELECT * FROM full_feed")
def _(assortment, skus, stores, promos):
    return _full_feed(assortment, skus, promos)


@query("d28_changed_feed", FEEDS + " moves", f"""
WITH {BEST}, {SHELF}, {FULL} SELECT * FROM full_feed f WHERE EXISTS (SELECT 1 FROM moves m WHERE m.item = f.sku AND m.id % 10 = f.store_id AND ts BETWEEN TIMESTAMP '2024-01-20 08:00:00' AND TIMESTAMP '2024-01-25 12:00:00')""")
def _(assortment, skus, stores, promos, moves):
    moved = moves.select(F.col("item").alias("sku"), (F.col("id") % 10).alias("store_id"), "ts")
    return plan.changed_stock_feed(_full_feed(assortment, skus, promos), moved, "2024-01-25 12:00:00", 124)


VALID = "v AS (SELECT * FROM prices WHERE valid_from <= DATE '1998-06-20' AND (valid_to IS NULL OR valid_to >= DATE '1998-06-20'))"


@query("d63_copy_reference_prices", "prices stores", f"""
WITH {VALID}, n AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY store_id, sku, min_qty ORDER BY valid_from DESC, id DESC) = 1)
SELECT n.sku, n.store_id, n.min_qty, n.price, r.price AS reference_price, r.list_price AS reference_list FROM n JOIN n r ON r.sku = n.sku AND r.min_qty = n.min_qty AND r.store_id = 4
WHERE n.store_id <> 4 AND n.price <> r.price AND n.store_id IN (SELECT store_id FROM stores WHERE status = 1)""")
def _(prices, stores):
    rows = pricing.copy_reference_prices(prices, stores, 4, DAY)
    return rows.select("sku", "store_id", "min_qty", "price", "reference_price", "reference_list")




@query("d63_spread_reference_prices", "prices assortment", """
WITH r AS (SELECT a.sku, p.price, row_number() OVER (PARTITION BY a.sku ORDER BY a.price DESC, a.store_id, p.price) AS rn FROM assortment a JOIN prices p USING (sku, store_id)
 WHERE a.store_id IN (1, 2, 3, 4) AND (valid_to IS NULL OR valid_from <= valid_to))
SELECT p.id, p.sku, p.store_id, r.price AS new_price FROM prices p JOIN r ON r.sku = p.sku AND rn = 1 WHERE p.store_id IN (7, 8)""")
def _(prices, assortment):
    regular = assortment.select("sku", "store_id", F.col("price").alias("regular_price"))
    return pricing.spread_reference_prices(prices, regular, (1, 2, 3, 4), (7, 8)).select("id", "sku", "store_id", "new_price")


@query("d64_price_profiles", "prices stores", f"""
WITH {VALID.replace("v AS", "u AS")}, v AS (SELECT * FROM u WHERE store_id IN (SELECT store_id FROM stores WHERE status = 1) QUALIFY row_number() OVER (PARTITION BY sku, store_id, min_qty ORDER BY valid_from DESC, id DESC, price) = 1), t AS (SELECT sku, store_id, string_agg(DISTINCT min_qty || '-' || price || '-' || list_price, '|' ORDER BY min_qty || '-' || price || '-' || list_price) AS profile, count(*) AS n, MAX(CASE WHEN min_qty = 1 THEN price END) AS base FROM v GROUP BY 1, 2),
w AS (SELECT sku, store_id FROM t QUALIFY row_number() OVER (PARTITION BY sku ORDER BY (store_id = 4) DESC, n DESC, coalesce(base, 0) DESC, store_id) = 1),
d AS (SELECT *, row_number() OVER (PARTITION BY sku, store_id ORDER BY min_qty) - 1 AS level FROM v), f AS (SELECT sku, store_id, MIN(min_qty) AS least FROM d GROUP BY 1, 2),
k AS (SELECT w.sku, w.store_id, arg_min(list_price, min_qty) AS list_price,
  '{{"escalas":[{{"fechaInicio":"' || arg_min(valid_from::VARCHAR, min_qty) || '","fechaTermino":' || CASE WHEN arg_min(coalesce(valid_to::VARCHAR, ''), min_qty) = '' THEN 'null' ELSE '"' || arg_min(coalesce(valid_to::VARCHAR, ''), min_qty) || '"' END || ',' ||
   string_agg(CASE WHEN min_qty > 1 THEN '"nivel' || (level + CASE WHEN least > 1 THEN 1 ELSE 0 END) || '":{{"precio":"' || price || '","cantidad":"' || min_qty || '"}}' END, ',' ORDER BY min_qty) || '}}]}}' AS scale
  FROM w JOIN d USING (sku, store_id) JOIN f USING (sku, store_id) GROUP BY 1, 2)
SELECT k.*, (SELECT count(DISTINCT profile) = 1 FROM t WHERE t.sku = k.sku) AS uniform FROM k""")
def _(prices, stores):
    return pricing.price_profiles(pricing.valid_prices(prices, DAY), stores, 4)


@query("d65_price_tiers", "promos", """
WITH p AS (SELECT *, modal_price - 100 AS p1, qty_n - 1 AS f1, promo_price AS p2, CASE WHEN pct = 0 THEN 0 ELSE qty_n + 2 END AS f2, translate(trim(name), ' .+-,', '') AS policy FROM promos)
SELECT sku, policy, modal_price AS list_price, CAST(start_day AS VARCHAR) AS valid_from, CAST(end_day + 1 AS VARCHAR) AS valid_to, price, min_qty FROM
(SELECT *, modal_price AS price, CASE WHEN f1 = 1 THEN 0 ELSE 1 END AS min_qty FROM p UNION ALL SELECT *, p1, f1 FROM p UNION ALL SELECT *, p2, f2 FROM p) WHERE min_qty <> 0""")
def _(promos):
    wide = promos.withColumns({
        "price1": F.col("modal_price") - 100, "factor1": F.col("qty_n") - 1, "price2": F.col("promo_price"),
        "factor2": F.when(F.col("pct") == 0, 0).otherwise(F.col("qty_n") + 2),
    })
    return pricing.price_tiers(wide)


@query("d66_audit_published", "skus", """
WITH e AS (SELECT sku, list_price + CASE WHEN size = 10 THEN 5 ELSE 0 END AS p, CASE WHEN size < 30 THEN category END AS s FROM skus WHERE size <> 8), j AS (SELECT k.sku, k.list_price, nullif(k.category, 'PROMO') AS scale, e.p, e.s FROM skus k LEFT JOIN e USING (sku))
SELECT sku, list_price IS DISTINCT FROM p AS price_differs, scale IS DISTINCT FROM s AS scale_differs,
 '[' || concat_ws(',', CASE WHEN list_price IS DISTINCT FROM p THEN '{"name":"Precio Lista"' || coalesce(',"value":"' || p || '"', '') || '}' END, CASE WHEN scale IS DISTINCT FROM s THEN '{"name":"Escala Precios"' || coalesce(',"value":"' || s || '"', '') || '}' END) || ']' AS "update",
 '[' || concat_ws(',', CASE WHEN list_price IS DISTINCT FROM p THEN '{"name":"Precio Lista"' || coalesce(',"value":"' || list_price || '"', '') || '}' END, CASE WHEN scale IS DISTINCT FROM s THEN '{"name":"Escala Precios"' || coalesce(',"value":"' || scale || '"', '') || '}' END) || ']' AS backup
FROM j WHERE list_price IS DISTINCT FROM p OR scale IS DISTINCT FROM s""")
def _(skus):
    expected = skus.where("size <> 8").selectExpr(
        "sku", "list_price + CASE WHEN size = 10 THEN 5 ELSE 0 END AS list_price", "CASE WHEN size < 30 THEN category END AS scale"
    )
    return pricing.audit_published(expected, skus.selectExpr("sku", "list_price", "nullif(category, 'PROMO') AS scale"))


@query("d111_policy_prices", "assortment skus prices", """
SELECT p.id, p.sku, price, name FROM prices p JOIN skus USING (sku) WHERE min_qty IN (1, 4) AND size <> 5 AND p.sku IN (SELECT sku FROM assortment WHERE store_id IN (5, 6))""")
def _(assortment, skus, prices):
    policies = prices.withColumn("policy", F.col("min_qty").cast("string"))
    goods = skus.withColumn("web_id", F.expr("nullif(size, 5)"))
    return pricing.policy_prices(assortment, goods, policies, (5, 6), ("1", "4")).select("id", "sku", "price", "name")


@query("d113_load_price_list", "prices skus", """
SELECT id, sku, store_id, price, lpad(sku::VARCHAR, 18, '0') || '-' || unit AS ref_id FROM prices JOIN skus USING (sku) WHERE size > 2""")
def _(prices, skus):
    goods = skus.where("size > 2").select("sku", F.concat(F.lpad(F.col("sku").cast("string"), 18, "0"), F.lit("-"), "unit").alias("ref_id"))
    return pricing.load_price_list(prices, goods).select("id", "sku", "store_id", "price", "ref_id")
