"""Catalogue, assortment and stock queries."""

from pyspark.sql import functions as F

from granero.functions import dates
from granero.plans import assortment as stock_plan
from granero.plans import catalogue as plan
from granero.plans import calendar as calendar_plan
from granero.suite.registry import feed, query

feed("web_stock", ["sales"], """
SELECT sku, store_id * 10 + line_no % 2 AS warehouse, SUM(units) AS total_wide, MIN(units) AS reserved, MAX(units) AS peak
FROM sales GROUP BY sku, store_id * 10 + line_no % 2""")

SNAPSHOT = """
i AS (SELECT item AS sku, bool_or(kind = 'error') AS pending FROM moves GROUP BY 1),
snap AS (SELECT a.sku, a.store_id, a.stock, a.listed AND NOT a.excluded AS ecommerce, s.category, s.brand, i.sku IS NOT NULL AS photo_valid, coalesce(i.pending, false) AS photo_pending,
  coalesce(s.category <> 'SMALL', false) AS category_valid, (a.stock - a.price % 40 > 0) OR a.blocked_format IS NOT NULL AS stock_valid,
  EXISTS (SELECT 1 FROM sales x WHERE x.sku = a.sku AND x.store_id = a.store_id AND pct < 8) AS price_valid,
  EXISTS (SELECT 1 FROM sales x WHERE x.sku = a.sku AND x.store_id = a.store_id AND flag <> 'N') AS store_valid,
  s.size < 5 AS must_have, s.size > 45 AS top_seller, a.blocked_store, a.blocked_format, a.listed
  FROM assortment a LEFT JOIN skus s ON s.sku = a.sku LEFT JOIN i ON i.sku = a.sku),
snapshot AS (SELECT *, photo_valid AND category_valid AND store_valid AS published, photo_valid AND category_valid AND store_valid AND stock_valid AS sellable FROM snap)"""
SNAPSHOT_FEEDS = "assortment moves skus sales"


def _snapshot(assortment, moves, skus, sales):
    stock = assortment.select(
        "sku", "store_id", "stock", (F.col("listed") & ~F.col("excluded")).alias("ecommerce"),
        (F.col("stock") - F.col("price") % 40).alias("available"), F.col("blocked_format").isNotNull().alias("unlimited"),
    )
    images = moves.select(
        F.col("item").alias("sku"), F.when(F.col("kind") == "error", "Foto-en-camino").otherwise(F.col("kind")).alias("image")
    )
    products = skus.select("sku", "category", "brand", (F.col("category") != "SMALL").alias("category_active"))
    return plan.publication_snapshot(
        stock, images, products, sales.where("flag <> 'N'"), sales.where("pct < 8"), skus.where("size < 5"),
        skus.where("size > 45"),
    )


@query("d04_publication_snapshot", SNAPSHOT_FEEDS, f"""
WITH {SNAPSHOT} SELECT sku, store_id, brand, photo_valid, photo_pending, category_valid, stock_valid, price_valid, store_valid, must_have, top_seller, published, sellable FROM snapshot""")
def _(assortment, moves, skus, sales):
    snapshot = _snapshot(assortment, moves, skus, sales).withColumn("photo_pending", F.coalesce("photo_pending", F.lit(False)))
    return snapshot.select(
        "sku", "store_id", "brand", "photo_valid", "photo_pending", "category_valid", "stock_valid", "price_valid",
        "store_valid", "must_have", "top_seller", "published", "sellable",
    )


def _funnel_sql(by: str, scope: str = "true", source: str = "snapshot") -> str:
    names = {"published": "published", "sellable": "sellable", "with_stock": "stock > 0", "with_visible_stock": "stock_valid",
             "with_photo": "photo_valid", "with_category": "category_valid", "with_store": "store_valid"}
    counters = ", ".join(f"coalesce(SUM(CASE WHEN {c} THEN 1 ELSE 0 END), 0)::BIGINT AS {n}" for n, c in names.items())
    return f"""WITH {SNAPSHOT} SELECT {by}, count(*) AS assortment, {counters} FROM {source}
WHERE ecommerce AND blocked_store IS NULL AND blocked_format IS NULL AND listed AND {scope} GROUP BY {by}"""


_FUNNELS = {
    "d05_funnel_assortment": (["store_id", "category"], None, "true"),
    "d05_funnel_must_have": (["store_id", "category"], "must_have", "must_have"),
    "d05_funnel_top_300": (["store_id", "category"], "top_seller", "top_seller"),
    "d05_funnel_brand": (["store_id", "category", "brand"], None, "true"),
}
for _name, (_by, _scope, _text) in _FUNNELS.items():
    query(_name, SNAPSHOT_FEEDS, _funnel_sql(", ".join(_by), _text))(
        lambda assortment, moves, skus, sales, by=_by, scope=_scope: plan.publication_funnel(
            _snapshot(assortment, moves, skus, sales), assortment, by, F.col(scope) if scope else None
        )
    )


@query("d05_funnel_event", SNAPSHOT_FEEDS + " promos", _funnel_sql(
    "store_id, category, event", "event IN (400, 401, 402)", "(SELECT s.*, p.event FROM snapshot s JOIN promos p USING (sku))"))
def _(assortment, moves, skus, sales, promos):
    events = promos.where("event IN (400, 401, 402)").select("sku", "event").distinct()
    snapshot = _snapshot(assortment, moves, skus, sales).join(events, "sku")
    return plan.publication_funnel(snapshot, assortment, ["store_id", "category", "event"])


@query("d05_funnel_brand_supplier", SNAPSHOT_FEEDS + " stores", _funnel_sql(
    "store_id, category, brand, supplier", "supplier <> 'None'",
    "(SELECT s.*, CASE WHEN st.status = 1 THEN st.label ELSE 'None' END AS supplier FROM snapshot s JOIN stores st ON st.store_id = s.sku % 97)"))
def _(assortment, moves, skus, sales, stores):
    supplier = stores.select(
        F.col("store_id").alias("_s"), F.when(F.col("status") == 1, F.col("label")).otherwise("None").alias("supplier")
    )
    snapshot = _snapshot(assortment, moves, skus, sales).join(supplier, F.expr("sku % 97") == F.col("_s"))
    return plan.publication_funnel(
        snapshot, assortment, ["store_id", "category", "brand", "supplier"], F.col("supplier") != "None"
    )


@query("d05_funnels_together", SNAPSHOT_FEEDS, f"""
WITH {SNAPSHOT}, k AS (SELECT * FROM snapshot WHERE ecommerce AND blocked_store IS NULL AND blocked_format IS NULL AND listed)
SELECT 'all' AS variant, store_id, count(*) AS assortment, SUM(sellable::INT)::BIGINT AS sellable FROM k GROUP BY 2
UNION ALL SELECT 'top', store_id, count(*), SUM(sellable::INT)::BIGINT FROM k WHERE top_seller GROUP BY 2""")
def _(assortment, moves, skus, sales):
    variants = {"all": (["store_id"], None), "top": (["store_id"], F.col("top_seller"))}
    funnels = plan.publication_funnels(_snapshot(assortment, moves, skus, sales), assortment, variants)
    named = [df.select(F.lit(name).alias("variant"), "store_id", "assortment", "sellable") for name, df in funnels.items()]
    return named[0].unionByName(named[1])


@query("d06_catalogue_summary", SNAPSHOT_FEEDS, f"""
WITH {SNAPSHOT} SELECT '1998-06-15' AS day, store_id, count(*) AS assortment, SUM(published::INT)::BIGINT AS published, SUM(sellable::INT)::BIGINT AS sellable
FROM snapshot WHERE ecommerce AND blocked_store IS NULL AND blocked_format IS NULL AND listed AND category <> 'LARGE' GROUP BY 2""")
def _(assortment, moves, skus, sales):
    funnel = plan.publication_funnel(_snapshot(assortment, moves, skus, sales), assortment, ["store_id", "category"])
    hour = F.when(F.col("category") == "LARGE", 8).otherwise(12)
    at = F.timestamp_add("HOUR", hour, dates.as_date("1998-06-15").cast("timestamp"))
    return plan.catalogue_summary(funnel.withColumn("at", at), F.col("at"), "1998-06-15")


@query("d10_stock_snapshot", "web_stock stores sales assortment", """
WITH w AS (SELECT store_id * 10 + i AS warehouse, store_id, status, (i = 0 OR balance > 300000) AS dock_active FROM stores, (VALUES (0), (1)) v(i)),
b AS (SELECT sku, store_id, store_id * 10 AS warehouse, SUM(units)::BIGINT AS backend FROM sales WHERE flag = 'A' GROUP BY 1, 2)
SELECT s.sku, w.store_id, s.warehouse, s.peak AS total, s.reserved, s.peak - s.reserved AS available, b.backend,
  coalesce(NOT a.excluded AND a.blocked_store IS NULL AND a.blocked_format IS NULL AND a.listed, false) AS ecommerce
FROM web_stock s JOIN w USING (warehouse) LEFT JOIN b ON b.sku = s.sku AND b.warehouse = s.warehouse LEFT JOIN assortment a ON a.sku = s.sku AND a.store_id = w.store_id
WHERE w.status = 1 AND w.dock_active AND NOT (w.store_id = 3 AND s.warehouse = 31)""")
def _(web_stock, stores, sales, assortment):
    warehouses = stores.select("store_id", "balance", F.explode(F.array(F.lit(0), F.lit(1))).alias("i")).select(
        (F.col("store_id") * 10 + F.col("i")).alias("warehouse"), "store_id",
        ((F.col("i") == 0) | (F.col("balance") > 300000)).alias("dock_active"),
    )
    backend = sales.where("flag = 'A'").groupBy("sku", "store_id").agg(F.sum("units").alias("backend"))
    backend = backend.withColumn("warehouse", F.col("store_id") * 10)
    web = web_stock.select("sku", "warehouse", F.col("peak").alias("total"), "reserved")
    rows = stock_plan.stock_snapshot(web, warehouses, stores, backend, assortment, [(3, 31)])
    return rows.select("sku", "store_id", "warehouse", "total", "reserved", "available", "backend", "ecommerce")


@query("d11_top_store_stock", "assortment lines baskets", """
WITH t AS (SELECT CAST(b.store_id AS BIGINT) AS store_id, sku, SUM(price * asked) AS g FROM lines JOIN baskets b USING (order_id)
  WHERE b.day BETWEEN DATE '1998-06-08' AND DATE '1998-06-14' GROUP BY 1, 2),
k AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY g DESC, sku) <= 300)
SELECT a.sku, a.store_id, a.stock FROM assortment a JOIN k USING (sku, store_id)""")
def _(assortment, lines, baskets):
    days = baskets.select("day").distinct()
    calendar = calendar_plan.relative_calendar(days, "1998-06-15")
    return plan.top_store_stock(assortment, lines, baskets, calendar).select("sku", "store_id", "stock")


@query("d37_detect_changes", "assortment skus", """
WITH c AS (SELECT sku, store_id, MAX(stock) AS s, bool_or(blocked_format IS NOT NULL) AS m FROM assortment WHERE listed AND NOT excluded GROUP BY 1, 2),
v AS (SELECT sku, store_id, CASE WHEN size < 25 THEN a.stock ELSE size END AS stock, category <> 'SMALL' AS active, size > 40 AS not_found FROM assortment a JOIN skus USING (sku) WHERE brand <> 'Brand#5'),
j AS (SELECT coalesce(c.sku, v.sku) AS sku, coalesce(c.store_id, v.store_id) AS store_id, c.sku IS NOT NULL AS listed, c.s, c.m, v.stock, v.active, v.not_found FROM c FULL JOIN v ON c.sku = v.sku AND c.store_id = v.store_id)
SELECT sku, store_id, CASE WHEN stock IS NULL THEN 'new' WHEN listed AND active AND (s <> stock OR m <> not_found) THEN 'changed'
  WHEN NOT listed AND active THEN 'deactivated' WHEN listed AND NOT active THEN 'reactivated' END AS change, listed AS active, coalesce(s, 0) AS stock, coalesce(m, false) AS not_found FROM j
WHERE stock IS NULL OR (listed AND active AND (s <> stock OR m <> not_found)) OR (NOT listed AND active) OR (listed AND NOT active)""")
def _(assortment, skus):
    """The whole assortment, product by store; the image lacks a brand and is outdated for the larger sizes."""
    key = ["sku", "store_id"]
    listed = assortment.where("listed AND NOT excluded").select(*key, "stock", F.col("blocked_format").isNotNull().alias("not_found"))
    image = assortment.join(skus.where("brand <> 'Brand#5'"), "sku").select(
        *key, F.when(F.col("size") < 25, F.col("stock")).otherwise(F.col("size").cast("long")).alias("stock"),
        (F.col("category") != "SMALL").alias("active"), (F.col("size") > 40).alias("not_found"),
    )
    return plan.detect_changes(listed, image, key)


@query("d38_upload_set", "assortment sales skus stores", """
WITH st AS (SELECT store_id FROM stores WHERE status = 1), ok AS (SELECT sku FROM skus WHERE category <> 'PROMO'),
w AS (SELECT sku, store_id FROM assortment WHERE listed AND store_id IN (FROM st) AND sku IN (FROM ok)),
p AS (SELECT DISTINCT sku, store_id FROM sales WHERE flag = 'A' AND store_id IN (FROM st)),
ch AS (SELECT DISTINCT sku FROM ((FROM w EXCEPT FROM p) UNION ALL (FROM p EXCEPT FROM w)))
SELECT sku, string_agg(DISTINCT store_id::VARCHAR, ',' ORDER BY store_id::VARCHAR) AS stores, 1 AS visible, 1 AS active FROM w
WHERE sku IN (FROM ch) AND NOT EXISTS (SELECT 1 FROM sales x WHERE x.units = 50 AND x.sku = w.sku AND x.store_id = w.store_id) GROUP BY 1
UNION ALL SELECT DISTINCT sku, '0486', 0, 0 FROM p WHERE sku NOT IN (SELECT sku FROM w)""")
def _(assortment, sales, skus, stores):
    return plan.upload_set(
        assortment.where("listed"), sales.where("flag = 'A'").select("sku", "store_id").distinct(),
        skus.where("category <> 'PROMO'").select("sku"), stores.where("status = 1").select("store_id"),
        sales.where("units = 50").select("sku", "store_id"), "0486",
    )


@query("d39_removed_since_yesterday", "sales", """
WITH y AS (SELECT DISTINCT store_id, sku FROM sales WHERE flag = 'A'), t AS (SELECT DISTINCT store_id, sku FROM sales WHERE flag = 'R' AND store_id <> 2)
SELECT * FROM y WHERE store_id IN (SELECT store_id FROM t) AND (store_id, sku) NOT IN (FROM t)""")
def _(sales):
    pairs = sales.select("store_id", "sku", "flag").distinct()
    return plan.removed_since(
        pairs.where("flag = 'A'").drop("flag"), pairs.where("flag = 'R' AND store_id <> 2").drop("flag")
    )


KIT = """SELECT name || '/' || category || '/' || brand AS bundle, sku, 1 + size % 3 AS quantity, 1 + size % 2 AS multiplier FROM skus"""
feed("kits", ["skus"], KIT)


@query("d40_bundle_stores", "kits assortment", """
WITH o AS (SELECT sku, store_id FROM assortment WHERE listed), c AS (SELECT bundle, store_id, count(DISTINCT sku) AS n FROM kits JOIN o USING (sku) GROUP BY 1, 2)
SELECT bundle, string_agg(store_id::VARCHAR, ',' ORDER BY store_id::VARCHAR) AS stores FROM c
WHERE n = (SELECT count(DISTINCT sku) FROM kits k WHERE k.bundle = c.bundle) GROUP BY 1""")
def _(kits, assortment):
    return plan.bundle_stores(kits.select("bundle", "sku"), assortment.where("listed"))


@query("d40_bundle_prices", "kits skus", """
SELECT bundle, CASE WHEN count(b) = count(*) THEN SUM(b * quantity * multiplier)::BIGINT END AS base,
  CASE WHEN count(l) = count(*) THEN SUM(l * quantity * multiplier)::BIGINT END AS list
FROM kits JOIN (SELECT sku, CASE WHEN size <> 7 THEN list_price END AS b, CASE WHEN size < 40 THEN list_price + 10 END AS l FROM skus) p USING (sku) GROUP BY 1""")
def _(kits, skus):
    prices = skus.select(
        "sku", F.expr("CASE WHEN size <> 7 THEN list_price END").alias("base"),
        F.expr("CASE WHEN size < 40 THEN list_price + 10 END").alias("list"),
    )
    return plan.bundle_prices(kits, prices)


@query("d41_load_assortment", "assortment skus sales stores", """
WITH f AS (SELECT sku, store_id, stock, blocked_store, blocked_format FROM assortment),
g AS (SELECT sku FROM skus WHERE size < 6), e AS (SELECT DISTINCT sku, store_id FROM sales WHERE pct = 10), r AS (SELECT DISTINCT sku, store_id FROM sales WHERE units = 1),
q AS (SELECT sku - sku % 3 AS purchase_sku, sku AS sale_sku FROM skus WHERE unit IN ('KG', 'KGV') AND sku - sku % 3 <> sku),
ps AS (SELECT sku, store_id, listed, NOT excluded AS active, blocked_store, blocked_format FROM assortment),
x AS (SELECT coalesce(q.sale_sku, ps.sku) AS sku, store_id, NOT listed OR NOT active OR blocked_store IS NOT NULL OR blocked_format IS NOT NULL AS bad, blocked_store AS bs, blocked_format AS bf
  FROM ps LEFT JOIN q ON q.purchase_sku = ps.sku),
p AS (SELECT sku, store_id, bool_or(bad) AS bad, MAX(bs) AS bs, MAX(bf) AS bf FROM x GROUP BY 1, 2)
SELECT f.sku, f.store_id, coalesce(f.blocked_store, p.bs) AS blocked_store, coalesce(f.blocked_format, p.bf) AS blocked_format,
 (f.sku IN (FROM g) AND (f.sku, f.store_id) NOT IN (FROM e)) OR (f.sku, f.store_id) IN (FROM r) OR coalesce(p.bad, false) AS excluded
FROM f LEFT JOIN p ON p.sku = f.sku AND p.store_id = f.store_id""")
def _(assortment, skus, sales, stores):
    files = assortment.select("sku", "store_id", "stock", "blocked_store", "blocked_format")
    equivalents = skus.where("unit IN ('KG', 'KGV')").selectExpr("sku - sku % 3 AS purchase_sku", "sku AS sale_sku").where("purchase_sku <> sale_sku")
    state = assortment.select("sku", "store_id", "listed", (~F.col("excluded")).alias("active"), "blocked_store", "blocked_format")
    loaded = stock_plan.load_assortment(
        files, skus.where("size < 6"), sales.where("pct = 10"), sales.where("units = 1"), equivalents, state
    )
    return loaded.select("sku", "store_id", "blocked_store", "blocked_format", "excluded")


@query("d41_exclusion_table", "skus sales", """
SELECT sku, 1 AS all_stores, NULL::BIGINT AS store_id FROM skus s WHERE size < 20 AND NOT EXISTS (SELECT 1 FROM sales x WHERE x.sku = s.sku AND x.units = 50)
UNION ALL SELECT DISTINCT sku, 0, store_id FROM sales WHERE units = 2""")
def _(skus, sales):
    return stock_plan.exclusion_table(
        skus.where("size < 20"), sales.where("units = 50"), sales.where("units = 2").select("sku", "store_id").distinct()
    )


@query("d42_sold_assortment", "assortment sales", """
SELECT DISTINCT a.sku, a.store_id FROM assortment a JOIN sales s ON s.sku = a.sku AND s.store_id = a.store_id AND s.flag = 'N'""")
def _(assortment, sales):
    return stock_plan.sold_assortment(assortment, sales.where("flag = 'N'"))


@query("d62_substitutable_moves", "assortment skus", """
WITH v AS (SELECT sku, bool_and(stock > 3) AS v FROM assortment GROUP BY 1)
SELECT sku, name, CASE WHEN v THEN 'in' ELSE 'out' END AS move FROM skus JOIN v USING (sku)
WHERE (v AND category NOT IN ('SMALL', 'PROMO')) OR (NOT v AND category = 'SMALL')""")
def _(assortment, skus):
    votes = assortment.select("sku", (F.col("stock") > 3).alias("substitute"))
    return plan.substitutable_moves(votes, skus, "SMALL", "PROMO")


@query("d76_unify_group_stock", "assortment skus", """
WITH m AS (SELECT store_id, brand || category AS grp, a.sku, stock FROM assortment a JOIN skus USING (sku) WHERE store_id NOT IN (3, 4))
SELECT DISTINCT m.store_id, grp AS "group", sku, CAST(SUM(stock) OVER (PARTITION BY m.store_id, grp) AS BIGINT) AS group_stock FROM m""")
def _(assortment, skus):
    groups = skus.select("sku", F.concat("brand", "category").alias("group"))
    return stock_plan.unify_group_stock(assortment.select("sku", "store_id", "stock"), groups, [3, 4])


@query("d77_stock_breaks", "sales", """
SELECT sku, store_id, CAST(day AS VARCHAR) AS day FROM sales WHERE units < 4
 AND ((flag <> 'N' AND day BETWEEN DATE '1998-06-15' - 60 AND DATE '1998-06-15' - 15) OR (flag = 'N' AND day > DATE '1998-06-15' - 15))""")
def _(sales):
    rows = sales.select("sku", "store_id", "day", "flag", F.when(F.col("units") >= 4, F.col("units")).alias("stock"))
    found = plan.stock_breaks(rows.where("flag <> 'N'"), rows.where("flag = 'N'"), "1998-06-15")
    return found.select("sku", "store_id", "day")


@query("d82_seller_conflicts", "assortment moves", """
SELECT sku, store_id FROM assortment WHERE sku IN (SELECT item FROM moves WHERE length(kind) <> 5)""")
def _(assortment, moves):
    sellers = moves.select(F.col("item").alias("sku"), F.when(F.length("kind") == 5, 1).otherwise(2).alias("seller"))
    return plan.seller_conflicts(assortment, sellers).select("sku", "store_id")


@query("d103_delist_missing", "sales", """
WITH t AS (SELECT sku, MAX(units) AS stock, 1 AS active FROM sales WHERE flag = 'A' AND units > 20 GROUP BY 1),
y AS (SELECT sku, MAX(units) AS stock, CASE WHEN MAX(units) > 30 THEN 1 ELSE 0 END AS active FROM sales WHERE flag = 'N' GROUP BY 1)
FROM t UNION ALL SELECT sku, stock, 0 FROM y WHERE active = 1 AND sku NOT IN (SELECT sku FROM t)""")
def _(sales):
    today = sales.where("flag = 'A' AND units > 20").groupBy("sku").agg(F.max("units").alias("stock"), F.lit(1).alias("active"))
    before = sales.where("flag = 'N'").groupBy("sku").agg(
        F.max("units").alias("stock"), F.when(F.max("units") > 30, 1).otherwise(0).alias("active")
    )
    return plan.delist_missing(today, before)


@query("d104_reconcile_catalogue", "assortment skus stores", """
WITH l AS (SELECT sku, string_agg(DISTINCT store_id::VARCHAR, ',' ORDER BY store_id::VARCHAR) AS stores FROM assortment
  WHERE NOT excluded AND listed AND store_id IN (SELECT store_id FROM stores WHERE status = 1) GROUP BY 1)
SELECT s.sku, coalesce(stores, '3188') AS stores, (stores IS NOT NULL)::INT AS visible, (stores IS NOT NULL)::INT AS active FROM skus s LEFT JOIN l USING (sku) WHERE size <> 9""")
def _(assortment, skus, stores):
    return plan.reconcile_catalogue(
        assortment.where("listed"), skus, skus.where("size = 9").select("sku"), stores.where("status = 1").select("store_id"), "3188"
    )


@query("d106_store_channels", "assortment stores", """
SELECT DISTINCT sku, a.store_id::VARCHAR AS store_id, CASE WHEN status = 1 THEN 'web' || district END AS channel FROM assortment a JOIN stores USING (store_id) WHERE listed""")
def _(assortment, stores):
    load = assortment.where("listed").groupBy("sku").agg(
        F.array_join(F.collect_set(F.col("store_id").cast("string")), ",").alias("stores")
    )
    channels = stores.select("store_id", F.when(F.col("status") == 1, F.concat(F.lit("web"), "district")).alias("channel"))
    return plan.store_channels(load, channels)


@query("d107_complete_set", "skus promos assortment", """
WITH f AS (SELECT sku, MIN(stock) AS stock FROM assortment GROUP BY 1), r AS (SELECT sku FROM skus UNION SELECT n_promo FROM promos)
SELECT sku, stock, false AS not_found FROM f UNION ALL SELECT sku, 0, true FROM r WHERE sku NOT IN (SELECT sku FROM f)""")
def _(skus, promos, assortment):
    """All products and the codes of promotional packs are asked for; the whole assortment answers, which has no packs."""
    requested = skus.select("sku").unionByName(promos.select(F.col("n_promo").alias("sku")))
    return plan.complete_set(requested, assortment.select("sku", "stock"))


@query("d67_active_catalogue", "assortment skus", """
SELECT sku, size AS web_id, name, category, coalesce(category NOT IN ('SMALL'), false) AS category_valid FROM skus
WHERE size <> 3 AND sku IN (SELECT sku FROM assortment WHERE listed)""")
def _(assortment, skus):
    products = skus.withColumn("web_id", F.expr("nullif(size, 3)"))
    return plan.active_catalogue(assortment.where("listed"), products, ("SMALL",))


@query("d36_reconcile_stock", "assortment skus sales", """
WITH a AS (SELECT a.sku, a.store_id, a.stock, CASE s.unit WHEN 'CS' THEN 'CJ' WHEN 'ST' THEN (CASE WHEN s.size = 1 THEN 'PAQ' ELSE 'UN' END) ELSE s.unit END AS uom, 1 + s.size % 4 AS m FROM assortment a JOIN skus s USING (sku)),
y AS (SELECT sku, store_id, MAX(CASE WHEN flag <> 'N' THEN units END) AS sys FROM sales GROUP BY 1, 2),
w AS (SELECT sku AS purchase_sku, store_id, SUM(units)::BIGINT AS ws FROM sales WHERE pct > 4 GROUP BY 1, 2),
p AS (SELECT a.sku, a.store_id, MAX(ws) AS ps FROM a JOIN w ON w.purchase_sku = a.sku - a.sku % 5 AND w.store_id = a.store_id WHERE uom IN ('KG', 'KGV') GROUP BY 1, 2)
SELECT a.sku, a.store_id, a.stock, coalesce(sys, 0) AS system_stock,
 CAST(round(CASE WHEN coalesce(ps, 0) <> 0 THEN ps / m WHEN uom IN ('KG', 'KGV') THEN a.stock / m ELSE a.stock END) AS BIGINT) AS expected
FROM a JOIN y USING (sku, store_id) LEFT JOIN p USING (sku, store_id) WHERE uom <> 'PAQ'""")
def _(assortment, skus, sales):
    uom = F.expr("CASE unit WHEN 'CS' THEN 'CJ' WHEN 'ST' THEN (CASE WHEN size = 1 THEN 'PAQ' ELSE 'UN' END) ELSE unit END")
    units = skus.select("sku", uom.alias("uom"))
    rows = assortment.select("sku", "store_id", "stock").join(units, "sku")
    system = sales.groupBy("sku", "store_id").agg(F.max(F.when(F.col("flag") != "N", F.col("units"))).alias("system_stock"))
    warehouse = sales.where("pct > 4").groupBy(F.col("sku").alias("purchase_sku"), "store_id").agg(F.sum("units").alias("warehouse_stock"))
    parents = rows.where("uom IN ('KG', 'KGV')").selectExpr("sku", "store_id", "sku - sku % 5 AS purchase_sku")
    return stock_plan.reconcile_stock(rows, system, skus.selectExpr("sku", "1 + size % 4 AS multiplier"), parents, warehouse)


@query("d43_recency_flags", "assortment sales", """
SELECT a.sku, a.store_id, """ + ", ".join(f"coalesce(MAX((DATE '1998-06-15' - day = {d})::INT), 0) AS day_{d}" for d in range(1, 11)) + """
FROM assortment a LEFT JOIN sales s ON s.sku = a.sku AND s.store_id = a.store_id AND DATE '1998-06-15' - day BETWEEN 1 AND 10 GROUP BY 1, 2""")
def _(assortment, sales):
    return stock_plan.recency_flags(assortment, sales, dates.as_date("1998-06-15"))


@query("d100_immobile_stock", "assortment sales skus stores", """
WITH f AS (SELECT a.sku, a.store_id, coalesce(MIN(DATE '1998-06-15' - day) - 1, 10) AS age FROM assortment a LEFT JOIN sales s ON s.sku = a.sku AND s.store_id = a.store_id AND DATE '1998-06-15' - day BETWEEN 1 AND 10 GROUP BY 1, 2)
SELECT sku, f.store_id, category, CAST(age AS INT) AS days_since FROM f JOIN skus USING (sku) JOIN stores USING (store_id) WHERE category <> 'LARGE' AND age = district % 11""")
def _(assortment, sales, skus, stores):
    sold = assortment.select("sku", "store_id").join(skus.where("category <> 'LARGE'").select("sku", "category"), "sku").select("store_id", "category").distinct()
    thresholds = sold.join(stores.select("store_id", (F.col("district") % 11).alias("threshold")), "store_id")
    flags = stock_plan.recency_flags(assortment, sales, dates.as_date("1998-06-15"))
    return stock_plan.immobile_stock(flags, skus, thresholds).select("sku", "store_id", "category", "days_since")


@query("d79_adjustment_totals", "sales", """
SELECT CAST(day AS VARCHAR) AS day, store_id, sku, SUM(units)::BIGINT AS units, count(*) AS adjustments FROM sales
WHERE flag = 'R' AND day >= DATE '1998-06-15' - 60 GROUP BY 1, 2, 3""")
def _(sales):
    from granero.operators.merge import backfill_filter

    window = backfill_filter(sales.where("units < 0"), F.col("day"), dates.as_date("1998-06-15"), 60, 7)
    return stock_plan.adjustment_totals(sales.where("flag = 'R'").where(window))


@query("d101_last_plan_rows", "lines", """
SELECT line_id, order_id, line_no = MAX(line_no) OVER (PARTITION BY order_id) AS current FROM lines""")
def _(lines):
    return stock_plan.last_plan_rows(lines.select("line_id", "order_id", "line_no"), "order_id", "line_no").drop("line_no")


@query("d46_fill_rates", "sales skus", """
WITH t AS (SELECT sku, day, SUM(units)::BIGINT AS ordered, SUM(CASE WHEN flag <> 'R' THEN units ELSE 0 END)::BIGINT AS received FROM sales GROUP BY 1, 2),
l AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY sku ORDER BY day DESC) = 1)
SELECT s.sku, s.size, ordered, received, received / nullif(ordered, 0) AS fill_rate FROM skus s LEFT JOIN l USING (sku)""")
def _(sales, skus):
    bought = sales.select(
        "sku", F.col("day").alias("received_on"), F.col("units").alias("ordered"),
        F.when(F.col("flag") != "R", F.col("units")).otherwise(0).alias("received"),
    )
    return stock_plan.fill_rates(bought, skus.select("sku", "size")).select("sku", "size", "ordered", "received", "fill_rate")


@query("d22_promotion_days", "promos", """
WITH d AS (SELECT CAST(unnest(generate_series(DATE '1998-06-15', DATE '1998-06-15' + 21, INTERVAL 1 DAY)) AS DATE) AS day)
SELECT CAST(day AS VARCHAR) AS day, mechanic, channel, count(sku) AS promotions FROM d JOIN promos ON day BETWEEN start_day AND end_day
WHERE mechanic NOT IN (36, 12, 37) GROUP BY ALL""")
def _(promos):
    return plan.promotion_days(promos, "1998-06-15", 21, (36, 12, 37))


@query("d109_returnable_residual", "kits skus", """
WITH k AS (SELECT bundle, MIN(sku) AS original, MAX(sku) AS container FROM kits GROUP BY 1 HAVING count(*) = 2)
SELECT bundle, original, container, w.list_price - c.list_price + 30 * (w.size - c.size) AS residual FROM k JOIN skus w ON w.sku = original JOIN skus c ON c.sku = container
WHERE w.list_price - c.list_price + 30 * (w.size - c.size) >= 0""")
def _(kits, skus):
    bundles = kits.groupBy("bundle").agg(F.min("sku").alias("original"))
    prices = skus.select("sku", (F.col("list_price") + 30 * F.col("size")).alias("base"))
    return plan.returnable_residual(bundles, kits, prices)
