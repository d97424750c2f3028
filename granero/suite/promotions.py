"""Promotion queries."""

from pyspark.sql import functions as F

from granero.plans import promotions as plan
from granero.suite.registry import feed, query

DAY = "1998-06-20"
LIVE = "start_day <= DATE '1998-06-20' + {ahead} AND end_day >= DATE '1998-06-20' - {behind}"


def _full(promos):
    """Columns only some encodings need."""
    return promos.withColumns({
        "multiplier": F.when(F.col("qty_m") == 1, F.lit(0.5)).otherwise(F.lit(1.0)), "take_n": F.lit(2),
        "pct_n": F.col("pct"), "total_price": F.col("promo_price") * F.col("qty_n"), "web_id": F.expr("nullif(sku, 7)"),
    })


UOM = "CASE uom WHEN 'ST' THEN 'UN' WHEN 'CS' THEN 'CJ' ELSE uom END"


def _case(column: str, table: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in table.items()) + " END"


IDENTIFIER = f"""n_promo || ' ' || regexp_replace(name, '[^a-zA-Z0-9]', '', 'g') || '_' ||
 CASE WHEN {_case('mechanic', plan.CODES_FIRST)} IS NOT NULL THEN {_case('mechanic', plan.CODES_FIRST)} WHEN name LIKE '%CYBER%' THEN 'C029'
  WHEN mechanic = 57 THEN 'C031' WHEN mechanic = 7 THEN 'C064' WHEN event = 400 THEN 'C065' WHEN mechanic = 115 THEN 'C073' ELSE 'C011' END || '_' ||
 CASE type WHEN 7 THEN {_case('qty_n', plan.BUNDLE_CODES)} || promo_price WHEN 1 THEN {_case('pct', plan.PERCENT_CODES)}
  WHEN 4 THEN CASE WHEN uom IN ('KG', 'KGV') THEN '__' || round(promo_price * mult)::BIGINT ELSE '_XXXX_' END
  WHEN 2 THEN brand || CASE qty_n WHEN 2 THEN 'M022-1__' WHEN 3 THEN 'M023-1__' WHEN 4 THEN 'M003__' || promo_price WHEN 5 THEN 'M004__' || promo_price WHEN 6 THEN 'M005__' || promo_price END
  WHEN 8 THEN {_case('pct', plan.SECOND_UNIT_CODES)} ELSE 'FALTA_COD_MEC' END"""


@query("d20_promotion_list", "promos assortment", f"""
WITH p AS (SELECT * REPLACE ({UOM} AS uom), CASE WHEN qty_m = 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS mult FROM promos
  WHERE {LIVE.format(ahead=1, behind=0)} AND mechanic NOT IN (36, 37) AND name NOT LIKE '%MFC%' AND name NOT LIKE '%BANCO ESTADO%' AND name NOT LIKE '%UNIPAY%' AND name NOT LIKE '%917%' AND name NOT LIKE '% LOC%' AND sku IN (SELECT sku FROM assortment WHERE listed))
SELECT sku, n_promo, {IDENTIFIER} AS identifier, CASE WHEN type IN (1, 4) THEN 'regular' ELSE 'forThePriceOf' END AS mechanic_kind,
 CASE type WHEN 4 THEN CASE WHEN uom IN ('KG', 'KGV') THEN (round(promo_price * mult)::BIGINT)::VARCHAR ELSE 'lista-precio' END WHEN 7 THEN promo_price::VARCHAR ELSE '0' END AS price FROM p""")
def _(promos, assortment):
    rows = plan.promotion_list(_full(promos), assortment.where("listed"), DAY)
    return rows.select("sku", "n_promo", "identifier", "mechanic_kind", "price")


SUMMARY = f"""
s AS (SELECT sku, count(DISTINCT store_id) AS stores FROM assortment WHERE store_id IN (SELECT store_id FROM stores WHERE status = 1) GROUP BY 1),
summary AS (SELECT p.sku, event AS n_promo, name, stores, promo_price, modal_price, CAST(round(CASE type WHEN 2 THEN (1 - qty_m / qty_n) * 100
    WHEN 7 THEN (1 - (promo_price * qty_n) / qty_n / modal_price) * 100 WHEN 8 THEN pct / 2 WHEN 1 THEN pct ELSE (1 - promo_price / modal_price) * 100 END) AS INT) AS discount,
  event || ' ' || regexp_replace(name, '[^a-zA-Z0-9]', '', 'g') || '_' || CASE type WHEN 7 THEN brand || '_' || qty_n || 'x' || (promo_price * qty_n) || '$'
    WHEN 1 THEN pct || '%' WHEN 4 THEN CASE WHEN uom = 'KG' THEN '_PESABLE_' || round(promo_price * CASE WHEN qty_m = 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END)::BIGINT ELSE 'LISTA_PRECIOS' END
    WHEN 2 THEN brand || '_' || qty_n || 'x' || qty_m ELSE brand || '_' || pct || '_2DA_UN' END ||
   CASE WHEN type IN (1, 4) THEN '' WHEN count(nullif(p.sku, 7)) OVER (PARTITION BY event) > 1 THEN '_CLP1' ELSE '_CLP0' END AS published_name,
  CASE WHEN type = 4 AND uom <> 'KG' THEN regexp_replace(name, '[^a-zA-Z0-9]', '', 'g') ELSE 'NO_APLICA' END AS price_list
 FROM promos p JOIN s USING (sku) WHERE {LIVE.format(ahead=8, behind=0)} AND mechanic NOT IN (36, 37, 50) AND name NOT LIKE '%LOC%')"""


def _summary(promos, assortment, stores):
    grouped = _full(promos).withColumn("n_promo", F.col("event"))
    return plan.promotion_summary(grouped, assortment, stores, DAY, ["%LOC%"])


@query("d21_promotion_summary", "promos assortment stores", f"""
WITH {SUMMARY} SELECT sku, n_promo, stores, discount, published_name, price_list FROM summary""")
def _(promos, assortment, stores):
    return _summary(promos, assortment, stores).select("sku", "n_promo", "stores", "discount", "published_name", "price_list")


@query("d21_discount_alerts", "promos assortment stores skus", f"""
WITH {SUMMARY} SELECT sku, name, discount FROM summary a WHERE discount > 75 AND NOT EXISTS (SELECT 1 FROM skus k WHERE k.sku = a.sku AND k.size > 45 AND a.name = 'Precio bajo!')""")
def _(promos, assortment, stores, skus):
    exceptions = skus.where("size > 45").select("sku", F.lit("Precio bajo!").alias("name"))
    return plan.discount_alerts(_summary(promos, assortment, stores), exceptions).select("sku", "name", "discount")


feed("versions", ["sales"], """
SELECT sku, order_id AS n_promo, day AS start_day, day + CAST(units % 9 AS INT) AS end_day, store_id % 5 <> 0 AS current,
       CASE WHEN pct < 8 THEN '1000' ELSE '3000' END AS organisation FROM sales""")


@query("d23_date_changes", "versions", """
WITH v AS (SELECT DISTINCT sku, n_promo, start_day, MAX(end_day) AS end_day, bool_or(current) AS current, MIN(organisation) AS organisation FROM versions GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY start_day DESC, n_promo DESC) AS rn FROM v)
SELECT a.sku, a.n_promo, CAST(a.start_day AS VARCHAR) AS start_day, CAST(a.end_day AS VARCHAR) AS end_day, CAST(b.start_day AS VARCHAR) AS previous_start, CAST(b.end_day AS VARCHAR) AS previous_end
FROM r a JOIN r b ON a.sku = b.sku AND a.rn = 1 AND b.rn = 2 WHERE a.current AND (a.start_day <> b.start_day OR a.end_day <> b.end_day) AND a.organisation = '1000'""")
def _(versions):
    unique = versions.groupBy("sku", "n_promo", "start_day").agg(
        F.max("end_day").alias("end_day"), F.bool_or("current").alias("current"), F.min("organisation").alias("organisation")
    )
    return plan.date_changes(unique, ["1000", "7500"])


@query("d24_purchase_limits", "promos skus", f"""
SELECT sku, n_promo, abs(promo_price - modal_price) AS off, pct, CAST(end_day AS VARCHAR) AS end_day, CASE WHEN end_day < DATE '1998-06-20' THEN 999 ELSE 48 END AS limit_code FROM promos
WHERE {LIVE.format(ahead=1, behind=1)} AND mechanic NOT IN (36, 37) AND name NOT LIKE '%MFC%' AND name NOT LIKE '%S06%' AND name NOT LIKE '%NO ELIMINAR%' AND name NOT LIKE '%UNIPAY%' AND name NOT LIKE '%917%' AND name NOT LIKE '%0743%' AND name NOT LIKE '% LOC%' AND name NOT LIKE '%L65%' AND name NOT LIKE '%L0089%' AND (event IN (402, 404) OR abs(promo_price - modal_price) >= 5000 OR pct >= 25)
 AND sku NOT IN (SELECT sku FROM skus WHERE size = 11)""")
def _(promos, skus):
    return plan.purchase_limits(promos, skus.where("size = 11"), DAY)


OFFERS = """SELECT l_partkey AS sku, l_orderkey * 10 + l_linenumber AS n_promo,
 CASE l_returnflag WHEN 'A' THEN 'strikethrough' WHEN 'N' THEN 'bundle_price' ELSE 'free_item' END AS kind,
 CAST(round(l_extendedprice) AS BIGINT) AS regular_price, CAST(round(l_extendedprice * (1 - l_tax * 3)) AS BIGINT) AS strike_price,
 CAST(l_quantity AS BIGINT) * 1500 AS total_price, 2 + l_linenumber % 5 AS qty_n, 1 + l_linenumber % 2 AS qty_m, l_suppkey AS store_id FROM lineitem"""
feed("multibuy", ["lineitem"], OFFERS)


@query("d29_best_promotion", "multibuy", """
WITH u AS (SELECT *, CASE kind WHEN 'strikethrough' THEN CAST(strike_price AS DOUBLE) WHEN 'bundle_price' THEN total_price / qty_n ELSE (qty_m * regular_price) / qty_n END AS unit_price FROM multibuy)
SELECT DISTINCT sku, unit_price, n_promo FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY unit_price, n_promo) AS r FROM u) WHERE r = 1""")
def _(multibuy):
    return plan.best_promotion(multibuy).select("sku", "unit_price", "n_promo")


@query("d30_encode_promotions", "promos stores", """
WITH p AS (SELECT sku, CASE type WHEN 2 THEN 'Combinacion NxM ' WHEN 7 THEN 'COMBINACION NX$' WHEN 8 THEN '' ELSE 'OTRA' END AS kind, nullif(name, 'Precio bajo!') AS name, nullif(qty_n, 5) AS n, qty_m + CASE WHEN pct = 50 THEN 3 ELSE 0 END AS m,
  promo_price * qty_n - 5000 * (qty_n - 2) AS price, start_day, CASE WHEN pct = 80 THEN start_day - 1 ELSE end_day END AS end_day FROM promos)
SELECT sku, CASE WHEN name IS NULL THEN 'missing name' WHEN kind = '' THEN 'missing type' WHEN kind = 'OTRA' THEN 'unsupported type' WHEN end_day < start_day THEN 'ends before start'
  WHEN n IS NULL THEN 'bad quantity' WHEN kind LIKE 'Comb%' AND m >= n THEN 'pays all' WHEN kind LIKE 'COMB%' AND price <= 0 THEN 'bad price' END AS reject_reason,
 CASE WHEN kind LIKE 'Comb%' THEN 'L' || n || '_P' || m WHEN kind LIKE 'COMB%' THEN 'N' || n || '_M' || price END AS type_format,
 CASE WHEN kind LIKE 'Comb%' THEN 'Compra ' || n || ' y paga ' || m WHEN kind LIKE 'COMB%' THEN n || ' unidades por $' || replace(format('{:,}', price), ',', '.') END AS description FROM p""")
def _(promos, stores):
    raw = promos.selectExpr(
        "sku", "n_promo AS store_id", "nullif(name, 'Precio bajo!') AS name",
        "CASE type WHEN 2 THEN 'Combinacion NxM ' WHEN 7 THEN 'COMBINACION NX$' WHEN 8 THEN '' ELSE 'OTRA' END AS kind",
        "nullif(qty_n, 5) AS qty_n", "qty_m + CASE WHEN pct = 50 THEN 3 ELSE 0 END AS qty_m",
        "promo_price * qty_n - 5000 * (qty_n - 2) AS total_price", "start_day",
        "CASE WHEN pct = 80 THEN start_day - 1 ELSE end_day END AS end_day",
    )
    return plan.encode_promotions(raw).select("sku", "reject_reason", "type_format", "description")


@query("d35_promotional_sales", "promos sales", """
WITH w AS (SELECT DISTINCT sku, start_day, end_day FROM promos WHERE end_day <= DATE '1998-07-15' AND start_day >= DATE '1998-07-15' - 60 AND type IN (1, 4) AND mechanic NOT IN (25, 27, 36, 37, 50) AND valid AND organisation = '1000' AND channel = '10' AND name NOT LIKE '%MFC%' AND name NOT LIKE '%BANCO%' AND name NOT LIKE '%UNIPAY%' AND name NOT LIKE '%TERCERA%' AND name NOT LIKE '%917%' AND name NOT LIKE '%ESTADO%' AND name NOT LIKE '% LOC%' AND name NOT LIKE '%LIQ%')
SELECT sku, store_id, SUM(units)::BIGINT AS units FROM w JOIN sales USING (sku) WHERE day BETWEEN start_day AND end_day GROUP BY 1, 2""")
def _(promos, sales):
    return plan.promotional_sales(promos, sales, "1998-07-15", 60)


@query("d74_load_promotions", "promos", """
WITH i AS (SELECT n_promo, lpad(sku::VARCHAR, 18, '0') AS material, pct / 100 AS pct_final, type = 4 AS valid, CASE funding WHEN 'SELL IN' THEN 'SELL OUT' ELSE funding END AS funding, end_day + 1 AS end_day FROM promos WHERE end_day >= DATE '1998-06-20' - 7)
SELECT n_promo, lpad(sku::VARCHAR, 18, '0') AS material, 0.5::DOUBLE AS pct_final, true AS valid, funding, CAST(end_day AS VARCHAR) AS end_day FROM promos WHERE NOT end_day >= DATE '1998-06-20' - 7
UNION ALL SELECT n_promo, material, pct_final, valid, funding, CAST(end_day AS VARCHAR) FROM i""")
def _(promos):
    stored = promos.select(
        "n_promo", F.lpad(F.col("sku").cast("string"), 18, "0").alias("material"), F.lit(0.5).alias("pct_final"),
        F.lit(0.0).alias("pct_financing"), F.lit(True).alias("valid"), "funding", "end_day",
    )
    raw = promos.where("end_day >= DATE'1998-06-20' - 7").select(
        "n_promo", F.col("sku").alias("material"), F.col("pct").alias("pct_final"), F.lit(0).alias("pct_financing"),
        F.when(F.col("type") == 4, "X").alias("valid"),
        F.when(F.col("funding") == "SELL IN", "SELL IN/SELL OUT").otherwise(F.col("funding")).alias("funding"),
        F.date_add("end_day", 1).alias("end_day"),
    )
    return plan.load_promotions(stored, plan.clean_promotions(raw), DAY).drop("pct_financing")


@query("d94_membership_change", "promos", """
WITH m AS (SELECT * FROM promos WHERE name LIKE '%bajo%'), t AS (SELECT DISTINCT sku FROM m WHERE DATE '1998-06-20' BETWEEN start_day AND end_day),
y AS (SELECT DISTINCT sku FROM m WHERE DATE '1998-06-12' BETWEEN start_day AND end_day)
SELECT sku, 'today' AS status FROM t UNION ALL SELECT sku, 'dropped' FROM (FROM y EXCEPT FROM t)""")
def _(promos):
    return plan.membership_change(promos, DAY, "1998-06-12", "%bajo%")


@query("d102_marketplace_promotions", "promos assortment skus", f"""
SELECT sku, a.store_id, CASE WHEN type IN (1, 4) THEN 'descuento' ELSE 'pack' END AS kind, CASE type WHEN 2 THEN qty_n || 'x' || qty_m WHEN 7 THEN qty_n || 'x' ELSE 'null' END AS combination,
 {UOM} AS uom, promo_price FROM promos JOIN (SELECT DISTINCT sku, store_id FROM assortment WHERE listed) a USING (sku) WHERE {LIVE.format(ahead=0, behind=0)} AND type <> 8 AND mechanic NOT IN (25, 27, 36, 37, 50) AND valid AND organisation = '1000' AND channel = '10'
 AND name NOT ILIKE '%ZONA%' AND name NOT ILIKE '%MFC%' AND name NOT ILIKE '%BANCO%' AND name NOT ILIKE '%UNIPAY%' AND name NOT ILIKE '%TERCERA%' AND name NOT ILIKE '%917%' AND name NOT ILIKE '%ESTADO%' AND name NOT ILIKE '% LOC%' AND name NOT ILIKE '%LIQ%' AND name NOT ILIKE '%CYBER%' AND name NOT ILIKE '%REGIO%' AND sku NOT IN (SELECT sku FROM skus WHERE category = 'SMALL')""")
def _(promos, assortment, skus):
    rows = plan.marketplace_promotions(promos, assortment.where("listed"), skus, DAY, ("SMALL",))
    return rows.select("sku", "store_id", "kind", "combination", "uom", "promo_price")


@query("d86_fixed_price_removals", "promos skus", f"""
SELECT DISTINCT sku, {UOM} AS uom, translate(p.name, ' ,.', '') AS price_table, s.size AS web_id FROM promos p JOIN skus s USING (sku)
WHERE {LIVE.format(ahead=0, behind=0)} AND type = 4 AND channel IN ('10', '70') AND s.size < 40""")
def _(promos, skus):
    return plan.fixed_price_removals(promos, skus.where("size < 40").withColumn("web_id", F.col("size")), DAY)


feed("line_promotions", ["lineitem"], """
SELECT (l_orderkey * 10 + l_linenumber) * 100 + 1 AS line_id, l_partkey * 100 + l_suppkey % 100 AS id,
 CASE CAST((l_partkey + l_suppkey) % 7 AS INT) WHEN 0 THEN '4100 Gratis DESPACHO' WHEN 1 THEN 'Descuento 10% boleta app' WHEN 2 THEN 'Cupon Fuga 5 x 20' WHEN 3 THEN 'flete gratis'
  WHEN 4 THEN 'Beneficio Colaborador' WHEN 5 THEN 'Cupon referido' ELSE '5550 Oferta' END AS name,
 CAST(round(l_discount * 100) AS BIGINT) * CAST(l_quantity AS BIGINT) * 10 AS value FROM lineitem""")


@query("d13_savings_detail", "lines baskets line_promotions", """
SELECT order_id, line_id, b.store_id, customer_id, p.name, value, price * asked AS gross, CASE WHEN p.name IS NULL OR p.name ILIKE '%despac%' OR p.name ILIKE '%flet%' OR p.name IN ('Descuento 10% boleta app', 'Oferta semana') THEN 0 ELSE value END AS product_saving,
 CASE WHEN p.name ILIKE '%despac%' OR p.name ILIKE '%flet%' THEN value ELSE 0 END AS delivery_saving, CASE WHEN p.name IN ('Descuento 10% boleta app', 'Cupon Fuga 5 x 20') THEN value ELSE 0 END AS order_saving,
 CASE WHEN p.name IS NOT NULL THEN split_part(p.name, ' ', 1) END AS promo_ref FROM lines LEFT JOIN baskets b USING (order_id) LEFT JOIN line_promotions p USING (line_id)""")
def _(lines, baskets, line_promotions):
    ticket = ("Descuento 10% boleta app", "Oferta semana")
    return plan.savings_detail(lines, baskets, line_promotions, ("Descuento 10% boleta app", "Cupon Fuga 5 x 20"), ticket)
