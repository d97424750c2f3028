"""Domain frames shaped from the driver tables. Money is whole cents, so both engines add it exactly."""

from granero.suite.registry import feed

feed("sales", ["lineitem"], """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS sku, l_suppkey AS store_id,
       CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS units,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS gross,
       CAST(round(l_discount * 100) AS BIGINT) AS pct,
       CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS net,
       l_returnflag AS flag, l_linestatus AS status
FROM lineitem""")

feed("baskets", ["orders"], """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_custkey % 25 AS INT) AS store_id,
       o_orderstatus AS status,
       CASE o_orderstatus WHEN 'F' THEN 90 WHEN 'O' THEN 60 ELSE 100 END AS state,
       CAST(o_orderdate AS DATE) AS day, CAST(round(o_totalprice * 100) AS BIGINT) AS total,
       o_orderpriority AS priority
FROM orders""")

feed("skus", ["part"], """
SELECT p_partkey AS sku, p_name AS name, p_brand AS brand, p_type AS category, p_size AS size,
       CAST(round(p_retailprice * 100) AS BIGINT) AS list_price,
       CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN 'KG' WHEN 1 THEN 'CS' WHEN 2 THEN 'KGV' ELSE 'ST' END AS unit
FROM part""")

feed("stores", ["supplier"], """
SELECT s_suppkey AS store_id, s_name AS label, s_nationkey AS district,
       CAST(round(s_acctbal * 100) AS BIGINT) AS balance, CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS status
FROM supplier""")

feed("moves", ["events"], """
SELECT event_id AS id, ts, CAST(ts AS DATE) AS day, user_id AS item, event_type AS kind,
       CAST(round(value * 100) AS BIGINT) AS amount, props
FROM events""")

# The source repeats the pair of order and line number: a repeat is a line of its own, with its own id.
feed("lines", ["lineitem"], """
SELECT (l_orderkey * 10 + l_linenumber) * 100 + nth AS line_id, l_orderkey AS order_id, l_linenumber AS line_no,
       l_partkey AS sku, l_suppkey AS store_id,
       CASE WHEN l_returnflag = 'R' AND l_linenumber > 1 THEN (l_orderkey * 10 + l_linenumber - 1) * 100 + nth END AS substitute_of,
       CASE WHEN l_partkey % 3 = 0 THEN 'kg' ELSE 'un' END AS uom,
       CAST(l_quantity AS BIGINT) AS asked,
       CASE WHEN l_linestatus = 'O' AND l_linenumber > 2 THEN CAST(l_quantity AS BIGINT) - (l_orderkey + l_linenumber) % 4
            WHEN l_tax < 0.08 THEN CAST(l_quantity AS BIGINT) END AS picked,
       CAST(CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE 0.5 END AS DECIMAL(8, 4)) AS multiplier,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
       CAST(round(l_discount * 100) AS BIGINT) AS pct,
       CAST(l_shipdate AS DATE) AS day
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                   l_shipdate, l_discount, l_tax, l_returnflag, l_linestatus) AS nth FROM lineitem) AS numbered""")

# Promotions cover every product: dates, mechanics and prices follow from its number and size.
feed("promos", ["part"], """
SELECT p_partkey * 100 + p_size AS n_promo, p_partkey AS sku,
       CASE CAST((CASE WHEN p_partkey % 4 = 3 THEN floor(p_partkey / 4) END) AS INT) % 20 WHEN 0 THEN 'Semana ZONA' WHEN 1 THEN 'plan zona'
            WHEN 2 THEN 'BANCO x' WHEN 3 THEN 'UNIPAY ya' WHEN 4 THEN 'TERCERA edad' WHEN 5 THEN 'Cod 917' WHEN 6 THEN 'BANCO ESTADO'
            WHEN 7 THEN 'LIQ total' WHEN 8 THEN 'Regional' WHEN 9 THEN 'Ruta S06' WHEN 10 THEN 'NO ELIMINAR' WHEN 11 THEN 'Cod 0743'
            WHEN 12 THEN 'Solo L65' WHEN 13 THEN 'Solo L0089' WHEN 14 THEN 'Solo L012' ELSE
       CASE CAST(p_partkey % 6 AS INT) WHEN 0 THEN 'CYBER 30% despacho' WHEN 1 THEN 'Oferta-semana LOC'
            WHEN 2 THEN 'Especial MFC' WHEN 3 THEN 'Lleva 3 (regular)' ELSE 'Precio bajo!' END END AS name,
       p_partkey % 7 <> 0 AS valid, CASE WHEN p_partkey % 11 = 0 THEN '2000' ELSE '1000' END AS organisation,
       CAST(p_size AS INT) AS mechanic,
       CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 7 ELSE 8 END AS type,
       400 + CAST(p_partkey % 10 AS INT) AS event, p_brand AS brand,
       CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 'KG' WHEN 1 THEN 'CS' ELSE 'ST' END AS uom,
       CAST(round(p_retailprice * 10) AS BIGINT) AS modal_price,
       CAST(round(p_retailprice * 10) AS BIGINT) * (100 - (p_partkey % 9) * 10) AS promo_price_x100,
       CAST(floor(round(p_retailprice * 10) * (100 - (p_partkey % 9) * 10) / 100) AS BIGINT) AS promo_price,
       2 + CAST(p_partkey % 4 AS INT) AS qty_n, 1 + CAST(p_partkey % 2 AS INT) AS qty_m,
       CAST((p_partkey % 9) * 10 AS INT) AS pct,
       CAST('1998-06-01' AS DATE) + CAST(p_size AS INT) AS start_day,
       CAST('1998-06-01' AS DATE) + CAST(p_size + 5 + p_partkey % 20 AS INT) AS end_day,
       CASE WHEN p_partkey % 3 = 0 THEN '70' WHEN p_partkey % 3 = 1 THEN '10' END AS channel,
       CASE WHEN p_partkey % 2 = 0 THEN 'SELL OUT' ELSE 'SELL IN' END AS funding,
       CAST(p_size * 10 AS BIGINT) AS negotiated
FROM part""")

# Shelf assortment: products offered at a store, with the block flags that control publication.
feed("assortment", ["lineitem"], """
SELECT l_partkey AS sku, l_suppkey AS store_id, CAST(SUM(l_quantity) AS BIGINT) AS stock,
       MIN(CAST(round(l_extendedprice * 100) AS BIGINT)) AS price,
       CASE WHEN MAX(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) = 1 THEN CAST(1 AS BIGINT) END AS blocked_store,
       CASE WHEN MIN(l_linenumber) = 7 THEN CAST(1 AS BIGINT) END AS blocked_format,
       MAX(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) = 1 AS listed, MIN(l_tax) > 0.07 AS excluded
FROM lineitem GROUP BY l_partkey, l_suppkey""")

# Scale readings of weighed lines; those of a repeated pair all belong to its first line.
feed("weights", ["lineitem"], """
SELECT (l_orderkey * 10 + l_linenumber) * 100 + 1 AS line_id,
       CAST(l_quantity AS BIGINT) * (650 + 50 * ((l_orderkey + l_linenumber) % 9)) AS weight_g
FROM lineitem""")

feed("dispatches", ["lines"], """
SELECT line_id AS id, order_id, store_id AS carrier,
       CASE CAST(sku % 3 AS INT) WHEN 1 THEN '1' WHEN 2 THEN '2' END AS type, day AS promised,
       CAST(day AS TIMESTAMP) + INTERVAL '1' HOUR * (8 + order_id % 6) AS window_start,
       CAST(day AS TIMESTAMP) + INTERVAL '1' HOUR * (10 + order_id % 6) AS window_end
FROM lines""")

feed("changes", ["lines"], """
SELECT line_id AS id, order_id, CASE CAST(line_no % 3 AS INT) WHEN 0 THEN 5 WHEN 1 THEN 90 ELSE 70 END AS new_state,
       CAST(day AS TIMESTAMP) + INTERVAL '1' DAY * (CASE CAST(sku % 8 AS INT) WHEN 0 THEN -1 WHEN 1 THEN 1 ELSE 0 END)
           + INTERVAL '1' MINUTE * (480 + (order_id * 7 + sku) % 600) AS created
FROM lines""")

# A three-level tree over every product: type, then type and brand, then the product itself.
feed("category_rows", ["skus"], """
SELECT MIN(sku) * 10 AS id, category AS ref_id, category AS name, CAST(NULL AS VARCHAR(9)) AS ref_parent, 1 AS status
FROM skus GROUP BY category
UNION ALL SELECT MIN(sku) * 10 + 1, category || brand, brand, category, 8 FROM skus GROUP BY category, brand
UNION ALL SELECT sku * 10 + 2, CAST(sku AS VARCHAR(20)), name, category || brand, CASE WHEN size < 9 THEN 0 ELSE 1 END FROM skus""")
