"""The relational vocabulary: filters, joins, aggregates, windows, sets, reshaping and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granero.functions import dates, geo, keys, numbers
from granero.operators import joins, merge, ranking, sets
from granero.session import shared_folder, track
from granero.sources import publisher, scans, snapshots
from granero.suite.registry import query

DAY = "1998-06-15"

# ---------------------------------------------------------------- scans


@query("s01_scan_where", "lineitem", """
SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'""")
def _(lineitem):
    return scans.scan(lineitem, "l_quantity > 45 AND l_returnflag = 'R'").select("l_orderkey", "l_quantity")


@query("s02_scan_since", "orders", """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderdate > TIMESTAMP '1999-01-01 00:00:00' AND o_orderkey >= 100""")
def _(orders):
    recent = scans.scan_since(orders, created="o_orderdate", created_mark=dates.as_ts("1999-01-01 00:00:00"))
    return scans.scan_since(
        recent, updated="o_orderkey", updated_mark=F.lit(100), inclusive=True
    ).select("o_orderkey", "o_orderstatus")


@query("s03_high_watermark", "baskets", "SELECT CAST(MAX(day) AS VARCHAR) AS mark FROM baskets")
def _(baskets):
    return scans.high_watermark(baskets, "day")


@query("s04_is_empty", "orders", """
SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1""")
def _(orders):
    window = "o_totalprice >= 0" if scans.is_empty(orders.where("o_totalprice < 0")) else "false"
    return orders.where(window).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("s07_dated_range", "moves", """
SELECT CAST(day AS VARCHAR) AS day, count(*) AS n FROM moves
WHERE day BETWEEN DATE '2024-01-05' AND DATE '2024-02-20' GROUP BY 1""")
def _(moves):
    return scans.dated_range(moves, "day", "2024-01-05", "2024-02-20").groupBy("day").agg(F.count("*").alias("n"))


@query("s10_parameterised", "lineitem part", """
SELECT l_partkey, CAST(SUM(l_quantity) AS BIGINT) AS units FROM lineitem
WHERE l_quantity >= 10 AND l_partkey IN (SELECT p_partkey FROM part WHERE p_brand IN ('Brand#3', 'Brand#7'))
GROUP BY 1""")
def _(lineitem, part):
    spark = lineitem.sparkSession
    wanted = spark.sql(
        "SELECT p_partkey AS l_partkey FROM {part} WHERE array_contains(:brands, p_brand)",
        args={"brands": F.array(F.lit("Brand#3"), F.lit("Brand#7"))}, part=part,
    )
    sold = lineitem.where(F.col("l_quantity") >= 10).join(wanted, "l_partkey", "left_semi")
    return sold.groupBy("l_partkey").agg(F.sum("l_quantity").cast("long").alias("units"))


@query("s14_payload_chunks", "stores sales", """
WITH s AS (SELECT DISTINCT district, sku FROM sales JOIN stores USING (store_id)),
n AS (SELECT *, (row_number() OVER (PARTITION BY district ORDER BY sku) - 1) // 500 AS chunk FROM s)
SELECT district, chunk, count(*) AS items,
       '[' || string_agg('{"sku":' || sku || '}', ',' ORDER BY sku) || ']' AS payload
FROM n GROUP BY 1, 2""")
def _(stores, sales):
    rows = sales.join(stores, "store_id").select("district", "sku").distinct()
    return scans.payload_chunks(rows, "district", [F.col("sku")], ["sku"], 500)


@query("s14_published_payloads", "stores sales", """
WITH s AS (SELECT DISTINCT district, sku FROM sales JOIN stores USING (store_id)),
n AS (SELECT *, (row_number() OVER (PARTITION BY district ORDER BY sku) - 1) // 500 AS chunk FROM s)
SELECT district::VARCHAR AS key, chunk, '[' || string_agg('{"sku":' || sku || '}', ',' ORDER BY sku) || ']' AS payload FROM n GROUP BY 1, 2, district""")
def _(stores, sales):
    """The payloads as a publisher has received them: written by tasks, committed together, read back."""
    rows = sales.join(stores, "store_id").select("district", "sku").distinct()
    path = f"{shared_folder(sales.sparkSession)}/granero-{uuid.uuid4().hex}"
    track(sales.sparkSession, path)
    publisher.publish(scans.payload_chunks(rows, "district", [F.col("sku")], ["sku"], 500).withColumnRenamed("district", "key"), path)
    return publisher.published(sales.sparkSession, path)


# ---------------------------------------------------------------- projection and filters

_FILTERS = {
    "p02_membership": "category NOT IN ('PROMO', 'SMALL') AND size IN (1, 2, 3, 10)",
    "p03_between": "list_price BETWEEN 90500 AND 91500 AND name BETWEEN 'a' AND 'm'",
    "p04_like": "name LIKE 'red%' AND name NOT ILIKE '%BOLT'",
    "p07_null_logic": "(CASE WHEN size > 25 THEN size > 40 END) IS NOT TRUE AND nullif(size, 7) IS NOT NULL "
                      "AND nullif(size, 9) IS DISTINCT FROM 8",
    "p10_exclusion_pairs": "NOT ((brand = 'Brand#3' AND category = 'PROMO') OR (brand = 'Brand#8' AND size = 4))",
}
for _name, _condition in _FILTERS.items():
    query(_name, "skus", f"SELECT sku, name, size FROM skus WHERE {_condition}")(
        lambda skus, c=_condition: skus.where(c).select("sku", "name", "size")
    )


@query("p01_rename_assign", "part", "SELECT p_partkey AS material, p_name AS label, 'shop' AS origin FROM part")
def _(part):
    named = part.withColumnsRenamed({"p_partkey": "material", "p_name": "label"})
    return named.withColumn("origin", F.lit("shop")).select("material", "label", "origin")


@query("p05_like_any", "skus", "SELECT sku FROM skus WHERE name ILIKE '%RING' OR name ILIKE 'blue%'")
def _(skus):
    return skus.where("name ILIKE ANY ('%RING', 'blue%')").select("sku")


@query("p06_regex", "skus", "SELECT sku FROM skus WHERE NOT regexp_matches(name, '^(red|blue) .*[gt]$')")
def _(skus):
    return skus.where(~F.col("name").rlike("^(red|blue) .*[gt]$")).select("sku")


@query("p08_case_first_match", "skus", """
SELECT sku, CASE WHEN size < 10 THEN 1 WHEN size < 30 THEN 2 ELSE 0 END AS band,
       CASE WHEN unit IN ('KG', 'KGV') THEN 'weight' WHEN unit = 'CS' THEN 'case' ELSE 'piece' END AS kind
FROM skus""")
def _(skus):
    size, unit = F.col("size"), F.col("unit")
    return skus.select(
        "sku", F.when(size < 10, 1).when(size < 30, 2).otherwise(0).alias("band"),
        F.when(unit.isin("KG", "KGV"), "weight").when(unit == "CS", "case").otherwise("piece").alias("kind"),
    )


@query("p09_reject_reason", "sales", """
SELECT reason, count(*) AS n FROM (SELECT CASE WHEN units > 45 THEN 'too many' WHEN pct = 0 THEN 'no discount'
  WHEN flag = 'A' THEN 'flagged' END AS reason FROM sales) GROUP BY 1""")
def _(sales):
    rules = {"too many": F.col("units") > 45, "no discount": F.col("pct") == 0, "flagged": F.col("flag") == "A"}
    return scans.validate(sales, rules).groupBy(F.col("reject_reason").alias("reason")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- joins


@query("j01_inner", "sales skus", """
SELECT brand, SUM(net)::BIGINT AS net FROM sales JOIN skus USING (sku) GROUP BY 1""")
def _(sales, skus):
    return sales.join(skus, "sku").groupBy("brand").agg(F.sum("net").alias("net"))


@query("j02_left_star", "baskets customer nation region", """
SELECT r_name, n_name, c_mktsegment, count(*) AS n FROM baskets
LEFT JOIN customer ON customer_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def _(baskets, customer, nation, region):
    star = (
        baskets.join(customer, F.col("customer_id") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    )
    return star.groupBy("r_name", "n_name", "c_mktsegment").agg(F.count("*").alias("n"))


@query("j03_condition_in_on", "stores sales", """
SELECT s.store_id, count(x.order_id) AS n FROM stores s
LEFT JOIN sales x ON s.store_id = x.store_id AND x.flag = 'R' AND s.status = 1 GROUP BY 1""")
def _(stores, sales):
    x = sales.alias("x")
    s = stores.alias("s")
    on = (F.col("s.store_id") == F.col("x.store_id")) & (F.col("x.flag") == "R") & (F.col("s.status") == 1)
    return s.join(x, on, "left").groupBy("s.store_id").agg(F.count("x.order_id").alias("n"))


@query("j04_full_outer", "baskets stores", """
WITH b AS (SELECT store_id, count(*) AS n FROM baskets GROUP BY 1)
SELECT coalesce(b.store_id, s.store_id) AS store_id, n, label FROM b FULL JOIN stores s ON b.store_id = s.store_id""")
def _(baskets, stores):
    counts = baskets.groupBy(F.col("store_id").cast("long").alias("store_id")).agg(F.count("*").alias("n"))
    return counts.join(stores, "store_id", "full").select("store_id", "n", "label")


@query("j05_outer_chain", "sales baskets moves", """
WITH a AS (SELECT day, SUM(units)::BIGINT AS units FROM sales GROUP BY 1),
b AS (SELECT day, count(*) AS orders FROM baskets GROUP BY 1),
c AS (SELECT day, count(*) AS moves FROM moves GROUP BY 1)
SELECT CAST(coalesce(a.day, b.day, c.day) AS VARCHAR) AS day, units, orders, moves
FROM a FULL JOIN b ON a.day = b.day FULL JOIN c ON coalesce(a.day, b.day) = c.day""")
def _(sales, baskets, moves):
    return joins.outer_chain([
        sales.groupBy("day").agg(F.sum("units").alias("units")),
        baskets.groupBy("day").agg(F.count("*").alias("orders")),
        moves.groupBy("day").agg(F.count("*").alias("moves")),
    ], "day")


@query("j06_one_row_cross", "skus", """
SELECT sku, list_price - (SELECT MAX(list_price) FROM skus) AS gap, w AS weeks
FROM skus, (VALUES (1), (2)) AS v(w)""")
def _(skus):
    top = skus.agg(F.max("list_price")).scalar()
    weeks = F.explode(F.array(F.lit(1), F.lit(2)))
    return skus.select("sku", (F.col("list_price") - top).alias("gap"), weeks.alias("weeks"))


@query("j07_semi", "skus sales", """
SELECT sku, name FROM skus WHERE EXISTS (SELECT 1 FROM sales x WHERE x.sku = skus.sku AND x.units = 50)""")
def _(skus, sales):
    return skus.join(sales.where("units = 50"), "sku", "left_semi").select("sku", "name")


@query("j08_not_exists", "skus sales", """
SELECT sku, name FROM skus
WHERE NOT EXISTS (SELECT 1 FROM sales x WHERE x.sku = skus.sku AND x.units = 50)""")
def _(skus, sales):
    return skus.join(sales.where("units = 50"), "sku", "left_anti").select("sku", "name")


@query("j09_left_is_null", "customer orders", """
SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'
WHERE o_orderkey IS NULL""")
def _(customer, orders):
    done = orders.where("o_orderstatus = 'F'")
    return customer.join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j10_not_in_nulls", "skus sales", """
SELECT sku FROM skus WHERE nullif(sku, 3) NOT IN (SELECT sku FROM sales WHERE units = 50)""")
def _(skus, sales):
    return joins.not_in(skus.select("sku"), F.nullif(F.col("sku"), F.lit(3)), sales.where("units = 50").select("sku"), "sku")


@query("j11_self", "lines", """
SELECT l.line_id, o.sku AS original_sku FROM lines l JOIN lines o ON l.substitute_of = o.line_id""")
def _(lines):
    original = lines.select(F.col("line_id").alias("substitute_of"), F.col("sku").alias("original_sku"))
    return lines.join(original, "substitute_of").select("line_id", "original_sku")


@query("j12_validity", "sales promos", """
SELECT n_promo, count(*) AS n, SUM(units)::BIGINT AS units FROM sales s
JOIN promos p ON s.sku = p.sku AND s.day BETWEEN p.start_day AND coalesce(p.end_day, DATE '9999-12-31') GROUP BY 1""")
def _(sales, promos):
    hit = joins.validity_join(sales, promos, ["sku"], "day", "start_day", "end_day")
    return hit.groupBy("n_promo").agg(F.count("*").alias("n"), F.sum("units").alias("units"))


@query("j13_day_series", "promos", """
SELECT CAST(d AS VARCHAR) AS day, count(*) AS n FROM
  (SELECT CAST(unnest(generate_series(start_day, end_day, INTERVAL 1 DAY)) AS DATE) AS d FROM promos) GROUP BY 1""")
def _(promos):
    days = joins.expand_days(promos.select("start_day", "end_day"), F.col("start_day"), F.col("end_day"))
    return days.groupBy("day").agg(F.count("*").alias("n"))


@query("j14_default_row", "sales nation", """
WITH r AS (SELECT CASE WHEN n_nationkey = 0 THEN 'default' ELSE 'S' || n_nationkey END AS k,
                  100 + n_nationkey AS factor FROM nation)
SELECT s.store_id, coalesce(r.factor, d.factor) AS factor, count(*) AS n FROM sales s
LEFT JOIN r ON r.k = 'S' || s.store_id LEFT JOIN r d ON d.k = 'default' GROUP BY 1, 2""")
def _(sales, nation):
    rules = nation.select(
        F.when(F.col("n_nationkey") == 0, "default").otherwise(F.concat(F.lit("S"), "n_nationkey")).alias("k"),
        (F.col("n_nationkey") + 100).alias("rate"),
    )
    counts = sales.groupBy("store_id").agg(F.count("*").alias("n"))
    keyed = counts.withColumn("k", F.concat(F.lit("S"), "store_id"))
    return joins.default_join(keyed, rules, "k", "default", "rate", "factor").select("store_id", "factor", "n")


@query("j15_prefix", "skus", """
SELECT a.sku, b.total FROM (SELECT sku, lpad(CAST(sku AS VARCHAR), 18, '0') || '-' || unit AS ref FROM skus) a
JOIN (SELECT lpad(CAST(sku AS VARCHAR), 18, '0') AS material, list_price AS total FROM skus) b
ON a.ref LIKE b.material || '-%'""")
def _(skus):
    refs = skus.withColumn("ref", keys.ref_id(keys.material_code(F.col("sku")), F.col("unit")))
    costs = skus.select(keys.material_code(F.col("sku")).alias("material"), F.col("list_price").alias("total"))
    return refs.withColumn("material", keys.ref_material(F.col("ref"))).join(costs, "material").select("sku", "total")


@query("j16_computed_key", "assortment skus", """
SELECT a.store_id, count(*) AS n FROM assortment a
JOIN skus s ON a.sku || '-' || CASE s.unit WHEN 'ST' THEN 'UN' WHEN 'CS' THEN 'CJ' ELSE s.unit END
             = s.sku || '-' || CASE s.unit WHEN 'ST' THEN 'UN' WHEN 'CS' THEN 'CJ' ELSE s.unit END
WHERE a.sku = s.sku GROUP BY 1""")
def _(assortment, skus):
    keyed = skus.withColumn("uom", keys.normal_unit(F.col("unit")))
    return assortment.join(keyed, "sku").where("uom IS NOT NULL").groupBy("store_id").agg(F.count("*").alias("n"))


@query("j17_lateral", "skus", """
SELECT sku, big, label FROM skus, LATERAL (SELECT size > 25 AS big, upper(brand) AS label) v""")
def _(skus):
    return skus.select("sku", (F.col("size") > 25).alias("big"), F.upper("brand").alias("label"))


@query("j18_latest_row", "baskets moves", """
WITH m AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY id DESC) AS r FROM moves)
SELECT order_id, kind, id FROM baskets LEFT JOIN m ON customer_id = item AND r = 1""")
def _(baskets, moves):
    last = ranking.latest_per_key(moves.select("item", "id", "kind"), ["item"], "id")
    return baskets.join(last.withColumnRenamed("item", "customer_id"), "customer_id", "left").select(
        "order_id", "kind", "id"
    )


# ---------------------------------------------------------------- aggregation


@query("a01_group_by", "sales", """
SELECT flag, status, count(*) AS n, SUM(units)::BIGINT AS units, MIN(gross) AS lo, MAX(gross) AS hi,
       SUM(units) / count(*) AS mean_units FROM sales GROUP BY 1, 2""")
def _(sales):
    return sales.groupBy("flag", "status").agg(
        F.count("*").alias("n"), F.sum("units").alias("units"), F.min("gross").alias("lo"),
        F.max("gross").alias("hi"), (F.sum("units") / F.count("*")).alias("mean_units"),
    )


@query("a02_conditional", "sales", """
SELECT store_id, SUM(CASE WHEN flag = 'R' THEN 1 ELSE 0 END)::BIGINT AS returned,
       count(CASE WHEN pct > 5 THEN sku END) AS deals, AVG(CASE WHEN status = 'O' THEN units END) AS open_units
FROM sales GROUP BY 1""")
def _(sales):
    return sales.groupBy("store_id").agg(
        numbers.count_when(F.col("flag") == "R").alias("returned"),
        F.count(F.when(F.col("pct") > 5, F.col("sku"))).alias("deals"),
        F.avg(F.when(F.col("status") == "O", F.col("units"))).alias("open_units"),
    )


@query("a03_count_distinct", "sales", """
SELECT store_id, count(DISTINCT sku) AS skus, count(DISTINCT order_id) AS orders FROM sales GROUP BY 1""")
def _(sales):
    return sales.groupBy("store_id").agg(
        F.count_distinct("sku").alias("skus"), F.count_distinct("order_id").alias("orders")
    )


@query("a04_having", "sales", """
SELECT sku, SUM(net)::BIGINT AS net FROM sales GROUP BY 1 HAVING abs(SUM(net)) > 9000000000""")
def _(sales):
    return sales.groupBy("sku").agg(F.sum("net").alias("net")).where(F.abs("net") > 9_000_000_000)


@query("a05_bool_aggregates", "assortment", """
SELECT sku, bool_and(listed) AS all_listed, bool_or(excluded) AS any_excluded, bool_and(stock > 0) AS every_stock
FROM assortment GROUP BY 1""")
def _(assortment):
    return assortment.groupBy("sku").agg(
        F.bool_and("listed").alias("all_listed"), F.bool_or("excluded").alias("any_excluded"),
        F.every(F.col("stock") > 0).alias("every_stock"),
    )


@query("a06_string_agg", "customer", """
SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments
FROM customer GROUP BY 1""")
def _(customer):
    return customer.groupBy("c_nationkey").agg(
        F.expr("listagg(DISTINCT c_mktsegment, ', ') WITHIN GROUP (ORDER BY c_mktsegment)").alias("segments")
    )


@query("a07_two_levels", "sales", """
SELECT sku, AVG(units) AS mean_day FROM
  (SELECT sku, day, SUM(units)::BIGINT AS units FROM sales GROUP BY 1, 2) GROUP BY 1""")
def _(sales):
    daily = sales.groupBy("sku", "day").agg(F.sum("units").alias("units"))
    return daily.groupBy("sku").agg(F.avg("units").alias("mean_day"))


@query("a08_arithmetic_of_sums", "sales", """
SELECT store_id, SUM(net)::BIGINT / SUM(gross)::BIGINT AS kept, floor(SUM(gross) / 1000)::BIGINT AS thousands
FROM sales GROUP BY 1""")
def _(sales):
    return sales.groupBy("store_id").agg(
        numbers.ratio(F.sum("net"), F.sum("gross")).alias("kept"),
        F.floor(F.sum("gross") / 1000).alias("thousands"),
    )


@query("a09_collapse_duplicates", "sales stores", """
SELECT sku, MAX(CASE WHEN district IS NULL THEN NULL ELSE district END) AS district, MAX(label) AS label
FROM sales LEFT JOIN stores ON sales.store_id = stores.store_id AND stores.status = 1 GROUP BY 1""")
def _(sales, stores):
    pairs = sales.select("sku", "store_id").distinct().join(stores.where("status = 1"), "store_id", "left")
    return pairs.groupBy("sku").agg(
        F.max(F.when(F.col("district").isNotNull(), F.col("district"))).alias("district"), F.max("label").alias("label")
    )


@query("a10_scalar_subquery", "sales", """
SELECT order_id, sku, units FROM sales WHERE day = (SELECT MAX(day) FROM sales)""")
def _(sales):
    last = sales.agg(F.max("day")).scalar()
    return sales.where(F.col("day") == last).select("order_id", "sku", "units")


@query("a11_argmax", "promos", """
SELECT brand, n_promo, pct FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY pct DESC, n_promo DESC) r
FROM promos) WHERE r = 1""")
def _(promos):
    best = promos.groupBy("brand").agg(F.max(F.struct("pct", "n_promo")).alias("best"))
    return best.select("brand", "best.n_promo", "best.pct")


@query("a12_first_row", "baskets", """
SELECT customer_id, order_id, CAST(day AS VARCHAR) AS day FROM (SELECT *, row_number() OVER
  (PARTITION BY customer_id ORDER BY day, order_id) r FROM baskets) WHERE r = 1""")
def _(baskets):
    return ranking.first_per_key(
        baskets.select("customer_id", "order_id", "day"), ["customer_id"], [F.col("day").asc(), F.col("order_id").asc()]
    )


@query("a13_distinct", "skus", "SELECT DISTINCT brand, category FROM skus")
def _(skus):
    return skus.select("brand", "category").distinct()


@query("a14_drop_duplicates", "sales", """
SELECT sku, store_id, net FROM (SELECT *, row_number() OVER
  (PARTITION BY sku, store_id ORDER BY net, order_id, line_no) r FROM sales) WHERE r = 1""")
def _(sales):
    order = [F.col(c).asc() for c in ("net", "order_id", "line_no")]
    narrow = sales.select("sku", "store_id", "net", "order_id", "line_no")
    return ranking.first_per_key(narrow, ["sku", "store_id"], order).select("sku", "store_id", "net")


@query("a15_ordered_list", "lines", """
SELECT order_id, string_agg(line_no || ':' || sku, '|' ORDER BY line_no, line_no || ':' || sku) AS items FROM lines GROUP BY 1""")
def _(lines):
    # Orders have few lines, so the list is bounded.
    listed = F.array_sort(F.collect_list(F.struct("line_no", F.concat("line_no", F.lit(":"), "sku").alias("item"))))
    return lines.groupBy("order_id").agg(F.array_join(F.transform(listed, lambda e: e["item"]), "|").alias("items"))


@query("a16_mean_plus_two_sigma", "sales", """
SELECT store_id, round(AVG(units) + 2 * stddev_pop(units), 6) AS bound FROM sales GROUP BY 1""")
def _(sales):
    return sales.groupBy("store_id").agg(
        F.round(F.avg("units") + 2 * F.stddev_pop("units"), 6).alias("bound")
    )


# ---------------------------------------------------------------- windows and order


@query("w01_dense_rank", "sales", """
WITH t AS (SELECT sku, count(*) AS n, SUM(units)::BIGINT AS units FROM sales GROUP BY 1)
SELECT *, dense_rank() OVER (ORDER BY n DESC) AS n_rank, dense_rank() OVER (ORDER BY units DESC) AS units_rank FROM t""")
def _(sales):
    totals = sales.groupBy("sku").agg(F.count("*").alias("n"), F.sum("units").alias("units"))
    return ranking.dense_ranks(totals, {"n_rank": "n", "units_rank": "units"})


@query("w02_row_number", "baskets", """
SELECT order_id, row_number() OVER (PARTITION BY store_id ORDER BY total DESC, order_id) AS rn,
       row_number() OVER (ORDER BY total DESC, order_id) AS overall FROM baskets""")
def _(baskets):
    order = [F.col("total").desc(), F.col("order_id").asc()]
    narrow = baskets.select("order_id", "store_id", "total")
    inside = ranking.positions(narrow, order, "rn", within=["store_id"])
    return ranking.positions(inside, order, "overall").select("order_id", "rn", "overall")


@query("w03_rank_latest", "moves", """
SELECT item, id FROM (SELECT *, rank() OVER (PARTITION BY item ORDER BY day DESC) r FROM moves) WHERE r = 1""")
def _(moves):
    last = moves.groupBy("item").agg(F.max("day").alias("day"))
    return moves.join(last, ["item", "day"], "left_semi").select("item", "id")


@query("w04_previous_version", "moves", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY item, kind ORDER BY ts DESC, id DESC) rn FROM moves)
SELECT a.item, a.kind, a.id, b.id AS previous_id FROM r a LEFT JOIN r b
ON a.item = b.item AND a.kind = b.kind AND b.rn = 2 WHERE a.rn = 1""")
def _(moves):
    two = ranking.top_k(moves, ["item", "kind"], [F.col("ts").desc(), F.col("id").desc()], 2)
    return two.groupBy("item", "kind").agg(
        F.max(F.when(F.col("rank") == 1, F.col("id"))).alias("id"),
        F.max(F.when(F.col("rank") == 2, F.col("id"))).alias("previous_id"),
    )


@query("w05_count_over", "promos", """
SELECT n_promo, event, count(channel) OVER (PARTITION BY event) AS in_event FROM promos""")
def _(promos):
    return ranking.group_count(promos, ["event"], F.col("channel"), "in_event").select("n_promo", "event", "in_event")


@query("w06_rolling_sum", "sales", """
WITH w AS (SELECT store_id, CAST(date_trunc('week', day) AS DATE) AS week, SUM(units)::BIGINT AS units
           FROM sales GROUP BY 1, 2)
SELECT store_id, CAST(week AS VARCHAR) AS week, SUM(units) OVER (PARTITION BY store_id ORDER BY week
       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)::BIGINT AS rolling FROM w""")
def _(sales):
    weekly = sales.groupBy("store_id", F.date_trunc("week", "day").cast("date").alias("week")).agg(
        F.sum("units").alias("units")
    )
    window = Window.partitionBy("store_id").orderBy("week").rowsBetween(-2, 0)
    return weekly.select("store_id", "week", F.sum("units").over(window).alias("rolling"))


@query("w07_tail_and_head", "baskets", """
SELECT * FROM (SELECT customer_id, order_id, row_number() OVER (PARTITION BY customer_id ORDER BY day DESC, order_id DESC)
 AS rank FROM baskets) WHERE rank <= 3""")
def _(baskets):
    narrow = baskets.select("customer_id", "order_id", "day")
    return ranking.top_k(narrow, ["customer_id"], [F.col("day").desc(), F.col("order_id").desc()], 3).drop("day")


@query("w08_cumcount", "skus", """
SELECT sku, row_number() OVER (PARTITION BY brand ORDER BY sku) - 1 AS slot FROM skus""")
def _(skus):
    placed = ranking.positions(skus.select("sku", "brand"), [F.col("sku").asc()], "slot", within=["brand"])
    return placed.select("sku", (F.col("slot") - 1).alias("slot"))


@query("w09_order_by_greatest", "sales", """
SELECT sku, store_id, order_id FROM (SELECT *, row_number() OVER (PARTITION BY sku, store_id
  ORDER BY greatest(units * 1000, gross) DESC, order_id, line_no, net) r FROM sales) WHERE r = 1""")
def _(sales):
    order = [F.greatest(F.col("units") * 1000, F.col("gross")).desc(), *[F.col(c).asc() for c in ("order_id", "line_no", "net")]]
    return ranking.first_per_key(sales, ["sku", "store_id"], order).select("sku", "store_id", "order_id")


@query("o01_sort_null_order", "skus", """
SELECT sku, nullif(size, 5) AS size, row_number() OVER (ORDER BY (brand = 'Brand#9') DESC, nullif(size, 5) DESC NULLS FIRST, sku) AS place FROM skus""")
def _(skus):
    """The place of each row in the sorted output, from the order in which its partitions hold the rows."""
    shown = skus.select("sku", F.expr("nullif(size, 5)").alias("size"), "brand")
    order = [(F.col("brand") == "Brand#9").desc(), F.col("size").desc_nulls_first(), F.col("sku").asc_nulls_last()]
    return ranking.positions(shown, order, "place").drop("brand")


@query("o02_top_k", "sales", """
WITH t AS (SELECT store_id, sku, SUM(net)::BIGINT AS net FROM sales GROUP BY 1, 2)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY net DESC, sku) AS rank FROM t) WHERE rank <= 300""")
def _(sales):
    totals = sales.groupBy("store_id", "sku").agg(F.sum("net").alias("net"))
    return ranking.top_k(totals, ["store_id"], [F.col("net").desc(), F.col("sku").asc()], 300)


@query("o03_top_k_by_column", "sales stores", """
WITH t AS (SELECT store_id, sku, SUM(units)::BIGINT AS units FROM sales GROUP BY 1, 2),
r AS (SELECT t.*, CASE WHEN status = 1 THEN 3 + district % 8 END AS k,
      dense_rank() OVER (PARTITION BY t.store_id ORDER BY units DESC) AS dense,
      row_number() OVER (PARTITION BY t.store_id ORDER BY units DESC, sku) AS row_in_group
      FROM t JOIN stores USING (store_id))
SELECT store_id, sku, units, dense, row_in_group FROM r WHERE dense <= coalesce(k, 5) AND row_in_group <= 15""")
def _(sales, stores):
    totals = sales.groupBy("store_id", "sku").agg(F.sum("units").alias("units"))
    limits = stores.select("store_id", F.when(F.col("status") == 1, 3 + F.col("district") % 8).alias("k"))
    return ranking.top_k_by_column(
        totals.join(limits, "store_id"), ["store_id"], [F.col("units").desc()], [F.col("sku").asc()],
        F.coalesce("k", F.lit(5)), 15,
    ).drop("k")


@query("o04_global_limit", "baskets", """
SELECT order_id, total FROM baskets ORDER BY total DESC, order_id LIMIT 20""")
def _(baskets):
    return baskets.orderBy(F.col("total").desc(), "order_id").limit(20).select("order_id", "total")


@query("o05_distinct_on", "sales", """
SELECT DISTINCT ON (sku) sku, store_id, units FROM sales ORDER BY sku, units DESC, store_id, order_id, line_no""")
def _(sales):
    order = [F.col("units").desc(), *[F.col(c).asc() for c in ("store_id", "order_id", "line_no")]]
    return ranking.first_per_key(sales, ["sku"], order).select("sku", "store_id", "units")


# ---------------------------------------------------------------- sets and reshaping


@query("u01_union_all", "skus stores", """
SELECT sku AS id, name AS label FROM skus UNION ALL SELECT store_id, label FROM stores""")
def _(skus, stores):
    a = skus.select(F.col("sku").alias("id"), F.col("name").alias("label"))
    return a.unionByName(stores.select(F.col("store_id").alias("id"), "label"))


@query("u02_union_distinct", "sales baskets", "SELECT CAST(day AS VARCHAR) AS day FROM sales UNION SELECT CAST(day AS VARCHAR) FROM baskets")
def _(sales, baskets):
    return sales.select("day").union(baskets.select("day")).distinct()


@query("u03_joiners_leavers", "baskets", """
WITH a AS (SELECT DISTINCT customer_id FROM baskets WHERE day < DATE '1998-01-01'),
b AS (SELECT DISTINCT customer_id FROM baskets WHERE day >= DATE '1998-01-01')
SELECT customer_id, 'gone' AS side FROM (FROM a EXCEPT FROM b) UNION ALL
SELECT customer_id, 'new' FROM (FROM b EXCEPT FROM a)""")
def _(baskets):
    cut = dates.as_date("1998-01-01")
    return sets.tagged_difference(baskets.where(F.col("day") < cut), baskets.where(F.col("day") >= cut), ["customer_id"])


@query("u04_symmetric_difference", "sales", """
WITH a AS (SELECT DISTINCT sku, store_id FROM sales WHERE flag = 'R'),
b AS (SELECT DISTINCT sku, store_id FROM sales WHERE flag = 'A')
SELECT *, 'gone' AS side FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'new' FROM (FROM b EXCEPT FROM a)""")
def _(sales):
    return sets.tagged_difference(sales.where("flag = 'R'"), sales.where("flag = 'A'"), ["sku", "store_id"])


@query("u05_set_intersection", "sales skus", """
WITH p AS (SELECT DISTINCT brand, category, store_id FROM sales JOIN skus USING (sku))
SELECT brand, store_id FROM p GROUP BY 1, 2
HAVING count(*) = (SELECT count(DISTINCT category) FROM p q WHERE q.brand = p.brand)""")
def _(sales, skus):
    return sets.common_members(sales.join(skus, "sku"), "brand", "category", "store_id")


@query("u06_pivot", "sales", """
SELECT store_id, SUM(CASE flag WHEN 'A' THEN units END)::BIGINT AS "A", SUM(CASE flag WHEN 'N' THEN units END)::BIGINT AS "N",
       SUM(CASE flag WHEN 'R' THEN units END)::BIGINT AS "R" FROM sales GROUP BY 1""")
def _(sales):
    return sales.groupBy("store_id").pivot("flag", ["A", "N", "R"]).agg(F.sum("units"))


@query("u07_stub_unpivot", "skus", """
SELECT sku, 0 AS tier, list_price AS price, 1 AS factor FROM skus
UNION ALL SELECT sku, 1, list_price - size, 3 FROM skus UNION ALL SELECT sku, 2, list_price - 2 * size, 6 FROM skus""")
def _(skus):
    wide = skus.selectExpr(
        "sku", "list_price AS price0", "list_price - size AS price1", "list_price - 2 * size AS price2"
    )
    return wide.selectExpr("sku", "stack(3, 0, price0, 1, 1, price1, 3, 2, price2, 6) AS (tier, price, factor)")


@query("u08_melt", "sales", """
WITH w AS (SELECT sku, SUM(CASE WHEN flag = 'A' THEN units ELSE 0 END)::BIGINT AS a, SUM(CASE WHEN flag = 'N' THEN units ELSE 0 END)::BIGINT AS n
FROM sales GROUP BY 1) SELECT sku, 'a' AS flag, a AS units FROM w UNION ALL SELECT sku, 'n', n FROM w""")
def _(sales):
    wide = sales.groupBy("sku").agg(
        *[F.sum(F.when(F.col("flag") == f.upper(), F.col("units")).otherwise(0)).alias(f) for f in ("a", "n")]
    )
    return wide.unpivot("sku", ["a", "n"], "flag", "units")


@query("u09_explode_repack", "skus", """
SELECT word, string_agg(DISTINCT brand, ',' ORDER BY brand) AS brands
FROM (SELECT unnest(string_split(name, ' ')) AS word, brand FROM skus) GROUP BY 1""")
def _(skus):
    words = skus.select(F.explode(F.split("name", " ")).alias("word"), "brand")
    return words.groupBy("word").agg(sets.packed_list(F.col("brand")).alias("brands"))


@query("u10_series", "baskets", """
WITH b AS (SELECT MIN(day) AS a, MAX(day) AS z FROM baskets),
d AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM b)
SELECT CAST(d.day AS VARCHAR) AS day, count(order_id) AS n FROM d LEFT JOIN baskets USING (day) GROUP BY 1""")
def _(baskets):
    span = baskets.agg(F.min("day").alias("a"), F.max("day").alias("z"))
    days = joins.expand_days(span, F.col("a"), F.col("z")).select("day")
    counts = baskets.groupBy("day").agg(F.count("*").alias("n"))
    return days.join(counts, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("u11_values", "sales", """
SELECT word, SUM(units)::BIGINT AS units FROM sales
JOIN (VALUES ('A', 'accepted'), ('R', 'returned')) AS v(flag, word) USING (flag) GROUP BY 1""")
def _(sales):
    words = sales.sparkSession.sql("SELECT * FROM VALUES ('A', 'accepted'), ('R', 'returned') AS v(flag, word)")
    return sales.join(F.broadcast(words), "flag").groupBy("word").agg(F.sum("units").alias("units"))


@query("u12_close_ring", "baskets", """
WITH c AS (SELECT *, customer_id % 90 AS x, store_id AS y FROM baskets), p AS (SELECT order_id, '{"lng":' || x || '.0,"lat":' || y || '.0}' AS a, '{"lng":' || (x + 1) || '.0,"lat":' || y || '.0}' AS b, '{"lng":' || (x + 1) || '.0,"lat":' || (y + 1) || '.0}' AS d FROM c)
SELECT order_id, '[' || a || ',' || b || ',' || d || ',' || a || ']' AS ring, 4 AS points FROM p""")
def _(baskets):
    def corner(dx, dy):
        x, y = F.col("customer_id") % 90 + dx, F.col("store_id") + dy
        return F.struct(x.cast("double").alias("lng"), y.cast("double").alias("lat"))

    nested = F.array(F.array(corner(0, 0), corner(1, 0)), F.array(corner(1, 0), corner(1, 1)))
    ring = geo.closed_ring(F.flatten(nested))
    return baskets.select("order_id", F.to_json(ring).alias("ring"), F.size(ring).alias("points"))


# ---------------------------------------------------------------- scalar functions

_SCALARS = {
    "f01_split_part": ("split_part(ref, '-', 1) AS a, split_part(ref, '-', 2) AS b, split_part(ref, '-', 3) AS c",) * 2,
    "f04_text": ("upper(name) AS up, trim(name) AS t, replace(name, 'e', '') AS r, substring(name, 2, 3) AS s, "
                 "right(ref, 2) AS tail, translate(name, 'aeiou', '12345') AS tr",) * 2,
    "f05_regex": (
        "regexp_replace(name, '[^a-z]', '') AS clean, nullif(regexp_extract(brand, '([0-9]+)', 1), '') AS num",
        "regexp_replace(name, '[^a-z]', '', 'g') AS clean, nullif(regexp_extract(brand, '([0-9]+)', 1), '') AS num"),
    "f10_coalesce": ("coalesce(nullif(size, 3), 0) AS a, greatest(size, 10) AS g, least(size, nullif(size, 9)) AS l",) * 2,
    "f13_try_cast": ("try_cast(replace(brand, 'Brand#', '') AS INT) AS n, try_cast(name AS INT) AS bad",) * 2,
    "f18_fill_null": ("coalesce(nullif(size, 4), -1) AS size, coalesce(nullif(name, 'red ring'), brand) AS name",) * 2,
    "f19_md5": ("md5(ref) AS digest",) * 2,
    "f20_cut_text": ("substring(name, 1, 5) AS cut",) * 2,
}
for _name, (_spark, _duck) in _SCALARS.items():
    query(_name, "skus", f"""
SELECT sku, {_duck} FROM (SELECT *, sku || '-' || unit AS ref FROM skus)""")(
        lambda skus, e=_spark: skus.withColumn("ref", F.expr("sku || '-' || unit")).selectExpr("sku", *_split(e))
    )


def _split(text: str) -> list[str]:
    """Split a select list at commas outside parentheses."""
    items, depth, start = [], 0, 0
    for i, char in enumerate(text):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            items.append(text[start:i])
            start = i + 1
    return [*items, text[start:]]


@query("f02_zero_pad", "sales", """
SELECT DISTINCT gross, CASE WHEN length(gross::VARCHAR) >= 4 THEN gross::VARCHAR ELSE lpad(gross::VARCHAR, 4, '0') END AS store_code,
 lpad(sku::VARCHAR, 18, '0') AS material, ltrim(lpad(sku::VARCHAR, 18, '0'), '0') AS bare FROM sales""")
def _(sales):
    pairs = sales.select("gross", "sku").distinct()
    return pairs.select(
        "gross", keys.store_code(F.col("gross")).alias("store_code"), keys.material_code(F.col("sku")).alias("material"),
        keys.strip_zeros(keys.material_code(F.col("sku"))).alias("bare"),
    )


@query("f03_concat", "skus", """
SELECT sku, concat(name, nullif(brand, 'Brand#3')) AS skips_null, name || nullif(brand, 'Brand#3') AS keeps_null,
 concat_ws(', ', name, nullif(size, 3)::VARCHAR, unit) AS listed FROM skus""")
def _(skus):
    brand = F.nullif(F.col("brand"), F.lit("Brand#3"))
    size = F.nullif(F.col("size"), F.lit(3)).cast("string")
    return skus.select(
        "sku", F.concat_ws("", "name", brand).alias("skips_null"), F.concat("name", brand).alias("keeps_null"),
        F.concat_ws(", ", "name", size, "unit").alias("listed"),
    )


@query("f06_format_dates", "moves", """
SELECT id, strftime(ts, '%H%M') AS hhmm, strftime(ts, '%d-%m-%Y %H:%M:%S') AS stamp,
 CAST(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d')::DATE AS VARCHAR) AS back FROM moves""")
def _(moves):
    return moves.select(
        "id", dates.hhmm(F.col("ts")).alias("hhmm"), F.date_format("ts", "dd-MM-yyyy HH:mm:ss").alias("stamp"),
        F.to_date(F.date_format("ts", "yyyyMMdd"), "yyyyMMdd").alias("back"),
    )


@query("f07_date_parts", "baskets", """
SELECT order_id, dayofweek(day)::INT AS dow, weekofyear(day)::INT AS week, year(day)::INT AS year, isoyear(day)::INT AS iso_year FROM baskets""")
def _(baskets):
    day = F.col("day")
    return baskets.select(
        "order_id", dates.sunday_zero(day).alias("dow"), F.weekofyear(day).alias("week"), F.year(day).alias("year"),
        dates.iso_year(day).alias("iso_year"),
    )


@query("f08_date_arithmetic", "baskets", """
SELECT order_id, CAST(date_trunc('month', day)::DATE AS VARCHAR) AS month, CAST(day - 15 AS VARCHAR) AS before,
 CAST((day + INTERVAL 1 MONTH)::DATE AS VARCHAR) AS later FROM baskets""")
def _(baskets):
    return baskets.select(
        "order_id", F.trunc("day", "month").alias("month"), F.date_sub("day", 15).alias("before"),
        F.add_months("day", 1).alias("later"),
    )


@query("f09_local_time", "moves", """
SELECT id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Santiago', '%Y-%m-%d %H:%M:%S') AS local,
 strftime(date_trunc('second', ts) AT TIME ZONE 'UTC' AT TIME ZONE 'America/Santiago', '%Y-%m-%d %H:%M:%S') AS from_epoch FROM moves""")
def _(moves):
    return moves.select(
        "id", dates.to_local(F.col("ts")).alias("local"), dates.epoch_local(F.unix_timestamp("ts")).alias("from_epoch")
    )


@query("f11_rounding", "sales", """
SELECT order_id, line_no, sku, net, ceil(net / 1000)::BIGINT AS up, floor(net / 1000)::BIGINT AS down,
 CASE WHEN units IS NOT NULL THEN greatest(5, least(40, units)) END AS clipped, trunc((pct - 5) / 2)::BIGINT AS cut,
 round_even(pct / 4, 0) AS half_even FROM sales""")
def _(sales):
    return sales.select(
        "order_id", "line_no", "sku", "net", F.ceil(F.col("net") / 1000).alias("up"),
        F.floor(F.col("net") / 1000).alias("down"), numbers.clip(F.col("units"), 5, 40).alias("clipped"),
        numbers.truncate((F.col("pct") - 5) / 2).cast("long").alias("cut"), F.bround(F.col("pct") / 4, 0).alias("half_even"),
    )


@query("f12_safe_division", "sales", """
SELECT DISTINCT sku, pct, units / nullif(pct, 0) AS per_point FROM sales""")
def _(sales):
    return sales.select("sku", "pct", numbers.ratio(F.col("units"), F.col("pct")).alias("per_point")).distinct()


@query("f14_value_maps", "sales", """
SELECT DISTINCT flag, status, CASE flag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' END AS word,
 status IN ('O', 'X') AS is_open FROM sales""")
def _(sales):
    words = F.create_map(F.lit("A"), F.lit("accepted"), F.lit("R"), F.lit("returned"))
    shown = sales.select("flag", "status").distinct()
    return shown.select(
        "flag", "status", F.try_element_at(words, F.col("flag")).alias("word"),
        keys.yes_flag(F.when(F.col("status") == "O", "x").otherwise("n")).alias("is_open"),
    )


@query("f15_json_get", "moves", """
SELECT id, json_extract_string(props, '$.k')::INT AS k, json_extract_string(props, '$.none') AS missing FROM moves""")
def _(moves):
    return moves.select(
        "id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.get_json_object("props", "$.none").alias("missing"),
    )


@query("f16_json_build", "lines", """
SELECT order_id, '[' || string_agg('{"line":' || line_no || ',"sku":' || sku || '}', ',' ORDER BY line_no, sku) || ']' AS doc FROM lines GROUP BY 1""")
def _(lines):
    rows = F.array_sort(F.collect_list(F.struct(F.col("line_no").alias("line"), "sku")))
    return lines.groupBy("order_id").agg(F.to_json(rows).alias("doc"))


@query("f17_array_membership", "sales", """
SELECT sku, bool_or(flag = 'A') AS accepted, bool_or(flag = 'R') AS returned FROM sales GROUP BY 1""")
def _(sales):
    flags = sales.groupBy("sku").agg(F.collect_set("flag").alias("flags"))  # three flags exist
    return flags.select(
        "sku", F.array_contains("flags", "A").alias("accepted"), F.array_contains("flags", "R").alias("returned")
    )


@query("f21_distance", "customer nation", """
SELECT c_custkey, round(least(2 * 2 * 6371.0088 * asin(sqrt(pow(sin(radians(n_nationkey - c_custkey % 7) / 2), 2)
  + cos(radians(c_custkey % 7)) * cos(radians(n_nationkey)) * pow(sin(radians(c_custkey % 5) / 2), 2))), 81), 6) AS km
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(customer, nation):
    lat1, lat2 = F.col("c_custkey") % 7, F.col("n_nationkey")
    km = F.least(2 * geo.haversine_km(lat1, F.lit(0), lat2, F.col("c_custkey") % 5), F.lit(81.0))
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", F.round(km, 6).alias("km"))


# ---------------------------------------------------------------- loads and merges

_OLD = "SELECT sku, list_price AS price, size FROM skus WHERE category <> 'PROMO'"
_NEW = "SELECT sku, list_price + 100 AS price, size FROM skus WHERE size < 20"


def _old_new(skus: DataFrame) -> tuple[DataFrame, DataFrame]:
    old = skus.where("category <> 'PROMO'").selectExpr("sku", "list_price AS price", "size")
    return old, skus.where("size < 20").selectExpr("sku", "list_price + 100 AS price", "size")


@query("i01_upsert", "skus", f"""
WITH o AS ({_OLD}), n AS ({_NEW}) FROM o WHERE sku NOT IN (SELECT sku FROM n) UNION ALL FROM n""")
def _(skus):
    return merge.merge_upsert(*_old_new(skus), ["sku"])


def _merge_files(old: DataFrame, new: DataFrame, null_safe: bool = False) -> DataFrame:
    """The merge as a change of files: the old rows as a table of several, of which only those with a new key are replaced."""
    path = f"{shared_folder(old.sparkSession)}/granero-{uuid.uuid4().hex}"
    track(old.sparkSession, path)
    snapshots.append(old, path, ["sku"])
    merge.merge_files(old.sparkSession, path, old.schema, new, ["sku"], null_safe=null_safe)
    return snapshots.read(old.sparkSession, path, old.schema)


@query("i01_merge_files", "skus", f"""
WITH o AS ({_OLD}), n AS ({_NEW}) FROM o WHERE sku NOT IN (SELECT sku FROM n) UNION ALL FROM n""")
def _(skus):
    return _merge_files(*_old_new(skus))


@query("i06_merge_files", "skus", f"""
WITH o AS (SELECT nullif(sku, 5) AS sku, price, size FROM ({_OLD})), n AS (SELECT nullif(sku, 4) AS sku, price, size FROM ({_NEW}))
SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.sku IS NOT DISTINCT FROM o.sku) UNION ALL SELECT * FROM n""")
def _(skus):
    old, new = _old_new(skus)
    return _merge_files(old.withColumn("sku", F.expr("nullif(sku, 5)")), new.withColumn("sku", F.expr("nullif(sku, 4)")), null_safe=True)


@query("i02_insert_absent", "skus", f"""
WITH o AS ({_OLD}), n AS ({_NEW}) FROM o UNION ALL FROM n WHERE sku NOT IN (SELECT sku FROM o)""")
def _(skus):
    return merge.merge_insert_absent(*_old_new(skus), ["sku"])


@query("i03_upsert_columns", "skus", f"""
WITH o AS ({_OLD}), n AS ({_NEW}) SELECT coalesce(o.sku, n.sku) AS sku, CASE WHEN n.sku IS NULL THEN o.price ELSE n.price END AS price,
 coalesce(o.size, n.size) AS size FROM o FULL JOIN n ON o.sku = n.sku""")
def _(skus):
    return merge.merge_columns(*_old_new(skus), ["sku"], ["price"])


@query("i04_change_aware", "skus", f"""
WITH o AS ({_OLD}), n AS ({_NEW})
SELECT coalesce(o.sku, n.sku) AS sku, CASE WHEN n.sku IS NULL THEN o.price ELSE n.price END AS price,
 CASE WHEN o.sku IS NULL THEN '1998-06-15' ELSE '1998-01-01' END AS created,
 CASE WHEN n.sku IS NOT NULL AND (o.sku IS NULL OR o.price IS DISTINCT FROM n.price) THEN '1998-06-15' ELSE '1998-01-01' END AS updated,
 CASE WHEN n.sku IS NULL THEN CASE WHEN o.size > 30 THEN '1998-03-01' ELSE '1998-06-15' END
      WHEN o.size > 30 THEN '1998-03-01' END AS deleted
FROM o FULL JOIN n ON o.sku = n.sku""")
def _(skus):
    old, new = _old_new(skus)
    first = dates.as_date("1998-01-01")
    known = old.select(
        "sku", "price", first.alias("created"), first.alias("updated"),
        F.when(F.col("size") > 30, dates.as_date("1998-03-01")).alias("deleted"),
    )
    return merge.merge_history(known, new.select("sku", "price"), ["sku"], ["price"], dates.as_date(DAY))


@query("i05_premerge_dedupe", "sales", """
SELECT order_id, line_no, MAX(units) AS units, MAX(net) AS net FROM sales GROUP BY 1, 2""")
def _(sales):
    return merge.dedupe_max(sales.select("order_id", "line_no", "units", "net"), ["order_id", "line_no"])


@query("i06_delete_then_insert", "skus", f"""
WITH o AS (SELECT nullif(sku, 5) AS sku, price, size FROM ({_OLD})), n AS (SELECT nullif(sku, 4) AS sku, price, size FROM ({_NEW}))
SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.sku IS NOT DISTINCT FROM o.sku) UNION ALL SELECT * FROM n""")
def _(skus):
    old, new = _old_new(skus)
    return merge.delete_then_insert(
        old.withColumn("sku", F.expr("nullif(sku, 5)")), new.withColumn("sku", F.expr("nullif(sku, 4)")), ["sku"]
    )


@query("i07_replace_day", "baskets", """
SELECT order_id, CAST(day AS VARCHAR) AS day, total FROM baskets WHERE day <> DATE '1998-06-15'
UNION ALL SELECT order_id, CAST(day AS VARCHAR), total * 2 FROM baskets WHERE day = DATE '1998-06-15'""")
def _(baskets):
    rows = baskets.select("order_id", "day", "total")
    fresh = rows.where(F.col("day") == dates.as_date(DAY)).withColumn("total", F.col("total") * 2)
    return merge.replace_where(rows, fresh, F.col("day") == dates.as_date(DAY))


@query("i08_replace_table", "skus", f"{_NEW}")
def _(skus):
    old, new = _old_new(skus)
    return merge.replace_where(old, new, F.lit(True))


@query("i09_update_from_lookup", "baskets stores", """
SELECT order_id, CASE WHEN s.status = 1 THEN s.label ELSE b.priority END AS label FROM baskets b
LEFT JOIN stores s ON b.store_id = s.store_id""")
def _(baskets, stores):
    known = stores.select("store_id", "label", F.col("status").alias("store_status"))
    joined = baskets.join(known, "store_id", "left")
    return joined.select("order_id", F.when(F.col("store_status") == 1, F.col("label")).otherwise(F.col("priority")).alias("label"))


@query("i10_update_by_time", "baskets", """
SELECT order_id, CASE WHEN state = 60 AND day < DATE '1998-06-15' THEN 999 ELSE state END AS state FROM baskets""")
def _(baskets):
    late = (F.col("state") == 60) & (F.col("day") < dates.as_date(DAY))
    return baskets.select("order_id", F.when(late, 999).otherwise(F.col("state")).alias("state"))


@query("i11_retention", "sales", """
SELECT CAST(day AS VARCHAR) AS day, count(*) AS n FROM sales WHERE day >= (DATE '1998-06-15' - INTERVAL 24 MONTH)::DATE GROUP BY 1""")
def _(sales):
    kept = sales.where(F.col("day") >= F.add_months(dates.as_date(DAY), -24))
    return kept.groupBy("day").agg(F.count("*").alias("n"))


@query("i13_backfill", "sales", """
SELECT CAST(day AS VARCHAR) AS day, SUM(units)::BIGINT AS units FROM sales WHERE day >= DATE '1998-06-15' - 60 GROUP BY 1""")
def _(sales):
    loaded = sales.where("units < 0")
    wanted = merge.backfill_filter(loaded, F.col("day"), dates.as_date(DAY), 60, 7)
    return sales.where(wanted).groupBy("day").agg(F.sum("units").alias("units"))


@query("i14_replace_window", "promos", """
SELECT n_promo, promo_price_x100 FROM promos WHERE NOT end_day >= DATE '1998-06-15' - 7
UNION ALL SELECT n_promo, promo_price_x100 + 1 FROM promos WHERE end_day >= DATE '1998-06-15' - 7""")
def _(promos):
    rows = promos.select("n_promo", "promo_price_x100", "end_day")
    doomed = F.col("end_day") >= F.date_sub(dates.as_date(DAY), 7)
    fresh = rows.where(doomed).withColumn("promo_price_x100", F.col("promo_price_x100") + 1)
    return merge.replace_where(rows, fresh, doomed).drop("end_day")
