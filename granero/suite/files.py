"""Sources and sinks: each query writes files derived from the tables and reads them back."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.operators.merge import write_partitions
from granero.session import shared_folder
from granero.sources import scans
from granero.suite.registry import query


def _folder(df) -> str:
    return f"{shared_folder(df.sparkSession)}/files-{uuid.uuid4().hex}"


@query("s05_csv_decimal_comma", "skus", "SELECT sku AS material, name, list_price / 100 AS price FROM skus")
def _(skus):
    path = _folder(skus)
    comma = F.replace((F.col("list_price") / 100).cast("decimal(12,2)").cast("string"), F.lit("."), F.lit(","))
    skus.select("sku", "name", comma.alias("price")).write.option("header", True).option("sep", ";").csv(path)
    schema = T.StructType([T.StructField("sku", T.LongType()), T.StructField("name", T.StringType()), T.StructField("price", T.StringType())])
    return scans.read_csv(skus.sparkSession, path, schema, ";", True, {"price": "decimal(12,2)"}, {"sku": "material"})


@query("s06_store_files", "assortment", "SELECT sku, stock, CAST(store_id AS VARCHAR) AS store_id FROM assortment")
def _(assortment):
    """One file a store, as the stores send them: rows gather by store first, else every task writes a file for each store."""
    path = _folder(assortment)
    assortment.select("sku", "stock", "store_id").hint("rebalance", "store_id").write.partitionBy("store_id").option("header", True).csv(path)
    schema = T.StructType([T.StructField("sku", T.LongType()), T.StructField("stock", T.LongType())])
    return scans.read_store_files(assortment.sparkSession, path, schema, r"store_id=(\d+)/")


@query("s08_json_documents", "moves", """
SELECT id, kind, json_extract_string(props, '$.k')::BIGINT AS k, amount AS first_amount FROM moves""")
def _(moves):
    path = _folder(moves)
    amounts = F.when(F.col("amount") >= 0, F.array(F.struct("amount"))).alias("items")
    props = F.from_json("props", "k LONG").alias("props")
    moves.select("id", F.struct(F.col("kind").alias("name")).alias("type"), props, amounts).write.json(path)
    schema = "id LONG, type STRUCT<name: STRING>, props STRUCT<k: LONG>, items ARRAY<STRUCT<amount: LONG>>"
    first = F.try_element_at("items", F.lit(1))["amount"]
    return scans.read_documents(moves.sparkSession, path, schema).select(
        "id", F.col("type.name").alias("kind"), F.col("props.k").alias("k"), first.alias("first_amount")
    )


@query("s09_headerless_csv", "stores", "SELECT store_id AS code, label AS title, status FROM stores")
def _(stores):
    path = _folder(stores)
    stores.select("store_id", "label", "status").write.csv(path)
    schema = T.StructType([T.StructField("code", T.LongType()), T.StructField("title", T.StringType()), T.StructField("status", T.IntegerType())])
    return scans.read_csv(stores.sparkSession, path, schema, header=False)


@query("s11_dated_sink", "skus", "SELECT sku, CASE WHEN size < 20 THEN '1998-06-14' ELSE '1998-06-15' END AS ds, list_price + CASE WHEN size < 20 THEN 0 ELSE 1 END AS price FROM skus")
def _(skus):
    path = _folder(skus)
    scans.write_dated(skus.where("size < 20").select("sku", F.col("list_price").alias("price")), path, "1998-06-14")
    for bump in (0, 1):
        later = skus.where("size >= 20").select("sku", (F.col("list_price") + bump).alias("price"))
        scans.write_dated(later, path, "1998-06-15")
    schema = T.StructType([T.StructField("sku", T.LongType()), T.StructField("price", T.LongType()), T.StructField("ds", T.StringType())])
    return scans.read_csv(skus.sparkSession, path, schema)


@query("s11_day_replaced_by_nothing", "skus", "SELECT sku, '1998-06-14' AS ds FROM skus")
def _(skus):
    path = _folder(skus)
    for day in ("1998-06-14", "1998-06-15"):
        scans.write_dated(skus.select("sku"), path, day)
    scans.write_dated(skus.select("sku").where("sku < 0"), path, "1998-06-15")
    schema = T.StructType([T.StructField("sku", T.LongType()), T.StructField("ds", T.StringType())])
    return scans.read_csv(skus.sparkSession, path, schema)


@query("s12_per_key_files", "assortment", "SELECT store_id, count(*) AS items, SUM(stock)::BIGINT AS stock FROM assortment GROUP BY 1")
def _(assortment):
    path = _folder(assortment)
    scans.write_per_key(assortment.select("store_id", "sku", "stock"), path, "store_id")
    back = scans.read_documents(assortment.sparkSession, path, "sku LONG, stock LONG, store_id LONG")
    return back.groupBy("store_id").agg(F.count("*").alias("items"), F.sum("stock").alias("stock"))


@query("s13_complete_export", "skus", "SELECT sku, brand, name FROM skus WHERE size <> 4 AND brand <> 'Brand#2'")
def _(skus):
    blanked = skus.withColumns({"name": F.when(F.col("size") != 4, F.col("name")), "brand": F.when(F.col("brand") == "Brand#2", " ").otherwise(F.col("brand"))})
    path = _folder(skus)
    scans.complete_rows(blanked, ["sku", "brand", "name"]).write.option("header", True).csv(path)
    schema = T.StructType([T.StructField("sku", T.LongType()), T.StructField("brand", T.StringType()), T.StructField("name", T.StringType())])
    return scans.read_csv(skus.sparkSession, path, schema)


@query("i07_partition_overwrite", "baskets", """
SELECT CASE WHEN state = 60 THEN 'open' ELSE 'done' END AS part, order_id, total + CASE WHEN state = 60 THEN 1 ELSE 0 END AS total FROM baskets""")
def _(baskets):
    path = _folder(baskets)
    rows = baskets.select("order_id", "total", F.when(F.col("state") == 60, "open").otherwise("done").alias("part"))
    write_partitions(rows, path, "part")
    write_partitions(rows.where("part = 'open'").withColumn("total", F.col("total") + 1), path, "part")
    return baskets.sparkSession.read.schema("order_id LONG, total LONG, part STRING").parquet(path)


@query("i07_partition_replaced_by_nothing", "baskets", "SELECT 'done' AS part, order_id FROM baskets WHERE state <> 60")
def _(baskets):
    path = _folder(baskets)
    rows = baskets.select("order_id", F.when(F.col("state") == 60, "open").otherwise("done").alias("part"))
    write_partitions(rows, path, "part")
    write_partitions(rows.where("order_id < 0"), path, "part", replace=[("open",)])
    return baskets.sparkSession.read.schema("order_id LONG, part STRING").parquet(path)


@query("i12_archive_and_delete", "moves", """
SELECT 'archived' AS place, count(*) AS n FROM moves WHERE day = DATE '2024-01-10' UNION ALL SELECT 'live', count(*) FROM moves WHERE day <> DATE '2024-01-10'""")
def _(moves):
    path = _folder(moves)
    doomed = F.col("day") == F.lit("2024-01-10").cast("date")
    live, archived = scans.archive(moves.select("id", "day"), doomed, f"{path}/archive")
    counts = [df.agg(F.lit(place).alias("place"), F.count("*").alias("n")) for place, df in (("archived", archived), ("live", live))]
    return counts[0].unionByName(counts[1])
