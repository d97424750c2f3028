"""Marketplace offers, catalogues and availability feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_ts
from granero.functions.keys import PIECE_UNITS, WEIGHT_UNITS, normal_unit
from granero.functions.numbers import ratio
from granero.operators.ranking import first_per_key
from granero.plans.promotions import OFFERED, Eligibility, live_promotions

# Fixed value: store-numbered promotion names (L0xx, L1 to L999).


def best_simple_promotion(promotions: DataFrame, day, rules: Eligibility = OFFERED) -> DataFrame:
    """Lowest price per SKU among live percentage and fixed-price promotions of the main channel."""
    live = live_promotions(promotions, day, rules)
    return live.groupBy("sku").agg(F.min("promo_price").alias("promo_price"))


def offers(stock: DataFrame, products: DataFrame, prices: DataFrame, best: DataFrame) -> DataFrame:
    """Stock x price x best promotion for complete products with at least one whole sale unit."""
    complete = products.where("name IS NOT NULL AND brand IS NOT NULL AND uom IS NOT NULL AND multiplier IS NOT NULL")
    joined = stock.join(prices, ["sku", "store_id"]).join(complete, "sku").join(best, "sku", "left")
    return joined.where(F.floor(F.col("stock") / F.col("multiplier")) > 0)


def store_prices(prices: DataFrame, assortment: DataFrame, stores: DataFrame, products: DataFrame, hidden: Sequence[str]) -> DataFrame:
    """Prices of listed, unblocked SKUs in active stores, outside hidden categories."""
    open_items = assortment.where(
        "NOT coalesce(excluded, false) AND blocked_store IS NULL AND blocked_format IS NULL"
    ).select("sku", "store_id")
    shown = products.where(F.col("category").isNull() | ~F.col("category").isin(*hidden)).select("sku")
    return (
        prices.join(stores.where("status = 1"), "store_id", "left_semi")
        .join(open_items, ["sku", "store_id"], "left_semi").join(shown, "sku", "left_semi")
    )


def other_store_prices(prices: DataFrame, stock: DataFrame, stores: DataFrame) -> DataFrame:
    """Price for stores without e-commerce: the highest price of the SKU over active stores."""
    highest = prices.groupBy("sku").agg(F.max("price").alias("price"))
    others = stock.join(stores.where("status = 1"), "store_id", "left_anti").select("sku", "store_id")
    return others.join(highest, "sku")


def translate_parent_stock(stock: DataFrame, equivalents: DataFrame) -> DataFrame:
    """Stock kept under the purchase SKU, offered under each of its sale SKUs."""
    pairs = equivalents.select(F.col("purchase_sku").alias("sku"), "sale_sku").distinct()
    return stock.join(pairs, "sku").drop("sku").withColumnRenamed("sale_sku", "sku")


def format_offers(
    stock: DataFrame, stores: DataFrame, modal_prices: DataFrame, promotions: DataFrame, masters: DataFrame,
    formats: Sequence[str] = ("09", "02"),
) -> DataFrame:
    """Offers of a smaller format: latest stock load, price by format priority, unit codes normalised.

    ``promotions`` holds the live fixed-price and percentage rows; the lowest price per SKU and unit wins.
    """
    last = stock.agg(F.max("loaded_on")).scalar()
    current = stock.where((F.col("loaded_on") == last) & (F.col("stock") > 0) & ~F.coalesce("blocked", F.lit(False)))
    current = current.withColumn("uom", normal_unit(F.col("uom"))).join(stores, "store_id", "left_semi")
    price_order = [(F.col("format") == f).desc() for f in formats] + [F.col("week").desc(), F.col("price").asc()]
    priced = first_per_key(modal_prices.withColumn("uom", normal_unit(F.col("uom"))), ["sku", "uom"], price_order)
    cheapest = promotions.withColumn("uom", normal_unit(F.col("uom"))).groupBy("sku", "uom").agg(
        F.min("promo_price").alias("promo_price")
    )
    return (
        current.join(priced.select("sku", "uom", "price").where("price IS NOT NULL"), ["sku", "uom"])
        .join(masters.where("ean IS NOT NULL AND brand IS NOT NULL"), "sku").join(cheapest, ["sku", "uom"], "left")
    )


def marketplace_catalogue(assortment: DataFrame, skus: DataFrame, images: DataFrame, host: str, hidden: Sequence[str]) -> DataFrame:
    """One row per material with an image: the first reference, content quantity and full image address."""
    listed = assortment.where("NOT coalesce(excluded, false) AND blocked_store IS NULL AND blocked_format IS NULL")
    offered = listed.groupBy("sku").agg(F.max("price").alias("price"))
    main = images.where("position = 1 AND image <> ''").select("sku", F.concat(F.lit(host), "image").alias("image"))
    rows = (
        skus.where(F.col("category").isNull() | ~F.col("category").isin(*hidden)).join(offered, "sku")
        .join(main, "sku", "left")
        .withColumns({
            "quantity": ratio(F.col("content"), F.col("pack")),
            "weighable": F.when(F.col("uom") == "KGV", "VERDADERO").otherwise(""),
        })
    )
    order = [F.col("ref_id").asc(), F.col("image").asc_nulls_last()]
    return first_per_key(rows, ["material"], order).where(F.col("image").isNotNull())


def sale_type(uom: Column) -> Column:
    return F.when(uom.isin(*PIECE_UNITS), "U").when(uom.isin(*WEIGHT_UNITS), "WW").otherwise("ERROR")


def availability_feed(offered: DataFrame, safety: DataFrame, default_safety: int = 2) -> DataFrame:
    """Feed rows: id with pack suffix, whole stock, capped promotion price and active flag."""
    weighed, multiplier, stock = F.col("uom").isin(*WEIGHT_UNITS), F.col("multiplier"), F.col("stock")
    joined = offered.join(safety, ["sku", "store_id"], "left")
    units = F.when(weighed, stock.cast("double")).otherwise(ratio(stock, multiplier))
    sku = F.col("sku").cast("string")
    return joined.select(
        "store_id", F.when((multiplier > 1) & ~weighed, F.concat(sku, F.lit("_"), multiplier)).otherwise(sku).alias("id"),
        F.round(units).cast("long").alias("stock"), "price",
        F.least("promo_price", "price").alias("discount_price"), sale_type(F.col("uom")).alias("sale_type"),
        F.when(units >= F.coalesce("safety", F.lit(default_safety)), 1).otherwise(0).alias("active"),
    )


def net_stock_feed(offered: DataFrame, safety: DataFrame, netted_stores: Sequence[int]) -> DataFrame:
    """Sellable quantity per unit of sale; in ``netted_stores`` the safety stock is held back."""
    held = F.when(F.col("store_id").isin(*netted_stores), F.coalesce("safety", F.lit(0))).otherwise(0)
    stock, multiplier, uom = F.col("stock"), F.col("multiplier"), F.col("uom")
    quantity = (
        F.when(uom == "KGV", F.round(stock - held * multiplier, 3))
        .when(uom == "KG", F.round((stock - held) * multiplier, 3)).otherwise(F.round((stock - held) * multiplier, 0))
    )
    return offered.join(safety, ["sku", "store_id"], "left").select(
        "sku", "store_id", "uom", F.when(uom == "KGV", 1).otherwise(multiplier).alias("units_per_sale"),
        F.greatest(quantity, F.lit(0)).alias("quantity"), "price",
    )


def full_stock_feed(stock: DataFrame, prices: DataFrame, products: DataFrame, best: DataFrame) -> DataFrame:
    """Every priced e-commerce row with its stock and the promotion price when it is lower."""
    joined = (
        stock.where("ecommerce").join(prices.where("price IS NOT NULL"), ["sku", "store_id"])
        .join(products, "sku", "left").join(best, "sku", "left")
    )
    return joined.select(
        "store_id", "sku", "stock", "price", F.least(F.coalesce("promo_price", "price"), "price").alias("discount_price"),
        "brand", sale_type(F.col("uom")).alias("sale_type"),
    )


def changed_stock_feed(feed: DataFrame, movements: DataFrame, now, hours: int = 4) -> DataFrame:
    """Feed rows whose SKU moved at the store in the last ``hours`` hours."""
    now = as_ts(now)
    recent = movements.where(F.col("ts").between(now - F.expr(f"INTERVAL '{hours}' HOUR"), now))
    return feed.join(recent.select("sku", "store_id"), ["sku", "store_id"], "left_semi")
