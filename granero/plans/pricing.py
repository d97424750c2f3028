"""Price lists, tiers and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date
from granero.operators.ranking import first_per_key


def valid_prices(prices: DataFrame, day) -> DataFrame:
    """Prices valid on ``day``; an open end stays valid."""
    day = as_date(day)
    return prices.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") >= day)))


def copy_reference_prices(prices: DataFrame, stores: DataFrame, reference_store: int, day) -> DataFrame:
    """Rows of other active stores whose price differs from the reference store's for the same tier."""
    key = ["store_id", "sku", "min_qty"]
    newest = first_per_key(valid_prices(prices, day), key, [F.col("valid_from").desc(), F.col("id").desc()])
    reference = newest.where(F.col("store_id") == reference_store).select(
        "sku", "min_qty", F.col("price").alias("reference_price"), F.col("list_price").alias("reference_list")
    )
    others = newest.where(F.col("store_id") != reference_store).join(stores.where("status = 1"), "store_id", "left_semi")
    return others.join(reference, ["sku", "min_qty"]).where(F.col("price") != F.col("reference_price"))


def spread_reference_prices(
    prices: DataFrame, assortment: DataFrame, source_stores: Sequence[int], target_stores: Sequence[int]
) -> DataFrame:
    """Price of the source store with the highest regular price, sent to every target store that sells it."""
    wanted = assortment.where(F.col("store_id").isin(*source_stores)).select("sku", "store_id", "regular_price")
    usable = prices.where("price IS NOT NULL AND (valid_to IS NULL OR valid_from <= valid_to)")
    ranked = wanted.join(usable.select("sku", "store_id", "price"), ["sku", "store_id"])
    best = first_per_key(
        ranked, ["sku"], [F.col("regular_price").desc(), F.col("store_id").asc(), F.col("price").asc()]
    ).select("sku", F.col("price").alias("new_price"))
    targets = prices.where(F.col("store_id").isin(*target_stores)).select("id", "sku", "store_id")
    return targets.join(best, "sku")


def price_profiles(prices: DataFrame, stores: DataFrame, reference_store: int) -> DataFrame:
    """Winning tiers per SKU over active stores, and whether all of them share one profile.

    The reference store wins where it has prices; elsewhere the store with most tiers, then the highest base
    price. Profiles compare as sorted tier text. Only the newest price of a tier counts, so a list has one
    entry per quantity step however many prices a store has sent.
    """
    newest = [F.col("valid_from").desc(), F.col("id").desc(), F.col("price").asc()]
    active = prices.join(stores.where("status = 1").select("store_id"), "store_id", "left_semi")
    prices = first_per_key(active, ["sku", "store_id", "min_qty"], newest)
    tier = F.concat_ws("-", "min_qty", "price", "list_price")
    tiers = F.array_sort(F.collect_set(F.struct("min_qty", "price", "list_price", "valid_from", "valid_to")))
    per_store = prices.groupBy("sku", "store_id").agg(
        F.array_join(F.array_sort(F.collect_set(tier)), "|").alias("profile"), tiers.alias("tiers"),
        F.count("*").alias("n"), F.max(F.when(F.col("min_qty") == 1, F.col("price"))).alias("base"),
    )
    order = [
        (F.col("store_id") == reference_store).desc(), F.col("n").desc(), F.coalesce("base", F.lit(0)).desc(),
        F.col("store_id").asc(),
    ]
    winner = first_per_key(per_store.drop("profile"), ["sku"], order)
    same = per_store.groupBy("sku").agg((F.count_distinct("profile") == 1).alias("uniform"))
    steps = F.filter("tiers", lambda t: t["min_qty"] > 1)
    def level(tier: Column, place: Column) -> Column:
        body = F.struct(
            F.coalesce(tier["price"], F.lit(0)).cast("string").alias("precio"), tier["min_qty"].cast("string").alias("cantidad")
        )
        return F.concat(F.lit('"nivel'), place + 1, F.lit('":'), F.to_json(body))

    first = F.element_at("tiers", 1)
    dates = F.struct(first["valid_from"].cast("string").alias("fechaInicio"), first["valid_to"].cast("string").alias("fechaTermino"))
    opened = F.rtrim(F.to_json(dates, {"ignoreNullFields": "false"}), F.lit("}"))
    scale = F.concat(F.lit('{"escalas":['), opened, F.lit(","), F.array_join(F.transform(steps, level), ","), F.lit("}]}"))
    return winner.join(same, "sku").select(
        "sku", "store_id", "uniform", F.coalesce(first["list_price"], F.lit(0)).alias("list_price"),
        F.when(F.size(steps) > 0, scale).alias("scale"),
    )


def price_tiers(promotions: DataFrame) -> DataFrame:
    """Three wide price and factor pairs per SKU as rows; factor 0 is no tier.

    The cheapest second tier per SKU counts; a first factor of 1 voids the base tier.
    """
    best = first_per_key(promotions, ["sku"], [F.col("price2").asc(), F.col("name").asc()])
    wide = best.withColumns({
        "price0": F.col("modal_price"), "factor0": F.when(F.col("factor1") == 1, 0).otherwise(1),
        "policy": F.translate(F.trim("name"), " .+-,", ""),
    })
    rows = wide.selectExpr(
        "sku", "policy", "modal_price AS list_price", "start_day AS valid_from", "date_add(end_day, 1) AS valid_to",
        "stack(3, price0, factor0, price1, factor1, price2, factor2) AS (price, min_qty)",
    )
    return rows.where("min_qty <> 0")


def audit_published(expected: DataFrame, published: DataFrame) -> DataFrame:
    """Expected against published price and scale, with the update and the backup as JSON when they differ."""
    e = expected.select("sku", F.col("list_price").alias("_price"), F.col("scale").alias("_scale"))
    joined = published.join(e, "sku", "left")

    def differs(now: str, wanted: str) -> Column:
        return ~F.col(now).eqNullSafe(F.col(wanted))

    def payload(price: str, scale: str) -> Column:
        price_spec = F.when(differs("list_price", "_price"), F.struct(F.lit("Precio Lista").alias("name"), F.col(price).cast("string").alias("value")))
        scale_spec = F.when(differs("scale", "_scale"), F.struct(F.lit("Escala Precios").alias("name"), F.col(scale).alias("value")))
        return F.to_json(F.array_compact(F.array(price_spec, scale_spec)))

    return joined.where(differs("list_price", "_price") | differs("scale", "_scale")).select(
        "sku", differs("list_price", "_price").alias("price_differs"), differs("scale", "_scale").alias("scale_differs"),
        payload("_price", "_scale").alias("update"), payload("list_price", "scale").alias("backup"),
    )


def policy_prices(product_stores: DataFrame, skus: DataFrame, prices: DataFrame, stores: Sequence[int], policies: Sequence[str]) -> DataFrame:
    """Published prices of chosen policies for SKUs sold in chosen stores."""
    sold = product_stores.where(F.col("store_id").isin(*stores)).select("sku").distinct()
    wanted = skus.where(F.col("web_id").isNotNull()).join(sold, "sku", "left_semi")
    return prices.where(F.col("policy").isin(*policies)).join(wanted.select("sku", "web_id", "name"), "sku")


def load_price_list(prices: DataFrame, skus: DataFrame) -> DataFrame:
    """Price list with the SKU's reference attached; prices of unknown SKUs are dropped."""
    return prices.join(skus.select("sku", "ref_id"), "sku")
