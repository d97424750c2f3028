"""Assortment load, stock reconciliation and stock attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions import keys
from granero.functions.numbers import ratio, truncate
from granero.operators.ranking import latest_per_key


def clean_assortment(raw: DataFrame) -> DataFrame:
    """Parse a store file: padded codes, first block number, X/Y flags, decimal commas."""
    return raw.select(
        keys.store_code(F.col("store")).alias("store_id"), keys.material_code(F.col("material")).alias("material"),
        F.col("uom"), keys.decimal_comma(F.col("stock")).alias("stock"),
        keys.first_number(F.col("blocked_store")).try_cast("long").alias("blocked_store"),
        keys.first_number(F.col("blocked_format")).try_cast("long").alias("blocked_format"),
        (F.coalesce("substitute", F.lit("Y")) == "X").alias("substitute"),
        F.coalesce(keys.yes_flag(F.col("listed")), F.lit(False)).alias("listed"),
    ).distinct()


def load_assortment(
    files: DataFrame, excluded: DataFrame, exceptions: DataFrame, store_excluded: DataFrame,
    equivalents: DataFrame, parent_state: DataFrame,
) -> DataFrame:
    """Day files with exclusion rules and blocks inherited from the purchase SKU.

    A globally excluded SKU stays where an exception names the store; a store rule always excludes. When the
    purchase SKU (or the sale SKU itself) is blocked or inactive at a store, its sale SKUs are excluded there
    and empty block numbers take the parent's.
    """
    pair = ["sku", "store_id"]

    def marked(df: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
        return df.select(*on).distinct().withColumn(flag, F.lit(True))

    own = parent_state.join(
        equivalents.select(F.col("purchase_sku").alias("sku")).distinct(), "sku", "left_anti"
    )
    inherited = (
        equivalents.select(F.col("purchase_sku").alias("sku"), "sale_sku").distinct().join(parent_state, "sku")
        .drop("sku").withColumnRenamed("sale_sku", "sku")
    )
    failed = (
        ~F.coalesce("listed", F.lit(False)) | ~F.coalesce("active", F.lit(False))
        | F.col("blocked_store").isNotNull() | F.col("blocked_format").isNotNull()
    )
    parents = own.unionByName(inherited).groupBy(*pair).agg(
        F.bool_or(failed).alias("_failed"), F.max("blocked_store").alias("_store_block"),
        F.max("blocked_format").alias("_format_block"),
    )
    joined = (
        files.join(marked(exceptions, pair, "_except"), pair, "left")
        .join(marked(store_excluded, pair, "_store"), pair, "left").join(parents, pair, "left")
        .join(marked(excluded, ["sku"], "_global"), "sku", "left")
    )
    out = (
        (F.col("_global").isNotNull() & F.col("_except").isNull()) | F.col("_store").isNotNull()
        | F.coalesce("_failed", F.lit(False))
    )
    return joined.withColumns({
        "excluded": out, "blocked_store": F.coalesce("blocked_store", "_store_block"),
        "blocked_format": F.coalesce("blocked_format", "_format_block"),
    }).drop("_global", "_except", "_store", "_failed", "_store_block", "_format_block")


def exclusion_table(excluded: DataFrame, exceptions: DataFrame, store_excluded: DataFrame) -> DataFrame:
    """Excluded products: for every store unless any exception names the product, and per store."""
    everywhere = excluded.join(exceptions, "sku", "left_anti").select(
        "sku", F.lit(1).alias("all_stores"), F.lit(None).cast("long").alias("store_id")
    )
    return everywhere.unionByName(store_excluded.select("sku", F.lit(0).alias("all_stores"), "store_id"))


def sold_assortment(assortment: DataFrame, sales: DataFrame) -> DataFrame:
    """Listed (SKU, store) pairs that sold."""
    return assortment.select("sku", "store_id").join(sales, ["sku", "store_id"], "left_semi").distinct()


def stock_snapshot(
    web: DataFrame, warehouses: DataFrame, stores: DataFrame, backend: DataFrame, assortment: DataFrame,
    excluded_pairs: Sequence[tuple[int, int]] = (),
) -> DataFrame:
    """Web stock with backend stock beside it, for active stores and docks, and an e-commerce flag."""
    active = warehouses.where("dock_active").join(stores.where("status = 1").select("store_id"), "store_id", "left_semi")
    kept = active.select("warehouse", "store_id")
    for store, warehouse in excluded_pairs:
        kept = kept.where(~((F.col("store_id") == store) & (F.col("warehouse") == warehouse)))
    offered = assortment.select(
        "sku", "store_id",
        F.expr("NOT excluded AND blocked_store IS NULL AND blocked_format IS NULL AND listed").alias("ecommerce"),
    )
    return (
        web.join(kept, "warehouse").join(backend, ["sku", "store_id", "warehouse"], "left")
        .join(offered, ["sku", "store_id"], "left")
        .withColumns({
            "available": F.col("total") - F.col("reserved"), "ecommerce": F.coalesce("ecommerce", F.lit(False)),
        })
    )


def reconcile_stock(
    assortment: DataFrame, system: DataFrame, multipliers: DataFrame, parents: DataFrame, warehouse: DataFrame
) -> DataFrame:
    """System stock beside the assortment's, converted to sale units.

    Cases are truncated and weights divided by the unit multiplier; a stock of the purchase SKU replaces the
    converted figure. Packs are not compared.
    """
    unit, stock = F.col("uom"), F.col("stock")
    converted = (
        F.when(unit.isin("DIS", "CJ"), truncate(stock)).when(unit.isin(*keys.WEIGHT_UNITS), F.round(ratio(stock, F.col("multiplier"))))
        .otherwise(stock)
    )
    parent = (
        parents.join(warehouse, ["purchase_sku", "store_id"])
        .groupBy("sku", "store_id").agg(F.max("warehouse_stock").alias("parent_stock"))
    )
    joined = (
        assortment.where(unit != "PAQ").join(system, ["sku", "store_id"]).join(parent, ["sku", "store_id"], "left")
        .join(multipliers, "sku")
    )
    final = F.when(
        F.coalesce("parent_stock", F.lit(0)) != 0, F.round(ratio(F.col("parent_stock"), F.col("multiplier")))
    ).otherwise(F.round(converted))
    return joined.select(
        "sku", "store_id", "stock", F.coalesce("system_stock", F.lit(0)).alias("system_stock"),
        final.cast("long").alias("expected"),
    )


def unify_group_stock(stock: DataFrame, groups: DataFrame, skipped_stores: Sequence[int] = ()) -> DataFrame:
    """Every member of a substitute group shows the group's total stock at the store."""
    members = stock.where(~F.col("store_id").isin(*skipped_stores)).join(groups, "sku")
    totals = members.groupBy("store_id", "group").agg(F.round(F.sum("stock"), 2).alias("group_stock"))
    return members.select("store_id", "group", "sku").distinct().join(totals, ["store_id", "group"])


def recency_flags(assortment: DataFrame, sales: DataFrame, as_of: Column, days: int = 10) -> DataFrame:
    """One flag per trailing day that had a sale, for every SKU and store of the assortment."""
    recent = sales.where(F.col("day").between(F.date_sub(as_of, days), F.date_sub(as_of, 1))).withColumn("age", F.datediff(as_of, "day"))
    names = [f"day_{d}" for d in range(1, days + 1)]
    flags = recent.groupBy("sku", "store_id").agg(
        *[F.max(F.when(F.col("age") == d, 1).otherwise(0)).alias(name) for d, name in enumerate(names, 1)]
    )
    pairs = assortment.select("sku", "store_id").distinct()
    return pairs.join(flags, ["sku", "store_id"], "left").fillna(0, names)


def immobile_stock(flags: DataFrame, products: DataFrame, thresholds: DataFrame, days: int = 10) -> DataFrame:
    """SKU-stores whose days since the last sale equal the threshold of the store and category."""
    since = F.lit(days)
    for day in range(days, 0, -1):
        since = F.when(F.col(f"day_{day}") == 1, day - 1).otherwise(since)
    aged = flags.withColumn("days_since", since).join(products.select("sku", "category"), "sku")
    return aged.join(thresholds, ["store_id", "category"]).where(F.col("days_since") == F.col("threshold"))


def adjustment_totals(adjustments: DataFrame) -> DataFrame:
    """Manual adjustments by day, store and SKU."""
    return adjustments.groupBy("day", "store_id", "sku").agg(
        F.sum("units").alias("units"), F.count("*").alias("adjustments")
    )


def last_plan_rows(plans: DataFrame, key: str, version: str) -> DataFrame:
    """Plans with a flag on the newest row of each order."""
    last = plans.groupBy(key).agg(F.max(version).alias("_last"))
    return plans.join(last, key).withColumn("current", F.col(version) == F.col("_last")).drop("_last")


def fill_rates(purchases: DataFrame, attributes: DataFrame) -> DataFrame:
    """Slotting attributes with received / ordered units of the SKU's latest receipt."""
    totals = purchases.groupBy("sku", "received_on").agg(
        F.sum("ordered").alias("ordered"), F.sum("received").alias("received")
    )
    last = latest_per_key(totals, ["sku"], "received_on")
    return attributes.join(last, "sku", "left").withColumn(
        "fill_rate", ratio(F.col("received"), F.col("ordered"))
    )
