"""Store, carrier, slot, label and category dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.keys import zero_pad
from granero.operators.ranking import first_per_key

# Seal bucket by number of seals.
SEALS = {1: "Un Sello", 2: "Dos Sellos", 3: "Tres Sellos", 4: "Cuatro Sellos"}
# Closed content ranges (low, high, label) per unit; the first match wins.
CONTENT_RANGES = {
    "g": [
        (0, 200, "hasta 200 g"), (201, 249, "201 a 400 g"), (250, 250, "250 g"), (251, 399, "201 a 400 g"), (400, 400, "400 g"),
        (401, 499, "401 a 600 g"), (500, 500, "500 g"), (501, 600, "401 a 600 g"), (601, 800, "601 a 800 g"), (801, 999, "801 a 1000 g"),
    ],
    "Kg": [
        (1, 1, "1 Kg"), (1.001, 1.2, "1 a 1.2 Kg"), (1.201, 1.4, "1.201 a 1.4 Kg"), (1.401, 1.6, "1.401 a 1.6 Kg"),
        (1.601, 1.8, "1.601 a 1.8 Kg"), (1.801, 1.999, "1.801 a 2 Kg"), (2, 2, "2 Kg"), (3, 3, "3 Kg"), (5, 5, "5 Kg"),
        (7, 7, "7 Kg"), (9, 9, "9 Kg"), (15, 15, "15 Kg"), (18, 18, "18 Kg"),
    ],
    "L": [
        (1, 1, "1 L"), (1.201, 1.4, "1.201 a 1.4 L"), (1.401, 1.499, "1.401 a 1.6 L"), (1.5, 1.5, "1.5 L"), (1.501, 1.6, "1.401 a 1.6 L"),
        (1.601, 1.749, "1.601 a 1.8 L"), (1.75, 1.75, "1.75 L"), (1.751, 1.8, "1.601 a 1.8 L"), (1.801, 1.999, "1.801 a 2 L"),
        (2, 2, "2 L"), (2.5, 2.5, "2.5 L"), (3, 3, "3 L"), (5, 5, "5 L"), (6, 6, "7 L"),
    ],
    "ml": [
        (0, 199, "hasta 200 ml"), (200, 200, "200 ml"), (201, 249, "201 a 400 ml"), (250, 250, "250 ml"), (251, 299, "201 a 400 ml"),
        (300, 300, "300 ml"), (301, 349, "201 a 400 ml"), (350, 350, "350 ml"), (351, 400, "201 a 400 ml"), (401, 499, "401 a 600 ml"),
        (500, 500, "500 ml"), (501, 599, "401 a 600 ml"), (600, 600, "600 ml"), (601, 749, "601 a 800 ml"), (750, 750, "750 ml"),
        (751, 800, "601 a 800 ml"), (801, 999, "801 a 1000 ml"),
    ],
}


def carrier_store(ref: Column) -> Column:
    """Store prefix of a carrier reference: leading digits padded to four, the rest kept."""
    clean = F.trim(ref)
    digits = F.regexp_extract(clean, r"^(\d+)", 1)
    return F.when(digits == "", clean).otherwise(F.concat(zero_pad(digits, 4), F.regexp_extract(clean, r"^\d+(.*)$", 1)))


def store_dimension(stores: DataFrame, hierarchy: DataFrame, carriers: DataFrame) -> DataFrame:
    """Stores with their hierarchy, label and service flags.

    A store offers a service when an active carrier of that type has a reference starting with its code. Each
    reference is spread over its possible code prefixes, which makes the prefix test an equi join.
    """
    coded = stores.withColumn("code", zero_pad(F.col("store_id"), 4))
    widest = coded.agg(F.max(F.length("code"))).scalar()
    active = carriers.where("status = 3 AND ref_id IS NOT NULL").withColumn("_ref", carrier_store(F.col("ref_id")))
    spread = active.withColumn("_width", F.explode(F.sequence(F.lit(4), widest))).withColumn(
        "code", F.substring(F.col("_ref"), F.lit(1), F.col("_width"))
    )
    services = spread.groupBy("code").agg(
        F.bool_or(F.col("type") == "pickup").alias("pickup"), F.bool_or(F.col("type") == "delivery").alias("delivery")
    )
    return (
        coded.join(hierarchy, "store_id", "left").join(services, "code", "left")
        .withColumns({
            "label": F.concat("code", F.lit(" - "), "name"), "pickup": F.coalesce("pickup", F.lit(False)),
            "delivery": F.coalesce("delivery", F.lit(False)),
        })
    )


def carrier_dimension(carriers: DataFrame, warehouses: DataFrame) -> DataFrame:
    """One row per carrier; the dock is kept only when a warehouse knows it."""
    docks = warehouses.groupBy("dock").agg(F.max("warehouse").alias("warehouse"), F.max("store_id").alias("store_id"))
    joined = carriers.join(docks, "dock", "left").withColumn("_dock", F.when(F.col("warehouse").isNotNull(), F.col("dock")))
    keep = [c for c in carriers.columns if c != "dock"]
    return joined.groupBy(*keep).agg(
        F.max("_dock").alias("dock"), F.max("warehouse").alias("warehouse"), F.max("store_id").alias("store_id")
    )


def slot_monitor(slots: DataFrame, stores: DataFrame, carriers: DataFrame) -> DataFrame:
    """Delivery slots with store and carrier names."""
    return slots.join(stores.select("store_id", F.col("label").alias("store_label")), "store_id", "left").join(
        carriers.select("carrier", F.col("name").alias("carrier_name")), "carrier", "left"
    )


def slot_offsets(ranges: DataFrame, offsets: DataFrame) -> DataFrame:
    """Active ranges with the newest offset of their carrier, by creation or change time."""
    order = [F.greatest("created", "modified").desc(), F.col("offset").desc()]
    newest = first_per_key(offsets, ["carrier", "range"], order).select("carrier", "range", "offset")
    return ranges.join(newest, ["carrier", "range"], "left")


def product_labels(flags: DataFrame, labels: dict[str, str]) -> Column:
    """Comma list of the labels whose flag column is 1."""
    return F.nullif(F.concat_ws(",", *[F.when(F.col(c) == 1, text) for c, text in labels.items()]), F.lit(""))


def label_changes(flags: DataFrame, allergens: dict[str, str], seals: dict[str, str], current: DataFrame) -> DataFrame:
    """SKUs whose allergen or seal text differs from the current attributes, with the seal bucket appended."""
    count = sum((F.when(F.col(c) == 1, 1).otherwise(0) for c in seals), F.lit(0))
    bucket = F.try_element_at(F.create_map(*[F.lit(x) for pair in SEALS.items() for x in pair]), count)
    fresh = flags.select(
        "sku", product_labels(flags, allergens).alias("allergens"), F.concat(product_labels(flags, seals), F.lit(","), bucket).alias("seals")
    ).where("allergens IS NOT NULL OR seals IS NOT NULL")
    known = current.select("sku", F.col("allergens").alias("_a"), F.col("seals").alias("_s"))
    joined = fresh.join(known, "sku", "left")

    def changed(now: str, old: str) -> Column:
        return F.when(~F.col(now).eqNullSafe(F.col(old)), F.col(now))

    return joined.select("sku", changed("allergens", "_a").alias("allergens"), changed("seals", "_s").alias("seals")).where(
        "allergens IS NOT NULL OR seals IS NOT NULL"
    )


def content_label(skus: DataFrame) -> DataFrame:
    """Pack content label: sizes below one in litres or kilograms are rescaled, then the first range wins."""
    size = F.round(F.col("multiplier") * F.col("content"), 2)
    small = size < 1
    unit = F.when((F.col("unit") == "L") & small, "ml").when((F.col("unit") == "Kg") & small, "g").otherwise(F.col("unit"))
    rows = skus.withColumns({"size": F.when(small, F.round(size * 1000)).otherwise(size).cast("double"), "unit": unit})
    ranges = F.array(*[
        F.struct(F.lit(name).alias("unit"), F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"), F.lit(text).alias("label"))
        for name, group in CONTENT_RANGES.items() for low, high, text in group
    ])
    hits = F.filter(ranges, lambda r: (r["unit"] == F.col("unit")) & F.col("size").between(r["low"], r["high"]))
    label = F.try_element_at(hits, F.lit(1))["label"]
    return rows.withColumn("label", label).where("label IS NOT NULL").select("sku", "size", "unit", "label")


def sku_categories(skus: DataFrame, categories: DataFrame) -> DataFrame:
    """SKUs with the category row of the last 18 characters of their material."""
    material = F.right(F.split_part("ref_id", F.lit("-"), F.lit(1)), F.lit(18))
    return skus.withColumn("material", material).join(categories, "material", "left")


def display_minima(rows: DataFrame) -> DataFrame:
    """Display minima with boolean flags and the piece unit normalised."""
    return rows.withColumns({
        "in_out": F.coalesce(F.col("in_out") == "X", F.lit(False)), "planned": F.coalesce(F.col("planned") == "1.0", F.lit(False)),
        "listed": F.coalesce(F.col("listed") == "1", F.lit(False)), "uom": F.when(F.col("uom") == "ST", "UN").otherwise(F.col("uom")),
    })
