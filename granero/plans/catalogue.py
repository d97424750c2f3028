"""Catalogue publication: snapshots, funnels, change detection and upload sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date
from granero.functions.numbers import count_when, is_true
from granero.operators.joins import expand_days
from granero.operators.ranking import first_per_key, top_k
from granero.operators.sets import common_members, packed_list, tagged_difference
from granero.session import cut_lineage

# Category names that never publish, and image names of a missing photo.
HIDDEN_CATEGORIES = ("No trabajar", "No Trabajar", "Inactivos", "Integración")
PLACEHOLDER_IMAGES = ("%foto-en%", "%foto-pendiente%")


def _member(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    return df.select(*keys).distinct().withColumn(flag, F.lit(True))


def _known(flag: str) -> Column:
    return F.coalesce(F.col(flag), F.lit(False))


def publication_snapshot(
    stock: DataFrame, images: DataFrame, products: DataFrame, product_stores: DataFrame, prices: DataFrame,
    must_have: DataFrame, top: DataFrame, placeholders: Sequence[str] = PLACEHOLDER_IMAGES,
) -> DataFrame:
    """One row per SKU-store with the five validity flags and whether it is published and sellable.

    ``products`` carries ``category``, ``category_active`` and ``brand``. Every side is reduced to its key
    first, so no join multiplies stock rows.
    """
    pending = F.bool_or(F.expr(" OR ".join(f"image ILIKE '{p}'" for p in placeholders)))
    photos = images.groupBy("sku").agg(F.count("*").alias("photos"), pending.alias("photo_pending"))
    pair = ["sku", "store_id"]
    joined = (
        stock.join(_member(product_stores, pair, "store_valid"), pair, "left")
        .join(_member(prices, pair, "price_valid"), pair, "left")
        .join(photos, "sku", "left").join(products, "sku", "left")
        .join(_member(must_have, ["sku"], "must_have"), "sku", "left")
        .join(_member(top, ["sku"], "top_seller"), "sku", "left")
    )
    flagged = joined.withColumns({
        "photo_valid": F.col("photos").isNotNull(),
        "category_valid": _known("category_active"),
        "stock_valid": F.coalesce(F.col("available") > 0, F.lit(False)) | is_true(F.col("unlimited")),
        "price_valid": _known("price_valid"), "store_valid": _known("store_valid"),
        "must_have": _known("must_have"), "top_seller": _known("top_seller"),
    })
    published = F.col("photo_valid") & F.col("category_valid") & F.col("store_valid")
    return flagged.withColumns({"published": published, "sellable": published & F.col("stock_valid")})


def publication_funnel(
    snapshot: DataFrame, assortment: DataFrame, by: Sequence[str], scope: Column | None = None
) -> DataFrame:
    """Eight counters per group over the listed, unblocked assortment.

    ``scope`` narrows the variant (must-have, top sellers); event or supplier variants join their columns
    to ``snapshot`` first and name them in ``by``.
    """
    open_items = assortment.where("blocked_store IS NULL AND blocked_format IS NULL AND listed").select(
        "sku", "store_id"
    )
    in_scope = snapshot.where(is_true(F.col("ecommerce")))
    if scope is not None:
        in_scope = in_scope.where(scope)
    return in_scope.join(open_items, ["sku", "store_id"]).groupBy(*by).agg(
        F.count("*").alias("assortment"), count_when(F.col("published")).alias("published"),
        count_when(F.col("sellable")).alias("sellable"),
        count_when(F.coalesce("stock", F.lit(0)) > 0).alias("with_stock"),
        count_when(F.col("stock_valid")).alias("with_visible_stock"), count_when(F.col("photo_valid")).alias("with_photo"),
        count_when(F.col("category_valid")).alias("with_category"), count_when(F.col("store_valid")).alias("with_store"),
    )


def publication_funnels(
    snapshot: DataFrame, assortment: DataFrame, variants: dict[str, tuple[Sequence[str], Column | None]]
) -> dict[str, DataFrame]:
    """Several funnels of one snapshot, which is written once and read by each of them."""
    stored = cut_lineage(snapshot)
    return {name: publication_funnel(stored, assortment, by, scope) for name, (by, scope) in variants.items()}


def catalogue_summary(funnel: DataFrame, at: Column, day) -> DataFrame:
    """Store totals of the noon snapshot of ``day``."""
    noon = F.timestamp_add("HOUR", F.lit(12), as_date(day).cast("timestamp"))
    return (
        funnel.where(at == noon).groupBy(at.cast("date").alias("day"), "store_id")
        .agg(*[F.sum(c).alias(c) for c in ("assortment", "published", "sellable")])
    )


def top_store_stock(stock: DataFrame, lines: DataFrame, orders: DataFrame, calendar: DataFrame, k: int = 300) -> DataFrame:
    """Stock rows of each store's ``k`` best sellers by created sales of the last relative week."""
    week = calendar.where("relative_week = -1").select("day")
    created = orders.join(week, "day", "left_semi").select("order_id", "store_id")
    sold = (
        lines.drop("store_id").join(created, "order_id").groupBy("store_id", "sku")
        .agg(F.sum(F.col("price") * F.col("asked")).alias("created_gross"))
    )
    best = top_k(sold, ["store_id"], [F.col("created_gross").desc(), F.col("sku").asc()], k)
    return stock.join(best.select("store_id", "sku"), ["store_id", "sku"], "left_semi")


def detect_changes(catalogue: DataFrame, image: DataFrame, keys: Sequence[str] = ("sku",)) -> DataFrame:
    """Rows of the catalogue that differ from the published image: new, changed, deactivated, reactivated.

    ``keys`` say what is published as one: a product, or a product in a store.
    """
    now = catalogue.groupBy(*keys).agg(
        F.max(F.coalesce("stock", F.lit(0))).alias("now_stock"),
        F.bool_or(F.coalesce("not_found", F.lit(False))).alias("now_missing"), F.lit(True).alias("listed"),
    )
    both = now.join(image, list(keys), "full")
    listed, active = F.col("listed").isNotNull(), F.col("active")
    differs = ~F.col("now_stock").eqNullSafe(F.col("stock")) | ~F.col("now_missing").eqNullSafe(F.col("not_found"))
    change = (
        F.when(F.col("stock").isNull(), "new")
        .when(listed & active & differs, "changed")
        .when(~listed & F.coalesce(active, F.lit(True)), "deactivated")
        .when(listed & ~active, "reactivated")
    )
    return both.select(
        *keys, change.alias("change"), listed.alias("active"),
        F.coalesce("now_stock", F.lit(0)).alias("stock"), F.coalesce("now_missing", F.lit(False)).alias("not_found"),
    ).where("change IS NOT NULL")


def apply_changes(image: DataFrame, changes: DataFrame, keys: Sequence[str] = ("sku",)) -> DataFrame:
    """The next image: changed rows win and wait for publication again."""
    pending = changes.select(*keys, "stock", "active", "not_found", F.lit(False).alias("published"))
    kept = image.join(pending.select(*keys), list(keys), "left_anti")
    return kept.select(*keys, "stock", "active", "not_found", "published").unionByName(pending)


def upload_set(
    assortment: DataFrame, published: DataFrame, valid: DataFrame, active_stores: DataFrame, exclusions: DataFrame,
    parking_store: str,
) -> DataFrame:
    """Load file from the difference between wanted and published (SKU, store) pairs.

    SKUs with a changed pair are sent with their full store list, minus store-level exclusions; SKUs without
    any wanted store are deactivated and parked. Store lists are bounded by the number of stores.
    """
    wanted = assortment.join(active_stores, "store_id", "left_semi").join(valid, "sku", "left_semi").select("sku", "store_id")
    present = published.join(active_stores, "store_id", "left_semi").select("sku", "store_id")
    changed = tagged_difference(present, wanted, ["sku", "store_id"]).select("sku").distinct()
    listed = (
        wanted.join(changed, "sku", "left_semi").join(exclusions, ["sku", "store_id"], "left_anti")
        .groupBy("sku").agg(packed_list(F.col("store_id")).alias("stores"))
    )
    gone = present.select("sku").distinct().join(wanted, "sku", "left_anti")
    return _load_rows(listed, True).unionByName(_load_rows(gone.withColumn("stores", F.lit(parking_store)), False))


def _load_rows(df: DataFrame, active: bool) -> DataFrame:
    flag = F.lit(int(active))
    return df.select("sku", "stores", flag.alias("visible"), flag.alias("active"))


def reconcile_catalogue(
    assortment: DataFrame, known: DataFrame, invalid: DataFrame, active_stores: DataFrame, parking_store: str
) -> DataFrame:
    """Every known SKU: active with its sorted store list, or inactive in the parking store."""
    allowed = assortment.where(~F.coalesce("excluded", F.lit(False))).join(active_stores, "store_id", "left_semi")
    lists = allowed.groupBy("sku").agg(packed_list(F.col("store_id")).alias("stores"))
    every = known.select("sku").distinct().join(invalid, "sku", "left_anti").join(lists, "sku", "left")
    active = F.col("stores").isNotNull().cast("int")
    return every.select(
        "sku", F.coalesce("stores", F.lit(parking_store)).alias("stores"), active.alias("visible"), active.alias("active")
    )


def removed_since(yesterday: DataFrame, today: DataFrame, keys: Sequence[str] = ("store_id", "sku")) -> DataFrame:
    """Rows only yesterday's files had. Stores without a file today are left alone."""
    stores = today.select("store_id").distinct()
    return yesterday.join(stores, "store_id", "left_semi").join(today.select(*keys), list(keys), "left_anti")


def bundle_stores(components: DataFrame, offers: DataFrame) -> DataFrame:
    """Stores that carry every component of a bundle, as a sorted list."""
    pairs = components.join(offers.select("sku", "store_id").distinct(), "sku", "left")
    common = common_members(pairs, "bundle", "sku", "store_id").where(F.col("store_id").isNotNull())
    return common.groupBy("bundle").agg(packed_list(F.col("store_id")).alias("stores"))


def bundle_prices(components: DataFrame, prices: DataFrame) -> DataFrame:
    """Base and list price of a bundle: sum of component price x quantity x multiplier.

    A bundle with an unpriced component has no base price; one missing list price voids the list price.
    """
    joined = components.join(prices, "sku", "left")
    amount = F.col("quantity") * F.col("multiplier")

    def total(price: str) -> Column:
        return F.when(F.count("*") == F.count(price), F.sum(F.col(price) * amount))

    return joined.groupBy("bundle").agg(total("base").alias("base"), total("list").alias("list"))


def returnable_residual(bundles: DataFrame, components: DataFrame, prices: DataFrame) -> DataFrame:
    """Price left for the drink after its container; bundles must hold exactly the drink and one container."""
    kit = components.groupBy("bundle").agg(F.count("*").alias("parts"))
    others = components.select("bundle", F.col("sku").alias("container"))
    base = prices.select("sku", "base")
    whole = base.withColumnRenamed("sku", "original").withColumnRenamed("base", "whole")
    empty = base.withColumnRenamed("sku", "container").withColumnRenamed("base", "container_price")
    holds = components.select("bundle", F.col("sku").alias("original"))
    return (
        bundles.join(kit.where("parts = 2"), "bundle").join(holds, ["bundle", "original"], "left_semi")
        .join(others, "bundle").where("container <> original").join(whole, "original").join(empty, "container")
        .withColumn("residual", F.col("whole") - F.col("container_price")).where("residual >= 0")
        .select("bundle", "original", "container", "residual")
    )


def store_channels(load: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per SKU and store of a packed list, with the store's sales channel."""
    rows = load.select("sku", F.explode(F.split("stores", ",")).alias("store_id"))
    return rows.join(stores.select(F.col("store_id").cast("string").alias("store_id"), "channel"), "store_id", "left")


def complete_set(requested: DataFrame, feed: DataFrame) -> DataFrame:
    """Requested SKUs missing from the feed become stock 0 and not found; duplicates keep the first."""
    found = feed.select("sku", "stock", F.lit(False).alias("not_found"))
    missing = requested.select("sku").join(feed, "sku", "left_anti").distinct().select(
        "sku", F.lit(0).cast("long").alias("stock"), F.lit(True).alias("not_found")
    )
    return first_per_key(found.unionByName(missing), ["sku"], [F.col("not_found").asc(), F.col("stock").asc()])


def active_catalogue(assortment: DataFrame, products: DataFrame, hidden: Sequence[str] = HIDDEN_CATEGORIES) -> DataFrame:
    """Listed products with a web id, and whether their top category may be shown."""
    listed = products.where(F.col("web_id").isNotNull()).join(assortment, "sku", "left_semi")
    valid = F.coalesce(~F.col("category").isin(*hidden), F.lit(False))
    return listed.select("sku", "web_id", "name", "category", valid.alias("category_valid"))


def delist_missing(today: DataFrame, yesterday: DataFrame) -> DataFrame:
    """Add yesterday's active feed rows that are absent today, as inactive."""
    gone = yesterday.where("active = 1").join(today, "sku", "left_anti").withColumn("active", F.lit(0))
    return today.unionByName(gone.select(*today.columns))


def stock_breaks(archive: DataFrame, live: DataFrame, as_of, live_days: int = 15, archive_days: int = 45) -> DataFrame:
    """Rows without backend stock: archived snapshots up to the live horizon, live rows after it."""
    day = as_date(as_of)
    edge = F.date_sub(day, live_days)
    old = archive.where(F.col("day").between(F.date_sub(edge, archive_days), edge))
    recent = live.where(F.col("day") > edge)
    return old.unionByName(recent).where(F.col("stock").isNull())


def substitutable_moves(
    assortment: DataFrame, products: DataFrame, substitute_category: str, fixed_category: str
) -> DataFrame:
    """Products to move into the substitute category (all stores say so) or out of it (some store does not)."""
    votes = assortment.groupBy("sku").agg(F.bool_and("substitute").alias("everywhere"))
    category = F.coalesce("category", F.lit(""))
    move = (
        F.when(F.col("everywhere") & ~category.isin(substitute_category, fixed_category), "in")
        .when(~F.col("everywhere") & (category == substitute_category), "out")
    )
    return products.join(votes, "sku").select("sku", "name", move.alias("move")).where("move IS NOT NULL")


def seller_conflicts(assortment: DataFrame, sellers: DataFrame, own_seller: int = 1) -> DataFrame:
    """Listed rows whose base material another seller offers too."""
    foreign = sellers.where(F.col("seller") != own_seller).select("sku").distinct()
    return assortment.join(foreign, "sku", "left_semi")


def promotion_days(promotions: DataFrame, first, days: int = 21, excluded: Sequence[int] = ()) -> DataFrame:
    """Active promotions per day, mechanic and channel. Intervals are clipped to the horizon, then exploded."""
    start, last = as_date(first), F.date_add(as_date(first), days)
    live = promotions.where((F.col("start_day") <= last) & (F.col("end_day") >= start) & ~F.col("mechanic").isin(*excluded))
    spread = expand_days(live, F.greatest("start_day", start), F.least("end_day", last))
    return spread.groupBy("day", "mechanic", "channel").agg(F.count("sku").alias("promotions"))
