"""Contribution margin, margin losses and cost facts."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date
from granero.functions.keys import WEIGHT_UNITS
from granero.functions.numbers import VAT, ratio
from granero.operators.joins import validity_join
from granero.plans.promotions import is_delivery
from granero.session import cut_lineage, drop_tables

OWN_CHANNEL = "70"  # fixed value: distribution channel of e-commerce promotions
DEEP_DISCOUNT = 0.34  # fixed value
GRAMS = Decimal("0.001")


def line_margins(
    orders: DataFrame, lines: DataFrame, weights: DataFrame, costs: DataFrame, packs: DataFrame,
    line_promotions: DataFrame, promotions: DataFrame,
) -> DataFrame:
    """Gross, net, cost, savings, negotiated funding and both margins per order line.

    Weighed lines are priced by their scale reading, substitutes at most at the price of the original line.
    A line's promotions are reduced per funding type, channel and delivery saving before they are added.
    ``packs`` has one row for each product. Unit costs, lines with theirs, amounts of original lines and promotions
    by line are written one after the other: what one of them shuffles is gone before the next one starts.
    """
    place = ["sku", "store_id", "day"]
    unit_cost = F.when(F.col("sold") == 0, 0).otherwise(F.round(F.col("cogs") / F.col("sold"))).cast("long") * F.col("pack")
    unit_costs = cut_lineage(costs.join(packs, "sku", "left").select(*place, unit_cost.alias("unit_cost")))
    weighed = F.col("unit").isin(*WEIGHT_UNITS) & (F.col("picked") != 0)
    sold = cut_lineage(
        lines.select("line_id", "order_id", "sku", "price", "picked", (F.col("asked") == 0).alias("substitute"), weighed.alias("_weighed"))
        .join(orders.select("order_id", "store_id", "day"), "order_id").join(unit_costs, place, "left").drop("store_id")
    )
    drop_tables(unit_costs)
    scale = weights.groupBy("line_id").agg(
        (F.sum("weight_g").cast("decimal(18,0)") * F.lit(GRAMS)).alias("_kg"), F.sum("price").alias("_scale_price")
    )
    originals = lines.select(
        F.col("line_id").alias("substitute_of"), (F.col("price") * F.col("asked")).alias("_original")
    )
    marks = lines.where("substitute_of IS NOT NULL").select("line_id", "substitute_of")
    original_amounts = cut_lineage(marks.join(originals, "substitute_of").select("line_id", "_original"))
    # Names stay behind, and one shuffle by line serves both aggregates.
    delivery = is_delivery(F.col("name"))
    savings = line_promotions.select(
        "line_id", "n_promo", "sku", F.when(delivery, F.col("value")).otherwise(0).alias("_delivery"),
        F.when(delivery, 0).otherwise(F.col("value")).alias("_saving"),
    )
    deals = savings.join(promotions, ["n_promo", "sku"], "left").select(
        "line_id", "_delivery", "_saving", "funding", "channel", "negotiated"
    ).repartition("line_id")
    own = F.coalesce(F.col("channel") == OWN_CHANNEL, F.lit(False))
    grouped = deals.groupBy("line_id", "_delivery", "funding", "channel").agg(
        F.min("_saving").alias("_saving"), F.min("negotiated").alias("_negotiated"),
        F.every(F.col("negotiated").isNotNull()).alias("_all"),
    )
    sell_out = F.col("funding") == "SELL OUT"
    per_line = cut_lineage(grouped.groupBy("line_id").agg(
        F.min("_delivery").alias("delivery_saving"), F.sum(F.when(own, 0).otherwise(F.col("_saving"))).alias("chain_saving"),
        F.sum(F.when(own, F.col("_saving")).otherwise(0)).alias("ecommerce_saving"), F.sum("_negotiated").alias("negotiated"),
        F.sum(F.when(sell_out & ~own, F.col("_negotiated")).otherwise(0)).alias("_chain"),
        F.sum(F.when(sell_out & own, F.col("_negotiated")).otherwise(0)).alias("_own"), F.bool_or("_all").alias("promoted"),
    ))
    joined = sold.join(original_amounts, "line_id", "left").join(scale, "line_id", "left").join(per_line, "line_id", "left")
    unit_price = F.coalesce("_scale_price", "price")
    full = F.col("price") * F.col("picked")
    gross = F.when(F.col("_weighed"), unit_price).otherwise(F.least(full, F.coalesce("_original", full)))
    priced = joined.withColumns({
        "units": F.coalesce("_kg", F.col("picked").cast("decimal(18,3)")), "unit_price": unit_price, "gross": gross,
        "net": F.round(gross / VAT).cast("long"),
    })
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("delivery_saving", "chain_saving", "ecommerce_saving")]
    units, cost = F.col("units"), F.coalesce("unit_cost", F.lit(0))
    first = F.col("net") - units * cost
    funded = units * F.coalesce("negotiated", F.lit(0))
    return priced.select(
        "line_id", "order_id", "sku", "day", "substitute", "units", "unit_price", "gross", "net", cost.alias("unit_cost"), *zero,
        (units * F.coalesce("_chain", F.lit(0))).alias("chain_funding"), (units * F.coalesce("_own", F.lit(0))).alias("ecommerce_funding"),
        first.alias("margin_1"), (first + funded).alias("margin_2"), F.coalesce("promoted", F.lit(False)).alias("promoted"),
    )


def fund_substitutes(margins: DataFrame, promotions: DataFrame, excluded_events: Sequence[int] = (102,)) -> DataFrame:
    """Second pass: unpromoted substitutes take the sell-out funding valid on their day.

    The margins, of which each line has one, are written once; only lines that can take funding are shuffled again.
    """
    margins = cut_lineage(margins)
    takes = F.coalesce(F.col("substitute") & ~F.col("promoted"), F.lit(False))
    open_lines = margins.where(takes)
    funding = promotions.where((F.col("funding") == "SELL OUT") & ~F.col("event").isin(*excluded_events)).select(
        "sku", "n_promo", F.col("negotiated").alias("_n"), "start_day", "end_day"
    )
    hits = validity_join(open_lines.select("line_id", "sku", "day"), funding, ["sku"], "day", "start_day", "end_day")
    per_line = hits.groupBy("line_id").agg(F.sum("_n").alias("_n"))
    added = F.coalesce("_n", F.lit(0)) * F.col("units")
    funded = open_lines.join(per_line, "line_id", "left")
    others = margins.where(~takes).withColumn("_n", F.lit(None).cast(per_line.schema["_n"].dataType))
    return funded.unionByName(others).withColumns({
        "late_funding": added, "margin_2": F.col("margin_2") + added,
    }).drop("_n")


def fill_zero_cost(margins: DataFrame, fallback: DataFrame) -> DataFrame:
    """Third pass: lines without cost take the material's fallback cost (prefix of the reference as equi key)."""
    joined = margins.join(fallback.select("sku", F.col("cost").alias("_cost")), "sku", "left")
    cost = F.when(F.col("unit_cost") == 0, F.col("_cost"))
    change = F.coalesce(cost, F.lit(0)) * F.col("units")
    return joined.withColumns({
        "unit_cost": F.coalesce(cost, "unit_cost"), "margin_1": F.round(F.col("margin_1") - change),
        "margin_2": F.round(F.col("margin_2") - change),
    }).drop("_cost")


def margin_losses(
    lines: DataFrame, orders: DataFrame, line_promotions: DataFrame, promotions: DataFrame,
    programmes: dict[str, Column], ignored: Sequence[str], as_of, days: int = 7,
) -> DataFrame:
    """Per day: discounts by programme, expired sell-out funding, substitution loss and net sales.

    ``programmes`` maps a report column to its condition on ``name`` and ``promo_id``.
    """
    recent = orders.where(F.col("day") >= F.date_sub(as_date(as_of), days)).select("order_id", "day")
    sold = lines.drop("day").join(recent, "order_id")
    deals = sold.drop("sku").join(line_promotions.where(~F.col("name").ilike("%despacho%")), "line_id")
    funded = promotions.select("n_promo", "sku", "end_day", "funding", "negotiated")
    deals = deals.join(funded, ["n_promo", "sku"], "left")
    named = reduce(lambda a, b: a | b, [F.col("name").ilike(p) for p in ignored], F.lit(False))
    in_programme = reduce(lambda a, b: a | b, programmes.values(), F.lit(False))
    expired = (
        (F.col("day") > F.col("end_day")) & ~F.col("funding").ilike("%SIN FINANCIAMIENTO%") & ~named & ~in_programme
    )
    gap = F.when(expired, -F.col("negotiated") * F.col("picked")).otherwise(0)
    discounts = deals.groupBy("day").agg(
        *[F.sum(F.when(c, F.col("value")).otherwise(0)).alias(n) for n, c in programmes.items()],
        F.coalesce(F.sum(gap), F.lit(0)).alias("sell_out_gap"),
    )
    original = sold.where("asked > 0 AND uom <> 'kg'").select(
        F.col("line_id").alias("substitute_of"), (F.col("list_price") * F.col("asked")).alias("_wanted")
    )
    swapped = sold.where("uom <> 'kg' AND substitute_of IS NOT NULL").join(original, "substitute_of")
    delta = F.col("list_price") * F.col("picked") - F.col("_wanted")
    loss = swapped.where(delta > 0).groupBy("day").agg((-F.sum(delta)).alias("substitution_loss"))
    picked = sold.where("picked IS NOT NULL")

    def net(price: str) -> Column:
        return F.floor(F.sum(F.coalesce("scale_price", F.col(price) * F.col("picked"))) / VAT)

    totals = picked.groupBy("day").agg(net("list_price").alias("net_undiscounted"), net("price").alias("net_sales"))
    return discounts.join(loss, "day", "left").join(totals, "day", "left").fillna(0, ["substitution_loss"])


def regular_sales(sales: DataFrame, lines: DataFrame, strict: bool = False) -> DataFrame:
    """Discount share and deep-promotion flag per sale line.

    Weighed units divide the sale price by the sold weight. ``strict`` reproduces the source rule that flags
    every weighed line as deep whatever its share.
    """
    per_line = lines.select("order_id", "sku", "list_price", "sale_price").distinct()
    joined = sales.join(per_line, ["order_id", "sku"])
    weighed = F.col("unit").isin(*WEIGHT_UNITS)
    paid = F.when(weighed, ratio(F.col("sale_price"), F.col("units"))).when(F.col("unit").isin("UN", "DIS"), F.col("sale_price").cast("double"))
    share = 1 - F.try_divide(paid, F.col("list_price").cast("double"))
    deep = F.coalesce(share >= DEEP_DISCOUNT, F.lit(False))
    if strict:
        deep = deep | (weighed & share.isNotNull())
    return joined.withColumns({"discount": share, "deep": deep})


def profit_and_loss(facts: DataFrame, products: DataFrame, other_stores: DataFrame, day) -> DataFrame:
    """Sales and cost of ``day`` with product attributes, without the stores of the other banner."""
    today = facts.where(F.col("day") == as_date(day)).join(other_stores, "store_id", "left_anti")
    return today.join(products, "sku", "left")


def cost_facts(facts: DataFrame, stores: DataFrame, skus: DataFrame) -> DataFrame:
    """Cost rows with the store code and SKU attributes of their surrogate keys."""
    return facts.join(stores, "store_key", "left").join(skus, "sku_key", "left").drop("store_key", "sku_key")


def cost_of_sales(sales: DataFrame, accounting: DataFrame, units: DataFrame) -> DataFrame:
    """Net sales, calculated cost and baskets per SKU, store and day.

    Accounting rows are reduced to their minimum per key; a zero base quantity costs nothing.
    """
    key = ["sku", "store_id", "day"]
    unit = accounting.groupBy(*key).agg(F.min("base_units").alias("base_units"), F.min("cost").alias("cost"))
    each = F.when(F.col("base_units") == 0, 0.0).otherwise(ratio(F.col("cost"), F.col("base_units")))
    sold = sales.groupBy(*key).agg(
        F.sum("net").alias("net"), F.sum("units").alias("units"), F.count_distinct("order_id").alias("baskets")
    )
    cost = each * ratio(F.col("numerator"), F.col("denominator")) * F.col("units")
    return sold.join(units, "sku").join(unit, key, "left").select(*key, "net", cost.alias("cost"), "baskets")
