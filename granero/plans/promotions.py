"""Promotions: live lists, encodings, alerts, limits and savings."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date
from granero.functions.keys import WEIGHT_UNITS, material_code, normal_unit
from granero.functions.numbers import ratio
from granero.operators.joins import validity_join
from granero.operators.merge import replace_where
from granero.operators.ranking import first_per_key, group_count, latest_per_key, top_k
from granero.sources.scans import validate

# Mechanics each report leaves out.
LIST_MECHANICS = (36, 67, 72, 99, 84, 37, 51, 93, 53, 96, 77, 59)
SUMMARY_MECHANICS = (124, 36, 67, 72, 99, 84, 37, 51, 93, 53, 96, 77, 59, 50)
DENSITY_MECHANICS = (36, 99, 84, 12, 37, 51, 93, 53, 96, 77, 59)
OFFER_MECHANICS = (25, 27, 36, 37, 50, 51, 53, 67, 72, 77, 93, 99, 123, 124)
SUPPLY_MECHANICS = (12, 22, 25, 27, 36, 50, 67, 72, 84, 99, 37, 51, 53, 59, 77, 82, 93, 96, 123)
# Name patterns of promotions each report leaves out, because they are local, a bank's or a clearance.
LIST_NAMES = ("%MFC%", "%BANCO ESTADO%", "%UNIPAY%", "%917%", "% LOC%")
LIMIT_NAMES = ("%MFC%", "%S06%", "%NO ELIMINAR%", "%UNIPAY%", "%917%", "%0743%", "% LOC%", "%L65%", "%L0089%")
SALES_NAMES = ("%MFC%", "%BANCO%", "%UNIPAY%", "%TERCERA%", "%917%", "%ESTADO%", "% LOC%", "%LIQ%")
OFFER_NAMES = ("%ZONA%", *SALES_NAMES, "%CYBER%")
MARKET_NAMES = (*OFFER_NAMES, "%REGIO%")
# Fixed value: a store's number in a promotion's name.
STORE_NAMED = "L(0[0-9]{2}|[1-9][0-9]{0,2})"
# The sales organisation and distribution channel of the shops.
ORGANISATION, CHANNEL = "1000", "10"
# Codes by mechanic, in the order they are tried around the name and event rules.
CODES_FIRST = {13: "C003", 10: "C004", 9: "C005", 30: "C008", 12: "C011", 8: "C015", 114: "C015", 117: "C015",
               43: "C017", 11: "C018"}
CODES_SECOND = {57: "C031", 7: "C064"}
CODES_LAST = {115: "C073"}
# Detail codes by units of a bundle, by percentage and by second-unit percentage.
BUNDLE_CODES = {2: "M001__", 3: "M002__", 4: "M003__", 5: "M004__", 6: "M005__", 7: "M006__", 8: "M007__",
                9: "M008__", 10: "M009__", 12: "M010__", 18: "M011__", 24: "M012__", 36: "M013__"}
PERCENT_CODES = {10: "M014__", 15: "M015__", 20: "M016__", 25: "M017__", 30: "M018__", 35: "M019__", 40: "M020__",
                 45: "M021__", 50: "M034__", 60: "___", 70: "___"}
PAY_FEWER_CODES = {2: "M022-1__", 3: "M023-1__"}
PAY_FEWER_PRICED = {4: "M003__", 5: "M004__", 6: "M005__"}
SECOND_UNIT_CODES = {50: "M025-1", 60: "M026-1", 70: "M027-1", 80: "M028-1", 90: "M029-1"}
# Events that always limit purchases, the limit itself and the code that lifts it.
LIMIT_EVENTS = (402, 565, 566, 553, 404)
LIMIT_CODE, NO_LIMIT_CODE = 48, 999
# Promotion types.
PERCENT, PAY_FEWER, FIXED, BUNDLE, SECOND_UNIT = 1, 2, 4, 7, 8


def _lookup(table: dict[int, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key.cast("int"))


@dataclass(frozen=True)
class Eligibility:
    """Which promotions a report takes: what it leaves out, and what a promotion must have.

    ``names`` are case-sensitive patterns, ``names_any_case`` are not, ``name_pattern`` is a regular expression.
    ``promotions`` are single promotion numbers, a matter of the shop.
    """

    mechanics: tuple[int, ...] = ()
    names: tuple[str, ...] = ()
    names_any_case: tuple[str, ...] = ()
    name_pattern: str | None = None
    promotions: tuple[int, ...] = ()
    types: tuple[int, ...] | None = None
    not_types: tuple[int, ...] = ()
    organisation: str | None = None
    channel: str | None = None
    valid: bool = False


def _as_expression(like: str) -> str:
    """A LIKE pattern as a regular expression to be found anywhere in a text."""
    inner = "".join({"%": "(?s:.*)", "_": "(?s:.)"}.get(c, re.escape(c)) for c in like.strip("%"))
    return ("" if like.startswith("%") else "\\A") + inner + ("" if like.endswith("%") else "\\z")


def _unwanted_names(rules: Eligibility) -> str | None:
    """All name rules as one expression, so that a computed name is evaluated and searched once for each row."""
    parts = [_as_expression(like) for like in rules.names]
    parts += [f"(?iu:{_as_expression(like)})" for like in rules.names_any_case]
    return "|".join([*parts, *([rules.name_pattern] if rules.name_pattern is not None else [])]) or None


def eligible(promotions: DataFrame, rules: Eligibility) -> DataFrame:
    """The promotions a report takes, by one filter: plain comparisons first, the name last."""
    wanted = [~F.col("mechanic").isin(*rules.mechanics)]
    if rules.valid:
        wanted.append(F.col("valid"))
    if rules.types is not None:
        wanted.append(F.col("type").isin(*rules.types))
    if rules.not_types:
        wanted.append(~F.col("type").isin(*rules.not_types))
    if rules.promotions:
        wanted.append(~F.col("n_promo").isin(*rules.promotions))
    if rules.organisation is not None:
        wanted.append(F.col("organisation") == rules.organisation)
    if rules.channel is not None:
        wanted.append(F.col("channel") == rules.channel)
    if (names := _unwanted_names(rules)) is not None:
        wanted.append(~F.col("name").rlike(names))
    return promotions.where(reduce(lambda a, b: a & b, wanted))


def live_promotions(promotions: DataFrame, day, rules: Eligibility = Eligibility(), ahead: int = 0, behind: int = 0) -> DataFrame:
    """Eligible promotions running on ``day``, also those starting ``ahead`` or ended ``behind`` days of it."""
    day = as_date(day)
    running = promotions.where((F.col("start_day") <= F.date_add(day, ahead)) & (F.col("end_day") >= F.date_sub(day, behind)))
    return eligible(running, rules)


LISTED = Eligibility(LIST_MECHANICS, LIST_NAMES, not_types=(3,))
LIMITED = Eligibility(LIST_MECHANICS, LIMIT_NAMES, not_types=(3,))
SOLD = Eligibility(OFFER_MECHANICS, SALES_NAMES, types=(PERCENT, FIXED), organisation=ORGANISATION, channel=CHANNEL, valid=True)
OFFERED = Eligibility(
    OFFER_MECHANICS, OFFER_NAMES, ("%REGIO%",), STORE_NAMED, types=(PERCENT, FIXED), organisation=ORGANISATION, channel=CHANNEL, valid=True
)
MARKETED = Eligibility(
    (*OFFER_MECHANICS, 84), names_any_case=MARKET_NAMES, types=(PERCENT, PAY_FEWER, FIXED, BUNDLE), organisation=ORGANISATION,
    channel=CHANNEL, valid=True,
)


def short_name(name: Column) -> Column:
    return F.regexp_replace(name, "[^a-zA-Z0-9]", "")


def identifier(mechanic_text: Column | None = None) -> Column:
    """Encoded promotion name: number, letters of the name, campaign code and mechanic detail."""
    mechanic, kind = F.col("mechanic"), F.col("type")
    text = F.lit("") if mechanic_text is None else F.coalesce(mechanic_text, F.lit(""))
    campaign = F.coalesce(
        _lookup(CODES_FIRST, mechanic), F.when(F.col("name").like("%CYBER%"), "C029"), _lookup(CODES_SECOND, mechanic),
        F.when(F.col("event") == 400, "C065"), F.when(text.like("%MARCAS PROPIAS%"), "C068"),
        F.when(text.like("%BLACK FRIDAYS%"), "C070"), _lookup(CODES_LAST, mechanic), F.lit("C011"),
    )
    price, weighed = F.col("promo_price").cast("string"), F.col("uom").isin(*WEIGHT_UNITS)
    detail = (
        F.when(kind == BUNDLE, F.concat(_lookup(BUNDLE_CODES, F.col("qty_n")), price))
        .when(kind == PERCENT, _lookup(PERCENT_CODES, F.col("pct")))
        .when(kind == FIXED, F.when(weighed, F.concat(F.lit("__"), F.round(F.col("promo_price") * F.col("multiplier")).cast("long").cast("string"))).otherwise("_XXXX_"))
        .when(kind == PAY_FEWER, F.concat("brand", F.coalesce(
            _lookup(PAY_FEWER_CODES, F.col("qty_n")), F.concat(_lookup(PAY_FEWER_PRICED, F.col("qty_n")), price))))
        .when((kind == SECOND_UNIT) & (F.col("take_n") == 2), _lookup(SECOND_UNIT_CODES, F.col("pct_n")))
        .otherwise("FALTA_COD_MEC")
    )
    return F.concat(F.col("n_promo"), F.lit(" "), short_name(F.col("name")), F.lit("_"), campaign, F.lit("_"), detail)


def mechanic_kind() -> Column:
    kind = F.col("type")
    return F.when(kind.isin(PERCENT, FIXED), "regular").when(kind.isin(SECOND_UNIT, BUNDLE, PAY_FEWER), "forThePriceOf").otherwise("error")


def promotion_list(promotions: DataFrame, assortment: DataFrame, day) -> DataFrame:
    """Live promotions of listed products with encoded name, mechanic kind and price text."""
    weighed = F.col("uom").isin(*WEIGHT_UNITS)
    price = (
        F.when((F.col("type") == FIXED) & ~weighed, "lista-precio")
        .when((F.col("type") == FIXED) & weighed, F.round(F.col("promo_price") * F.col("multiplier")).cast("long").cast("string"))
        .when(F.col("type").isin(PERCENT, PAY_FEWER, SECOND_UNIT), "0")
        .when(F.col("type") == BUNDLE, F.col("promo_price").cast("string")).otherwise("err")
    )
    live = live_promotions(promotions, day, LISTED, ahead=1)
    listed = live.withColumn("uom", normal_unit(F.col("uom"))).join(assortment, "sku", "left_semi")
    return listed.withColumns({"identifier": identifier(), "mechanic_kind": mechanic_kind(), "price": price}).distinct()


def final_discount() -> Column:
    """Discount in whole percent, by promotion type."""
    kind, modal = F.col("type"), F.col("modal_price")

    def off(price: Column) -> Column:
        return F.round((1 - price / modal) * 100)

    return (
        F.when((kind == PAY_FEWER) & (F.col("qty_n") > 0), F.round((1 - F.col("qty_m") / F.col("qty_n")) * 100))
        .when((kind == BUNDLE) & (F.col("qty_n") > 0) & (modal > 0), off(F.col("total_price") / F.col("qty_n")))
        .when(kind == SECOND_UNIT, F.round(F.col("pct_n") / 2)).when(kind == PERCENT, F.round("pct"))
        .when(modal > 0, off(F.col("promo_price"))).otherwise(0).cast("int")
    )


def promotion_summary(promotions: DataFrame, assortment: DataFrame, stores: DataFrame, day, names: Sequence[str]) -> DataFrame:
    """Live promotions with discount, number of active stores and published name."""
    offered = (
        assortment.join(stores.where("status = 1"), "store_id", "left_semi")
        .groupBy("sku").agg(F.count_distinct("store_id").alias("stores"))
    )
    live = live_promotions(promotions, day, Eligibility(SUMMARY_MECHANICS, tuple(names)), ahead=8)
    kept = live.where("modal_price > 0 AND promo_price IS NOT NULL AND type <> 3").join(offered, "sku").distinct()
    counted = group_count(kept, ["n_promo"], F.col("web_id"), "web_ids")
    kind, qty_n, brand = F.col("type"), F.col("qty_n").cast("string"), F.col("brand")
    weighed = F.col("uom").isin(*WEIGHT_UNITS)
    detail = (
        F.when(kind == BUNDLE, F.concat(brand, F.lit("_"), qty_n, F.lit("x"), F.col("total_price").cast("string"), F.lit("$")))
        .when(kind == PERCENT, F.concat(F.col("pct").cast("string"), F.lit("%")))
        .when(kind == FIXED, F.when(weighed, F.concat(F.lit("_PESABLE_"), F.round(F.col("promo_price") * F.col("multiplier")).cast("long").cast("string"))).otherwise("LISTA_PRECIOS"))
        .when(kind == PAY_FEWER, F.concat(brand, F.lit("_"), qty_n, F.lit("x"), F.col("qty_m").cast("string")))
        .when((kind == SECOND_UNIT) & (F.col("take_n") == 2), F.concat(brand, F.lit("_"), F.col("pct").cast("string"), F.lit("_2DA_UN")))
        .otherwise("FALTA_COD_MEC")
    )
    base = F.concat(F.col("n_promo"), F.lit(" "), short_name(F.col("name")), F.lit("_"), detail)
    suffix = F.when(mechanic_kind() != "forThePriceOf", "").when(F.col("web_ids") > 1, "_CLP1").otherwise("_CLP0")
    return counted.withColumns({
        "discount": final_discount(), "published_name": F.concat(base, suffix),
        "price_list": F.when((kind == FIXED) & ~weighed, short_name(F.col("name"))).otherwise("NO_APLICA"),
    })


def discount_alerts(summary: DataFrame, exceptions: DataFrame, above: int = 75) -> DataFrame:
    """Promotions over ``above`` percent that no exception names."""
    return summary.where(F.col("discount") > above).join(exceptions, ["sku", "name"], "left_anti")


def date_changes(versions: DataFrame, organisations: Sequence[str]) -> DataFrame:
    """Materials whose newest promotion version changed its dates against the previous one.

    Two versions per material are kept before the shuffle; a missing previous version is no change.
    """
    two = top_k(versions, ["sku"], [F.col("start_day").desc(), F.col("n_promo").desc()], 2)
    last, before = F.col("rank") == 1, F.col("rank") == 2

    def pick(when: Column, column: str) -> Column:
        return F.max(F.when(when, F.col(column)))

    pairs = two.groupBy("sku").agg(
        pick(last, "n_promo").alias("n_promo"), pick(last, "start_day").alias("start_day"),
        pick(last, "end_day").alias("end_day"), pick(before, "start_day").alias("previous_start"),
        pick(before, "end_day").alias("previous_end"), pick(last, "current").alias("current"),
        pick(last, "organisation").alias("organisation"),
    )
    changed = (F.col("start_day") != F.col("previous_start")) | (F.col("end_day") != F.col("previous_end"))
    return pairs.where(F.col("current") & changed & F.col("organisation").isin(*organisations)).drop("current", "organisation")


def purchase_limits(promotions: DataFrame, excluded: DataFrame, day, rules: Eligibility = LIMITED) -> DataFrame:
    """Limit code per SKU from its longest-running deep promotion; expired promotions lift the limit."""
    live = live_promotions(promotions, day, rules, ahead=1, behind=1)
    off = F.abs(F.col("promo_price") - F.col("modal_price"))
    deep = live.where(F.col("event").isin(*LIMIT_EVENTS) | (off >= 5000) | (F.col("pct") >= 25)).withColumn("off", off)
    longest = latest_per_key(deep.join(excluded, "sku", "left_anti"), ["sku"], "end_day", "n_promo")
    code = F.when(F.col("end_day") < as_date(day), NO_LIMIT_CODE).otherwise(LIMIT_CODE)
    return longest.select("sku", "n_promo", "off", "pct", "end_day", code.alias("limit_code"))


def unit_price() -> Column:
    """Effective price of one unit: strike price, bundle total / n, or m regular prices / n."""
    regular = F.when(F.col("regular_price") > 0, F.col("regular_price").cast("double")).otherwise(F.lit(9999999.0))
    strike = F.when((F.col("kind") == "strikethrough") & (F.col("strike_price") > 0), F.col("strike_price").cast("double"))
    bundle = F.when(
        (F.col("kind") == "bundle_price") & (F.col("qty_n") > 0) & (F.col("total_price") > 0),
        ratio(F.col("total_price"), F.col("qty_n")),
    )
    free = F.when(
        (F.col("kind") == "free_item") & (F.col("qty_n") > 0) & (F.col("regular_price") > 0),
        ratio(F.col("qty_m") * F.col("regular_price"), F.col("qty_n")),
    )
    return F.coalesce(strike, bundle, free, regular)


def best_promotion(offers: DataFrame, tie_breaker: str = "n_promo") -> DataFrame:
    """The promotion with the lowest effective unit price per SKU, over all bundle sizes in one pass."""
    priced = offers.withColumn("unit_price", unit_price())
    return first_per_key(priced, ["sku"], [F.col("unit_price").asc(), F.col(tie_breaker).asc()])


def encode_promotions(promotions: DataFrame) -> DataFrame:
    """Validate multi-buy promotions and encode them as ``L{n}_P{m}`` or ``N{n}_M{price}``.

    Rows keep their ``reject_reason`` (NULL when valid), so the caller splits valid from rejected.
    """
    kind = F.upper(F.trim(F.coalesce("kind", F.lit(""))))
    n, m, price = F.col("qty_n"), F.col("qty_m"), F.col("total_price")
    is_m, is_price = kind == "COMBINACION NXM", kind == "COMBINACION NX$"

    def blank(name: str) -> Column:
        return F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")

    def not_positive_whole(value: Column) -> Column:
        return value.isNull() | (value <= 0) | (value != F.floor(value))

    rules = {
        "missing store": blank("store_id"), "missing product": blank("sku"), "missing name": blank("name"),
        "missing type": blank("kind"), "unsupported type": ~(is_m | is_price),
        "missing dates": F.col("start_day").isNull() | F.col("end_day").isNull(),
        "ends before start": F.col("end_day") < F.col("start_day"), "bad quantity": not_positive_whole(n),
        "bad paid quantity": is_m & not_positive_whole(m), "buys one": is_m & (n <= 1),
        "pays all": is_m & (m >= n), "bad price": is_price & not_positive_whole(price),
        "bundle of one": is_price & (n <= 1),
    }
    whole = [F.floor(c).cast("long").cast("string") for c in (n, m, price)]
    dotted = F.regexp_replace(F.format_number(F.floor(price), 0), ",", ".")
    checked = validate(promotions, rules)
    return checked.withColumns({
        "type_format": F.when(is_m, F.concat(F.lit("L"), whole[0], F.lit("_P"), whole[1]))
        .when(is_price, F.concat(F.lit("N"), whole[0], F.lit("_M"), whole[2])),
        "description": F.when(is_m, F.concat(F.lit("Compra "), whole[0], F.lit(" y paga "), whole[1]))
        .when(is_price, F.concat(whole[0], F.lit(" unidades por $"), dotted)),
    })


def cheapest_per_store(promotions: DataFrame, keys: Sequence[str] = ("sku", "store_id")) -> DataFrame:
    return first_per_key(promotions, list(keys), [F.col("promo_price").asc(), F.col("n_promo").asc()])


def promotional_sales(promotions: DataFrame, sales: DataFrame, day, days: int = 30, rules: Eligibility = SOLD) -> DataFrame:
    """Units sold per SKU-store inside each finished promotion window, rounded up per window and added up."""
    day = as_date(day)
    finished = eligible(promotions.where((F.col("end_day") <= day) & (F.col("start_day") >= F.date_sub(day, days))), rules)
    windows = finished.select("sku", "start_day", "end_day").distinct()
    hits = validity_join(sales.where("units >= 0"), windows, ["sku"], "day", "start_day", "end_day")
    per_window = hits.groupBy("sku", "store_id", "start_day", "end_day").agg(F.ceil(F.sum("units")).alias("units"))
    return per_window.groupBy("sku", "store_id").agg(F.sum("units").alias("units"))


def clean_promotions(raw: DataFrame) -> DataFrame:
    """Percentages to fractions, X to true, padded material, merged financing types."""
    return raw.withColumns({
        "pct_final": F.col("pct_final") / 100, "pct_financing": F.col("pct_financing") / 100,
        "valid": F.coalesce(F.col("valid") == "X", F.lit(False)), "material": material_code(F.col("material")),
        "funding": F.when(F.col("funding") == "SELL IN/SELL OUT", "SELL OUT").otherwise(F.col("funding")),
    })


def load_promotions(current: DataFrame, incoming: DataFrame, day, days: int = 7) -> DataFrame:
    """Replace promotions that end within the last ``days`` days or later, then append the incoming ones."""
    return replace_where(current, incoming, F.col("end_day") >= F.date_sub(as_date(day), days))


def membership_change(promotions: DataFrame, today, yesterday, pattern: str = "%MEMB%") -> DataFrame:
    """SKUs in today's membership promotions, and those dropped since yesterday."""
    members = promotions.where(F.col("name").like(pattern))
    now = live_promotions(members, today).select("sku").distinct().withColumn("_now", F.lit(True))
    before = live_promotions(members, yesterday).select("sku").distinct().withColumn("_before", F.lit(True))
    both = now.join(before, "sku", "full")
    return both.select("sku", F.when(F.col("_now"), "today").otherwise("dropped").alias("status"))


def marketplace_promotions(
    promotions: DataFrame, listed: DataFrame, products: DataFrame, day, hidden: Sequence[str] = (), max_units: int = 10,
    rules: Eligibility = MARKETED,
) -> DataFrame:
    """Live promotions with pack label for each marketplace store that lists the SKU, cheapest per SKU.

    The cheapest promotion is chosen before the stores are joined: it does not depend on the store. Products of
    ``hidden`` categories are left out, products without a category stay.
    """
    shown = products.where(F.col("category").isin(*hidden)).select("sku")
    live = live_promotions(promotions, day, rules).join(shown, "sku", "left_anti")
    best = first_per_key(
        live.where(F.col("qty_n") < max_units), ["sku"], [F.col("promo_price").asc(), F.col("n_promo").asc()]
    )
    kind = F.when(F.col("type").isin(PERCENT, FIXED), "descuento").otherwise("pack")
    label = (
        F.when(F.col("type") == PAY_FEWER, F.concat("qty_n", F.lit("x"), "qty_m"))
        .when(F.col("type") == BUNDLE, F.concat("qty_n", F.lit("x"))).otherwise("null")
    )
    named = best.withColumns({"kind": kind, "combination": label, "uom": normal_unit(F.col("uom"))})
    return named.join(listed.select("sku", "store_id").distinct(), "sku")


def fixed_price_removals(promotions: DataFrame, published: DataFrame, day) -> DataFrame:
    """Published SKUs of live single-price promotions, with the price table the promotion named."""
    live = live_promotions(promotions, day, Eligibility(types=(FIXED,))).where(F.col("channel").isin("10", "70"))
    rows = live.select(
        "sku", normal_unit(F.col("uom")).alias("uom"), F.translate("name", " ,.", "").alias("price_table")
    ).distinct()
    return rows.join(published.select("sku", "web_id"), "sku")


# Patterns of promotion names that save on delivery instead of the product.
DELIVERY_NAMES = ("%despac%", "%flet%")


def is_delivery(name: Column) -> Column:
    return reduce(lambda a, b: a | b, [name.ilike(p) for p in DELIVERY_NAMES])


def savings_detail(
    lines: DataFrame, orders: DataFrame, line_promotions: DataFrame, order_names: Sequence[str], ticket_names: Sequence[str],
) -> DataFrame:
    """Per line and promotion, the saving split into product, delivery and order parts by promotion name.

    Names of promotions on the order and on the whole ticket belong to the shop. Lines without a promotion stay,
    with NULL for the promotion and 0 for the savings.
    """
    name, value = F.col("name"), F.col("value")
    product = F.when(~name.isin(*ticket_names) & ~is_delivery(name), value).otherwise(0)
    buyers = orders.select("order_id", "store_id", "customer_id")
    joined = lines.drop("store_id").join(buyers, "order_id", "left").join(line_promotions, "line_id", "left")
    return joined.select(
        "order_id", "line_id", "store_id", "customer_id", "name", "value",
        (F.col("price") * F.col("asked")).alias("gross"), product.alias("product_saving"),
        F.when(is_delivery(name), value).otherwise(0).alias("delivery_saving"),
        F.when(name.isin(*order_names), value).otherwise(0).alias("order_saving"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("promo_ref"),
    )
