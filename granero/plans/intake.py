"""Order, line, payment, ticket and sales models built from landed rows and documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.functions.dates import epoch_local
from granero.functions.numbers import net_of_vat
from granero.operators.merge import merge_upsert

# Order fields kept from the side table, and app names.
ORDER_FIELDS = ("sourceApp", "clientLevel", "wantBags", "giftcardType")
APPS = ("Android", "iOS", "1")
MONEY = ("created", "discount", "changes", "invoiced", "shipping")


def build_orders(raw: DataFrame, fields: DataFrame, marketing: DataFrame, excluded_stores: Sequence[int] = ()) -> DataFrame:
    """Order rows with local times, net amounts, sales channel and the pivoted side-table fields."""
    pivoted = fields.groupBy("order_id").pivot("field", list(ORDER_FIELDS)).agg(F.max("value"))
    joined = raw.where(~F.col("store_id").isin(*excluded_stores)).join(pivoted, "order_id", "left").join(marketing, "order_id", "left")
    operator = F.coalesce("call_center_operator", F.lit(0))
    channel = F.when(F.col("sourceApp").isin(*APPS), "app").when(operator == 0, "sitio").otherwise("callcenter")
    net = {f"net_{m}": F.coalesce(net_of_vat(F.col(f"gross_{m}")), F.lit(0)) for m in MONEY if f"gross_{m}" in raw.columns}
    return joined.withColumns({
        **net, "created_at": epoch_local(F.col("created_unix")), "picked_at": epoch_local(F.col("picked_unix")),
        "invoiced_on": F.timestamp_seconds("invoiced_unix").cast("date"), "picker": F.col("picker").try_cast("long"),
        "channel": channel, "client_level": F.coalesce("clientLevel", F.lit("")),
        "wants_bags": F.coalesce(F.col("wantBags") == "si", F.lit(False)), "gift_card": F.coalesce("giftcardType", F.lit("NA")),
    }).drop(*ORDER_FIELDS, "created_unix", "picked_unix", "invoiced_unix", "call_center_operator")


def build_lines(raw: DataFrame, changed_orders: DataFrame) -> DataFrame:
    """Typed lines of the changed orders, keyed by the order's own id."""
    numbers = {c: F.col(c).try_cast("long") for c in ("picker", "asked", "picked", "substitute_of") if c in raw.columns}
    return raw.join(changed_orders.select("source_id", "order_id"), "source_id").withColumns(numbers).drop("source_id")


def status_changes(raw: DataFrame) -> DataFrame:
    """Typed changes with the old and new store read from the JSON text; broken JSON gives NULL."""
    return raw.withColumns({
        "created": F.timestamp_seconds("created_unix"), "old_store": F.get_json_object("extra", "$.old_store"),
        "new_store": F.get_json_object("extra", "$.new_store"),
    })


MARKET_ORDER = (
    "id STRING, pack_id STRING, date_created STRING, last_updated STRING, status STRING, cancel_detail STRUCT<date: STRING>, "
    "order_items ARRAY<STRUCT<item: STRUCT<id: STRING, seller_sku: STRING, title: STRING, category_id: STRING>, "
    "full_unit_price: DOUBLE, unit_price: DOUBLE, sale_fee: DOUBLE, quantity: LONG, requested_quantity: STRUCT<value: LONG>>>"
)


def flatten_market_orders(documents: DataFrame) -> DataFrame:
    """One row per marketplace order from its first item; orders without items are dropped."""
    first = F.try_element_at("order_items", F.lit(1))
    return documents.withColumn("_item", first).select(
        F.col("id").alias("order_id"), "pack_id", F.col("_item.item.seller_sku").alias("sku"),
        F.col("_item.item.id").alias("market_product"), F.col("_item.item.title").alias("description"),
        F.col("_item.full_unit_price").alias("list_price"), F.col("_item.unit_price").alias("sale_price"),
        F.col("_item.sale_fee").alias("fee"), F.col("_item.requested_quantity.value").alias("asked"),
        F.col("_item.quantity").alias("picked"), F.col("_item.item.category_id").alias("market_category"),
        "date_created", "last_updated", F.col("cancel_detail.date").alias("cancelled"), "status",
    ).where(F.col("market_product").isNotNull())


# Ticket states by source name, and the events that close a ticket.
TICKET_STATES = {"solved": "Solved", "closed": "Closed", "hold": "Hold", "pending": "Pending", "open": "Open"}
CLOSING, REOPENABLE = ("solved", "closed"), ("open", "new", "hold", "pending")


def _field(field_id: int) -> Column:
    """Value of one entry of the custom-field array."""
    hits = F.filter("custom_fields", lambda f: f["id"] == field_id)
    return F.try_element_at(F.transform(hits, lambda f: f["value"]), F.lit(1))


def build_tickets(tickets: DataFrame, fields: dict[str, int]) -> DataFrame:
    """Ticket rows: custom fields as columns, resolution times, merge parents and children, and resolver.

    ``tickets`` carries ``metrics`` and ``audits`` beside the document. The resolver is the author of the last
    audit that closed an open ticket.
    """
    state = reduce(lambda acc, kv: F.when(F.col("status") == kv[0], kv[1]).otherwise(acc), TICKET_STATES.items(), F.lit("New"))
    closed = F.col("status").isin(*CLOSING)

    def closes(audit: Column) -> Column:
        return F.exists(audit["events"], lambda e: (
            (e["type"] == "Change") & (e["field_name"] == "status") & e["value"].isin(*CLOSING) & e["previous_value"].isin(*REOPENABLE)
        ))

    closers = F.filter("audits", lambda a: F.coalesce(closes(a), F.lit(False)))
    merges = F.filter("audits", lambda a: F.coalesce(a["rel"] == "merge", F.lit(False)))
    parents = F.array_compact(F.array_distinct(F.transform(merges, lambda a: a["merged_ticket"].cast("string"))))
    children = F.array_distinct(F.flatten(F.transform(merges, lambda a: F.coalesce(a["merged_children"], F.array().cast("array<bigint>")))))
    return tickets.select(
        F.col("id").alias("ticket"), state.alias("state"), "created_at", "updated_at",
        *[_field(number).alias(name) for name, number in fields.items()],
        F.array_contains("tags", "closed_by_merge").alias("closed_by_merge"),
        F.when(closed, F.col("metrics.solved_at")).alias("closed_at"),
        F.when(closed, F.round(F.col("metrics.resolution_minutes") / 1440, 2)).alias("resolution_days"),
        F.when(closed, F.round(F.col("metrics.first_reply_minutes") / 60, 2)).alias("first_reply_hours"),
        F.array_join(F.array_sort(parents), ",").alias("merged_into"),
        F.array_join(F.array_sort(children.cast("array<string>")), ",").alias("merged_from"),
        F.try_element_at(F.transform(closers, lambda a: a["author_id"]), F.lit(-1)).alias("resolver"),
    )


def _labelled(rows: DataFrame, field: Column, code: Column, options: DataFrame, name: str) -> DataFrame:
    """Add ``name``: the label of a field's code, NULL where the field has no such option."""
    keyed = rows.withColumns({"_f": field.cast("long"), "_c": code})
    labels = options.select(F.col("field_id").cast("long").alias("_f"), F.col("code").alias("_c"), F.col("label").alias(name))
    return keyed.join(labels, ["_f", "_c"], "left").drop("_f", "_c")


def ticket_taxonomy(tickets: DataFrame, motive_field: int, options: DataFrame, children: DataFrame, levels: int = 3) -> DataFrame:
    """Motive and types of each ticket as labels: a motive's code names the field that holds type 1, and so on down.

    ``options`` has (field_id, code, label), ``children`` (field_id, code, child_field): the landed field definitions.
    """
    rows = tickets.select(F.col("id").alias("ticket"), "custom_fields").withColumns(
        {"_field": F.lit(motive_field).cast("long"), "_code": _field(motive_field)}
    )
    names = ["motive", *(f"type_{k}" for k in range(1, levels + 1))]
    links = children.select(F.col("field_id").cast("long").alias("_field"), F.col("code").alias("_code"), F.col("child_field").cast("long").alias("_child"))
    for name in names:
        rows = _labelled(rows, F.col("_field"), F.col("_code"), options, name)
        rows = rows.join(links, ["_field", "_code"], "left").withColumn("_field", F.col("_child")).drop("_child")
        held = F.filter("custom_fields", lambda f: f["id"].cast("long") == F.col("_field"))
        rows = rows.withColumn("_code", F.try_element_at(F.transform(held, lambda f: f["value"]), F.lit(1)))
    return rows.select("ticket", *names)


def requester_roles(tickets: DataFrame, users: DataFrame) -> DataFrame:
    """Role of the requester, looked up for closed and solved tickets only."""
    asked = tickets.select(F.col("id").alias("ticket"), F.when(F.col("status").isin(*CLOSING), F.col("requester_id")).alias("user_id"))
    return asked.join(users.select("user_id", "role"), "user_id", "left").select("ticket", "role")


def normalise_payments(documents: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Payments with numeric order numbers, typed columns, and NULL for columns a feed does not have."""
    numeric = documents.where(F.col("order_number").rlike("^[0-9]+$"))
    shaped = [
        (F.col(name).try_cast(kind) if name in documents.columns else F.lit(None).cast(kind)).alias(name)
        for name, kind in columns.items()
    ]
    return numeric.select(*shaped)


def sales_facts(raw: DataFrame) -> DataFrame:
    """E-commerce sale lines: composite id, normal unit, clean order number, blanks as NULL."""
    texts = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.StringType)]
    trimmed = raw.withColumns({c: F.when(F.trim(c) != "", F.col(c)) for c in texts})
    return trimmed.select(
        F.concat("day", "store", "transaction", "ean").alias("id"),
        F.concat("material", F.lit("-"), F.when(F.col("uom") == "ST", "UN").otherwise(F.col("uom"))).alias("ref_id"),
        F.substring("order_number", 2, 40).try_cast("long").alias("order_id"), "day", "store", "transaction", "ean", "units", "net",
    )


def merge_sales(target: DataFrame, recent: DataFrame) -> DataFrame:
    """Re-merge the last days of sales on day, store, transaction and EAN."""
    return merge_upsert(target, recent, ["day", "store", "transaction", "ean"], version=["id"])


def floor_sales(accounting: DataFrame, stores: DataFrame) -> DataFrame:
    """In-store net sales per store and day."""
    return accounting.join(stores.select("store_id", "format"), "store_id").groupBy("day", "store_id", "format").agg(
        F.round(F.sum("net")).alias("net")
    )
