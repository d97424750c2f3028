"""Customers, memberships, staff and service conversations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.functions.dates import as_date, as_ts
from granero.operators.joins import outer_chain
from granero.operators.merge import replace_where
from granero.operators.sets import tagged_difference

# Membership states that count as paid.
PAID_STATES = ("confirmada", "renovada")


def retained_customers(memberships: DataFrame, profiles: DataFrame, blocked: DataFrame, day, ahead: int = 7, recency: int = 40) -> DataFrame:
    """Paid members now and for the next ``ahead`` days whose last purchase is ``recency`` days old or more."""
    day = as_date(day)
    valid = memberships.where(
        F.col("status").isin(*PAID_STATES) & (F.col("from_day") <= day) & (F.col("to_day") >= F.date_add(day, ahead))
    )
    quiet = profiles.where(F.col("recency") >= recency)
    return valid.join(quiet, "profile").join(blocked, "profile", "left_anti")


def membership_moves(before: DataFrame, now: DataFrame, key: str = "profile") -> DataFrame:
    """Customers to add and to remove between two membership lists."""
    moved = tagged_difference(before, now, [key])
    return moved.select(key, F.when(F.col("side") == "new", "add").otherwise("remove").alias("action"))


def discount_limit(line_promotions: DataFrame, orders: DataFrame, lines: DataFrame, calendar: DataFrame, limit: int = 75_000) -> DataFrame:
    """Customers whose staff or referral discounts of the current month exceed ``limit`` in absolute value."""
    month = calendar.where("relative_month = 0").select("day")
    current = orders.join(month, "day", "left_semi").select("order_id", "customer_id")
    staff, referral = F.col("name").ilike("%Colaborador%"), F.col("name").ilike("%referido%")
    deals = line_promotions.where((staff | referral) & ~F.col("name").ilike("%despacho%"))
    joined = deals.join(lines.select("line_id", "order_id"), "line_id").join(current, "order_id")
    totals = joined.groupBy("customer_id").agg(
        F.sum(F.when(staff, F.col("value")).otherwise(0)).alias("staff_discount"),
        F.sum(F.when(referral, F.col("value")).otherwise(0)).alias("referral_discount"),
    )
    return totals.where((F.abs("staff_discount") > limit) | (F.abs("referral_discount") > limit))


def inactive_pickers(admins: DataFrame, activity: DataFrame, profiles: Sequence[int], own_mail: Sequence[str], day, days: int = 60) -> DataFrame:
    """Active external users of the given profiles whose last picking day is at least ``days`` days ago."""
    external = F.lit(True)
    for pattern in own_mail:
        external = external & ~F.col("email").like(pattern)
    users = admins.where((F.col("status") == 1) & F.col("profile").isin(*profiles) & external)
    last = activity.groupBy("picker").agg(F.max("day").alias("last_pick"))
    return users.join(last, "picker").where(F.col("last_pick") <= F.date_sub(as_date(day), days))


def session_board(feeds: dict[str, DataFrame], key: str = "day") -> DataFrame:
    """Day rows with the session metrics of every feed, each column prefixed by its feed name."""
    named = [
        df.select(key, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c != key]) for name, df in feeds.items()
    ]
    return outer_chain(named, key)


def split_conversations(feed: DataFrame) -> dict[str, DataFrame]:
    """Operator, robot and survey rows of a conversation feed; rows without a valid start are dropped."""
    clean = feed.withColumns({
        "case_id": F.nullif(F.col("case_id").try_cast("long"), F.lit(0)),
        "started": F.try_to_timestamp("started", F.lit("dd-MM-yyyy HH:mm")),
    }).where(F.col("started").isNotNull())
    robot = clean.where(F.col("operator") == "robot")
    if "template" in feed.columns:
        robot = robot.where(F.col("template").isNull())
    return {
        "operator": clean.where(F.col("operator") != "robot").select("case_id", "operator", "started", "messages"),
        "robot": robot.select("case_id", "menu", "started"),
        "survey": clean.where(F.col("case_id").isNotNull()).select("case_id", "answer"),
    }


def _window(at, minutes: int) -> Column:
    at = as_ts(at)
    slack = F.expr(f"INTERVAL '{minutes}' MINUTE")
    return F.col("started").between(at - slack, at + slack)


def replace_conversations(
    current: dict[str, DataFrame], incoming: dict[str, DataFrame], at, minutes: int = 30
) -> dict[str, DataFrame]:
    """Replace rows started within ``minutes`` of ``at``; surveys of the cases in that window go with them."""
    result, cases = {}, None
    for name in ("operator", "robot"):
        merged = replace_where(current[name], incoming[name], _window(at, minutes))
        result[name] = merged
        touched = merged.where(_window(at, minutes)).select("case_id")
        cases = touched if cases is None else cases.unionByName(touched)
    kept = current["survey"].join(cases, "case_id", "left_anti")
    result["survey"] = kept.unionByName(incoming["survey"])
    return result
