"""Differences, intersections and packed lists of keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged_difference(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on one side only, with ``side`` saying which; one shuffle and safe against duplicates."""
    sides = before.select(*keys, F.lit(1).alias("_side")).unionByName(
        after.select(*keys, F.lit(2).alias("_side"))
    )
    seen = sides.groupBy(*keys).agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi"))
    return seen.where("_lo = _hi").select(
        *keys, F.when(F.col("_lo") == 1, "gone").otherwise("new").alias("side")
    )


def common_members(members: DataFrame, group: str, part: str, member: str) -> DataFrame:
    """Members present in every part of their group (exact intersection of N sets)."""
    pairs = members.select(group, part, member).distinct()
    hits = pairs.groupBy(group, member).agg(F.count("*").alias("_hits"))
    parts = pairs.groupBy(group).agg(F.count_distinct(part).alias("_parts"))
    return hits.join(parts, group).where("_hits = _parts").select(group, member)


def packed_list(values: Column, separator: str = ",") -> Column:
    """Sorted distinct values of a bounded dimension (stores, brands) as one string."""
    return F.array_join(F.sort_array(F.collect_set(values.cast("string"))), separator)
