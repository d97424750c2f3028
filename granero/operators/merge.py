"""Keyed loads as pure table operators: the caller decides where the result is written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granero.operators.ranking import latest_per_key
from granero.session import cut_lineage, drop_tables, remove
from granero.sources import snapshots


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def merge_upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], version: Sequence[str] = ()
) -> DataFrame:
    """Incoming rows win. With ``version`` columns the newest incoming row per key is taken first.

    Without them a key must come once; a repeated one raises when the result is computed.
    """
    updates = latest_per_key(updates, keys, *version) if version else _unique(updates, keys)
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def _unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.struct(F.lit(0).alias("_none"))
    grouped = df.groupBy(*keys).agg(F.count("*").alias("_rows"), F.first(row).alias("_row"))
    repeated = F.raise_error(F.lit("an incoming key is repeated and no version column says which row is newer"))
    checked = grouped.where(F.when(F.col("_rows") == 1, F.lit(True)).otherwise(repeated.cast("boolean")))
    return checked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def merge_insert_absent(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows win."""
    fresh = updates.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def merge_columns(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Upsert that overwrites only ``columns`` of matched rows; unmatched updates are inserted."""
    t, u = target.alias("t"), updates.withColumn("_hit", F.lit(True)).alias("u")
    joined = t.join(u, list(keys), "full")
    picked = []
    for name in target.columns:
        if name in keys:
            picked.append(F.col(name))
        elif name in columns:
            picked.append(F.when(F.col("_hit"), F.col(f"u.{name}")).otherwise(F.col(f"t.{name}")).alias(name))
        elif name in updates.columns:
            picked.append(F.coalesce(F.col(f"t.{name}"), F.col(f"u.{name}")).alias(name))
        else:
            picked.append(F.col(f"t.{name}").alias(name))
    return joined.select(*picked)


def merge_history(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], tracked: Sequence[str], at: Column
) -> DataFrame:
    """Change-aware merge with ``created``, ``updated`` and a ``deleted`` date that sticks once set.

    ``updates`` is the complete current set: keys missing from it are marked deleted at ``at``.
    """
    t = target.withColumn("_known", F.lit(True)).alias("t")
    u = updates.withColumn("_seen", F.lit(True)).alias("u")
    changed = reduce(lambda a, b: a | b, [~F.col(f"t.{c}").eqNullSafe(F.col(f"u.{c}")) for c in tracked])
    known, seen = F.col("_known").isNotNull(), F.col("_seen").isNotNull()
    return t.join(u, list(keys), "full").select(
        *keys,
        *[F.when(seen, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in tracked],
        F.least(F.col("t.created"), at).alias("created"),
        F.when(seen & (~known | changed), at).otherwise(F.col("t.updated")).alias("updated"),
        F.when(known & ~seen, F.coalesce(F.col("t.deleted"), at)).otherwise(F.col("t.deleted")).alias("deleted"),
    )


def dedupe_max(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key holding the maximum of every other column."""
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in df.columns if c not in keys])


def delete_then_insert(target: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop target rows whose key (NULL equal to NULL) is staged, then append the staged rows."""
    doomed = staged.select(*keys).distinct()
    kept = target.join(doomed, _null_safe(target, doomed, keys), "left_anti")
    return kept.unionByName(staged.select(*target.columns))


def replace_where(target: DataFrame, incoming: DataFrame, doomed: Column) -> DataFrame:
    """Replace the rows that satisfy ``doomed`` (a day, a window) with ``incoming``."""
    return target.where(~F.coalesce(doomed, F.lit(False))).unionByName(incoming.select(*target.columns))


def write_partitions(df: DataFrame, path: str, *partitions: str, replace: Sequence[Sequence[str]] = ()) -> None:
    """Replace the partitions present in ``df`` and those listed in ``replace``, which may hold no row any more.

    ``replace`` has one tuple of partition values, as they stand in the folder names, for each such partition.
    Rebalancing splits a hot partition and joins small ones.
    """
    (
        df.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions).parquet(path)
    )
    for values in replace:
        same = [F.col(c).cast("string") == str(value) for c, value in zip(partitions, values)]
        if df.where(reduce(lambda a, b: a & b, same)).isEmpty():
            remove(df.sparkSession, "/".join([path, *(f"{c}={value}" for c, value in zip(partitions, values))]))


def backfill_filter(target: DataFrame, day: Column, as_of: Column, full_days: int, recent_days: int) -> Column:
    """Filter for the next load: the long window when nothing is loaded yet, else the short one."""
    days = full_days if target.isEmpty() else recent_days
    return day >= F.date_sub(as_of, days)


@dataclass(frozen=True)
class Merged:
    """What a merge of files did: the version it made, files left as they are, files replaced and files written."""

    version: int
    kept: int
    replaced: int
    written: int


def merge_files(
    spark: SparkSession, path: str, schema: StructType, updates: DataFrame, keys: Sequence[str], version: Sequence[str] = (),
    null_safe: bool = False, attempts: int = 3, doomed: DataFrame | None = None,
) -> Merged:
    """Merge into a snapshot table (``sources.snapshots``) by replacing only the files that hold an incoming key.

    Rows equal those of ``merge_upsert``, or with ``null_safe`` of ``delete_then_insert`` (incoming keys may then repeat or be
    NULL); the rows that go are those with an incoming key, or with a key of ``doomed``. Readers see the version before or after, never a mixture. ``updates`` is written once before it is read
    several times. Where another writer was faster, files are looked up again in its version, up to ``attempts`` times.
    """
    if not null_safe:
        updates = latest_per_key(updates, keys, *version) if version else _unique(updates, keys)
    ready = cut_lineage(updates.select(*schema.fieldNames()))
    doomed = (ready if doomed is None else doomed).select(*keys).distinct()
    try:
        for attempt in range(attempts):
            before = snapshots.snapshot(spark, path)
            old = snapshots.touched(spark, path, schema, before.files, doomed, keys, null_safe)
            held = snapshots.read_files(spark, path, schema, old)
            kept = held.join(doomed, snapshots.same_keys(held, doomed, keys, null_safe), "left_anti")
            fresh = snapshots.write_files(kept.unionByName(ready), path, keys)
            names = {one.name for one in old}
            rest = [one for one in before.files if one.name not in names]
            try:
                made = snapshots.commit(spark, path, before, [*rest, *fresh])
            except snapshots.ConflictError:
                if attempt == attempts - 1:
                    raise
                continue
            return Merged(made.version, len(rest), len(old), len(fresh))
    finally:
        drop_tables(ready)
