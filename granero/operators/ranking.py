"""Exact positions and ranks that never need one task to hold an unbounded group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.session import cut_lineage, drop_tables

BROADCAST_VALUES = 500_000  # distinct values with their ranks (16 bytes each) up to which a join may broadcast them

_PARTITION_BITS = 33  # layout of monotonically_increasing_id: partition above, row position below


def _sorted_index(df: DataFrame, order: Sequence[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """1-based position in a total order, and the table it reads: range sort, write with row ids, add offsets.

    The ids are written with the rows: their upper bits number the sorted partitions, the lower bits the rows.
    The number of a row's sorted partition stays with it as ``_pid``.
    """
    tagged = cut_lineage(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()))
    partition = F.shiftrightunsigned("_mid", _PARTITION_BITS)
    within = F.col("_mid").bitwiseAND(F.lit((1 << _PARTITION_BITS) - 1))
    # One row per sorted partition, so this unpartitioned window is bounded by the partition count.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(partition.alias("_pid")).agg(F.count("*").alias("_rows"))
        .select("_pid", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    indexed = (
        tagged.withColumn("_pid", partition).join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_offset") + within + 1).cast("long"))
        .drop("_mid", "_offset")
    )
    return indexed, tagged


def positions(df: DataFrame, order: Sequence[Column], name: str = "position", within: Sequence[str] = ()) -> DataFrame:
    """``row_number`` over ``order`` (which must be total), globally or inside ``within`` groups.

    At every size rows are range-sorted by group and order, indexed per sorted partition, and each group's first
    index is subtracted, so one hot group spreads over many tasks. The sorted rows are written once.
    """
    if not within:
        return _sorted_index(df, order, name)[0].drop("_pid")
    indexed, _ = _sorted_index(df, [*map(F.col, within), *order], "_index")
    keys = [f"_g{i}" for i, _ in enumerate(within)]
    # A group has a row for each sorted partition it reaches: rows meet their first index by both, so that even where
    # this join shuffles, no task reads more of a hot group than sorted partitions hold.
    reached = indexed.groupBy(F.col("_pid").alias("_part"), *[F.col(c).alias(k) for c, k in zip(within, keys)]).agg(F.min("_index").alias("_low"))
    firsts = reached.withColumn("_first", F.min("_low").over(Window.partitionBy(*keys))).drop("_low")
    same = [F.col("_pid") == F.col("_part"), *[F.col(c).eqNullSafe(F.col(k)) for c, k in zip(within, keys)]]
    return (
        indexed.join(firsts, same, "inner")
        .withColumn(name, F.col("_index") - F.col("_first") + 1)
        .drop("_index", "_first", "_pid", "_part", *keys)
    )


def dense_ranks(df: DataFrame, ranks: dict[str, str], broadcast_values: int = BROADCAST_VALUES) -> DataFrame:
    """Global descending ``dense_rank`` of several numeric columns: ``{output name: ranked column}``.

    Only distinct values are ranked, those of all columns in one sort, column by column: a column's ranks start after
    the counts of those before it. They are joined back: broadcast where a column has few of them (then many rows may
    share one), else by a join whose hot values Spark splits. ``df`` is read several times, so it should be a table.
    """
    kinds = dict(df.dtypes)
    values = None
    for number, column in enumerate(ranks.values()):
        own = df.select(F.lit(number).alias("_column"), F.col(column).cast("decimal(38,10)").alias("_value")).distinct()
        values = own if values is None else values.unionByName(own)
    ranked, table = _sorted_index(values, [F.col("_column").asc(), F.col("_value").desc_nulls_first()], "_index")
    counts = {row["_column"]: row["count"] for row in table.groupBy("_column").count().collect()}  # one row per column
    base, earlier = df, 0
    for number, (name, column) in enumerate(ranks.items()):
        rank = (F.col("_index") - F.lit(earlier)).alias(name)
        own = ranked.where(F.col("_column") == number).select(F.col("_value").cast(kinds[column]).alias("_value"), rank)
        if counts.get(number, 0) <= broadcast_values:
            own = F.broadcast(own)
        earlier += counts.get(number, 0)
        base = base.join(own, F.col(column).eqNullSafe(F.col("_value")), "inner").drop("_value")
    return base


def composite_rank(
    df: DataFrame,
    weights: dict[str, int],
    tie_breaker: Sequence[str],
    within: Sequence[str] = (),
    name: str = "ranking",
    broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """Row number by a weighted sum of global dense ranks (best first).

    ``weights`` maps measures to integer weights in tenths, so scores compare exactly. Component ranks are
    global even when the final numbering restarts in every ``within`` group. The input is written once for the
    ranks and removed when the numbered rows are written.
    """
    names = {f"{measure}_rank": measure for measure in weights}
    base = cut_lineage(df)
    scored = dense_ranks(base, names, broadcast_values).withColumn(
        "score", sum((F.col(f"{measure}_rank") * weight for measure, weight in weights.items()), F.lit(0))
    )
    order = [F.col("score").asc(), *[F.col(c).asc() for c in tie_breaker]]
    numbered = positions(scored, order, name, within)
    drop_tables(base)
    return numbered


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows per group. Spark limits each group before the shuffle, so hot groups stay small."""
    window = Window.partitionBy(*keys).orderBy(*order)
    kept = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return kept.withColumn(name, F.col(name).cast("long"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order``."""
    return top_k(df, keys, order, 1, "_rank").drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], *version: str) -> DataFrame:
    """One row per key: the one with the highest version, cut to one candidate per task before the shuffle."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in version])


def top_k_by_column(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_breaker: Sequence[Column],
    k: Column, cap: int,
) -> DataFrame:
    """Rows whose dense rank is at most the group's own ``k``, and at most ``cap`` rows per group.

    The cap is applied first: the dense rank of a kept row depends only on rows ahead of it, which the cap
    keeps as well.
    """
    window = Window.partitionBy(*keys)
    capped = top_k(df, keys, [*order, *tie_breaker], cap, "row_in_group")
    dense = F.dense_rank().over(window.orderBy(*order)).cast("long")
    return capped.withColumn("dense", dense).where(F.col("dense") <= k)


def group_count(df: DataFrame, keys: Sequence[str], counted: Column, name: str) -> DataFrame:
    """Add the group's non-null count to every row, aggregating before the shuffle instead of windowing."""
    aliases = [f"_k{i}" for i, _ in enumerate(keys)]
    counts = df.groupBy(*[F.col(k).alias(a) for k, a in zip(keys, aliases)]).agg(F.count(counted).alias(name))
    same = [df[k].eqNullSafe(counts[a]) for k, a in zip(keys, aliases)]
    return df.join(counts, same, "inner").drop(*aliases)
