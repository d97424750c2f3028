"""Structured Streaming over change feeds: stock movements, shortage blocks, lookbacks and latest states.

Every transformation works on a batch frame as well, so each stream has a batch twin to be checked against.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from granero.operators.ranking import first_per_key, latest_per_key
from granero.session import cut_lineage, drop_tables
from granero.sources import snapshots

# The source is polled hourly: one late poll on top of the interval.
LATENESS = "2 hours"


def open_feed(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet", files: int = 100, at: str = "ts",
    lateness: str = LATENESS,
) -> DataFrame:
    """Directory source with its one watermark on ``at``; ``files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(file_format).option("maxFilesPerTrigger", files)
    return reader.load(path).withWatermark(at, lateness)


def unique_movements(feed: DataFrame, key: str = "id") -> DataFrame:
    """Movements without repeated ids. A stream forgets ids once the watermark passes them."""
    if feed.isStreaming:
        return feed.dropDuplicatesWithinWatermark([key])
    return feed.dropDuplicates([key])


def block_counts(feed: DataFrame, keys: Sequence[str], at: str = "ts", length: str = "30 minutes") -> DataFrame:
    """Rows and amount per key and tumbling block."""
    return feed.groupBy(F.window(at, length).alias("block"), *keys).agg(
        F.count("*").alias("movements"), F.sum("amount").alias("amount")
    ).select(F.col("block.start").alias("block_start"), F.col("block.end").alias("block_end"), *keys, "movements", "amount")


def recent_keys(
    feed: DataFrame, keys: Sequence[str], at: str = "ts", length: str = "4 hours", slide: str = "30 minutes"
) -> DataFrame:
    """Keys that changed inside each sliding lookback window."""
    return feed.groupBy(F.window(at, length, slide).alias("span"), *keys).agg(F.count("*").alias("changes")).select(
        F.col("span.end").alias("as_of"), *keys, "changes"
    )


def latest_states(changes: DataFrame, key: str, version: str) -> DataFrame:
    """Newest change per key (batch, or one micro-batch)."""
    return latest_per_key(changes, [key], version)


def version_log(path: str, feed: str, partition: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that writes each micro-batch beside the earlier ones, below its partition.

    A batch owns the folder ``partition/feed/batch``, so a replay after a failure replaces exactly its own
    rows, and a write costs the size of the batch whatever the size of the table. ``merged_rows`` reads the
    keyed table back.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumns({"feed": F.lit(feed), "batch": F.lit(batch_id).cast("long")})
        writer = tagged.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(partition, "feed", "batch").parquet(path)

    return write


def merged_rows(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The upserted table: the newest logged version of every key."""
    logged = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return latest_per_key(logged, keys, *version)


def compact(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], version: Sequence[str], partition: str, target: str) -> None:
    """Write the merged rows as one plain table, after which the log can start anew."""
    merged_rows(spark, path, schema, keys, version).hint("rebalance", partition).write.mode("overwrite").partitionBy(partition).parquet(target)


def snapshot_log(path: str, feed: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that adds each micro-batch to a snapshot table (``sources.snapshots``).

    A batch's files carry its name and number, also after a compaction has absorbed them, so a replay replaces its own
    files or finds that its rows are in the table already, and changes nothing either way.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{feed}/{batch_id}"
        if any(one.batch == _ABSORBED + name for one in snapshots.snapshot(spark, path).files):
            return
        snapshots.append(batch, path, keys, name)

    return write


def snapshot_rows(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], version: Sequence[str], at: int | None = None) -> DataFrame:
    """The upserted table: the newest logged row of every key, in the newest snapshot or snapshot ``at``."""
    return latest_per_key(snapshots.read(spark, path, schema, at), keys, *version)


_ABSORBED = "absorbed "


def compact_log(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], version: Sequence[str]) -> int:
    """Replace the log's files by the newest row of every key, in one switch; returns the new version.

    Readers of the version before go on with its files, which ``snapshots.vacuum`` removes later. Batches that arrive
    meanwhile are kept beside the compacted files. The names of absorbed batches stay, as entries without rows.
    """
    start = snapshots.snapshot(spark, path)
    rows = latest_per_key(snapshots.read_files(spark, path, schema, [one for one in start.files if one.rows]), keys, *version)
    fresh = snapshots.write_files(rows, path, keys)
    gone = {one.name for one in start.files}
    batches = sorted({one.batch.removeprefix(_ABSORBED) for one in start.files if one.batch})
    absorbed = [snapshots.LiveFile(f"{_ABSORBED}{batch}", 0, None, None, 0, _ABSORBED + batch) for batch in batches]
    while True:
        now = snapshots.snapshot(spark, path)
        if not gone <= {one.name for one in now.files}:
            raise snapshots.ConflictError("another compaction or a replay has replaced the files that were read")
        try:
            return snapshots.commit(spark, path, now, [*fresh, *absorbed, *(one for one in now.files if one.name not in gone)]).version
        except snapshots.ConflictError:
            continue  # a batch arrived in between; it stays beside the compacted files


COUNTS = "feed string, batch long, input long, accepted long, repeated long, late long, watermark timestamp"


def sorting_sink(path: str, feed: str, schema: StructType, key: str = "id", at: str = "ts", lateness: str = LATENESS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that loses nothing: every row is accepted, repeated or late, and counted as such.

    A row is late if its time lies more than ``lateness`` before the latest one of earlier batches, or is missing; late
    rows go to the table ``late``. Others are accepted once for each ``key`` among what was accepted since ``lateness``
    before that limit, as ``unique_movements`` does, and go to ``accepted``. ``counts`` has one row a batch, which also
    carries the limit for the next. All three are snapshot tables whose files bear the batch's name, so a replay after a
    failure at any point replaces exactly its own rows. The stream itself needs no watermark.
    """
    counts_schema = StructType.fromDDL(COUNTS)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"{feed}/{batch_id}"
        rows = cut_lineage(batch.select(*schema.fieldNames()))
        try:
            earlier = snapshots.read(spark, f"{path}/counts", counts_schema).where((F.col("feed") == feed) & (F.col("batch") < batch_id))
            limits = earlier.agg(F.max("watermark").alias("limit"), (F.max("watermark") - F.expr(f"INTERVAL {lateness}")).cast("string").alias("horizon")).first()
            limit = F.lit(limits["limit"]).cast("timestamp")
            behind = F.col(at).isNull() | F.coalesce(F.col(at) < limit, F.lit(False))
            timely = first_per_key(rows.where(~behind), [key], [F.col(at).asc(), F.xxhash64(*rows.columns).asc()])
            known = [
                one for one in snapshots.snapshot(spark, f"{path}/accepted").files
                if not _is_from(one.batch, feed, batch_id) and (limits["horizon"] is None or one.high is None or one.high >= limits["horizon"])
            ]
            remembered = snapshots.read_files(spark, f"{path}/accepted", schema, known)
            if limits["horizon"] is not None:
                remembered = remembered.where(F.col(at) >= F.lit(limits["horizon"]).cast("timestamp"))
            seen = remembered.select(F.col(key).alias("_seen"))
            accepted = cut_lineage(timely.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti"))
            snapshots.append(rows.where(behind), f"{path}/late", [at], name)
            snapshots.append(accepted, f"{path}/accepted", [at], name)
            newest = F.greatest(F.max(at) - F.expr(f"INTERVAL {lateness}"), limit)
            sizes = rows.agg(F.count("*").alias("input"), F.count_if(behind).alias("late"), newest.alias("watermark"))
            taken = accepted.agg(F.count("*").alias("accepted"))
            counted = sizes.crossJoin(taken).select(
                F.lit(feed).alias("feed"), F.lit(batch_id).cast("long").alias("batch"), "input", "accepted",
                (F.col("input") - F.col("late") - F.col("accepted")).alias("repeated"), "late", "watermark",
            )
            snapshots.append(counted, f"{path}/counts", ["feed", "batch"], name)
            drop_tables(accepted)
        finally:
            drop_tables(rows)

    return write


def _is_from(name: str, feed: str, batch_id: int) -> bool:
    """Whether a file's batch is this one of the feed or a later one, written before a restart."""
    own, _, number = name.rpartition("/")
    return own == feed and int(number) >= batch_id


def latest_by_state(changes: DataFrame, key: str, version: str, at: str = "ts", keep_minutes: int = 30 * 24 * 60) -> DataFrame:
    """Newest change per key from keyed state: a row leaves when its key has a larger ``version`` than ever before.

    The state holds one number a key. A timer forgets a key ``keep_minutes`` after its last change, as the watermark
    counts, so the state's size is that of the active keys. A forgotten key starts anew: write to a sink that keeps the
    largest version. Rows without a version are left out. ``changes`` streams with a watermark on ``at``.
    """

    def advance(own: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        newest, seen = None, state.getCurrentWatermarkMs()
        for frame in frames:
            row = frame.loc[[frame[version].idxmax()]]
            if newest is None or row[version].iloc[0] > newest[version].iloc[0]:
                newest = row
            seen = max(seen, int(frame[at].max().timestamp() * 1000))
        if not state.exists or newest[version].iloc[0] > state.get[0]:
            state.update((int(newest[version].iloc[0]),))
            yield newest
        state.setTimeoutTimestamp(seen + keep_minutes * 60_000)

    known = changes.where(F.col(version).isNotNull() & F.col(at).isNotNull())
    return known.groupBy(key).applyInPandasWithState(advance, changes.schema, "version long", "update", GroupStateTimeout.EventTimeTimeout)


def run_available(
    stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None, path: str | None = None,
    mode: str = "append", partitions: int | None = None,
) -> StreamingQuery:
    """Process everything available now, into a batch sink or an append-only Parquet folder.

    ``partitions`` fixes the number of state partitions of a new checkpoint; the session's setting applies
    when it is left out.
    """
    conf = stream.sparkSession.conf
    before = conf.get("spark.sql.shuffle.partitions")
    if partitions:
        conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = writer.foreachBatch(sink).start() if sink else writer.format("parquet").option("path", path).start()
        query.awaitTermination()
    finally:
        conf.set("spark.sql.shuffle.partitions", before)
    return query
