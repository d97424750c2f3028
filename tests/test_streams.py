"""Streams against their batch twins, with small files, late rows and replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granero.streaming import feeds

SCHEMA = "id long, ts timestamp, kind string, amount long"
START = dt.datetime(2024, 1, 1)


def _rows(count):
    return [(i, START + dt.timedelta(minutes=7 * i), "ab"[i % 2], i) for i in range(count)]


@pytest.fixture
def landed(spark, tmp_path):
    """Six files in time order, each repeating some rows of the one before."""
    path = str(tmp_path / "feed")
    rows = _rows(120)
    for part in range(6):
        chunk = rows[max(0, part * 20 - 5): part * 20 + 20]
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, path):
    from pyspark.sql.types import StructType

    schema = spark.createDataFrame([], SCHEMA).schema
    assert isinstance(schema, StructType)
    return feeds.open_feed(spark, path, schema, files=1)


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_repeated_movements_are_written_once(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    feeds.run_available(feeds.unique_movements(_stream(spark, landed)), str(tmp_path / "cp"), path=out)
    got = spark.read.parquet(out)
    assert got.count() == 120 and _set(got) == set(_rows(120))


def test_version_log_upserts_and_survives_replays(spark, landed, tmp_path):
    table = str(tmp_path / "table")
    stream = _stream(spark, landed).withColumn("day", F.to_date("ts"))
    schema = spark.createDataFrame([], f"{SCHEMA}, day date").schema
    for feed in ("one", "two"):
        feeds.run_available(stream, str(tmp_path / feed), sink=feeds.version_log(table, feed, "day"))
    merged = feeds.merged_rows(spark, table, schema, ["id"], ["ts", "amount"])
    assert merged.count() == 120
    late = spark.createDataFrame([(0, START, "a", 99), (1, START, "b", -1)], SCHEMA).withColumn("day", F.to_date("ts"))
    for _ in ("first try", "replay"):
        feeds.version_log(table, "late", "day")(late, 0)
    merged = feeds.merged_rows(spark, table, schema, ["id"], ["ts", "amount"])
    assert merged.count() == 120 and spark.read.parquet(table).where("feed = 'late'").count() == 2
    # A same-time larger amount wins, an older row loses.
    assert {r["id"]: r["amount"] for r in merged.where("id < 2").collect()} == {0: 99, 1: 1}
    feeds.compact(spark, table, schema, ["id"], ["ts", "amount"], "day", str(tmp_path / "compacted"))
    assert spark.read.parquet(str(tmp_path / "compacted")).count() == 120


def test_blocks_match_the_batch_twin_once_closed(spark, landed, tmp_path):
    out = str(tmp_path / "blocks")
    unique = feeds.unique_movements(_stream(spark, landed))
    feeds.run_available(feeds.block_counts(unique, ["kind"]), str(tmp_path / "cp"), path=out)
    got = _set(spark.read.parquet(out))
    twin = feeds.block_counts(spark.createDataFrame(_rows(120), SCHEMA), ["kind"])
    horizon = START + dt.timedelta(minutes=7 * 119) - dt.timedelta(hours=2)
    closed = {r for r in _set(twin) if r[1] <= horizon}
    assert got == closed and closed


def test_lookback_matches_the_batch_twin(spark, landed, tmp_path):
    out = str(tmp_path / "recent")
    unique = feeds.unique_movements(_stream(spark, landed))
    feeds.run_available(feeds.recent_keys(unique, ["kind"]), str(tmp_path / "cp"), path=out)
    twin = _set(feeds.recent_keys(spark.createDataFrame(_rows(120), SCHEMA), ["kind"]))
    got = _set(spark.read.parquet(out))
    assert got and got <= twin


def test_every_row_is_accepted_repeated_or_late(spark, tmp_path):
    from granero.sources import snapshots

    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    minutes = lambda n: None if n is None else START + dt.timedelta(minutes=n)
    parts = [
        [(1, 0, "a"), (2, 200, "a"), (1, 5, "a")],  # the limit becomes minute 80
        [(3, 79, "a"), (4, 80, "a"), (2, 200, "b"), (5, None, "a"), (6, 500, "a")],  # 3 and 5 late, 2 repeated; limit 380
        [(1, 600, "a"), (6, 500, "a"), (7, 100, "a"), (8, 380, "b")],  # 1 was forgotten, 6 repeated, 7 late
        [],
        [(9, 10_000, "a"), (None, 10_000, "a"), (None, 10_000, "a")],
    ]
    sink = feeds.sorting_sink(out, "f", schema)
    for _ in ("first run", "replay of every batch"):
        for number, rows in enumerate(parts):
            sink(spark.createDataFrame([(i, minutes(m), kind, 1) for i, m, kind in rows], SCHEMA), number)
    from pyspark.sql.types import StructType

    counts = snapshots.read(spark, f"{out}/counts", StructType.fromDDL(feeds.COUNTS))
    assert [(r.input, r.accepted, r.repeated, r.late) for r in counts.orderBy("batch").collect()] == [(3, 2, 1, 0), (5, 2, 1, 2), (4, 2, 1, 1), (0, 0, 0, 0), (3, 2, 1, 0)]
    late = snapshots.read(spark, f"{out}/late", schema)
    assert sorted(r.id for r in late.collect()) == [3, 5, 7]
    accepted = snapshots.read(spark, f"{out}/accepted", schema)
    assert sorted((r.id or 0, r.ts) for r in accepted.collect()) == [(0, minutes(10_000)), (1, minutes(0)), (1, minutes(600)), (2, minutes(200)), (4, minutes(80)), (6, minutes(500)), (8, minutes(380)), (9, minutes(10_000))]
    spark.createDataFrame([(i, minutes(i), "a", 1) for i in range(50)], SCHEMA).coalesce(1).write.parquet(source)
    feeds.run_available(_stream(spark, source), str(tmp_path / "cp"), sink=feeds.sorting_sink(str(tmp_path / "run"), "f", schema))
    assert snapshots.read(spark, f"{tmp_path}/run/accepted", schema).count() == 50


def test_keyed_state_keeps_active_keys_only(spark, tmp_path):
    """Keys of the first hours are forgotten; what has left the state equals the latest changes of a batch."""
    from granero.sources import snapshots

    source, table = str(tmp_path / "source"), str(tmp_path / "table")
    rows = [(k, START + dt.timedelta(minutes=7 * k), f"key{k // 20 if k % 2 else 'hot'}", (k * 37) % 400) for k in range(240)]
    for part in range(12):
        spark.createDataFrame(rows[part * 20 : part * 20 + 20], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    stream = _stream(spark, source)
    latest = feeds.latest_by_state(stream, "kind", "amount", keep_minutes=60)
    sink = feeds.snapshot_log(table, "f", ["kind"])
    query = feeds.run_available(latest, str(tmp_path / "cp"), sink=sink, mode="update", partitions=2)
    sizes = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(sizes) <= 8 and len({r[2] for r in rows}) == 13  # of 13 keys, those of the last hours
    batch = feeds.latest_states(spark.createDataFrame(rows, SCHEMA), "kind", "amount")
    assert _set(feeds.snapshot_rows(spark, table, stream.schema, ["kind"], ["amount"])) == _set(batch)
    assert snapshots.read(spark, table, stream.schema).count() < 120  # only rises of the version left the state
