"""Snapshot tables: atomic versions, merges that rewrite touched files only, and logs compacted under readers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granero.operators import merge
from granero.sources import snapshots
from granero.streaming import feeds

SCHEMA = "k long, day date, v long"


def rows(*triples):
    return [(k, dt.date(2024, 1, 1) + dt.timedelta(days=d), v) for k, d, v in triples]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


@pytest.fixture
def parts(spark):
    """Few, but several, files a write."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {key: spark.conf.get(key) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    yield 8
    for key, value in before.items():
        spark.conf.set(key, value)


def test_versions_are_whole_and_stay_readable(spark, path):
    one, two = frame(spark, rows((1, 0, 10), (2, 0, 20))), frame(spark, rows((3, 1, 30)))
    assert snapshots.read(spark, path, one.schema).count() == 0 and snapshots.versions(spark, path) == []
    snapshots.append(one, path, ["k"])
    old = snapshots.read(spark, path, one.schema)
    snapshots.append(two, path, ["k"])
    assert old.count() == 2 and snapshots.read(spark, path, one.schema).count() == 3
    assert snapshots.read(spark, path, one.schema, 1).count() == 2
    first = snapshots.snapshot(spark, path, 1)
    assert sum(f.rows for f in first.files) == 2 and {f.low for f in first.files} <= {"1", "2"}
    with pytest.raises(snapshots.ConflictError):
        snapshots.commit(spark, path, first, [])
    assert snapshots.versions(spark, path) == [1, 2]


def test_unfinished_and_failed_writes_are_not_read(spark, path):
    df = frame(spark, rows((1, 0, 10)))
    snapshots.append(df, path, ["k"])
    snapshots.write_files(frame(spark, rows((2, 0, 20))), path, ["k"])  # a writer that ended before its commit
    assert values(snapshots.read(spark, path, df.schema)) == values(df)
    removed = snapshots.vacuum(spark, path)
    assert len(removed) == 1 and values(snapshots.read(spark, path, df.schema)) == values(df)


def test_merge_rewrites_touched_files_only(spark, path, parts):
    target = frame(spark, rows(*((k, k % 30, k) for k in range(800))))
    snapshots.append(target, path, ["k"])
    files = len(snapshots.snapshot(spark, path).files)
    updates = frame(spark, rows((5, 0, -5), (7, 0, -7), (7, 1, -8), (9_000, 0, 1)))
    done = merge.merge_files(spark, path, target.schema, updates, ["k"], ["day"])
    assert files == parts and (done.kept, done.replaced) == (files - 1, 1) and done.version == 2
    assert values(snapshots.read(spark, path, target.schema)) == values(merge.merge_upsert(target, updates, ["k"], ["day"]))
    # Between two ranges of the table: the ranges overlap, but no file holds the key.
    done = merge.merge_files(spark, path, target.schema, frame(spark, rows((8_999, 0, 2))), ["k"])
    assert done.replaced == 0 and snapshots.read(spark, path, target.schema).count() == 802
    done = merge.merge_files(spark, path, target.schema, frame(spark, []), ["k"])
    assert done.replaced == 0 and snapshots.read(spark, path, target.schema).count() == 802


def test_merge_with_repeated_and_null_keys(spark, path, parts):
    target = frame(spark, rows(*((k % 50, k % 3, k) for k in range(200)), (None, 0, -1), (None, 1, -2)))
    snapshots.append(target, path, ["k"])
    staged = frame(spark, rows((3, 0, 1), (3, 0, 2), (None, 5, 3), (77, 0, 4)))
    done = merge.merge_files(spark, path, target.schema, staged, ["k"], null_safe=True)
    assert 0 < done.replaced <= 4
    assert values(snapshots.read(spark, path, target.schema)) == values(merge.delete_then_insert(target, staged, ["k"]))


def test_merge_refuses_repeated_keys_without_a_version(spark, path):
    target = frame(spark, rows((1, 0, 1)))
    snapshots.append(target, path, ["k"])
    with pytest.raises(Exception, match="repeated"):
        merge.merge_files(spark, path, target.schema, frame(spark, rows((1, 0, 2), (1, 0, 3))), ["k"])
    assert values(snapshots.read(spark, path, target.schema)) == values(target)


def test_merge_starts_again_when_another_writer_was_faster(spark, path, monkeypatch):
    target = frame(spark, rows((1, 0, 1), (2, 0, 2)))
    snapshots.append(target, path, ["k"])
    real, calls = snapshots.commit, []

    def slow(spark_, path_, before, files):
        calls.append(before.version)
        if len(calls) == 1:
            real(spark_, path_, before, [*before.files, *snapshots.write_files(frame(spark, rows((3, 0, 3))), path, ["k"])])
        return real(spark_, path_, before, files)

    monkeypatch.setattr(snapshots, "commit", slow)
    merge.merge_files(spark, path, target.schema, frame(spark, rows((3, 0, 30), (1, 0, 10))), ["k"])
    assert calls == [1, 2]
    assert values(snapshots.read(spark, path, target.schema)) == values(frame(spark, rows((1, 0, 10), (2, 0, 2), (3, 0, 30))))


def test_log_replays_and_compaction_under_a_reader(spark, path, monkeypatch):
    schema = frame(spark, []).schema
    write = feeds.snapshot_log(path, "one", ["k"])
    first, second = frame(spark, rows((1, 0, 10), (2, 0, 20))), frame(spark, rows((1, 1, 11), (3, 0, 30)))
    write(first, 0)
    write(second, 1)
    write(second, 1)  # a replay
    want = values(frame(spark, rows((1, 1, 11), (2, 0, 20), (3, 0, 30))))
    assert snapshots.read(spark, path, schema).count() == 4
    reader = feeds.snapshot_rows(spark, path, schema, ["k"], ["day"])
    seen = []
    real = snapshots.commit

    def while_switching(*args):
        seen.append(values(feeds.snapshot_rows(spark, path, schema, ["k"], ["day"])))
        made = real(*args)
        seen.append(values(feeds.snapshot_rows(spark, path, schema, ["k"], ["day"])))
        return made

    monkeypatch.setattr(snapshots, "commit", while_switching)
    feeds.compact_log(spark, path, schema, ["k"], ["day"])
    monkeypatch.setattr(snapshots, "commit", real)
    assert seen == [want, want] and values(reader) == want
    assert snapshots.read(spark, path, schema).count() == 3
    for batch, data in ((0, first), (1, second)):
        write(data, batch)  # replays of batches the compaction has absorbed
    assert snapshots.read(spark, path, schema).count() == 3
    write(frame(spark, rows((2, 5, 25))), 2)
    feeds.compact_log(spark, path, schema, ["k"], ["day"])
    write(frame(spark, rows((2, 5, 25))), 2)
    assert values(feeds.snapshot_rows(spark, path, schema, ["k"], ["day"])) == values(frame(spark, rows((1, 1, 11), (2, 5, 25), (3, 0, 30))))
    snapshots.vacuum(spark, path)
    assert snapshots.read(spark, path, schema).count() == 3 and len(snapshots.versions(spark, path)) == 1


def test_a_batch_that_arrives_during_compaction_is_kept(spark, path, monkeypatch):
    schema = frame(spark, []).schema
    write = feeds.snapshot_log(path, "one", ["k"])
    write(frame(spark, rows((1, 0, 10))), 0)
    real, calls = snapshots.write_files, []

    def meanwhile(df, *rest):
        made = real(df, *rest)
        if not calls:
            calls.append(1)
            feeds.snapshot_log(path, "two", ["k"])(frame(spark, rows((1, 3, 13))), 0)
        return made

    monkeypatch.setattr(snapshots, "write_files", meanwhile)
    feeds.compact_log(spark, path, schema, ["k"], ["day"])
    assert values(feeds.snapshot_rows(spark, path, schema, ["k"], ["day"])) == values(frame(spark, rows((1, 3, 13))))


def test_stream_into_a_snapshot_log(spark, tmp_path, path):
    schema = frame(spark, []).schema
    source = str(tmp_path / "source")
    for part in range(3):
        frame(spark, rows(*((k, part, 100 * part + k) for k in range(part, part + 4)))).coalesce(1).write.mode("append").parquet(source)
    for attempt in ("a", "b"):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        feeds.run_available(stream, str(tmp_path / attempt), sink=feeds.snapshot_log(path, attempt, ["k"]))
        feeds.compact_log(spark, path, schema, ["k"], ["day"])
    got = feeds.snapshot_rows(spark, path, schema, ["k"], ["day"])
    assert got.count() == 6 and got.agg(F.sum("v")).first()[0] == sum((0, 101, 202, 203, 204, 205))
