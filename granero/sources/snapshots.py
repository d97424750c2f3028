"""Parquet folders with a list of live files, so that readers see one version while files are added or replaced.

A table is a folder with ``data/`` (Parquet files that never change once written) and ``snapshots/``: numbered JSON texts, each
naming the files of one version with their row count, the smallest and largest key in them and how many keys are NULL. A
change writes new files first and then one new snapshot, under a name that must not exist yet; until that moment nobody
reads the new files, and afterwards nobody misses one. Two writers that start from one version cannot both succeed: the
second gets ``ConflictError`` and may start again. The driver handles file names and one pair of keys a file, never rows.

``vacuum`` removes files that only older snapshots name; readers of a version need it until they end.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class ConflictError(RuntimeError):
    """Another writer has made this version."""


@dataclass(frozen=True)
class LiveFile:
    """One file of a version; ``low`` and ``high`` are its first key's extremes as text of that type."""

    name: str
    rows: int
    low: str | None
    high: str | None
    nulls: int
    batch: str = ""


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    files: tuple[LiveFile, ...] = field(default=())


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    system, place = _file_system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """All versions that still have their list of files, oldest first."""
    return sorted(int(name.removesuffix(".json")) for name in _names(spark, f"{path}/snapshots") if name.endswith(".json") and not name.startswith((".", "_")))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The newest version, or the one asked for; an empty one where nothing was written yet."""
    known = versions(spark, path)
    if version is None:
        version = known[-1] if known else 0
    if version == 0:
        return Snapshot()
    system, place = _file_system(spark, f"{path}/snapshots/{version:012d}.json")
    stream = system.open(place)
    try:
        text = bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
    return Snapshot(version, tuple(LiveFile(**one) for one in json.loads(text)))


def commit(spark: SparkSession, path: str, before: Snapshot, files: Sequence[LiveFile]) -> Snapshot:
    """Make ``files`` the version after ``before``, or raise ``ConflictError`` if that version exists."""
    after = Snapshot(before.version + 1, tuple(files))
    system, place = _file_system(spark, f"{path}/snapshots/{after.version:012d}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/snapshots/.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(json.dumps([one.__dict__ for one in files]).encode()))
    finally:
        stream.close()
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise ConflictError(f"version {after.version} of {path} exists already")
    return after


def _statistics(rows: DataFrame, key: str) -> list:
    found = rows.groupBy(F.element_at(F.split(F.input_file_name(), "/data/"), -1).alias("name")).agg(
        F.count("*").alias("rows"), F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
    )
    return found.collect()  # one row a file just written


def write_files(df: DataFrame, path: str, keys: Sequence[str], batch: str = "") -> list[LiveFile]:
    """Write rows as new files, each with a narrow range of keys; nobody reads them before ``commit``.

    Rows are dealt by key range, and those of one key by a hash of the row, so that a hot key is several files.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex
    df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys).write.parquet(f"{path}/data/{folder}")
    written = spark.read.schema(df.schema).parquet(f"{path}/data/{folder}")
    return [LiveFile(r["name"], r["rows"], r["low"], r["high"], r["nulls"], batch) for r in sorted(_statistics(written, keys[0]))]


def read_files(spark: SparkSession, path: str, schema: StructType, files: Sequence[LiveFile]) -> DataFrame:
    places = [f"{path}/data/{one.name}" for one in files if one.rows]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, schema: StructType, version: int | None = None) -> DataFrame:
    """All rows of the newest version at this moment, or of the one asked for; later changes don't touch the frame."""
    return read_files(spark, path, schema, snapshot(spark, path, version).files)


def append(df: DataFrame, path: str, keys: Sequence[str], batch: str = "") -> Snapshot:
    """Add rows. Those of the same ``batch`` written before are replaced, so that a repeated batch changes nothing."""
    spark = df.sparkSession
    fresh = write_files(df, path, keys, batch)
    while True:
        before = snapshot(spark, path)
        kept = [one for one in before.files if not batch or one.batch != batch]
        try:
            return commit(spark, path, before, [*kept, *fresh])
        except ConflictError:
            continue  # another writer was faster; these files go beside its own


def touched(spark: SparkSession, path: str, schema: StructType, files: Sequence[LiveFile], updates: DataFrame, keys: Sequence[str], null_safe: bool = False) -> list[LiveFile]:
    """The files that hold a key of ``updates``.

    Files whose range of first keys misses that of the updates are left unread; of the others only keys are read.
    """
    first, kind = keys[0], schema[keys[0]].dataType.simpleString()
    span = updates.agg(F.min(first).cast("string").alias("low"), F.max(first).cast("string").alias("high"), F.count_if(F.col(first).isNull()).alias("nulls")).first()
    near = [one for one in files if one.rows]
    if span["low"] is not None and near:
        listed = spark.createDataFrame([(k, one.low, one.high) for k, one in enumerate(near)], "k int, low string, high string")
        overlap = (F.col("low").cast(kind) <= F.lit(span["high"]).cast(kind)) & (F.col("high").cast(kind) >= F.lit(span["low"]).cast(kind))
        hit = {r["k"] for r in listed.where(overlap).collect()}
    else:
        hit = set()
    near = [one for k, one in enumerate(near) if k in hit or (null_safe and span["nulls"] and one.nulls)]
    if not near:
        return []
    held = read_files(spark, path, schema, near).select(*keys, F.element_at(F.split(F.input_file_name(), "/data/"), -1).alias("_file"))
    wanted = updates.select(*keys).distinct()
    names = {r["_file"] for r in held.join(wanted, same_keys(held, wanted, keys, null_safe), "left_semi").select("_file").distinct().collect()}
    return [one for one in near if one.name in names]


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (left[key].eqNullSafe(right[key]) if null_safe else left[key] == right[key])
    return condition


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Forget all but the newest ``keep`` versions and remove the files that none of those names. Returns what was removed.

    Files that belong to no snapshot yet may be those of a running writer, so run it when none is.
    """
    known = versions(spark, path)
    for version in known[:-keep]:
        system, place = _file_system(spark, f"{path}/snapshots/{version:012d}.json")
        system.delete(place, False)
    live = {one.name for version in known[-keep:] for one in snapshot(spark, path, version).files}
    removed = []
    for folder in _names(spark, f"{path}/data"):
        for name in _names(spark, f"{path}/data/{folder}"):
            if name.endswith(".parquet") and f"{folder}/{name}" not in live:
                system, place = _file_system(spark, f"{path}/data/{folder}/{name}")
                system.delete(place, False)
                removed.append(f"{folder}/{name}")
        if not any(name.startswith(f"{folder}/") for name in live):
            system, place = _file_system(spark, f"{path}/data/{folder}")
            system.delete(place, True)
    return removed
