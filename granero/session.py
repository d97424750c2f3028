"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on. All may be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle for the aggregate that follows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sort-merge joins turn into hash joins at run time when every build partition is below this size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Stored columns of numbers are small: in a task's memory they take 10 to 30 times their bytes in a file or shuffle.
    "spark.sql.files.maxPartitionBytes": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


SHUFFLE_SHARE = 4 << 20  # bytes of input files for each partition a shuffle starts with
# Spark removes what a query shuffled when the query ends, not when the driver happens to collect garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def size_shuffles(spark: SparkSession, paths: Sequence[str]) -> int:
    """Start shuffles with partitions in proportion to the files at ``paths``, so that tasks stay small however large these are.

    Spark joins small partitions again at run time. There are never fewer than the session's own number.
    """
    total = sum(size for path in paths for _, size, _ in _files_of(spark, path))
    number = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHUFFLE_SHARE))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(number))
    return number


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("granero")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only a local-mode session without one gets a temporary folder, because there every executor shares the
    machine's disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="granero-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_TABLES: dict[str, SparkSession] = {}
_SHARED: dict[tuple, DataFrame] = {}


def _files_of(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files at ``path``, which change when its content does."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    found = [one for status in listed or [] for one in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(status.getPath())]
    return tuple(sorted((one.getPath().toString(), one.getLen(), one.getModificationTime()) for one in found))


def shared_table(spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[], DataFrame]) -> DataFrame:
    """A table derived from files, written once for all queries of the application that read it.

    It is made anew when its ``sources`` have changed, and stays when ``drop_tables`` is called without frames, until
    the driver ends.
    """
    key = (spark.sparkContext.applicationId, name, *(_files_of(spark, path) for path in sources))
    if key not in _SHARED:
        for old in [k for k in _SHARED if k[:2] == key[:2] and k[0] == spark.sparkContext.applicationId]:
            drop_tables(_SHARED.pop(old))
        _SHARED[key] = cut_lineage(build())
    return _SHARED[key]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    What follows survives lost executors, is not computed twice, and reads only the columns it needs. The table
    stays until ``drop_tables`` or the end of the driver; what was shuffled to make it is removed at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/granero-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEAN_SHUFFLES) if before is None else spark.conf.set(CLEAN_SHUFFLES, before)
    track(spark, path)
    saved = spark.read.schema(df.schema).parquet(path)
    saved._granero_path = path
    return saved


def track(spark: SparkSession, path: str) -> None:
    """Have ``drop_tables`` remove what was written at ``path``."""
    _TABLES[path] = spark


def remove(spark: SparkSession, path: str) -> None:
    _TABLES.pop(path, None)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_tables(*frames: DataFrame) -> None:
    """Remove tables that ``cut_lineage`` wrote: of these frames, or all there are but the shared ones."""
    kept = {frame._granero_path for frame in _SHARED.values()}
    for path in [frame._granero_path for frame in frames] or [path for path in _TABLES if path not in kept]:
        if path in _TABLES:
            remove(_TABLES[path], path)


@atexit.register
def _drop_at_exit() -> None:
    for path, spark in list(_TABLES.items()):
        if spark.sparkContext._jsc is None:  # stopped before
            _TABLES.pop(path)
    _SHARED.clear()
    if _TABLES:
        drop_tables()
