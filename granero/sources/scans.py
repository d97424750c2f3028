"""Batch sources and sinks. Paths and schemas are arguments; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from granero.functions.dates import as_date
from granero.operators.ranking import positions


def scan(df: DataFrame, where: str | None = None) -> DataFrame:
    return df.where(where) if where else df


def scan_since(
    df: DataFrame, created: str | None = None, created_mark: Column | None = None,
    updated: str | None = None, updated_mark: Column | None = None, inclusive: bool = False,
) -> DataFrame:
    """Rows past the watermark of each given column; a NULL watermark means the epoch."""
    marks = [(c, m) for c, m in ((created, created_mark), (updated, updated_mark)) if c is not None]
    if not marks:
        raise ValueError("an incremental scan needs a created or an updated column")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    for name, mark in marks:
        mark = epoch if mark is None else mark
        df = df.where(F.col(name) >= mark if inclusive else F.col(name) > mark)
    return df


def high_watermark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("mark"))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def dated_range(df: DataFrame, column: str, first, last) -> DataFrame:
    """Days from ``first`` to ``last``; on a partition column this prunes directories."""
    return df.where(F.col(column).between(as_date(first), as_date(last)))


def read_csv(
    spark: SparkSession, path: str, schema: StructType, separator: str = ",", header: bool = True,
    decimal_comma: dict[str, str] | None = None, rename: dict[str, str] | None = None,
) -> DataFrame:
    """Declared-schema CSV. ``decimal_comma`` maps text columns to the decimal type to parse them into."""
    df = spark.read.schema(schema).option("header", header).option("sep", separator).csv(path)
    for name, kind in (decimal_comma or {}).items():
        df = df.withColumn(name, F.replace(F.col(name), F.lit(","), F.lit(".")).try_cast(kind))
    return df.withColumnsRenamed(rename or {})


def read_store_files(spark: SparkSession, path: str, schema: StructType, pattern: str) -> DataFrame:
    """Every file below ``path``; the store code is the first group of ``pattern`` in the file path."""
    df = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(path)
    return df.withColumn("store_id", F.regexp_extract("_metadata.file_path", pattern, 1))


def read_documents(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_dated(df: DataFrame, path: str, day: str, file_format: str = "csv", column: str = "ds") -> None:
    """Replace the objects of one day, also by nothing."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(f"{path}/{column}={day}")


def write_per_key(df: DataFrame, path: str, key: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per key. Rebalancing gathers small keys and spreads a hot key over many tasks."""
    df.hint("rebalance", key).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy(key).json(path)


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed column order; rows with an empty cell are left out of an export."""
    filled = [F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "") for c in columns]
    return df.where(reduce(lambda a, b: a & b, filled)).select(*columns)


def payload_chunks(
    df: DataFrame, key: str, order: Sequence[Column], fields: Sequence[str], size: int
) -> DataFrame:
    """JSON arrays of at most ``size`` records per key, for a publisher that takes bounded requests."""
    placed = positions(df, order, "_position", within=[key])
    record = F.struct("_position", F.to_json(F.struct(*fields)).alias("json"))
    records = F.transform(F.array_sort(F.collect_list(record)), lambda r: r["json"])
    return (
        placed.groupBy(key, F.floor((F.col("_position") - 1) / size).alias("chunk"))
        .agg(F.count("*").alias("items"), F.concat(F.lit("["), F.array_join(records, ","), F.lit("]")).alias("payload"))
    )


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``reject_reason``: the first rule a row breaks, NULL for a valid row."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules.items()):
        reason = F.when(broken, name).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def archive(df: DataFrame, doomed: Column, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the rows of one instant to files; returns the rows that stay and the archive read back."""
    df.where(doomed).write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return df.where(~F.coalesce(doomed, F.lit(False))), stored
