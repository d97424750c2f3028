"""Intermediate tables in the shared folder, removed as soon as a later table replaces them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.session import remove, shared_folder, track

FEW_ROWS = 100_000  # rows of a few numbers each that one task reads without further dealing


class Scratch:
    """Tables that survive lost executors. ``drop`` removes one that nothing reads any more; what a result still
    reads stays until ``session.drop_tables`` or the end of the driver."""

    def __init__(self, spark: SparkSession, few_rows: int = FEW_ROWS):
        self.spark, self.few_rows = spark, few_rows
        self.folder = f"{shared_folder(spark)}/granero-{uuid.uuid4().hex}"
        self._count = 0

    def save(self, df: DataFrame, narrow: bool = False) -> DataFrame:
        """Write and read back. A ``narrow`` table (rows of a few numbers) that turns out to have few rows is read
        by one task, so that joins and groups of such tables need no shuffle; its rows are counted first."""
        self._count += 1
        path = f"{self.folder}/{self._count}"
        df.write.parquet(path)
        track(self.spark, path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        few = narrow and saved.count() <= self.few_rows
        if few:
            saved = saved.coalesce(1)
        saved._scratch_path, saved._scratch_few = path, few
        return saved

    def is_few(self, saved: DataFrame) -> bool:
        return saved._scratch_few

    def hinted(self, saved: DataFrame) -> DataFrame:
        """With a broadcast hint if the saved table was counted to have few rows."""
        return F.broadcast(saved) if self.is_few(saved) else saved

    def drop(self, saved: DataFrame) -> None:
        remove(self.spark, saved._scratch_path)
