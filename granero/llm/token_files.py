"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on document ids.

Defined results: a null text is an empty one, whose ids are the end id alone. Null document ids come first.
Rows that share a document id stand next to each other, ordered by their text. An empty table gives files
without rows. Only the two named columns are read, so extra columns of any name don't matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granero.llm.texts import slices
from granero.llm.tokens import encoder

FILE_SCHEMA = "shard int, doc_id long, start_in_shard long, n_tokens long, ids array<int>"


def encode_sorted(docs: DataFrame, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document in ascending order of ids, each partition a shard with its own running start.

    Texts are dealt by ranges of (id, hash of text), so also an id that many rows share is spread.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = source.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", 2 << 20):
            flat, bounds = encoder(vocabulary, end_id).encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(batch.num_rows, shard, np.int32)), batch.column("doc_id"),
                    pa.array(before + bounds[:-1]), pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.astype(np.int32))),
                ],
                ["shard", "doc_id", "start_in_shard", "n_tokens", "ids"],
            )
            before += int(bounds[-1])

    return ordered.mapInArrow(encode, FILE_SCHEMA)


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
    stripe_bytes: int = 16 << 20, row_index_stride: int = 1000, false_positives: float = 0.01,
) -> None:
    """Encode and write. ORC packs the ids by run-length encoding (version 2) within stripes of bounded size,
    indexes every ``row_index_stride`` rows, and keeps a Bloom filter on ``doc_id`` for each of those row groups."""
    options = {
        "compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": str(row_index_stride),
        "orc.stripe.size": str(stripe_bytes), "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": str(false_positives),
    }
    encode_sorted(docs, vocabulary, end_id, id_col, text_col).write.options(**options).orc(path)


def read_token_files(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The rows of the files; a condition on ``doc_id`` skips stripes and row groups by statistics and Bloom filters."""
    rows = spark.read.schema(FILE_SCHEMA).orc(path)
    return rows if where is None else rows.where(where)


def with_starts(rows: DataFrame) -> DataFrame:
    """Add ``start``: how many ids all documents before this one have. Reads only counts to find the shards' offsets."""
    # One row per shard of the files, so this window over all of them is as small as the list of files.
    earlier = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard").agg(F.sum("n_tokens").alias("_n")).select(
        F.col("shard").alias("_shard"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        rows.join(F.broadcast(offsets), F.col("shard") == F.col("_shard"))  # 12 bytes for each shard
        .withColumn("start", F.col("_offset") + F.col("start_in_shard")).drop("_shard", "_offset")
    )


def with_checksums(rows: DataFrame) -> DataFrame:
    """Replace ``ids`` by ``ids_crc32``: the checksum of the ids as little-endian unsigned 32-bit integers."""
    names = [name for name in rows.columns if name != "ids"]

    def checksums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(start, 1000) for whole in batches for start in range(0, whole.num_rows, 1000)):
            lists = batch.column("ids")
            bounds = lists.offsets.to_numpy()
            values = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).to_numpy(zero_copy_only=False)
            data, bounds = memoryview(np.ascontiguousarray(values, "<u4")).cast("B"), bounds - bounds[0]
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sums, pa.int64())], [*names, "ids_crc32"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(checksums, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", ids_crc32 long")
