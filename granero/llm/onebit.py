"""Nearest neighbours by largest inner product, from randomly rotated one-bit codes.

Vectors are scaled to length one and rotated; the signs of the rotated components are a vector's code, packed to
bits, with its length and its inner product with the code as correction scalars. For a query q and a code c of a
vector with correction a, <q, c> / a is an unbiased estimate of the inner product with the scaled vector, and its
error stays below ``width * sqrt((1 - a * a) / (a * a) / (d - 1))`` with high probability. A vector is compared
exactly if the upper end of its estimate reaches the k-th best lower end in its block.

Rows are indexed in blocks of bounded size by the tasks that read them. The queries of a bundle of blocks meet each
block of codes in a group of their own, so groups stay small however many queries or alike vectors there are; each
group sends the best k of each query on. The work grows with queries times rows.

Defined results: rows with a null id, a null or zero vector, a null or non-finite component, or another number
of components than most rows have take no part. Rows are candidates for each other also where ids repeat; only
the query's own row is left out. Equal scores go to the smaller id. Fewer candidates than k are all returned.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granero.llm.scratch import Scratch

BLOCK_ROWS = 8192
BUNDLE = 32  # blocks whose queries meet a block of codes together
_PARTS = ("ids", "bits", "lengths", "fits", "vectors", "places", "query_ids", "query_vectors")
WIDTH = 3.0  # standard errors on either side of an estimate


def rotation(size: int, seed: int = 17) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and inner products of each scaled vector with its code."""
    lengths = np.sqrt((vectors * vectors).sum(axis=1))
    turned = (vectors / lengths[:, None]) @ turn
    return np.packbits(turned > 0, axis=1), lengths, np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def estimates(queries: np.ndarray, bits: np.ndarray, lengths: np.ndarray, fits: np.ndarray, turn: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of all queries with all coded vectors, and the error bounds."""
    size = queries.shape[1]
    signs = (np.unpackbits(bits, axis=1, count=size).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(size))
    guess = ((queries @ turn).astype(np.float32) @ signs.T) * (lengths / fits).astype(np.float32)
    spread = lengths * np.sqrt(np.maximum(1 - fits * fits, 0) / (fits * fits) / max(1, size - 1)) * width
    error = np.sqrt((queries * queries).sum(axis=1))[:, None].astype(np.float32) * spread.astype(np.float32)
    return guess, error + np.float32(1e-5)


def usual_size(vectors: DataFrame, vector_col: str) -> int | None:
    sizes = vectors.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("size")).count()
    top = sizes.where("size > 0").orderBy(F.desc("count"), "size").first()
    return None if top is None else int(top["size"])


def index(vectors: DataFrame, size: int, query_rule: str, id_col: str, vector_col: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block: ids, codes and scalars of its vectors, the vectors themselves, and the queries among them."""
    turn = rotation(size)
    own, vector = F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")
    usable = vectors.select(own.alias("vec_id"), vector.alias("vector"), F.expr(query_rule).alias("asks")).where(
        F.col("vec_id").isNotNull() & (F.size("vector") == size) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for batch in _rows(batches, block_rows):
            table = batch.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            bits, lengths, fits = encode(table, turn)
            places = np.flatnonzero(np.array(batch.column("asks").to_pylist(), bool))
            ids = batch.column("vec_id").to_numpy().astype(np.int64)
            parts = (ids, bits, lengths, fits, table, places.astype(np.int64), ids[places], table[places])
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), *(pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts)], ["block", *_PARTS]
            )
            block += 1

    return usable.mapInArrow(run, "block long, " + ", ".join(f"{name} binary" for name in _PARTS))


def _rows(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, most - count)
            batch = batch.slice(part.num_rows)
            held.append(part)
            count += part.num_rows
            if count == most:
                yield pa.Table.from_batches(held)
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _search(stored: pd.DataFrame, asked: pd.DataFrame, size: int, k: int, width: float) -> pd.DataFrame:
    turn = rotation(size)
    out: list[tuple[np.ndarray, ...]] = []
    for s in stored.itertuples():
        ids, table = np.frombuffer(s.ids, np.int64), np.frombuffer(s.vectors, np.float64).reshape(-1, size)
        bits = np.frombuffer(s.bits, np.uint8).reshape(len(ids), -1)
        lengths, fits = np.frombuffer(s.lengths, np.float64), np.frombuffer(s.fits, np.float64)
        for a in asked.itertuples():
            which, query_ids = np.frombuffer(a.places, np.int64), np.frombuffer(a.query_ids, np.int64)
            queries = np.frombuffer(a.query_vectors, np.float64).reshape(-1, size)
            for start in range(0, len(which), 512):
                guess, error = estimates(queries[start : start + 512], bits, lengths, fits, turn, width)
                if a.query_block == s.block:  # the query's own row
                    guess[np.arange(len(guess)), which[start : start + 512]] = -np.inf
                low = guess - error
                least = np.partition(low, max(0, low.shape[1] - k), axis=1)[:, max(0, low.shape[1] - k)]
                chosen = (guess + error >= least[:, None]) & np.isfinite(guess)
                for row in range(len(guess)):
                    near = np.flatnonzero(chosen[row])
                    # The same order of additions for every vector, so that equal vectors have equal scores.
                    exact = (table[near] * queries[start + row]).sum(axis=1)
                    best = np.lexsort((ids[near], -exact))[:k]
                    own = np.full(len(best), query_ids[start + row])
                    place = np.full(len(best), (a.query_block << 20) + which[start + row])
                    out.append((own, place, ids[near][best], exact[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0)] * 4
    return pd.DataFrame(dict(zip(("query_id", "query_row", "vec_id", "score"), columns)))


def nearest(
    vectors: DataFrame, query_rule: str, k: int = 20, width: float = WIDTH, block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each row for which the SQL condition ``query_rule`` holds."""
    spark = vectors.sparkSession
    size = usual_size(vectors, vector_col)
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    scratch = Scratch(spark)
    raw = scratch.save(index(vectors, size, query_rule, id_col, vector_col, block_rows))
    # One small row for each block, numbered without gaps.
    numbers = raw.select(F.col("block").alias("old"), F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("block")).alias("number"))
    blocks = scratch.save(raw.join(numbers, raw["block"] == numbers["old"]).drop("old", "block").withColumnRenamed("number", "block"))
    count = max(1, blocks.count())
    bundles, bundle = (count - 1) // BUNDLE + 1, F.floor((F.col("block") - 1) / BUNDLE).cast("int")
    stored = blocks.select("block", "ids", "bits", "lengths", "fits", "vectors", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"))
    asked = blocks.where(F.length("places") > 0).select(
        F.col("block").alias("query_block"), bundle.alias("bundle"), "places", "query_ids", "query_vectors",
        F.explode(F.sequence(F.lit(1), F.lit(count))).alias("block"),
    )

    def run(held: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        return _search(held, queries, size, k, width)

    found = stored.groupBy("block", "bundle").cogroup(asked.groupBy("block", "bundle")).applyInPandas(
        run, "query_id long, query_row long, vec_id long, score double"
    )
    window = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
