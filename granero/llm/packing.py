"""Cost-balanced packing of tokenized documents into sequences of one length.

A document of n tokens costs ``linear * n + quadratic * n * n`` in attention. Whole stretches of the sequence
length fill sequences of their own. The rest of each document goes, in descending order of cost, to the sequence
of lowest cost that still has room for it; where none has, it is cut at the room of the one with the lowest cost.
As many sequences are opened as the tokens need. What is left over when the full ones are counted off goes to
sequences of lengths that are powers of two, which need no padding, so every sequence is full.

Each task packs its own rows, a batch of bounded size at a time: nothing is shuffled, and no source, group of
copies or long document can gather in one task. Which documents share a sequence depends on the partitions.

Defined results: a null or empty text is the end id alone. Repeated rows are packed each for itself. Ties in
cost go by position in the batch, then to the sequence opened first. An empty table gives no pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.llm.caches import lean
from granero.llm.texts import slices
from granero.llm.tokens import encoder

PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def balanced(sizes: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents with these token counts."""
    pieces, sequences, waiting = [], 0, []
    for doc, size in enumerate(sizes):
        for start in range(0, size - capacity + 1, capacity):
            pieces.append((doc, start, capacity, sequences, 0))
            sequences += 1
        if rest := size % capacity:
            waiting.append((-rest, doc, size - rest))
    full, left = divmod(sum(-rest for rest, _, _ in waiting), capacity)
    lengths = [capacity] * full + [1 << bit for bit in reversed(range(left.bit_length())) if left >> bit & 1]
    room, cost = np.array(lengths, np.int64), np.zeros(len(lengths))
    heapq.heapify(waiting)
    while waiting:
        negative, doc, start = heapq.heappop(waiting)
        size = -negative
        fits = room >= size
        if not fits.any():  # cut: fill the cheapest sequence with room, and queue the rest as a smaller piece
            fits = room > 0
        best = int(np.where(fits, cost, np.inf).argmin())
        length = min(size, int(room[best]))
        pieces.append((doc, start, length, sequences + best, lengths[best] - int(room[best])))
        room[best] -= length
        cost[best] += linear * length + quadratic * length * length
        if length < size:
            heapq.heappush(waiting, (length - size, doc, start + length))
    return pieces


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 2048, linear: float = 1.0,
    quadratic: float = 1 / 1024, batch_docs: int = 4096, batch_tokens: int = 4 << 20, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of documents with their place: every token of every text and its end id in exactly one piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers. Sequence ids are unique over all tasks.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_sequence = TaskContext.get().partitionId() << 40
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        sizes: list[int] = []

        def packed() -> pa.RecordBatch:
            nonlocal next_sequence
            pieces = balanced(sizes, capacity, linear, quadratic)
            first = np.cumsum([0, *sizes])
            data = memoryview(np.concatenate(parts).astype("<u4")).cast("B")
            ids = [data[4 * (first[d] + s) : 4 * (first[d] + s + n)].tobytes() for d, s, n, _, _ in pieces]
            table = np.array(pieces, np.int64).reshape(-1, 5)
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_ids[d] for d in table[:, 0].tolist()], pa.int64()), pa.array(table[:, 1]), pa.array(table[:, 2]),
                    pa.array(np.array(sizes, np.int64)[table[:, 0]]), pa.array(next_sequence + table[:, 3]), pa.array(table[:, 4]),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )
            next_sequence += int(table[:, 3].max()) + 1
            doc_ids.clear(), parts.clear(), sizes.clear()
            return batch

        for batch in slices(batches, "text", 2 << 20):
            flat, bounds = encoder(vocabulary, end_id).encode(batch.column("text").to_pylist())
            doc_ids += batch.column("doc_id").to_pylist()
            sizes += np.diff(bounds).tolist()
            parts.append(flat)
            if len(sizes) >= batch_docs or sum(map(len, parts)) >= batch_tokens:
                yield packed()
        if sizes:
            yield packed()

    return source.mapInArrow(lean(run), PIECE_SCHEMA)
