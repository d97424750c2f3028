"""Vectorised text helpers that run inside tasks, on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers of it can be inverted modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}

# Words end at a space or one of the five ASCII controls from tab to carriage return.
SPACES = "[\\x20\\x09-\\x0D]"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of a piece stays below ``limit`` bytes (one longer text stays whole)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and where each text starts and the last one ends."""
    texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = values ^ np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(kind: str, n: int) -> np.ndarray:
    table = _POWERS.get(kind)
    if table is None or len(table) < n:
        base = _MULTIPLIER if kind == "up" else _INVERSE
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        table = _POWERS[kind] = np.multiply.accumulate(table)
    return table[:n]


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and where each text's words start and the last one's end.

    The hash is a polynomial over the word's bytes, so equal words have equal hashes wherever they stand.
    """
    data, offsets = buffer_of(texts)
    if lower:
        data = _LOWER[data]
    # A separator after each text keeps its last word apart from the next text's first.
    padded = np.insert(data, offsets[1:], 32) if len(offsets) > 1 else data
    offsets = offsets + np.arange(len(offsets))
    inside = ~_IS_SPACE[padded]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside)).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    with np.errstate(over="ignore"):
        terms = (padded.astype(np.uint64) + np.uint64(1)) * _powers("up", len(padded))
        terms[~inside] = 0
        sums = np.add.reduceat(terms, starts) * _powers("down", len(padded))[starts]
        hashes = mixed(sums + (ends - starts).astype(np.uint64) * _MULTIPLIER)
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles of ``size`` words, sorted; a shorter text is one shingle, an empty one none."""
    out: list[np.ndarray] = []
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for step in range(size):
            rolled = mixed(rolled * _MULTIPLIER + words[step : step + len(rolled)], size)
        for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            n = stop - start
            if n >= size:
                out.append(np.unique(rolled[start : stop - size + 1]))
            elif n:
                value = np.zeros(1, np.uint64)
                for word in words[start:stop]:
                    value = mixed(value * _MULTIPLIER + word, n)
                out.append(value)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts one after another, and where each text starts and the last one ends."""
    values = ["" if text is None else text for text in texts.to_pylist()]
    bounds = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(value) for value in values], out=bounds[1:])
    return np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32), bounds
