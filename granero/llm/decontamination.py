"""Benchmark passages inside documents, also with edits: q-gram lemma filtering and banded alignment.

Benchmark items are cut into overlapping windows, so a part of an item is found too: ``quote`` words from every word
on (cut after ``window`` characters), and ``window`` characters every ``stride``. So a quotation of ``quote`` words,
or of a whole shorter item, holds a whole window wherever it starts. Where no space comes for long, windows also
start every few characters. A window of m characters matched with at most k edits shares at least
m - q + 1 - q * k of its q-grams with the document, on diagonals that differ by k at most. Shared q-grams are counted
in overlapping diagonal bands, of which one must hold them all; regions that reach the bound are aligned within the
band, and kept if k edits suffice. As windows overlap much, q-grams are first counted for *stretches* of two windows'
length, by the least bound of their windows; only those that reach it are counted for each window.

The benchmark is the query set. It is read in blocks of bounded size, and every block meets all documents, so
neither a large benchmark nor a long document is cut. Documents are not shuffled.

Defined results: letter case and runs of white space don't count. Null and empty texts hold nothing. Items that
have fewer than ``shortest`` characters after that are left out, as they would be found by chance. Repeated rows
are each searched. An empty benchmark or document table gives no matches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.llm.caches import held, lean
from granero.llm.scratch import Scratch
from granero.llm.texts import code_points, mixed, slices

_FILTER_BITS, _COUNT_BITS = 22, 20
_PAIRS, _ALIGNED = 1 << 18, 1 << 11  # pairs of places and alignments that are worked on at a time
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_TABLES: list[np.ndarray] = []


@dataclass(frozen=True)
class Rules:
    q: int = 8
    edits: float = 0.08  # edits allowed for each character of a window
    window: int = 96
    stride: int = 48
    shortest: int = 24
    quote: int = 13  # words of the shortest quotation that is always found
    inner: int = 16  # characters between the windows that start inside a longer word


def _cuts(text: np.ndarray, rules: Rules) -> list[tuple[int, int]]:
    """Where the windows of an item start and stop, in order."""
    n = len(text)
    last = max(0, n - rules.window)
    cuts = {(cut, min(n, cut + rules.window)) for cut in (*range(0, last + 1, rules.stride), last)}
    inside = np.concatenate(([False], text != 32, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2].tolist(), edges[1::2].tolist()
    least = max(rules.shortest, rules.q)
    for k, start in enumerate(starts):
        if k + rules.quote <= len(starts):
            stop = max(ends[k + rules.quote - 1], start + least)
            cuts.add((start, min(n, stop, start + rules.window)))
        for cut in range(start + rules.inner, min(ends[k], last + 1), rules.inner):
            cuts.add((cut, cut + rules.window))
    return sorted(cut for cut in cuts if cut[1] - cut[0] >= min(n, least, rules.window))


def _lower_and_spaces() -> tuple[np.ndarray, np.ndarray]:
    """Of the basic plane: each character's lower case where that is one character, and which are white space."""
    if not _TABLES:
        chars = [chr(k) for k in range(0x10000)]
        lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], np.uint32)
        _TABLES.extend([lower, np.array([c.isspace() for c in chars])])
    return _TABLES[0], _TABLES[1]


def normalized(points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower case with single spaces; where each character stood; the texts' new bounds. A zero follows each text."""
    lower, spaces = _lower_and_spaces()
    basic = points < 0x10000
    low = np.where(basic, lower[np.where(basic, points, 0)], points)
    space = basic & spaces[np.where(basic, points, 0)]
    low[space] = 32
    first = np.zeros(len(points) + 1, bool)
    first[bounds[:-1]] = True
    before = np.concatenate(([True], space[:-1])) if len(points) else np.zeros(0, bool)
    keep = ~(space & (before | first[: len(points)]))
    new_bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
    at = np.flatnonzero(keep)
    texts = np.insert(low[at], new_bounds[1:], 0)
    places = np.insert(at, new_bounds[1:], bounds[1:])
    return texts, places, new_bounds + np.arange(len(new_bounds))


def grams(texts: np.ndarray, q: int) -> np.ndarray:
    rolled = np.zeros(max(0, len(texts) - q + 1), np.uint64)
    for step in range(q):
        rolled = (rolled + texts[step : step + len(rolled)].astype(np.uint64) + np.uint64(1)) * _FACTOR
        rolled ^= rolled >> np.uint64(29)
    return mixed(rolled)


@dataclass
class Index:
    """Windows of benchmark items, the stretches they lie in, and where the stretches' q-grams stand."""

    items: list[int | None]
    windows: list[np.ndarray]
    budgets: np.ndarray
    needed: np.ndarray
    starts: np.ndarray  # of windows, in the concatenated items, ascending
    sizes: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    stretch_of: np.ndarray
    place_of: np.ndarray  # in the concatenated items
    stretch_starts: np.ndarray
    stretch_budgets: np.ndarray
    stretch_needed: np.ndarray
    sieve: np.ndarray = field(repr=False)

    @classmethod
    def of(cls, items: list[tuple[int | None, str | None]], rules: Rules) -> Index:
        points, bounds = code_points(pa.array([text for _, text in items], pa.string()))
        texts, _, ends = normalized(points, bounds)
        owners, windows, starts, stretch, stretches = [], [], [], [], []
        for (item, _), start, stop in zip(items, ends[:-1].tolist(), (ends[1:] - 1).tolist()):
            if stop - start < max(rules.shortest, rules.q):
                continue
            seen = set()
            for cut, end in _cuts(texts[start:stop], rules):
                window = texts[start + cut : start + end]
                if window.tobytes() in seen:
                    continue
                seen.add(window.tobytes())
                begin = start + cut // rules.window * rules.window
                if not stretches or stretches[-1][0] != begin:
                    stretches.append((begin, min(stop, begin + 2 * rules.window)))
                owners.append(item)
                windows.append(window)
                starts.append(start + cut)
                stretch.append(len(stretches) - 1)
        sizes = np.array([len(w) for w in windows], np.int64)
        budgets = np.floor(sizes * rules.edits).astype(np.int64)
        needed = sizes - rules.q + 1 - rules.q * budgets
        if (needed < 1).any():
            raise ValueError("the edit budget leaves no shared q-gram to count; take a smaller q or fewer edits")
        stretch_budgets, stretch_needed = np.zeros(len(stretches), np.int64), np.full(len(stretches), rules.window, np.int64)
        np.maximum.at(stretch_budgets, np.array(stretch, np.int64), budgets)
        np.minimum.at(stretch_needed, np.array(stretch, np.int64), needed)
        every = grams(texts, rules.q)
        counts = np.array([stop - start - rules.q + 1 for start, stop in stretches], np.int64)
        stretch_starts = np.array([start for start, _ in stretches], np.int64)
        stretch_of = np.repeat(np.arange(len(stretches)), counts)
        place_of = np.arange(len(stretch_of)) + np.repeat(stretch_starts - (np.cumsum(counts) - counts), counts)
        hashes = every[place_of]
        order = np.argsort(hashes, kind="stable")
        unique, first = np.unique(hashes[order], return_index=True)
        sieve = np.zeros(1 << _FILTER_BITS, bool)
        sieve[unique >> np.uint64(64 - _FILTER_BITS)] = True
        return cls(
            owners, windows, budgets, needed, np.array(starts, np.int64), sizes, unique, np.append(first, len(order)),
            stretch_of[order], place_of[order], stretch_starts, stretch_budgets, stretch_needed, sieve,
        )


def align(window: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """Fewest edits of the window against a stretch of the text on diagonals ``low`` to ``high``, and where it ends.

    The stretch may begin and end anywhere on the band. Cells left or right of the text cost more than any budget.
    """
    width = high - low + 1
    steps = np.arange(width)
    far = len(window) + width + 1
    place = low + steps  # in the text, where the next character of each diagonal stands
    row = np.where((place >= 0) & (place <= len(text)), 0, far)
    padded = np.concatenate([np.zeros(max(0, -low), np.uint32), text, np.zeros(max(0, high + len(window) - len(text)), np.uint32)])
    base = low + max(0, -low)
    for i, char in enumerate(window):
        place = low + i + 1 + steps
        inside = (place >= 1) & (place <= len(text))
        stay = row + (padded[base + i : base + i + width] != char)
        drop = np.append(row[1:], far) + 1
        row = np.where(inside, np.minimum(stay, drop), np.where(place == 0, np.minimum(i + 1, drop), far))
        row = np.minimum.accumulate(row - steps) + steps  # characters of the text that the window lacks
        row = np.where(place <= len(text), row, far)
    best = int(row.argmin())
    return int(row[best]), low + len(window) + best


def align_many(windows: list[np.ndarray], texts: list[np.ndarray], lows: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``align`` of many windows at once, each with its own stretch and band of ``widths`` diagonals from ``lows`` on."""
    edits, ends = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
    for at in range(0, len(windows), _ALIGNED):
        some = slice(at, at + _ALIGNED)
        edits[some], ends[some] = _align_some(windows[some], texts[some], lows[some], widths[some])
    return edits, ends


def _align_some(windows: list[np.ndarray], texts: list[np.ndarray], lows: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes, lengths = np.array([len(w) for w in windows]), np.array([len(t) for t in texts])[:, None]
    longest, width = int(sizes.max()), int(widths.max())
    steps = np.arange(width, dtype=np.int32)
    own = steps < widths[:, None]
    far = longest + width + 1
    chars = np.zeros((len(windows), longest), np.uint32)
    around = np.zeros((len(windows), longest + width), np.uint32)  # the text from its band's first diagonal on
    for k, (window, text, low) in enumerate(zip(windows, texts, lows.tolist())):
        chars[k, : len(window)] = window
        part = text[max(0, low) : max(0, low + longest + width)]
        around[k, max(0, -low) : max(0, -low) + len(part)] = part[: longest + width - max(0, -low)]
    place = (lows[:, None] + steps).astype(np.int32)
    row = np.where(own & (place >= 0) & (place <= lengths), 0, far).astype(np.int32)
    edge = np.full((len(windows), 1), far, np.int32)
    for i in range(longest):
        place += 1
        stay = row + (around[:, i : i + width] != chars[:, i : i + 1])
        drop = np.concatenate([row[:, 1:], edge], axis=1) + 1
        new = np.where(place >= 1, np.minimum(stay, drop), np.where(place == 0, np.minimum(i + 1, drop), far))
        new = np.where(own & (place <= lengths), new, far)
        new = np.minimum.accumulate(new - steps, axis=1) + steps
        new = np.where(own & (place <= lengths), new, far)
        row = np.where((i < sizes)[:, None], new, row).astype(np.int32)
    best = row.argmin(axis=1)
    return row[np.arange(len(row)), best], lows + sizes + best


def search(index: Index, texts: np.ndarray, bounds: np.ndarray, rules: Rules) -> list[tuple[int, int, int, int, int]]:
    """(document, window, start, end, edits) of regions in the concatenated texts that match a window."""
    hashes = grams(texts, rules.q)
    at = np.flatnonzero(index.sieve[hashes >> np.uint64(64 - _FILTER_BITS)])
    if not len(at) or not len(index.hashes):
        return []
    slot = np.searchsorted(index.hashes, hashes[at])
    found = (slot < len(index.hashes)) & (index.hashes[np.minimum(slot, len(index.hashes) - 1)] == hashes[at])
    at, slot = at[found], slot[found]
    counts = index.first[slot + 1] - index.first[slot]
    total = np.cumsum(counts)
    entry = np.repeat(index.first[slot] - (total - counts), counts) + np.arange(int(total[-1]) if len(total) else 0)
    place = np.repeat(at, counts)
    stretch, benchmark_place = index.stretch_of[entry], index.place_of[entry]
    diagonal = place - (benchmark_place - index.stretch_starts[stretch]) + 2 * rules.window  # never negative
    # Bands of twice the budget's width, each begun half a band after the last: one holds all of a match.
    band = diagonal // (index.stretch_budgets[stretch] + 1)
    span = len(texts) + 2 * rules.window + 2
    low, high = stretch * span + np.maximum(band - 1, 0), stretch * span + band
    # Counts by a part of the key are never too small, so they already rule out almost all bands.
    mask = (1 << _COUNT_BITS) - 1
    rough = np.bincount(low & mask, minlength=1 << _COUNT_BITS) + np.bincount(high & mask, minlength=1 << _COUNT_BITS)
    enough = index.stretch_needed[stretch]
    near = (rough[low & mask] >= enough) | (rough[high & mask] >= enough)
    place, benchmark_place, stretch, low, high = (x[near] for x in (place, benchmark_place, stretch, low, high))
    unique, counted = np.unique(np.concatenate([low, high]), return_counts=True)
    hit = unique[counted >= index.stretch_needed[unique // span]]
    near = np.isin(low, hit) | np.isin(high, hit)
    # Neighbouring stretches share characters; a pair of places counts once for each window.
    pairs = np.unique(place[near] * (int(index.place_of.max()) + 1) + benchmark_place[near])
    place, benchmark_place = np.divmod(pairs, int(index.place_of.max()) + 1)
    matches: list[tuple[int, int, int, int, int]] = []
    docs = np.searchsorted(bounds, place, "right") - 1
    cut = 0
    while cut < len(place):  # some documents at a time
        stop = max(int(np.searchsorted(docs, docs[min(cut + _PAIRS, len(place)) - 1])), int(np.searchsorted(docs, docs[cut], "right")))
        if cut + _PAIRS >= len(place):
            stop = len(place)
        matches += _matched(index, texts, bounds, rules, place[cut:stop], benchmark_place[cut:stop])
        cut = stop
    return matches


def _matched(index: Index, texts: np.ndarray, bounds: np.ndarray, rules: Rules, place: np.ndarray, benchmark_place: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``search`` from pairs of places, in texts and benchmark, that share a q-gram."""
    first = np.searchsorted(index.starts, benchmark_place - (rules.window - rules.q))
    counts = np.searchsorted(index.starts, benchmark_place, "right") - first
    total = np.cumsum(counts)
    window = np.repeat(first - (total - counts), counts) + np.arange(int(total[-1]) if len(total) else 0)
    place, benchmark_place = np.repeat(place, counts), np.repeat(benchmark_place, counts)
    inside = benchmark_place <= index.starts[window] + index.sizes[window] - rules.q
    window, place, benchmark_place = window[inside], place[inside], benchmark_place[inside]
    diagonal = place - (benchmark_place - index.starts[window]) + rules.window  # never negative
    span = len(texts) + rules.window + 2
    band = diagonal // (index.budgets[window] + 1)
    unique, counted = np.unique(np.concatenate([window * span + band, window * span + np.maximum(band - 1, 0)]), return_counts=True)
    hit = unique[counted >= index.needed[unique // span]]
    # A window that stands unchanged has all its q-grams on one diagonal.
    unique, counted = np.unique(window * span + diagonal, return_counts=True)
    w, start = np.divmod(unique[counted == index.sizes[unique // span] - rules.q + 1], span)
    start = start - rules.window
    matches, exact = [], []
    docs = np.searchsorted(bounds, start, "right") - 1
    for w, start, doc in zip(w.tolist(), start.tolist(), docs.tolist()):
        stop = start + len(index.windows[w])
        if start >= bounds[doc] and stop < bounds[doc + 1] and (texts[start:stop] == index.windows[w]).all():
            matches.append((doc, w, start, stop, 0))
            band = (start + rules.window) // (int(index.budgets[w]) + 1)
            exact += [w * span + band, w * span + max(band - 1, 0)]
    tried = []
    for key in hit[~np.isin(hit, np.array(exact, np.int64))].tolist():
        w, band = divmod(key, span)
        half, size = int(index.budgets[w]) + 1, len(index.windows[w])
        low = band * half - rules.window
        high = low + 2 * half - 1
        # The documents that the region lies in; a separator inside ends the region.
        for doc in range(max(0, int(np.searchsorted(bounds, low, "right")) - 1), min(len(bounds) - 1, int(np.searchsorted(bounds, high + size, "right")))):
            start, stop = int(bounds[doc]), int(bounds[doc + 1]) - 1
            origin = max(start, low - half)
            text = texts[origin : min(stop, high + size + half)]
            if len(text) >= size - half:
                tried.append((doc, w, origin, text, low - half - origin, 4 * half))
    if not tried:
        return matches
    windows = [index.windows[x[1]] for x in tried]
    edits, ends = align_many(windows, [x[3] for x in tried], np.array([x[4] for x in tried]), np.array([x[5] for x in tried]))
    kept = np.flatnonzero(edits <= index.budgets[[x[1] for x in tried]]).tolist()
    if kept:
        # The same alignment backwards from the end gives the start.
        halves = np.array([tried[k][5] // 4 for k in kept])
        backward = [tried[k][3][: ends[k]][::-1] for k in kept]
        _, lengths = align_many([windows[k][::-1] for k in kept], backward, 1 - halves, 2 * halves - 1)
        for k, length in zip(kept, lengths.tolist()):
            doc, w, origin = tried[k][:3]
            matches.append((doc, w, origin + int(ends[k]) - length, origin + int(ends[k]), int(edits[k])))
    return matches


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int | None, str | None]]]:
    block: list[tuple[int | None, str | None]] = []
    chars = 0
    for item, text in benchmark.select(item_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        block.append((item, text))
        chars += len(text)
        if chars >= block_chars:
            yield block
            block, chars = [], 0
    if block:
        yield block


def _index_of(key: str, block: list[tuple[int | None, str | None]], rules: Rules) -> Index:
    return held(("benchmark", key), lambda: Index.of(block, rules))


def _searched(batch: pa.RecordBatch, index: Index, rules: Rules) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, np.ndarray]:
    points, bounds = code_points(batch.column("text"))
    texts, places, ends = normalized(points, bounds)
    return search(index, texts, ends, rules), places, bounds


def find_passages(
    docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), block_chars: int = 1 << 20,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, start, length, edits): stretches of the documents' own code points that match an item.

    Matches of overlapping windows of one item are joined; ``edits`` is the largest number in one of them.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, start long, length long, edits int"
    parts = [source.mapInArrow(lean(_finder(block, rules)), schema) for block in _blocks(benchmark, item_col, item_text_col, block_chars)]
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def _finder(block: list[tuple[int | None, str | None]], rules: Rules):
    key = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            index = _index_of(key, block, rules)
            matches, places, bounds = _searched(batch, index, rules)
            joined: list[list[int]] = []
            spans = [(d, index.items[w], s, e, n) for d, w, s, e, n in matches]
            for doc, item, start, end, edits in sorted(spans, key=lambda m: (m[0], m[1] is None, m[1] or 0, *m[2:])):
                last = joined[-1] if joined else None
                if last and last[0] == doc and last[1] == item and start <= last[3]:
                    last[3], last[4] = max(last[3], end), max(last[4], edits)
                else:
                    joined.append([doc, item, start, end, edits])
            ids = batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([ids[m[0]] for m in joined], pa.int64()), pa.array([m[1] for m in joined], pa.int64()),
                    pa.array([int(places[m[2]] - bounds[m[0]]) for m in joined], pa.int64()),
                    pa.array([int(places[m[3] - 1] + 1 - places[m[2]]) for m in joined], pa.int64()),
                    pa.array([m[4] for m in joined], pa.int32()),
                ],
                ["doc_id", "item_id", "start", "length", "edits"],
            )

    return run


def _marker(block: list[tuple[int | None, str | None]], rules: Rules):
    key = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            hit = {m[0] for m in _searched(batch, _index_of(key, block, rules), rules)[0]}
            yield batch.select(["r1", "r2"]).filter(pa.array([k in hit for k in range(batch.num_rows)], pa.bool_()))

    return run


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, rules: Rules = Rules(), block_chars: int = 1 << 20,
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that hold no passage of the benchmark.

    Only texts go to the search, which sends back 128 bits of hash for each text with a passage.
    """
    text = F.col(text_col)
    r1, r2 = F.xxhash64(text), F.xxhash64(F.lit(1), text)
    source = docs.select(r1.alias("r1"), r2.alias("r2"), text.alias("text"))
    parts = [source.mapInArrow(lean(_marker(block, rules)), "r1 long, r2 long") for block in _blocks(benchmark, item_col, item_text_col, block_chars)]
    if not parts:
        return docs
    marked = reduce(DataFrame.unionByName, parts).distinct()
    scratch = Scratch(docs.sparkSession)
    found = scratch.hinted(scratch.save(marked, narrow=True))
    rows = docs.select(F.struct("*").alias("row"), r1.alias("r1"), r2.alias("r2"))
    left = rows.join(found, ["r1", "r2"], "left_anti")
    return left.select(*[F.col("row")[name].alias(name) for name in docs.columns])
