"""Runs of periodic words: maximal stretches of at least two equal blocks, found tile by tile.

Periods are handled by octave (1 to 7, 8 to 15, 16 to 31, ...). In an octave of stride s every document has a
boundary each s words, and the tile of a boundary reaches s words to its left and s plus the longest period to its
right. A run whose period lies in the octave repeats, at that distance, one of the two blocks of s / 2 words that
touch a boundary inside it; so only tiles where block hashes recur are made into rows (neighbouring ones in one row of
bounded length), dealt over all tasks, and solved each for itself: a Z-function to the right and one to the left of the
boundary give, for every period, how far words equal those one period later. What reaches a tile's edge is a
fragment; fragments are shuffled by document and period and stitched where they meet. Equal stretches of several
periods are one run of the smallest; periods that repeat a shorter one inside a tile are left out there already.

Words are compared by exact codes, hashes only choose tiles. A document without tiles is finished where it is
read: ``columns`` are derived there, and its text is neither written nor shuffled. All intermediate rows are written
to the shared folder, so lost executors cost only their own tasks.

Defined results: words are what stands between ASCII white space. A null, empty or short text has no run and its
words stay. Rows are documents of their own, also where ids repeat or are null. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.llm.scratch import Scratch
from granero.llm.texts import mixed, slices

Prepare = Callable[[int | None, list[bytes]], list[bytes]]
RUNS_TYPE = "array<struct<start: long, period: long, length: long>>"
SCAN_SCHEMA = "row long, doc_id long, tiled boolean, collapsed string, stride long, anchor long, boundaries long, base long, words binary"
FRAGMENT_SCHEMA = "row long, period long, lo long, hi long"
FIRST_STRIDE, FIRST_HIGHEST = 4, 7
TILE_WORDS = 4096  # of the neighbouring tiles that travel as one row; a single tile may be longer


def _octaves(longest: int) -> Iterator[tuple[int, int, int]]:
    """(stride, lowest period, highest period) of all octaves that a document of so many words may need."""
    yield FIRST_STRIDE, 1, FIRST_HIGHEST
    stride = FIRST_HIGHEST + 1
    while 2 * stride <= longest:
        yield stride, stride, 2 * stride - 1
        stride *= 2


def _doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of blocks twice as long; the last ones, which have no second half, count as zero."""
    with np.errstate(over="ignore"):
        both = np.zeros_like(hashes)
        if len(hashes) > size:
            both[:-size] = hashes[:-size] * np.uint64(0x9E3779B97F4A7C15) + (hashes[size:] ^ (hashes[size:] >> np.uint64(29)))
    return both


def tiles(documents: list[np.ndarray], least: int = 12) -> Iterator[tuple[int, int, int, int, int, np.ndarray]]:
    """(document, stride, anchor, boundaries, base, words) of all tiles that may touch a run.

    ``words`` begin at word ``base`` of the document; the first boundary is at ``anchor`` in them.
    """
    owners = np.array([k for k, codes in enumerate(documents) if len(codes) >= least], np.int64)
    if not len(owners):
        return
    sizes = np.array([len(documents[k]) for k in owners], np.int64)
    gaps = np.arange(-1, -1 - len(owners), -1, dtype=np.int64)  # after each document a word of its own, so no repeat crosses
    codes = np.concatenate([part for k, gap in zip(owners, gaps) for part in (documents[k].astype(np.int64), [gap])])
    hashes, size = mixed(codes.view(np.uint64)), 1
    for stride, lowest, highest in _octaves(int(sizes.max())):
        enough = sizes >= 2 * lowest
        if not enough.all():
            keep = np.repeat(enough, sizes + 1)
            codes, hashes, owners, sizes = codes[keep], hashes[keep], owners[enough], sizes[enough]
        starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        block = stride // 2
        while size < block:
            hashes, size = _doubled(hashes, size), 2 * size
        later = np.lib.stride_tricks.sliding_window_view(np.concatenate((hashes, np.zeros(highest + 1, np.uint64))), highest - lowest + 1)
        own = hashes[::block]
        rows = later[lowest::block][: len(own)]
        repeated = np.zeros(len(own), bool)
        step = max(1, (1 << 21) // rows.shape[1])
        for start in range(0, len(own), step):
            repeated[start : start + step] = (rows[start : start + step] == own[start : start + step, None]).any(axis=1)
        hit = np.flatnonzero(repeated)
        if not len(hit):
            continue
        doc = np.searchsorted(starts, hit * block, "right") - 1
        places = np.unique(np.stack((doc, (hit + 1) // 2 * stride), axis=1), axis=0)
        most = max(1, TILE_WORDS // stride)
        new = np.ones(len(places), bool)
        new[1:] = (np.diff(places[:, 0]) != 0) | (np.diff(places[:, 1]) != stride)
        firsts = np.flatnonzero(new)
        for first, stop in zip(firsts.tolist(), [*firsts[1:].tolist(), len(places)]):
            for begin in range(first, stop, most):
                count = min(most, stop - begin)
                k, boundary = int(places[begin, 0]), int(places[begin, 1])
                start, end = int(starts[k]), int(starts[k] + sizes[k])
                lo, hi = max(start, boundary - stride), min(end, boundary + count * stride + highest)
                yield int(owners[k]), stride, boundary - lo, count, lo - start, codes[lo:hi].astype(np.int32)


def z_function(word: array) -> array:
    """For each position, how many symbols from there on equal the first ones."""
    size = len(word)
    out = array("i", bytes(4 * size))
    left = right = 0
    for k in range(1, size):
        known = 0
        if k < right:
            known = out[k - left]
            if known < right - k:
                out[k] = known
                continue
            known = right - k
        while k + known < size and word[known] == word[k + known]:
            known += 1
        out[k] = known
        if k + known > right:
            left, right = k, k + known
    return out


def solve(words: array, stride: int, anchor: int, boundaries: int, least: int = 12) -> dict[int, list[list[int]]]:
    """Fragments ``[lo, hi]`` by period: stretches of this tile where a word equals the one a period later."""
    lowest, highest = (1, FIRST_HIGHEST) if stride == FIRST_STRIDE else (stride, 2 * stride - 1)
    found: dict[int, list[list[int]]] = {}
    for boundary in range(anchor, anchor + boundaries * stride, stride):
        begin, end = max(0, boundary - stride), min(len(words), boundary + highest)
        if boundary >= len(words):
            break
        z = z_function(words[boundary : boundary + stride + highest])
        width = len(z)
        before = words[begin:boundary][::-1]
        back = z_function(before + array("i", [-(1 << 31)]) + words[begin:end][::-1])
        shift = len(before) + 1 + end - boundary
        shorter = [r for r in range(1, min(highest // 2 + 1, width)) if z[r] >= r and z[r] >= lowest - r]
        for period in range(lowest, min(highest, end - boundary) + 1):
            ahead = min(z[period], stride) if period < width else 0
            behind = min(back[shift - period], stride) if period < shift - len(before) else 0
            if ahead < stride and behind < stride and ahead + behind < max(period, least - period):
                continue
            own = next((r for r in shorter if z[r] >= period - r), 0)
            if own and period % own == 0 and own < period:
                continue
            lo, hi = boundary - behind, boundary + ahead
            stretches = found.setdefault(period, [])
            if stretches and stretches[-1][1] >= lo:
                stretches[-1][1] = max(hi, stretches[-1][1])
            else:
                stretches.append([lo, hi])
    return found


def _scan(prepare: Prepare | None, least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            ids = batch.column("doc_id").to_pylist()
            texts = [(text or "").encode().split() for text in batch.column("text").to_pylist()]
            if prepare is not None:
                texts = [prepare(own, words) for own, words in zip(ids, texts)]
            codes = pa.array([word for words in texts for word in words], pa.binary()).dictionary_encode().indices.to_numpy()
            ends = np.cumsum([len(words) for words in texts])
            found = list(tiles(np.split(codes, ends[:-1]) if texts else [], least))
            tiled = {tile[0] for tile in found}
            rows = batch.column("row").to_pylist()
            nothing = [None] * len(rows)
            yield _record(
                rows, ids, [k in tiled for k in range(len(rows))], [b" ".join(words).decode() for words in texts],
                nothing, nothing, nothing, nothing, nothing,
            )
            for start in range(0, len(found), 1024):
                part = found[start : start + 1024]
                empty = [None] * len(part)
                yield _record(
                    [rows[tile[0]] for tile in part], empty, empty, empty, *([tile[k] for tile in part] for k in range(1, 5)),
                    [tile[5].tobytes() for tile in part],
                )

    return run


def _record(*columns: list) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), *[pa.int64()] * 4, pa.binary()]
    names = ["row", "doc_id", "tiled", "collapsed", "stride", "anchor", "boundaries", "base", "words"]
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, types)], names)


def _solve(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, periods, lows, highs = [], [], [], []
            for tile in batch.to_pylist():
                words = array("i", tile["words"])
                for period, stretches in solve(words, tile["stride"], tile["anchor"], tile["boundaries"], least).items():
                    for lo, hi in stretches:
                        rows.append(tile["row"])
                        periods.append(period)
                        lows.append(lo + tile["base"])
                        highs.append(hi + tile["base"])
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()) for values in (rows, periods, lows, highs)], ["row", "period", "lo", "hi"])

    return run


def _collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Take out what repeats: of each run all words after its first period."""
    for batch in slices(batches, "collapsed"):
        texts = []
        for text, runs in zip(batch.column("collapsed").to_pylist(), batch.column("runs").to_pylist()):
            words = text.encode().split()
            change = np.zeros(len(words) + 1, np.int64)
            for one in runs:
                change[one["start"] + one["period"]] += 1
                change[one["start"] + one["length"]] -= 1
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
            texts.append(b" ".join([words[k] for k in kept]).decode())
        yield batch.set_column(batch.schema.get_field_index("collapsed"), "collapsed", pa.array(texts, pa.string()))


def stitch(fragments: DataFrame, least: int = 12) -> DataFrame:
    """(row, runs) from fragments: those of one period that meet or overlap become one stretch of equal words."""
    inside = Window.partitionBy("row", "period").orderBy("lo", "hi")
    reach = F.max("hi").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("_new", F.when(F.col("lo") <= reach, 0).otherwise(1))
    joined = marked.withColumn("_part", F.sum("_new").over(inside)).groupBy("row", "period", "_part").agg(F.min("lo").alias("start"), F.max("hi").alias("_end"))
    long = joined.where(F.col("_end") - F.col("start") >= F.greatest(F.col("period"), least - F.col("period")))
    smallest = long.groupBy("row", "start", (F.col("_end") - F.col("start") + F.col("period")).alias("length")).agg(F.min("period").alias("period"))
    return smallest.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def periodic_runs(
    docs: DataFrame, columns: Mapping[str, Column] | None = None, prepare: Prepare | None = None, least: int = 12
) -> DataFrame:
    """Per document ``doc_id`` and ``columns``, expressions over ``runs`` (start, period, length, in order) and
    ``collapsed`` (the words left when each run keeps one period, joined by spaces); by default these two themselves.

    A run has at least ``least`` words and two periods. ``prepare`` may change a document's words first.
    """
    if columns is None:
        columns = {"runs": F.col("runs"), "collapsed": F.col("collapsed")}
    derived = [column.alias(name) for name, column in columns.items()]
    scratch = Scratch(docs.sparkSession)
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = read.mapInArrow(_scan(prepare, least), SCAN_SCHEMA).withColumn("runs", F.array().cast(RUNS_TYPE))
    clear = F.col("tiled") == F.lit(False)
    finished = [F.when(clear, column).alias(f"_done_{name}") for name, column in columns.items()]
    rest = ["row", "doc_id", "tiled", "stride", "anchor", "boundaries", "base", "words"]
    saved = scratch.save(scanned.select(*rest, F.when(F.col("tiled"), F.col("collapsed")).alias("collapsed"), *finished))
    pieces = saved.where("words IS NOT NULL").select("row", "stride", "anchor", "boundaries", "base", "words")
    # Solving costs far more than the tiles' bytes say, so their tasks are not joined by size.
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = pieces.repartition(tasks, F.xxhash64("row", "stride", "base"))
    runs = stitch(dealt.mapInArrow(_solve(least), FRAGMENT_SCHEMA), least)
    open_ones = saved.where("tiled").select("row", "doc_id", "collapsed").join(runs, "row", "left")
    open_ones = open_ones.withColumn("runs", F.coalesce("runs", F.array().cast(RUNS_TYPE))).select("doc_id", "runs", "collapsed")
    done = saved.where("NOT tiled").select("doc_id", *[F.col(f"_done_{name}").alias(name) for name in columns])
    return done.unionByName(open_ones.mapInArrow(_collapse, f"doc_id long, runs {RUNS_TYPE}, collapsed string").select("doc_id", *derived))
