"""Phrase collocations by prefix-free parsing.

Texts are cut into overlapping chunks at places that their own words choose (a hash of three neighbouring words), so
repeated passages give the same chunks. The distinct chunks with their frequencies are the dictionary; all counting
is done on it, weighted. A chunk ends with the words that follow it, up to the longest phrase less one, and a phrase
belongs to the chunk in which it begins, so overlaps are counted once.

Two passes over the dictionary count phrases. The first counts words and pairs by 64-bit hash and marks those that
reach ``least`` in one bit table of fixed size. The second counts, by their exact words, only words and phrases whose
words and pairs are all marked: a phrase is never more frequent than a pair in it. Marks may be shared by hash, which
only lets some rare phrases be counted too; no frequent one is missed. Each task adds up equal phrases first, so one
very common pair is one entry a task, however often it stands. Phrases travel in blocks, dealt by hash over shards whose
number follows the dictionary; a shard's blocks are added up in one group of bounded size.

``least`` is a number and not a share, so in a larger corpus more pairs reach it and the second pass counts more phrases a word.

Defined results: A-Z are lowered, pieces end at ``. , ; : ! ?`` and at ASCII line controls, words at spaces and tabs.
Null texts have no words; rows without a language count as ``und``. Repeated rows count each. Ties between cuts go
to the shortest first part, ties between phrases to the phrase in byte order. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granero.llm.scratch import Scratch
from granero.llm.texts import mixed, slices

LONGEST = 5  # words of a phrase
CHUNK = 32  # words of a chunk, on average
WORDS_OF_SHARD = 500_000  # of the dictionary, whose frequent phrases are merged in one group
TABLE_BITS = 27  # of the marks: 16 MB, whatever the input
_BREAK, _CHUNK_END, _CONTEXT = b"\xff", b"\xfe", b"\xfd"  # never part of UTF-8
_LOWERED = bytes(255 if chr(k) in ".,;:!?\n\x0b\x0c\r" else 32 if k == 9 else k + 32 if 65 <= k <= 90 else k for k in range(256))
_M = np.uint64(0x9E3779B97F4A7C15)


def _coded(tokens: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the tokens, and the distinct tokens by number."""
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _hashes(distinct: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(token) for token in distinct), np.uint64, len(distinct))


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(left * _M + right, 5)


def _chunks(average: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            marked = [(text or b"").translate(_LOWERED).replace(_BREAK, b" \xff ") for text in texts]
            tokens = b" \xfe ".join([*marked, b""]).split(b" ")
            tokens = list(filter(None, tokens))
            if not tokens:
                continue
            codes, distinct = _coded(tokens)
            number = {token: k for k, token in enumerate(distinct)}
            is_break, is_end = codes == number.get(_BREAK, -1), codes == number.get(_CHUNK_END, -1)
            own = _hashes(distinct)[codes]
            three = np.zeros(len(codes), np.uint64)
            three[2:] = _pair(_pair(own[:-2], own[1:-1]), own[2:])
            cut = three % np.uint64(average) == 0
            cut[1:] &= three[1:] != three[:-1]  # one word over and over is not cut at each of them
            # A chunk starts after each cut and at each document; ends themselves belong to no chunk.
            begins = np.zeros(len(codes), bool)
            begins[0] = True
            begins[1:] = cut[:-1] | is_end[:-1]
            begins &= ~is_end
            starts = np.flatnonzero(begins)
            ends = np.flatnonzero(is_end)
            document = np.searchsorted(ends, starts)
            stops = np.minimum(np.append(starts[1:], len(codes)), ends[document])
            stop_of_piece = np.flatnonzero(is_break | is_end)
            follow = np.minimum(stop_of_piece[np.searchsorted(stop_of_piece, stops - 1)], stops + LONGEST - 1)
            langs = batch.column("lang").take(pa.array(document))
            breaks = np.concatenate(([0], np.cumsum(is_break)))
            sizes = stops - starts - (breaks[stops] - breaks[starts])
            chunks = [
                b" ".join(tokens[a:b]) if b >= c else b" ".join([*tokens[a:b], _CONTEXT, *tokens[b:c]])
                for a, b, c in zip(starts.tolist(), stops.tolist(), follow.tolist())
            ]
            yield pa.RecordBatch.from_arrays([langs, pa.array(chunks, pa.binary()), pa.array(sizes, pa.int64())], ["lang", "chunk", "size"])

    return run


class _Words:
    """The words of a batch of chunks: codes, which begin a phrase of their chunk, and how many follow in their piece."""

    def __init__(self, batch: pa.RecordBatch):
        chunks = batch.column("chunk").to_pylist()
        tokens = b" \xfe ".join([*chunks, b""]).split(b" ")[:-1]
        self.codes, self.distinct = _coded(tokens)
        number = {token: k for k, token in enumerate(self.distinct)}
        is_end, is_context, is_break = (self.codes == number.get(mark, -1) for mark in (_CHUNK_END, _CONTEXT, _BREAK))
        chunk = np.cumsum(is_end) - is_end
        after = np.cumsum(is_context)
        first = np.concatenate(([0], np.flatnonzero(is_end)[:-1] + 1)) if is_end.any() else np.zeros(0, np.int64)
        own = after == (after[first] - is_context[first])[chunk]
        word = ~(is_end | is_context | is_break)
        # The mark between a chunk and what follows it is no border for phrases; leave it out before neighbours are read.
        kept = ~is_context
        self.codes, self.own, self.word, self.chunk = self.codes[kept], (own & word)[kept], word[kept], chunk[kept]
        borders = np.flatnonzero(~self.word)
        self.room = borders[np.searchsorted(borders, np.arange(len(self.codes)))] - np.arange(len(self.codes)) if len(borders) else np.zeros(len(self.codes), np.int64)
        self.weights = batch.column("times").to_numpy()[self.chunk]
        langs = batch.column("lang").dictionary_encode()
        self.langs, self.lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()[self.chunk]
        seeds = _hashes([name.encode() for name in self.langs])
        self.hashes = mixed(_hashes(self.distinct)[self.codes] + seeds[self.lang])

    def pairs(self) -> np.ndarray:
        """Hash of each word and the next one."""
        return _pair(self.hashes, np.append(self.hashes[1:], np.uint64(0)))


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the place of one of each, and the sum of its weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], order[first], np.add.reduceat(weights[order], first) if len(keys) else weights[:0]


def _count_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_keys, held_counts, waiting = [], [], 0
    for batch in slices(batches, "chunk", 2 << 20):
        words = _Words(batch)
        two = words.own & (words.room > 1)
        keys = np.concatenate((words.hashes[words.own], words.pairs()[two]))
        keys, _, counts = _added(keys, np.concatenate((words.weights[words.own], words.weights[two])))
        held_keys.append(keys)
        held_counts.append(counts)
        waiting += len(keys)
        if waiting > 3_000_000:
            yield _key_batch(held_keys, held_counts)
            held_keys, held_counts, waiting = [], [], 0
    if waiting:
        yield _key_batch(held_keys, held_counts)


def _key_batch(keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    key, _, count = _added(np.concatenate(keys), np.concatenate(counts))
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(count, pa.int64())], ["key", "times"])


def _count_phrases(marks: bytes, shards: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(marks, np.uint8)

        def marked(hashes: np.ndarray) -> np.ndarray:
            place = hashes & np.uint64((len(table) << 3) - 1)
            return (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        counts: dict[tuple[str, bytes], int] = {}
        for batch in slices(batches, "chunk", 2 << 20):
            words = _Words(batch)
            known = marked(words.hashes) & words.word
            linked = known & (words.room > 1)
            linked[:-1] &= known[1:]
            linked &= marked(words.pairs())
            at = np.flatnonzero(words.own & known)
            # Exact numbers of phrases: number of the shorter phrase and code of the next word, numbered anew each time.
            numbers = words.codes[at].astype(np.int64) * len(words.langs) + words.lang[at]
            for length in range(1, LONGEST + 1):
                if length > 1:
                    more = linked[at + length - 2]
                    at, numbers = at[more], numbers[more]
                    if not len(at):
                        break
                    numbers = np.unique(numbers, return_inverse=True)[1].astype(np.int64) * len(words.distinct) + words.codes[at + length - 1]
                _, places, sums = _added(numbers, words.weights[at])
                for place, times in zip(at[places].tolist(), sums.tolist()):
                    phrase = b" ".join([words.distinct[code] for code in words.codes[place : place + length].tolist()])
                    key = words.langs[words.lang[place]], phrase
                    counts[key] = counts.get(key, 0) + times
            if len(counts) > 300_000:
                yield _phrase_batch(counts, shards)
                counts = {}
        if counts:
            yield _phrase_batch(counts, shards)

    return run


def _phrase_batch(counts: dict[tuple[str, bytes], int], shards: int) -> pa.RecordBatch:
    """A block of phrases and their counts for each language and shard."""
    blocks: dict[tuple[str, int], tuple[list[str], list[int]]] = {}
    for (lang, phrase), times in counts.items():
        phrases, numbers = blocks.setdefault((lang, xxhash.xxh3_64_intdigest(phrase) % shards), ([], []))
        phrases.append(phrase.decode())
        numbers.append(times)
    langs, owners = zip(*blocks)
    phrases, numbers = zip(*blocks.values())
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(owners, pa.int32()), pa.array(phrases, pa.list_(pa.string())), pa.array(numbers, pa.list_(pa.int64()))],
        ["lang", "shard", "phrases", "numbers"],
    )


def _merge_blocks(least: int):
    def run(key: tuple[pa.Scalar, ...], blocks: pa.Table) -> pa.Table:
        rows = pa.table({"phrase": blocks.column("phrases").combine_chunks().flatten(), "times": blocks.column("numbers").combine_chunks().flatten()})
        sums = rows.group_by("phrase").aggregate([("times", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("times_sum"), least))
        return pa.table({"lang": pa.repeat(key[0], len(sums)), "phrase": sums.column("phrase"), "times": sums.column("times_sum")})

    return run


def _marks(keys: DataFrame, bits: int) -> bytes:
    """One bit table of the frequent keys, built by Spark in parts of 4 KB; ``2 ** (bits - 3)`` bytes reach the driver."""
    place = (F.col("key").bitwiseAND((1 << bits) - 1) + 1).alias("place")
    parts = keys.select(place).groupBy(F.bitmap_bucket_number("place").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    table = bytearray(1 << (bits - 3))
    for row in parts.toLocalIterator():
        table[(row.part - 1) << 12 : row.part << 12] = row.bits
    return bytes(table)


def dictionary(docs: DataFrame, average: int = CHUNK) -> DataFrame:
    """(lang, chunk, times, size): the distinct chunks of the prefix-free parse and how many words are their own. A mark
    inside tells where the words of the next chunk begin, which are there only as context."""
    read = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    parsed = read.mapInArrow(_chunks(average), "lang string, chunk binary, size long")
    return parsed.groupBy("lang", "chunk").agg(F.count("*").alias("times"), F.max("size").alias("size"))


def frequent_phrases(docs: DataFrame, least: int = 100, scratch: Scratch | None = None, bits: int = TABLE_BITS) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, times) of all words and phrases of up to five words found ``least`` times or more,
    (lang, n) with the number of all words)."""
    scratch = scratch or Scratch(docs.sparkSession)
    chunks = scratch.save(dictionary(docs))
    read = chunks.select("lang", "chunk", "times")
    counted = read.mapInArrow(_count_hashes, "key long, times long").repartition("key").groupBy("key").agg(F.sum("times").alias("times"))
    marks = _marks(counted.where(F.col("times") >= least), bits)
    totals = scratch.save(chunks.groupBy("lang").agg(F.sum(F.col("times") * F.col("size")).alias("n"), F.sum("size").alias("held")))
    # Shards in proportion to the dictionary, so that one task merges a bounded number of phrases whatever the input.
    shards = 1 + (totals.agg(F.sum("held")).first()[0] or 0) // WORDS_OF_SHARD
    blocks = read.mapInArrow(_count_phrases(marks, shards), "lang string, shard int, phrases array<string>, numbers array<long>")
    frequent = blocks.groupBy("lang", "shard").applyInArrow(_merge_blocks(least), "lang string, phrase string, times long")
    sized = scratch.save(frequent.withColumn("words", F.size(F.split("phrase", " "))))
    totals = totals.select("lang", "n")
    return sized, totals


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, bits: int = TABLE_BITS) -> DataFrame:
    """Per language its ``top`` phrases of two to five words by the score of their weakest cut, ``1000 * a * n / (l * r)``.

    A phrase that stands inside a longer one every time is left out.
    """
    counts, totals = frequent_phrases(docs, least, bits=bits)
    candidates = counts.where("words > 1")
    words = F.split("phrase", " ")
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", F.col("times").alias("a"), "words", cut).select(
        "lang", "phrase", "a", "words", "k",
        F.array_join(F.slice(words, 1, F.col("k")), " ").alias("_left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("words")), " ").alias("_right"),
    )
    lefts = counts.select("lang", F.col("phrase").alias("_left"), F.col("times").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("_right"), F.col("times").alias("r"))
    full = cuts.join(lefts, ["lang", "_left"]).join(rights, ["lang", "_right"]).join(totals, "lang")
    exact = "decimal(19,0)"
    above = (F.lit(1000) * F.col("a")).cast(exact) * F.col("n").cast(exact)
    scored = full.withColumn("score", F.call_function("div", above, F.col("l").cast(exact) * F.col("r").cast(exact)).cast("long"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("_cut"))
    # A phrase as frequent as a longer one is as frequent as one of the two that are one word longer around it.
    shorter = candidates.where("words > 2").select(
        "lang", F.col("times").alias("_times"),
        F.explode(F.array(F.array_join(F.slice(words, 1, F.col("words") - 1), " "), F.array_join(F.slice(words, 2, F.col("words")), " "))).alias("phrase"),
    ).groupBy("lang", "phrase").agg(F.max("_times").alias("_longer"))
    free = weakest.join(shorter, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (F.col("_longer") < F.col("_cut.a")))
    order = Window.partitionBy("lang").orderBy(F.desc("_cut.score"), F.desc("_cut.a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "_cut.a", "_cut.l", "_cut.r", "_cut.n", "_cut.score")
