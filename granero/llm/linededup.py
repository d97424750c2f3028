"""Reversible line dedup: exact reference counts of line keys, and cuckoo filters of the frequent ones by shard.

The *reference table* counts, for each line key, the documents that hold it. It is exact; adding documents adds
to it, deleting documents subtracts, and a key without documents leaves it, so any history of insertions and
deletions ends in the same table as a fresh count. The *filters*, one per shard of keys, hold the keys found in
at least ``min_docs`` documents. They pass a line on in constant time and few bytes; what passes is confirmed
against the reference table, so false positives never drop a line.

Defined results: a null or empty text is one empty line. A line's key is the line without ASCII white space at
its ends, A-Z in lower case. Keys shorter than ``min_length`` code points are never dropped. Every row counts as
a document of its own, also where ids repeat or are null. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm.caches import lean, release
from granero.session import cut_lineage

_SPACES = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = str.maketrans(_UPPER, _LOWER)
SHARDS = 64  # default number of filter shards
GROUP_ROWS = 100_000  # (document, key) rows that meet a filter in one group; a shard with more is dealt over several
SLOTS, MAX_KICKS = 4, 500


class CuckooFilter:
    """16-bit fingerprints in buckets of four, each key at home in two buckets; keys are 64-bit hashes."""

    def __init__(self, capacity: int):
        buckets = 1
        while buckets * SLOTS * 0.85 < max(capacity, 1):
            buckets *= 2
        self.table = np.zeros((buckets, SLOTS), np.uint16)

    @staticmethod
    def _mix(values: np.ndarray) -> np.ndarray:
        return (values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.asarray(keys, np.int64).view(np.uint64)
        prints = ((keys >> np.uint64(48)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
        mask = np.uint64(len(self.table) - 1)
        first = keys & mask
        return prints, first, (first ^ self._mix(prints)) & mask

    def insert(self, key: int) -> bool:
        """False if the filter is too full; it must then be built anew with more room."""
        prints, first, second = self.places(np.array([key], np.int64))
        fingerprint, bucket = int(prints[0]), int(first[0])
        for place in (bucket, int(second[0])):
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = fingerprint
                return True
        mask = len(self.table) - 1
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            evicted = int(self.table[bucket, slot])
            self.table[bucket, slot] = fingerprint
            fingerprint = evicted
            bucket = (bucket ^ int(self._mix(np.array([fingerprint], np.uint16))[0])) & mask
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = fingerprint
                return True
        return False

    def delete(self, key: int) -> bool:
        """Take out one copy of a key that was inserted; False if its fingerprint isn't there."""
        prints, first, second = self.places(np.array([key], np.int64))
        for place in (int(first[0]), int(second[0])):
            there = np.flatnonzero(self.table[place] == prints[0])
            if len(there):
                self.table[place, there[0]] = 0
                return True
        return False

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(keys)
        at = prints[:, None]
        return (self.table[first] == at).any(axis=1) | (self.table[second] == at).any(axis=1)

    @classmethod
    def of(cls, keys: Iterable[int], room: int) -> CuckooFilter:
        keys = list(keys)
        while True:
            built = cls(max(room, len(keys)))
            if all(built.insert(key) for key in keys):
                return built
            room = 2 * max(room, len(keys))

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        built = cls(0)
        built.table = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return built


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACES)), _UPPER, _LOWER)


def distinct_keys(text: Column, min_length: int) -> Column:
    """A text's distinct line keys, in order of first appearance; keys too short to be dropped become empty."""
    keys = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), line_key)
    return F.array_distinct(F.transform(keys, lambda key: F.when(F.length(key) >= min_length, key).otherwise("")))


def _pairs(docs: DataFrame, min_length: int, text_col: str, *extra: Column) -> DataFrame:
    """One row for each document and distinct key: 128 bits of hash stand for the key."""
    pairs = docs.select(*extra, F.posexplode(distinct_keys(F.col(text_col), min_length)).alias("idx", "text_key"))
    return pairs.where(F.col("text_key") != "").select(
        *[F.col(name) for name in pairs.columns if name != "text_key"],
        F.xxhash64("text_key").alias("hash"), F.xxhash64(F.lit(1), F.col("text_key")).alias("check"),
    )


def count_references(docs: DataFrame, min_length: int = 1, text_col: str = "text") -> DataFrame:
    """(hash, check, refs): the documents that hold each key. Tasks add up their own before the shuffle."""
    return _pairs(docs, min_length, text_col).groupBy("hash", "check").agg(F.count("*").alias("refs"))


def merge_references(references: DataFrame, change: DataFrame, sign: int) -> DataFrame:
    """The table after documents with these counts were added (``sign`` 1) or deleted (-1)."""
    both = references.unionByName(change.withColumn("refs", F.col("refs") * sign))
    return both.groupBy("hash", "check").agg(F.sum("refs").alias("refs")).where(F.col("refs") != 0)


def _shard(shards: int) -> Column:
    return F.pmod(F.col("hash"), F.lit(shards)).cast("int")


def build_filters(references: DataFrame, min_docs: int, shards: int = SHARDS) -> DataFrame:
    """(shard, filter): every shard with a frequent key gets the filter of its frequent keys."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        hashes = np.unique(group["hash"].to_numpy())
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "filter": [CuckooFilter.of(hashes.tolist(), len(hashes)).to_bytes()]})

    frequent = references.where(F.col("refs") >= min_docs).select(_shard(shards).alias("shard"), "hash")
    return frequent.groupBy("shard").applyInPandas(build, "shard int, filter binary")


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, min_docs: int, shards: int = SHARDS) -> DataFrame:
    """Filters after a change of the reference table: only keys that crossed ``min_docs`` are inserted or deleted.

    A filter that becomes too full is built anew from the exact table's keys of its shard.
    """
    old = before.where(F.col("refs") >= min_docs).select("hash", "check")
    new = after.where(F.col("refs") >= min_docs).select("hash", "check")
    risen = new.join(old, ["hash", "check"], "left_anti").select(_shard(shards).alias("shard"), "hash", F.lit(1).alias("change"))
    fallen = old.join(new, ["hash", "check"], "left_anti").select(_shard(shards).alias("shard"), "hash", F.lit(-1).alias("change"))
    kept = new.join(old, ["hash", "check"], "left_semi").select(_shard(shards).alias("shard"), "hash", F.lit(0).alias("change"))

    def update(changes: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        shard = int((changes if len(changes) else stored)["shard"].iloc[0])
        current = CuckooFilter.from_bytes(stored["filter"].iloc[0]) if len(stored) else CuckooFilter(0)
        hashes, change = changes["hash"].to_numpy(np.int64), changes["change"].to_numpy()
        for key in hashes[change < 0].tolist():
            current.delete(key)
        if not all(current.insert(key) for key in hashes[change > 0].tolist()):
            present = hashes[change >= 0].tolist()
            current = CuckooFilter.of(present, 2 * len(present))
        return pd.DataFrame({"shard": [shard], "filter": [current.to_bytes()]})

    changes = risen.unionByName(fallen).unionByName(kept)
    return changes.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(update, "shard int, filter binary")


def frequent_keys_of(
    docs: DataFrame, references: DataFrame, filters: DataFrame, min_docs: int, min_length: int = 1,
    shards: int = SHARDS, group_rows: int = GROUP_ROWS, text_col: str = "text", key: tuple[Column, Column] | None = None,
) -> DataFrame:
    """(r1, r2, dropped): for each document that holds frequent keys, their places in ``distinct_keys``.

    The (document, key) rows meet the filter of their shard. A shard's rows are dealt over as many groups as its
    reference counts ask for, each with a copy of the filter, so a line found everywhere does not gather in one
    task. Rows that pass are confirmed by a join with the exact table, whose hot keys Spark splits at run time.
    """
    loads = (
        references.groupBy(_shard(shards).alias("shard")).agg(F.sum("refs").alias("rows"))
        .select("shard", F.ceil(F.col("rows") / group_rows).cast("int").alias("groups"))
    )
    groups = {row["shard"]: row["groups"] for row in loads.collect()}  # at most ``shards`` rows
    dealt = F.element_at(F.array(*[F.lit(max(1, groups.get(shard, 1))) for shard in range(shards)]), F.col("shard") + 1)
    r1, r2 = key or row_key(text_col)
    rows = (
        _pairs(docs, min_length, text_col, r1.alias("r1"), r2.alias("r2")).withColumn("shard", _shard(shards))
        .withColumn("group", F.pmod(F.xxhash64("r1", "hash"), dealt).cast("int"))
    )
    copies = filters.withColumn("group", F.explode(F.sequence(F.lit(0), dealt - 1)))

    def passed(batch: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
        release()
        columns = ["r1", "r2", "idx", "hash", "check"]
        if not len(stored) or not len(batch):
            return batch[columns].iloc[:0]
        return batch.loc[CuckooFilter.from_bytes(stored["filter"].iloc[0]).contains(batch["hash"].to_numpy(np.int64)), columns]

    candidates = (
        rows.groupBy("shard", "group").cogroup(copies.groupBy("shard", "group"))
        .applyInPandas(passed, "r1 long, r2 long, idx int, hash long, check long")
    )
    frequent = references.where(F.col("refs") >= min_docs).select("hash", "check")
    confirmed = candidates.join(frequent, ["hash", "check"])
    return confirmed.groupBy("r1", "r2").agg(F.collect_set("idx").alias("dropped"))


def row_key(text_col: str, id_col: str | None = "doc_id") -> tuple[Column, Column]:
    """128 bits that stand for a row's id and text; rows equal in both are treated alike anyway."""
    own = F.col(id_col) if id_col else F.lit(0)
    return F.xxhash64(own, F.col(text_col)), F.xxhash64(F.lit(1), F.col(text_col), own)


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = 10, min_length: int = 1, shards: int = SHARDS, group_rows: int = GROUP_ROWS,
    id_col: str = "doc_id", text_col: str = "text", references: DataFrame | None = None, filters: DataFrame | None = None,
) -> DataFrame:
    """All rows, with ``kept_text``, ``n_lines`` (before) and ``n_dropped`` added; columns of these names are replaced.

    ``references`` and ``filters`` may come from earlier batches; otherwise these documents are counted alone.
    """
    rows = _cut_rows(docs, min_docs, min_length, shards, group_rows, id_col, text_col, references, filters)
    added = ["kept_text", "n_lines", "n_dropped"]
    return rows.select(*[F.col("row")[name].alias(name) for name in docs.columns if name not in added], *added)


def cut_documents(
    docs: DataFrame, min_docs: int = 10, min_length: int = 1, shards: int = SHARDS, group_rows: int = GROUP_ROWS,
    id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars",
) -> DataFrame:
    """All rows and columns, in which only the text is cut and ``chars_col``, where there is one, counted anew."""
    rows = _cut_rows(docs, min_docs, min_length, shards, group_rows, id_col, text_col, None, None)
    fresh = {text_col: F.col("kept_text"), chars_col: F.length("kept_text").cast("long")}
    return rows.select(*[fresh.get(name, F.col("row")[name]).alias(name) for name in docs.columns])


def _cut_rows(
    docs: DataFrame, min_docs: int, min_length: int, shards: int, group_rows: int, id_col: str, text_col: str,
    references: DataFrame | None, filters: DataFrame | None,
) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped), with a document's own columns inside ``row``."""
    if references is None:
        references = cut_lineage(count_references(docs, min_length, text_col))
    if filters is None:
        filters = cut_lineage(build_filters(references, min_docs, shards))
    found = frequent_keys_of(docs, references, filters, min_docs, min_length, shards, group_rows, text_col, row_key(text_col, id_col))
    r1, r2 = row_key(text_col, id_col)
    work = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), r1.alias("r1"), r2.alias("r2"))
    joined = work.join(found, ["r1", "r2"], "left").select("row", "text", "dropped")

    def cut(text: str, dropped: set[int]) -> tuple[str, int]:
        places: dict[str, int] = {}
        kept = []
        lines = text.split("\n")
        for line in lines:
            key = line.strip(_SPACES).translate(_TO_LOWER)
            place = places.setdefault(key if len(key) >= min_length else "", len(places))
            if place not in dropped:
                kept.append(line)
        return "\n".join(kept), len(lines) - len(kept)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, gone = [], [], []
            for text, dropped in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist()):
                kept, n = (text or "", 0) if not dropped else cut(text, set(dropped))
                texts.append(kept)
                counts.append((text or "").count("\n") + 1)
                gone.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                ["row", "kept_text", "n_lines", "n_dropped"],
            )

    row = dict(joined.dtypes)["row"]
    return joined.mapInArrow(lean(run), f"row {row}, kept_text string, n_lines long, n_dropped long")
