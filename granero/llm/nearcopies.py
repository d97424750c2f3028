"""Near copies by min-max hashing.

Each permutation of the shingle hashes gives two signature values, the smallest and the largest, so ``rows *
bands`` values cost half as many hash evaluations. The share of equal values estimates the Jaccard similarity.
Bands of ``rows`` values make candidates; links are confirmed on the full shingle sets.

Documents with equal shingle sets are one *node* from the start, so copies never meet in pairs. Within a bucket
of nodes that share a band, every node is compared with two centres: the one that meets most others, which is likely
the origin of its group, and one drawn for this bucket, so that a node's buckets try many. What is linked is
contracted into one component. What still lies apart in a bucket is compared exactly: nodes outside the largest
component of their cluster of buckets against all of the cluster, in blocks. So a group of near copies costs a few
comparisons a node and those of its strays, and no link between candidates is lost.

Defined results: words are what stands between ASCII white space, A-Z in lower case. A text with fewer words
than a shingle is one shingle; a null text or one without words has no shingle and is linked with nothing. Rows
are documents of their own, also where ids repeat; null ids count as larger than all others, so a component of
only such rows has a null ``component_id``. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm import components
from granero.llm.caches import lean, release
from granero.llm.scratch import FEW_ROWS, Scratch
from granero.llm.texts import mixed, shingle_hashes, slices, word_hashes

ROWS, BANDS = 6, 40  # two documents of similarity 0.85 share no band with a chance of 6e-9, of 0.8 with 5e-6
BLOCK_HELD, BLOCK_ASKED = 1024, 256  # nodes of a block, and strays that meet them
BLOCK_SHINGLES = 4_000_000  # of a block that are sorted at a time
ESTIMATE_SLACK = 0.15  # more than five standard deviations of the estimate from 240 values


def _columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own, text = F.col(id_col), F.col(text_col)
    return docs.select(
        own.cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(own, text).alias("r1"), F.xxhash64(F.lit(1), text, own).alias("r2"),
    )


def _digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, whatever the order of its members."""
    with np.errstate(over="ignore"):
        both = [(mixed(s, 11).sum(dtype=np.uint64), mixed(s, 23).sum(dtype=np.uint64)) for s in sets]
    table = np.array(both, np.uint64).reshape(-1, 2).view(np.int64)
    return table[:, 0], table[:, 1]


def signatures(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """One row per set: the smallest values under all permutations, then the largest. Sets must not be empty."""
    rng = np.random.default_rng(20240229)
    factors = rng.integers(0, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, permutations, np.uint64)
    out = np.empty((len(sets), 2 * permutations), np.uint64)
    if sets:
        starts = np.cumsum([0, *map(len, sets[:-1])])
        members = np.concatenate(sets)
        for k in range(permutations):
            # A product with an odd number is a permutation of all 64-bit integers.
            moved = members * factors[k] + shifts[k]
            out[:, k] = np.minimum.reduceat(moved, starts)
            out[:, permutations + k] = np.maximum.reduceat(moved, starts)
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    keys = np.zeros((len(values), values.shape[1] // rows), np.uint64)
    for band in range(keys.shape[1]):
        folded = np.full(len(values), band + 1, np.uint64)
        for column in range(band * rows, (band + 1) * rows):
            folded = mixed(folded * np.uint64(0x9E3779B97F4A7C15) + values[:, column])
        keys[:, band] = folded
    return keys


def sign(docs: DataFrame, shingle: int, rows: int, bands: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's set size, set digest, band keys and one byte of each signature value."""
    permutations = rows * bands // 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in slices(batches, "text", 2 << 20):
            sets = shingle_hashes(*word_hashes(batch.column("text")), shingle)
            filled = [k for k, s in enumerate(sets) if len(s)]
            values = signatures([sets[k] for k in filled], permutations)
            keys = np.zeros((len(sets), bands), np.int64)
            keys[filled] = band_keys(values, rows).view(np.int64)
            marks = np.zeros((len(sets), 2 * permutations), np.uint8)
            marks[filled] = mixed(values).astype(np.uint8)
            d1, d2 = _digests(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("r1"), batch.column("r2"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(d1), pa.array(d2),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), pa.array(keys.ravel())),
                    pa.array([row.tobytes() for row in marks], pa.binary()),
                ],
                ["doc_id", "r1", "r2", "n_shingles", "d1", "d2", "keys", "marks"],
            )

    return _columns(docs, id_col, text_col).mapInArrow(
        lean(run), "doc_id long, r1 long, r2 long, n_shingles long, d1 long, d2 long, keys array<long>, marks binary"
    )


def _sets_of(docs: DataFrame, nodes: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(node, members): the full shingle sets of nodes, from the text of one of their rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            sets = shingle_hashes(*word_hashes(batch.column("text")), shingle)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "members"]
            )

    texts = _columns(docs, id_col, text_col).join(nodes.select("node", "r1", "r2"), ["r1", "r2"])
    return texts.select("node", "text").dropDuplicates(["node"]).mapInArrow(lean(run), "node long, members binary")


def _with_both(pairs: DataFrame, values: DataFrame, names: list[str], few: bool) -> DataFrame:
    """Pairs with ``names`` of both nodes, as ``<name>_a`` and ``<name>_b``; few pairs go to the values, not these to them."""
    one = values.toDF("a", *(f"{name}_a" for name in names))
    two = values.toDF("b", *(f"{name}_b" for name in names))
    if few:
        return one.join(F.broadcast(pairs), "a").join(two.join(F.broadcast(pairs), "b"), ["a", "b"])
    # Centres are few and stand on side a, so values travel once for each pair of side b only.
    return pairs.join(two, "b").join(one, "a")


def _estimated(pairs: DataFrame, nodes: DataFrame, least: float, few: bool) -> DataFrame:
    """Pairs whose estimated similarity is high enough to be worth a comparison of the full sets."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("marks_a", "marks_b"))
                yield batch.select(["a", "b"]).filter(pa.array((one == two).mean(axis=1) >= least))

    both = _with_both(pairs, nodes.select("node", "n_shingles", "marks"), ["n", "marks"], few)
    # Sets whose sizes differ by more than the similarity allows need no comparison.
    sized = both.where(F.least("n_a", "n_b") >= F.lit(least) * F.greatest("n_a", "n_b"))
    return sized.select("a", "b", "marks_a", "marks_b").mapInArrow(lean(run), "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, few: bool) -> DataFrame:
    """Pairs whose full sets have at least ``percent`` of their union in common."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(batch.column("members_a"), batch.column("members_b")):
                first, second = (np.frombuffer(m.as_buffer(), np.uint64) for m in (one, two))
                merged = np.sort(np.concatenate([first, second]), kind="stable")
                common = int((merged[1:] == merged[:-1]).sum())
                linked.append(100 * common >= percent * (len(merged) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    joined = _with_both(pairs, sets, ["members"], few)
    return joined.select("a", "b", "members_a", "members_b").mapInArrow(lean(run), "a long, b long")


def _block_links(held: pd.DataFrame, asked: pd.DataFrame, percent: int) -> pd.DataFrame:
    """One link of each asked node to each component that a held node close enough to it belongs to.

    Intersections with all held sets come from one sorted list of their shingles, a few million at a time.
    """
    out: list[tuple[int, int]] = []
    sets = [np.frombuffer(m, np.uint64) for m in held["members"]]
    ends = np.cumsum([len(one) for one in sets])
    start = 0
    while start < len(sets):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_SHINGLES, "right")))
        part = sets[start:stop]
        sizes = np.array([len(one) for one in part])
        shingles, rows = np.concatenate(part), np.repeat(np.arange(len(part)), sizes)
        order = np.argsort(shingles, kind="stable")
        shingles, rows = shingles[order], rows[order]
        nodes, comps = held["node"].to_numpy()[start:stop], held["comp"].to_numpy()[start:stop]
        for node, comp, members in zip(asked["node"], asked["comp"], asked["members"]):
            own = np.frombuffer(members, np.uint64)
            low, high = np.searchsorted(shingles, own, "left"), np.searchsorted(shingles, own, "right")
            counts = high - low
            at = np.repeat(low - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
            common = np.bincount(rows[at], minlength=len(part))
            close = np.flatnonzero((100 * common >= percent * (len(own) + sizes - common)) & (comps != comp))
            if len(close):
                _, first = np.unique(comps[close], return_index=True)
                out += [(node, int(nodes[k])) for k in close[first]]
        start = stop
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _rest_links(scratch: Scratch, open_rows: DataFrame, alive: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): all further links between components of nodes that share an open bucket.

    Nodes that hang together by open buckets are a *cluster*. Its nodes outside the component that most of its
    nodes belong to are the query set, and meet all of its nodes in blocks of bounded size; small clusters share
    a block. Blocks compare full sets and send back links only.
    """
    first = open_rows.groupBy("key").agg(F.min("node").alias("a"))
    edges = open_rows.join(first, "key").select("a", F.col("node").alias("b"))
    single = scratch.save(alive.select("node", F.col("node").alias("comp")), narrow=True)
    clusters = components.merge(scratch, single, edges).withColumnRenamed("comp", "cluster")
    placed = scratch.save(alive.join(clusters, "node"), narrow=True)
    shares = placed.groupBy("cluster", "comp").agg(F.count("*").alias("rows"))
    sizes = shares.groupBy("cluster").agg(F.sum("rows").alias("size"), F.max(F.struct("rows", "comp")).alias("top")).select(
        "cluster", "size", F.col("top.comp").alias("most"), (F.col("size") - F.col("top.rows")).alias("others")
    )
    small = F.col("size") <= BLOCK_HELD
    bundles = placed.count() // BLOCK_HELD + 1
    group = F.when(small, -1 - F.pmod(F.xxhash64("cluster"), F.lit(bundles))).otherwise(F.col("cluster"))
    held_blocks = F.when(small, 1).otherwise(F.ceil(F.col("size") / BLOCK_HELD)).cast("int")
    asked_blocks = F.when(small, 1).otherwise(F.ceil(F.col("others") / BLOCK_ASKED)).cast("int")
    sized = placed.join(sizes.where("others > 0"), "cluster").select(
        group.alias("group"), "node", "comp", (F.col("comp") != F.col("most")).alias("asks"),
        held_blocks.alias("held_blocks"), asked_blocks.alias("asked_blocks"),
    )
    rows = scratch.save(sized.join(sets, "node"))

    def own(blocks: str) -> Column:
        return F.pmod(F.xxhash64("node"), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    columns = ["node", "comp", "members"]
    held = rows.select("group", own("held_blocks").alias("held"), every("asked_blocks").alias("asked"), *columns)
    asked = rows.where("asks").select("group", every("held_blocks").alias("held"), own("asked_blocks").alias("asked"), *columns)

    def run(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        return _block_links(one, two, percent)

    keys = ["group", "held", "asked"]
    links = scratch.save(held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, "a long, b long"), narrow=True)
    for old in (placed, rows):
        scratch.drop(old)
    return links


def _merged(scratch: Scratch, labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after links between nodes joined their components; ``links`` is dropped."""
    named = links.join(labels.toDF("a", "comp_a"), "a").join(labels.toDF("b", "comp_b"), "b")
    merged = components.merge(scratch, labels, named.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    scratch.drop(links)
    return merged


def _label(scratch: Scratch, docs: DataFrame, nodes: DataFrame, shingle: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(node, comp) of all nodes that share a band with another one."""
    keyed = nodes.select("node", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("_low"), F.max("node").alias("_high"), F.count("*").alias("size")).where("_low < _high")
    met_once = scratch.save(keyed.join(shared.select("key", "size"), "key"))
    # A node that meets most others is the likeliest origin of a group of copies, and the best centre.
    weights = met_once.groupBy("node").agg(F.sum("size").alias("weight"))
    members = scratch.save(met_once.join(weights, "node").select("key", "node", "weight", "n"), narrow=True)
    scratch.drop(met_once)
    labels = scratch.save(members.select("node").distinct().select("node", F.col("node").alias("comp")), narrow=True)
    busy = nodes.join(labels.select("node"), "node", "left_semi")
    sets = scratch.save(_sets_of(docs, busy, shingle, id_col, text_col))
    busy = scratch.save(busy.select("node", "n_shingles", "marks"))
    row = F.struct("weight", "node", "n")
    leaders = members.groupBy("key").agg(F.max(row).alias("first"), F.max(F.struct(F.xxhash64("node", "key"), row.alias("row"))).alias("any"))
    centres = scratch.save(
        leaders.select("key", F.explode(F.array_distinct(F.array("first", "any.row"))).alias("c"))
        .select("key", F.col("c.node").alias("a"), F.col("c.n").alias("n_a")),
        narrow=True,
    )
    sized = 100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")
    met = members.join(centres, "key").where((F.col("node") != F.col("a")) & sized)
    pairs = scratch.save(met.select(F.greatest("a", "node").alias("a"), F.least("a", "node").alias("b")).distinct(), narrow=True)
    close = scratch.save(_estimated(pairs, busy, percent / 100 - ESTIMATE_SLACK, scratch.is_few(pairs)), narrow=True)
    links = scratch.save(_confirmed(close, sets, percent, scratch.is_few(close)), narrow=True)
    labels = _merged(scratch, labels, links)
    for old in (pairs, close):
        scratch.drop(old)
    # A centre was compared with all of its bucket.
    rest = members.join(centres.select("key", F.col("a").alias("node")), ["key", "node"], "left_anti").join(labels, "node")
    several = rest.groupBy("key").agg(F.min("comp").alias("_low"), F.max("comp").alias("_high")).where("_low < _high")
    open_rows = scratch.save(rest.join(several.select("key"), "key").select("key", "node", "comp"), narrow=True)
    alive = scratch.save(open_rows.select("node", "comp").distinct(), narrow=True)
    if not alive.isEmpty():
        labels = _merged(scratch, labels, _rest_links(scratch, open_rows, alive, sets, percent))
    scratch.drop(open_rows)
    for old in (members, centres, alive, sets, busy):
        scratch.drop(old)
    return labels


def near_copies(
    docs: DataFrame, shingle: int = 5, percent: int = 80, rows: int = ROWS, bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text",
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, r1, r2, n_shingles, component_id, keeper).

    ``component_id`` is the smallest id of the component. ``keeper`` marks the row that represents it: the one
    with the smallest id, ties by the hash of id and text (``r1``, ``r2``), rows equal in both alike.
    """
    scratch = Scratch(docs.sparkSession, few_rows)
    signed = scratch.save(sign(docs, shingle, rows, bands, id_col, text_col))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "r1", "r2")).alias("best")
    groups = signed.where("n_shingles > 0").groupBy("d1", "d2").agg(
        best, F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("marks").alias("marks")
    )
    nodes = scratch.save(
        groups.select("d1", "d2", "best", F.col("best.r1").alias("r1"), F.col("best.r2").alias("r2"), "n_shingles", "keys", "marks")
        .withColumn("node", F.monotonically_increasing_id())
    )
    labels = _label(scratch, docs, nodes, shingle, percent, id_col, text_col)
    placed = nodes.select("node", "d1", "d2", "best").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    tops = placed.groupBy("comp").agg(F.min("best").alias("top"))
    named = scratch.save(placed.join(tops, "comp").select("d1", "d2", "top"))
    rows_in = signed.select("doc_id", "r1", "r2", "n_shingles", "d1", "d2")
    found = rows_in.where("n_shingles > 0").join(named, ["d1", "d2"]).select(
        "doc_id", "r1", "r2", "n_shingles", F.col("top.doc_id").alias("component_id"),
        ((F.col("r1") == F.col("top.r1")) & (F.col("r2") == F.col("top.r2"))).alias("keeper"),
    )
    empty = rows_in.where("n_shingles = 0").select("doc_id", "r1", "r2", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("keeper"))
    return found.unionByName(empty)


def _has_word(text: Column) -> Column:
    return F.coalesce(text.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each component left; rows without words all stay."""
    found = near_copies(docs, shingle, percent, id_col=id_col, text_col=text_col)
    keepers = found.where("keeper AND n_shingles > 0").select("r1", "r2").distinct()
    own, text = F.col(id_col), F.col(text_col)
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(own, text).alias("r1"), F.xxhash64(F.lit(1), text, own).alias("r2"), _has_word(text).alias("worded"))
    kept = rows.where("worded").join(keepers, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"])
    left = kept.select("row").unionByName(rows.where("NOT worded").select("row"))
    return left.select(*[F.col("row")[name].alias(name) for name in docs.columns])
