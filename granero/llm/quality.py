"""Quality by perplexity: an interpolated modified Kneser-Ney model of four-character grams, learned from trusted text.

Counts, continuation counts, discounts and back-off weights are Spark tables keyed by the gram; they grow with
the trusted text and are never gathered in one place. Documents are not exploded into grams either. Each task
cuts its rows into *blocks* of bounded size and sends every distinct gram of a block once. These meet the sharded
model tables in joins, one for each order, and the log-probabilities come back to their block, where the texts
wait in compressed form. So what is shuffled is the model, a few grams for each block, and the texts once.

A document's score is its mean negative log-probability for each character, drawn towards its language's mean
while it is short. Documents above a quantile of their language's trusted scores, plus a margin, are rejected.

Four characters don't see whole words, so words that repeat are judged by themselves: a document's *repeats* are the
share of its words that equal the word before or end a two-word phrase that stood at most ``PHRASE_LAG`` words earlier,
drawn towards its language's share while it has few words. They have a threshold of the same kind. Words end at white
space, so repetition inside a text without any is not seen.

Defined results: a null or empty text has score 0 pseudo-counts only (its language's mean) and is kept. A null
language is a language of its own. Documents of a language without trusted documents are kept, unjudged: their
thresholds are null, as the model has never seen such text. Without any trusted
document nothing is rejected. Repeated rows and null ids are scored each for itself.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm.caches import give_back, lean, release
from granero.llm.scratch import Scratch
from granero.llm.texts import code_points, slices, word_hashes

ORDER = 4
_BITS = 16  # of each character in a packed gram; code points beyond the basic plane are folded into it
BEGIN, END = 2, 3  # control characters that stand before and after each text
BLOCK_BYTES = 32 << 20
PHRASE_LAG = 8
BROADCAST_IDS = 2_000_000  # trusted or rejected rows up to which their ids are broadcast (16 MB); else they are joined

_BLOCK_COLUMNS = "block long, part int"
_SCORED = {
    "doc_id": "long", "r1": "long", "r2": "long", "lang": "string", "trusted": "boolean", "n": "long", "nll": "double",
    "words": "long", "repeats": "long",
}


def packed_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each character of each text and at its end mark, and where each text's grams start."""
    points, bounds = code_points(texts)
    folded = np.where(points < 0x10000, points, (points * np.uint32(40503)) & np.uint32(0xFFFF)).astype(np.int64)
    # Each text gets ORDER - 1 begin marks before and one end mark after it.
    starts = bounds[:-1] + np.arange(len(bounds) - 1) * ORDER
    chars = np.full(len(folded) + ORDER * (len(bounds) - 1), BEGIN, np.int64)
    own = np.ones(len(chars), bool)
    for shift in range(ORDER - 1):
        own[starts + shift] = False
    ends = bounds[1:] + np.arange(1, len(bounds)) * ORDER - 1
    chars[ends] = END
    inner = own.copy()
    inner[ends] = False
    chars[inner] = folded
    grams = np.zeros(len(chars), np.int64)
    for back in range(ORDER):
        grams[ORDER - 1 :] |= chars[ORDER - 1 - back : len(chars) - back] << (_BITS * back)
    return grams[own], bounds + np.arange(len(bounds))


def repeated_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many words each text has, and how many equal the word before or end a phrase that stood shortly before."""
    words, bounds = word_hashes(texts)
    text_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    repeats = np.zeros(len(words), bool)
    for lag in range(1, PHRASE_LAG + 1):
        same = (words[lag:] == words[:-lag]) & (text_of[lag:] == text_of[:-lag])
        if lag > 1:
            same[1:] &= same[:-1].copy()
            same[:1] = False
        repeats[lag:] |= same
    sums = np.concatenate(([0], np.cumsum(repeats)))[bounds]
    return np.diff(bounds), np.diff(sums)


def _blocked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Slices of a task's rows with the number of their block and a number of their own.

    A row's block follows from the bytes of the texts before it, so it is the same however rows come in batches.
    """
    first, part, before = TaskContext.get().partitionId() << 24, 0, 0
    for batch in slices(batches, "text", 1 << 20):
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        blocks = (before + np.cumsum(sizes) - sizes) // BLOCK_BYTES
        edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        for start, stop in zip(edges, edges[1:]):
            yield first + int(blocks[start]), part, batch.slice(start, stop - start)
            part += 1
        before += int(sizes.sum())


def block_grams(source: DataFrame) -> DataFrame:
    """(block, grams, trusted): each block's distinct grams, and how often its trusted rows have them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        current, seen, counts = None, np.zeros(0, np.int64), np.zeros(0, np.int64)

        def row() -> pa.RecordBatch:
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in (seen, counts)]
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), *lists], ["block", "grams", "trusted"])

        for block, _, batch in _blocked(batches):
            if current is not None and block != current:
                yield row()
                seen, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
            current = block
            grams, bounds = packed_grams(batch.column("text"))
            here = np.repeat(np.array(batch.column("trusted").to_pylist(), bool), np.diff(bounds))
            own, sums = np.unique(grams[here], return_counts=True)
            rest = np.unique(grams[~here])
            merged = np.unique(np.concatenate([seen, own, rest]))
            total = np.zeros(len(merged), np.int64)
            total[np.searchsorted(merged, seen)] += counts
            total[np.searchsorted(merged, own)] += sums
            seen, counts = merged, total
        if current is not None:
            yield row()

    return source.select("text", "trusted").mapInArrow(lean(run), "block long, grams array<long>, trusted array<long>")


def _discounts(counts: DataFrame) -> dict[int, float]:
    """The three discounts of modified Kneser-Ney from the counts of counts (one row)."""
    row = counts.agg(*[F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] or 0 for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return {1: 0.5, 2: 0.75, 3: 0.9}  # too little text for counts of counts
    y = n1 / (n1 + 2 * n2)
    raw = {1: 1 - 2 * y * n2 / n1, 2: 2 - 3 * y * n3 / n2, 3: 3 - 4 * y * n4 / n3}
    return {k: min(max(d, 0.05), k - 0.05) for k, d in raw.items()}


def _suffix(gram: Column, order: int) -> Column:
    """Without the first of ``order`` characters."""
    return gram.bitwiseAND(F.lit((1 << (_BITS * (order - 1))) - 1))


def _prefix(gram: Column) -> Column:
    """Without the last character."""
    return F.shiftrightunsigned(gram, _BITS)


def kneser_ney(scratch: Scratch, counts: DataFrame, asked: DataFrame) -> DataFrame:
    """(gram, logp) of the asked grams of the highest order under a model with these counts (gram, n).

    Order by order from single characters up, asked grams are joined with their own count, their context's total
    and back-off weight, and the probability of the gram without its first character.
    """
    levels = {ORDER: counts}
    wanted = {ORDER: asked}
    for order in range(ORDER - 1, 0, -1):
        shorter = _suffix(F.col("gram"), order + 1).alias("gram")
        # Below the highest order a gram counts the different characters seen before it.
        levels[order] = scratch.save(levels[order + 1].select(shorter).groupBy("gram").agg(F.count("*").alias("n")))
        wanted[order] = scratch.save(wanted[order + 1].select(shorter).distinct())
    kinds = levels[1].count() + 1  # one more for all characters never seen
    lower: DataFrame | None = None
    for order in range(1, ORDER + 1):
        table, discount = levels[order], _discounts(levels[order])
        taken = F.when(F.col("n") == 1, discount[1]).when(F.col("n") == 2, discount[2]).otherwise(discount[3])
        contexts = table.groupBy(_prefix(F.col("gram")).alias("context")).agg(
            F.sum("n").alias("total"), F.sum(taken).alias("mass")
        )
        grams = wanted[order].withColumn("context", _prefix(F.col("gram"))).join(table, "gram", "left").join(contexts, "context", "left")
        if lower is None:
            base = grams.withColumn("p_lower", F.lit(1.0 / kinds))
        else:
            base = grams.withColumn("tail", _suffix(F.col("gram"), order)).join(lower, "tail")
        seen = F.when(F.col("n").isNull(), 0.0).otherwise(F.col("n") - taken)
        p = F.when(F.col("total").isNull(), F.col("p_lower")).otherwise((seen + F.col("mass") * F.col("p_lower")) / F.col("total"))
        lower = scratch.save(base.select(F.col("gram").alias("tail"), p.alias("p_lower")))
    return lower.select(F.col("tail").alias("gram"), F.log("p_lower").alias("logp"))


def _payloads(source: DataFrame) -> DataFrame:
    """(block, part, payload): the rows of each block, a compressed slice at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for block, part, batch in _blocked(batches):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                writer.write_batch(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([part], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                ["block", "part", "payload"],
            )

    return source.select("doc_id", "r1", "r2", "lang", "trusted", "text").mapInArrow(lean(run), f"{_BLOCK_COLUMNS}, payload binary")


def _block_scores(payloads: DataFrame, scored: DataFrame) -> DataFrame:
    """(doc_id, r1, r2, lang, trusted, n, nll, words, repeats) of all rows.

    These are their characters, summed negative log-probability, words and repeated words.
    """

    def run(held: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        release()
        order = np.argsort(model["gram"].to_numpy(np.int64), kind="stable")
        keys, costs = model["gram"].to_numpy(np.int64)[order], -model["logp"].to_numpy(np.float64)[order]

        def judged(payload: bytes) -> pd.DataFrame:
            batch = next(iter(pa.ipc.open_stream(payload)))
            grams, bounds = packed_grams(batch.column("text"))
            cost = np.full(len(grams), np.nan)  # stays only if the block's rows changed between two readings
            if len(keys):
                place = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
                cost = np.where(keys[place] == grams, costs[place], np.nan)
            lost = np.concatenate(([0], np.cumsum(np.isnan(cost))))
            sums = np.concatenate(([0.0], np.cumsum(np.nan_to_num(cost))))
            rows = batch.select(["doc_id", "r1", "r2", "lang", "trusted"]).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)
            nll = pd.array(sums[bounds[1:]] - sums[bounds[:-1]], "Float64")
            nll[lost[bounds[1:]] > lost[bounds[:-1]]] = pd.NA
            words, repeats = repeated_words(batch.column("text"))
            return rows.assign(n=np.diff(bounds) - 1, nll=nll, words=words, repeats=repeats)

        out = [judged(payload) for payload in held["payload"]]
        give_back()
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in _SCORED})

    return payloads.groupBy("block").cogroup(scored.groupBy("block")).applyInPandas(
        run, ", ".join(f"{name} {kind}" for name, kind in _SCORED.items())
    )


def small(df: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _raw_scores(scratch: Scratch, source: DataFrame) -> DataFrame:
    blocks = scratch.save(block_grams(source))
    rows = blocks.select("block", F.explode(F.arrays_zip("grams", "trusted")).alias("g")).select(
        "block", F.col("g.grams").alias("gram"), F.col("g.trusted").alias("n")
    )
    counts = scratch.save(rows.where("n > 0").groupBy("gram").agg(F.sum("n").alias("n")))
    model = scratch.save(kneser_ney(scratch, counts, rows.select("gram").distinct()))
    return scratch.save(_block_scores(_payloads(source), rows.select("block", "gram").join(model, "gram")))


def score(
    docs: DataFrame, trusted_ids: DataFrame, quantile: float = 0.99, margin: float = 0.15, prior_chars: float = 100.0,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", broadcast_ids: int = BROADCAST_IDS,
    repeat_margin: float = 0.1, prior_words: float = 10.0,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, r1, r2, lang, n_chars, score, perplexity, threshold, kept, repeats, most_repeats).

    ``trusted_ids`` holds the ids of trusted documents in its first column. ``docs`` is read twice in the same
    partitions, as tables are; where a shuffle dealt its rows anew in between, that is noticed, the rows are saved
    and read again. ``perplexity`` is that of a character, ``threshold`` and ``score`` are natural logarithms.
    A document is kept if its score is at most ``threshold`` and its repeats are at most ``most_repeats``.
    """
    scratch = Scratch(docs.sparkSession)
    own, text = F.col(id_col), F.col(text_col)
    source = docs.select(
        own.cast("long").alias("doc_id"), text.alias("text"), F.col(lang_col).alias("lang"),
        F.xxhash64(own, text).alias("r1"), F.xxhash64(F.lit(1), text, own).alias("r2"),
    )
    ids = scratch.save(trusted_ids.select(F.col(trusted_ids.columns[0]).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct())
    source = source.join(small(ids.withColumn("trusted", F.lit(True)), broadcast_ids), "doc_id", "left")
    source = source.withColumn("trusted", F.coalesce("trusted", F.lit(False)))
    scores = _raw_scores(scratch, source)
    if not scores.where("nll IS NULL").isEmpty():
        scores = _raw_scores(scratch, scratch.save(source))
    return decide(scratch, scores, quantile, margin, prior_chars, broadcast_ids, repeat_margin, prior_words)


def decide(
    scratch: Scratch, scores: DataFrame, quantile: float, margin: float, prior_chars: float, broadcast_ids: int = BROADCAST_IDS,
    repeat_margin: float = 0.1, prior_words: float = 10.0,
) -> DataFrame:
    """Judge raw scores and repeats by each language's trusted ones."""
    trusted = scores.where("trusted AND n > 0")
    mean = (F.sum("nll") / F.sum("n")).alias("mean")
    usual = F.coalesce(F.try_divide(F.sum("repeats"), F.sum("words")), F.lit(0.0)).alias("usual")
    means = scratch.save(trusted.groupBy("lang").agg(mean, usual).withColumnRenamed("lang", "of_lang"))
    whole = trusted.agg(mean, usual).first()
    rated = _by_language(scores, means, broadcast_ids).withColumn("mean", F.coalesce("mean", F.lit(whole["mean"] or 0.0))).withColumn(
        "score", F.coalesce(F.try_divide(F.col("nll") + prior_chars * F.col("mean"), F.col("n") + prior_chars), F.lit(0.0))
    ).withColumn("usual", F.coalesce("usual", F.lit(whole["usual"]))).withColumn(
        "share", F.coalesce(F.try_divide(F.col("repeats") + prior_words * F.col("usual"), F.col("words") + prior_words), F.lit(0.0))
    )
    limit = F.percentile_approx("score", quantile, 10000).alias("threshold")
    most = F.percentile_approx("share", quantile, 10000).alias("most")
    judges = rated.where("trusted AND n > 0")
    limits = scratch.save(judges.groupBy("lang").agg(limit, most).withColumnRenamed("lang", "of_lang"))
    threshold, most_repeats = F.col("threshold") + margin, F.col("most") + repeat_margin
    return _by_language(rated, limits, broadcast_ids).select(
        "doc_id", "r1", "r2", "lang", F.col("n").alias("n_chars"), "score", F.exp("score").alias("perplexity"),
        threshold.alias("threshold"),
        F.coalesce((F.col("n") == 0) | ((F.col("score") <= threshold) & (F.col("share") <= most_repeats)), F.lit(True)).alias("kept"),
        F.col("share").alias("repeats"), most_repeats.alias("most_repeats"),
    )


def _by_language(rows: DataFrame, values: DataFrame, broadcast_ids: int) -> DataFrame:
    """Add a value of each language; languages are counted before they are broadcast."""
    values = small(values, broadcast_ids)
    return rows.join(values, rows["lang"].eqNullSafe(values["of_lang"]), "left").drop("of_lang")


def drop_rejected(
    docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    broadcast_ids: int = BROADCAST_IDS, **rules: float,
) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not rejected."""
    judged = score(docs, trusted_ids, id_col=id_col, text_col=text_col, lang_col=lang_col, broadcast_ids=broadcast_ids, **rules)
    # The decision depends on the language too, so rows equal in id and text may differ in it.
    own_lang = [F.col("lang").isNull().alias("no_lang"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("of_lang")]
    rejected = Scratch(docs.sparkSession).save(judged.where("NOT kept").select("r1", "r2", *own_lang).distinct())
    own, text = F.col(id_col), F.col(text_col)
    rows = docs.select(
        F.struct("*").alias("row"), F.xxhash64(own, text).alias("r1"), F.xxhash64(F.lit(1), text, own).alias("r2"), F.col(lang_col).alias("lang"),
    ).select("row", "r1", "r2", *own_lang)
    left = rows.join(small(rejected, broadcast_ids), ["r1", "r2", "no_lang", "of_lang"], "left_anti")
    return left.select(*[F.col("row")[name].alias(name) for name in docs.columns])
