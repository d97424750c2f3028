"""Language by family first, then by one-versus-one linear support vector machines inside the family.

Every two families, and every two languages of one family, have a machine of their own. They are trained on a
bounded sample of labelled rows, each machine in its own task. The most pairwise wins decide, larger sums of
margins break ties, then the name. Whole texts are read, in one pass without a shuffle.

Features are the square roots of hashed counts of one to three letters in a row, in lower case, with one space
for everything between words, scaled to length one.

Defined results: a null text or one without a letter is ``und`` with score 0. So is every text if nothing can be
learned. With one learned language every text with a letter gets it. Rows with a null id, language or text are
not learned from. Repeated rows count each time.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.llm.scratch import Scratch
from granero.llm.texts import code_points, mixed, slices

# Language families by ISO 639-1 code. Other codes are one family together.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fo", "fy", "is", "lb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tk", "tr", "tt", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "sd", "si", "ur"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "malayic": ("id", "jv", "ms", "su", "tl"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

DIMENSIONS = 4096
SAMPLE_PER_LANGUAGE = 1000  # labelled rows that are learned from, those of the smallest hash
LONGEST_LEARNED = 200_000  # characters of a text that is learned from; longer ones are predicted only
_ORDERS = 3
_LETTERS: list[np.ndarray] = []


def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Of the basic plane: which characters are letters, and their lower case where that is one character."""
    if not _LETTERS:
        chars = [chr(k) for k in range(0x10000)]
        _LETTERS.append(np.array([c.isalpha() for c in chars]))
        _LETTERS.append(np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], np.uint32))
    return _LETTERS[0], _LETTERS[1]


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One row for each text, and whether it has a letter."""
    points, bounds = code_points(texts)
    is_letter, lower = _letters()
    inside = np.minimum(points, 0xFFFF)
    beyond = points > 0xFFFF
    letter = np.where(beyond, True, is_letter[inside])
    if beyond.any():
        letter[beyond] = [chr(p).isalpha() for p in points[beyond].tolist()]
    chars = np.where(letter, np.where(beyond, points, lower[inside]), 32).astype(np.uint64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    keep = letter | np.concatenate(([True], letter[:-1] | (row[1:] != row[:-1]))) if len(points) else np.zeros(0, bool)
    chars, row, letter = chars[keep], row[keep], letter[keep]
    counts = np.zeros((len(bounds) - 1) * DIMENSIONS, np.float32)
    for order in range(1, _ORDERS + 1):
        n = len(chars) - order + 1
        if n <= 0:
            break
        code, some, same = np.full(n, order, np.uint64), np.zeros(n, bool), row[:n] == row[order - 1 :]
        for step in range(order):
            code = (code << np.uint64(21)) | chars[step : step + n]
            some |= letter[step : step + n]
        use = same & some
        slot = (mixed(code[use]) % np.uint64(DIMENSIONS)).astype(np.int64) + row[:n][use] * DIMENSIONS
        counts += np.bincount(slot, minlength=len(counts))
    table = np.sqrt(counts.reshape(-1, DIMENSIONS))
    size = np.sqrt((table * table).sum(axis=1, keepdims=True))
    return table / np.maximum(size, 1e-9), np.bincount(row[letter], minlength=len(bounds) - 1) > 0


@dataclass(frozen=True)
class Model:
    """Languages by family, and the weights of each pair's machine (the last one the bias)."""

    families: dict[str, list[str]]
    machines: dict[tuple[str, str], np.ndarray]

    def _winners(self, table: np.ndarray, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The index of each row's best name, and how sure its closest pair is."""
        wins, sums = np.zeros((len(table), len(names))), np.zeros((len(table), len(names)))
        sure = np.ones((len(table), len(names)))
        for (i, one), (j, two) in itertools.combinations(enumerate(names), 2):
            weights = self.machines[one, two]
            margin = table @ weights[:-1] + weights[-1]
            wins[:, i] += margin >= 0
            wins[:, j] += margin < 0
            sums[:, i] += margin
            sums[:, j] -= margin
            chance = 1 / (1 + np.exp(-2 * np.clip(margin, -15, 15)))
            sure[:, i], sure[:, j] = np.minimum(sure[:, i], chance), np.minimum(sure[:, j], 1 - chance)
        best = (wins + np.tanh(sums / max(1, len(names))) / 4).argmax(axis=1)
        return best, sure[np.arange(len(table)), best]

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        table, lettered = features(texts)
        names = np.full(len(table), "und", object)
        score = np.zeros(len(table))
        rows = np.flatnonzero(lettered)
        if self.families and len(rows):
            groups = sorted(self.families)
            family, sure = self._winners(table[rows], groups)
            for k, group in enumerate(groups):
                own = rows[family == k]
                if len(own):
                    best, certain = self._winners(table[own], self.families[group])
                    names[own] = np.array(self.families[group], object)[best]
                    score[own] = sure[family == k] * certain
        return names.tolist(), score


def choose(rows: DataFrame, per_language: int, scratch: Scratch) -> DataFrame:
    """(lang, family, _order, _tie, kind): the rows to learn from, chosen by hash alone before any text travels.

    Kind ``lang`` has up to ``per_language`` rows of each language. Kind ``family`` has as many of each family, taken from
    those in turns: the first of every language, then the second, and so on, so a rare language has an equal share.
    """
    inside = Window.partitionBy("lang").orderBy("_order", "_tie")
    of_lang = rows.drop("text").distinct().withColumn("_n", F.row_number().over(inside)).where(F.col("_n") <= per_language)
    own = scratch.save(of_lang, narrow=True)  # so many rows a language
    turns = Window.partitionBy("family").orderBy("_n", "_order", "_tie", "lang")
    of_family = own.withColumn("_turn", F.row_number().over(turns)).where(F.col("_turn") <= per_language).drop("_turn")
    both = own.withColumn("kind", F.lit("lang")).unionByName(of_family.withColumn("kind", F.lit("family")))
    return scratch.hinted(scratch.save(both.drop("_n"), narrow=True))


def train(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Machines from at most ``per_language`` rows of each language (and of each family, for those between families)."""
    from granero.llm.linear import fit_svm

    family_of = F.create_map(*[F.lit(x) for pair in FAMILY_OF.items() for x in pair])
    own, text = F.col(id_col), F.col(text_col)
    rows = labelled.where(own.isNotNull() & F.col(lang_col).isNotNull() & (F.length(text) <= LONGEST_LEARNED)).select(
        F.col(lang_col).alias("lang"), text.alias("text"), F.xxhash64(own, text).alias("_order"), F.xxhash64(F.lit(1), text, own).alias("_tie")
    )
    rows = rows.where(F.col("text").rlike("\\p{L}")).withColumn("family", F.coalesce(family_of[F.col("lang")], F.lit("other")))

    chosen = choose(rows, per_language, Scratch(labelled.sparkSession))
    sample = rows.drop("family").join(chosen, ["lang", "_order", "_tie"])
    found = [tuple(row) for row in chosen.select("family", "lang").distinct().collect()]  # languages, not rows
    families: dict[str, list[str]] = {}
    for family, lang in sorted(found):
        families.setdefault(family, []).append(lang)
    pairs = [("family", *pair) for pair in itertools.combinations(sorted(families), 2)]
    pairs += [("lang", *pair) for langs in families.values() for pair in itertools.combinations(langs, 2)]
    if not pairs:
        return Model(families, {})
    spark = labelled.sparkSession
    duties = spark.createDataFrame(
        [(kind, name, one, two, sign) for kind, one, two in pairs for name, sign in ((one, 1), (two, -1))],
        "kind string, name string, one string, two string, sign int",
    )
    named = sample.withColumn("name", F.when(F.col("kind") == "lang", F.col("lang")).otherwise(F.col("family")))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["sign", "_order", "text"])
        table, _ = features(pa.array(group["text"], pa.string()))
        y = group["sign"].to_numpy(np.float64)
        # Both sides weigh the same, however many rows they have.
        cost = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum()))) * 10
        weights = fit_svm(table, y, cost).astype(np.float32)
        return pd.DataFrame({"one": [group["one"].iloc[0]], "two": [group["two"].iloc[0]], "weights": [weights.tobytes()]})

    fitted = (
        named.join(duties, ["kind", "name"]).select("kind", "one", "two", "sign", "_order", "text")
        .groupBy("kind", "one", "two").applyInPandas(fit, "one string, two string, weights binary")
    )
    # One row of fixed size for each pair of languages or families.
    machines = {(row["one"], row["two"]): np.frombuffer(row["weights"], np.float32) for row in fitted.collect()}
    return Model(families, machines)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *extra: Column) -> DataFrame:
    """(doc_id, extra columns, lang_pred, score) of every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), *extra, F.col(text_col).alias("text"))
    names = [name for name in source.columns if name != "text"]
    kinds = dict(source.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                langs, score = model.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(langs, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"]
                )

    return source.mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", lang_pred string, score double")
