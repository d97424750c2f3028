"""Toxicity by a gap-weighted subsequence kernel with Nystroem landmarks and a linear support vector machine.

The kernel of two words sums, over all subsequences of three letters, the products of ``decay`` to the power of
the letters' spans, scaled so that a word has 1 with itself. An insult with gaps or inserted characters therefore
stays close to its plain form. Landmarks are words of the labelled sample: those that mark toxic documents best,
no two alike, and common clean ones. A word is its kernels with the landmarks, mapped by the inverse root of the
landmarks' own kernel. A sentence is as toxic as its worst word, and a document as its worst sentence.

The machine learns from labelled texts: every word of clean ones is clean; words that toxic ones hold far beyond chance
are toxic, and of each toxic text the word that looks worst so far, chosen anew in a few rounds. It is fitted on a bounded sample in one task; all
texts are scored whole, in one pass without a shuffle.

Defined results: a null or empty text has the score of a word without any landmark. Without both labels to
learn from, every score is 0. Rows with a null id or label are not learned from; a document labelled twice counts
as toxic if one label says so.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.llm.caches import held
from granero.llm.texts import slices

SAMPLE_PER_LABEL = 1500  # labelled documents learned from, those of the smallest hash of each label
LONGEST_LEARNED = 60_000  # characters of a text that is learned from; longer ones are scored only
LANDMARKS, NEUTRAL, ALIKE = 80, 24, 0.7
TELLING = 1.5  # logarithmic odds of a word that can be toxic itself; half of it suffices for the worst of a text
MARKED = 25.0  # how often a word stands in toxic texts, times its logarithmic odds, from which on the word is toxic itself
SPAN, DECAY, LEAST = 6, 0.6, 0.3  # widest span of three letters, weight of each position, kernels below count as 0
_MOST_WORDS = 400_000  # of a worker's memory of words, which is emptied beyond that
_LETTERS = 64
_CODES: list[np.ndarray] = []
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_SPELLED = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?!\S)")  # single characters in a row, as in "i d i o t"
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&=+~`/\\_-“”‘’¿¡«»"


def _letter_codes() -> np.ndarray:
    """Of the basic plane: 1 to 26 for a to z, larger numbers for other letters, 0 for what never matches."""
    if not _CODES:
        other = [27 + k % 36 if chr(k).isalpha() else 0 for k in range(0x10000)]
        _CODES.append(np.array(other, np.int64))
        _CODES[0][97:123] = np.arange(1, 27)
    return _CODES[0]


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' letter codes one after another, and the number of the word that each belongs to.

    What is no letter still counts as a gap. A mark stands before each word, so that beginnings match beginnings.
    """
    points = np.frombuffer("".join("\x00" + word for word in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.zeros(len(words), np.int64)
    np.cumsum([len(word) + 1 for word in words[:-1]], out=starts[1:])
    codes = np.where(points < 0x10000, _letter_codes()[np.minimum(points, 0xFFFF)], 27 + points.astype(np.int64) % 36)
    owner = np.repeat(np.arange(len(words)), [len(word) + 1 for word in words])
    codes[starts] = _LETTERS - 1
    return codes, owner


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, code and weight of every subsequence of three letters within the span."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    chars, owner = letters(words)
    owners, found, weights = [], [], []
    for a, b in _OFFSETS:
        n = len(chars) - b
        if n <= 0:
            continue
        one, two, three = chars[:n], chars[a : a + n], chars[b:]
        use = (owner[:n] == owner[b:]) & (one > 0) & (two > 0) & (three > 0)
        owners.append(owner[:n][use])
        found.append((one[use] * _LETTERS + two[use]) * _LETTERS + three[use])
        weights.append(np.full(int(use.sum()), DECAY ** (b + 1)))
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(owners), np.concatenate(found), np.concatenate(weights)


def self_kernels(words: list[str]) -> np.ndarray:
    owner, code, weight = triples(words)
    pairs, place = np.unique(owner * _LETTERS**3 + code, return_inverse=True)
    sums = np.bincount(place, weight, len(pairs))
    return np.bincount(pairs // _LETTERS**3, sums * sums, len(words))


class Kernel:
    """Kernels of any words with fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        owner, code, weight = triples(landmarks)
        known, row = np.unique(code, return_inverse=True)
        self.row_of = np.full(_LETTERS**3, -1, np.int32)
        self.row_of[known] = np.arange(len(known))
        self.table = np.zeros((len(known), len(landmarks)))
        np.add.at(self.table, (row, owner), weight)
        self.norms = np.sqrt(np.maximum((self.table**2).sum(axis=0), 1e-12))

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that are close to any landmark, and their kernels with all; small kernels are 0."""
        owner, code, weight = triples(words)
        bound = np.sqrt(np.maximum(np.bincount(owner, weight * weight, len(words)), 1e-12))  # at most the word's norm
        row = self.row_of[code]
        hit = row >= 0
        # A word can only be close if the part of it that any landmark shares is large enough.
        shared = np.bincount(owner[hit], weight[hit], len(words))
        near = np.flatnonzero(shared >= LEAST * bound)
        if not len(near):
            return near, np.zeros((0, len(self.landmarks)))
        new = np.full(len(words), -1)
        new[near] = np.arange(len(near))
        hit &= new[owner] >= 0
        order = np.argsort(new[owner[hit]], kind="stable")
        rows, at, weights = row[hit][order], new[owner[hit]][order], weight[hit][order]
        sums = np.zeros((len(near), len(self.landmarks)))
        for start in range(0, len(near), 1024):
            low, high = np.searchsorted(at, (start, start + 1024))
            if high > low:
                part = self.table[rows[low:high]] * weights[low:high, None]
                firsts = np.flatnonzero(np.diff(at[low:high], prepend=-1))
                sums[at[low:high][firsts]] = np.add.reduceat(part, firsts)
        best = (sums / self.norms).max(axis=1) / bound[near]
        near, sums = near[best >= LEAST], sums[best >= LEAST]
        norms = np.sqrt(np.maximum(self_kernels([words[k] for k in near]), 1e-12))
        kernels = sums / self.norms / norms[:, None]
        kernels[kernels < LEAST] = 0
        close = kernels.any(axis=1)
        return near[close], kernels[close]


def spelled(text: str) -> set[str]:
    """Runs of single characters, put together."""
    return {re.sub(r"\s+", "", run) for run in _SPELLED.findall(text)}


def words_of(text: str | None) -> set[str]:
    return {*text.split(), *spelled(text)} if text else set()


def plain(word: str) -> str:
    """Without signs at its ends, in lower case; fewer than three characters say too little."""
    word = word.strip(_EDGES).lower()
    return word if len(word) > 2 else ""


@dataclass(frozen=True)
class Model:
    landmarks: list[str]
    weights: np.ndarray  # of kernels with the landmarks, the last one the bias
    scale: tuple[float, float]


class Scorer:
    def __init__(self, model: Model):
        self.model, self.kernel = model, Kernel(model.landmarks)
        self.margin_of: dict[str, float] = {}  # by word as it stands in texts
        self.plain_margin: dict[str, float] = {}

    def margins(self, texts: list[str | None]) -> np.ndarray:
        """Of each text's most toxic word."""
        if len(self.margin_of) > _MOST_WORDS:
            self.margin_of.clear(), self.plain_margin.clear()
        known, bias = self.margin_of, float(self.model.weights[-1])
        words = [words_of(text) for text in texts]
        new = list(set().union(*words) - known.keys())
        plainly = list(map(plain, new))
        unseen = sorted(set(plainly) - self.plain_margin.keys())
        for start in range(0, len(unseen), 50_000):
            part = unseen[start : start + 50_000]
            self.plain_margin.update(dict.fromkeys(part, bias))
            near, kernels = self.kernel(part)
            self.plain_margin.update(zip((part[k] for k in near.tolist()), (kernels @ self.model.weights[:-1] + bias).tolist()))
        known.update(zip(new, map(self.plain_margin.__getitem__, plainly)))
        return np.array([max(map(known.__getitem__, own), default=bias) for own in words])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.model.landmarks:
            return np.zeros(len(texts))
        a, b = self.model.scale
        return 1 / (1 + np.exp(-np.clip(a * self.margins(texts) + b, -30, 30)))


def odds(texts: list[str], toxic: np.ndarray) -> dict[str, tuple[int, int, float]]:
    """Of each word: how often it stands in toxic and in clean texts, and the logarithm of its odds to be in toxic ones.

    A word counts once after each different word, so that copies of a text don't make all its words telling.
    """
    bad, good = Counter(), Counter()
    seen: set[tuple[bool, int]] = set()
    for text, label in zip(texts, toxic.tolist()):
        before = ""
        for word in [*map(plain, text.split()), *sorted(plain(w) for w in spelled(text))]:
            mark = (label, hash((before, word)))
            if mark not in seen:
                seen.add(mark)
                (bad if label else good)[word] += 1
            before = word
    n_bad, n_good = max(1, bad.total()), max(1, good.total())
    return {
        word: (bad[word], good[word], float(np.log((bad[word] + 0.5) / n_bad * n_good / (good[word] + 0.5))))
        for word in bad.keys() | good.keys()
    }


def choose_landmarks(words: dict[str, tuple[int, int, float]]) -> list[str]:
    """Words that mark toxic texts, most telling first, then the commonest clean words."""
    able = [w for w, (bad, _, odd) in words.items() if bad >= 3 and odd > TELLING / 2]
    ranked = sorted(able, key=lambda w: (-words[w][0] * words[w][2], w))[:2000]
    chosen = _unlike(ranked, [], LANDMARKS)
    common = sorted((w for w, (_, _, odd) in words.items() if odd < 0), key=lambda w: (-words[w][1], w))[:500]
    return _unlike(common, chosen, len(chosen) + NEUTRAL) if chosen else []


def _unlike(words: list[str], chosen: list[str], most: int) -> list[str]:
    """``chosen`` and further words, none too close to one of the same list before it, up to ``most`` in all."""
    own: list[str] = []
    for word, norm in zip(words, self_kernels(words) if words else ()):
        if len(chosen) + len(own) >= most:
            break
        if norm > 0 and (not own or not (Kernel(own)([word])[1] > ALIKE).any()):
            own.append(word)
    return chosen + own


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 3) -> Model:
    from granero.llm.linear import fit_sigmoid, fit_svm

    counted = odds(texts, toxic)
    landmarks = choose_landmarks(counted)
    if not landmarks or toxic.all() or not toxic.any():
        return Model([], np.zeros(1), (1.0, 0.0))
    kernel = Kernel(landmarks)
    own = kernel.table.T @ kernel.table / np.outer(kernel.norms, kernel.norms)
    values, vectors = np.linalg.eigh(own)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.2))) @ vectors.T  # the Nystroem map
    docs = [sorted({plain(word) for word in words_of(text)}) for text in texts]
    known = sorted(set().union(*docs))
    rows = np.zeros((len(known) + 1, len(landmarks)))  # the last stands for a text without words
    for start in range(0, len(known), 50_000):
        near, kernels = kernel(known[start : start + 50_000])
        rows[start + near] = kernels
    place = {word: k for k, word in enumerate(known)}
    words = [np.array([place[word] for word in doc] or [len(known)]) for doc in docs]
    # A word can only be what makes a text toxic if toxic texts hold it clearly more often.
    odd = np.array([counted[word][2] for word in known] + [0.0])
    marks = np.array([counted[word][0] for word in known] + [0]) * odd
    suspects = [own[odd[own] > TELLING / 2] for own, label in zip(words, toxic) if label]
    suspects = [own for own in suspects if len(own)]
    plainly = np.flatnonzero((odd > TELLING) & (marks > MARKED))
    seen = np.unique(np.concatenate([own for own, label in zip(words, toxic) if not label]))
    clean = np.unique(rows[seen[odd[seen] <= TELLING / 2]], axis=0)
    if not suspects or not len(clean):
        return Model([], np.zeros(1), (1.0, 0.0))
    margins = marks  # at first a word looks as bad as its own counts say
    for _ in range(rounds):
        worst = rows[np.concatenate([[own[margins[own].argmax()] for own in suspects], plainly]).astype(int)]
        x = np.concatenate([worst, clean]) @ root
        y = np.concatenate([np.ones(len(worst)), -np.ones(len(clean))])
        mapped = fit_svm(x, y, np.where(y > 0, np.sqrt(len(clean) / len(worst)), 1.0))
        weights = np.append(root @ mapped[:-1], mapped[-1])
        margins = rows @ weights[:-1] + weights[-1]
    return Model(landmarks, weights, fit_sigmoid(np.array([margins[own].max() for own in words]), toxic))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = SAMPLE_PER_LABEL) -> Model:
    """A model from at most ``per_label`` documents of each label."""
    marked = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    window = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    # Twice as many as needed, since some may have no usable text; their number is fixed, so they can be broadcast.
    chosen = marked.withColumn("place", F.row_number().over(window)).where(F.col("place") <= 2 * per_label)
    usable = docs.where(F.length(text_col).between(1, LONGEST_LEARNED)).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    again = Window.partitionBy("label").orderBy("place", "text")
    sample = usable.join(F.broadcast(chosen), "id").withColumn("nth", F.row_number().over(again)).where(F.col("nth") <= per_label)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["label", "nth"])
        model = fit(group["text"].tolist(), group["label"].to_numpy() > 0)
        return pd.DataFrame({"landmarks": [model.landmarks], "weights": [model.weights.tolist()], "a": [model.scale[0]], "b": [model.scale[1]]})

    fitted = sample.select(F.lit(0).alias("all"), "label", "nth", "text").groupBy("all").applyInPandas(
        run, "landmarks array<string>, weights array<double>, a double, b double"
    ).collect()
    if not fitted:
        return Model([], np.zeros(1), (1.0, 0.0))
    return Model(list(fitted[0]["landmarks"]), np.array(fitted[0]["weights"]), (fitted[0]["a"], fitted[0]["b"]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", *extra: Column) -> DataFrame:
    """(doc_id, extra columns, score, predicted) of every row."""
    source = docs.select(F.col(id_col).alias("doc_id"), *extra, F.col(text_col).alias("text"))
    names = [name for name in source.columns if name != "text"]
    kinds = dict(source.dtypes)

    key = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(("toxicity", key), lambda: Scorer(model))
        for batch in slices(batches, "text", 2 << 20):
            values = scorer.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(values, pa.float64()), pa.array((values >= 0.5).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    return source.mapInArrow(run, ", ".join(f"`{n}` {kinds[n]}" for n in names) + ", score double, predicted int")
