"""Near copies against brute force over all pairs of full shingle sets."""

import random
import re

import numpy as np
import pytest

from granero.llm import components, nearcopies
from granero.llm.scratch import Scratch
from tests.llm.conftest import sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent):
    """For each row: set size, smallest id of its component."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    tops = {}
    for k, (own, _) in enumerate(rows):
        if own is not None:
            tops[root(k)] = min(tops.get(root(k), own), own)
    return sorted((str(own), len(s), str(tops.get(root(k)))) for k, ((own, _), s) in enumerate(zip(rows, sets)))


def found(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_awkward_rows(spark, awkward, size, percent):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(nearcopies.near_copies(awkward, size, percent)) == brute(rows, size, percent)


def test_no_documents(spark, nothing):
    assert nearcopies.near_copies(nothing).count() == 0 and nearcopies.keep_one(nothing).count() == 0


def family(rng, base, copies, edits):
    words = base.split()
    for _ in range(copies):
        changed = list(words)
        for _ in range(rng.randrange(edits + 1)):
            changed[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        yield " ".join(changed)


@pytest.mark.parametrize("seed,few_rows", [(1, 0), (2, 100_000)])
def test_families_with_chains_and_hubs(spark, seed, few_rows):
    """Copies around the threshold: many pairs of a family are linked through others only."""
    rng = random.Random(seed)
    texts = [t for edits in (1, 4, 6) for t in family(rng, sentence(rng, 140), 60, edits)]
    step = sentence(rng, 100).split()
    for k in range(40):  # a chain, each text close to its neighbours alone
        texts.append(" ".join(step))
        step[(7 * k) % 100] = f"c{k}"
        step[(7 * k + 3) % 100] = f"d{k}"
    texts += [sentence(rng, 60) for _ in range(100)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(nearcopies.near_copies(docs, 3, 85, few_rows=few_rows)) == brute(rows, 3, 85)


def test_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(nearcopies.near_copies(docs, 3, 85)) == brute(rows, 3, 85)


def test_one_row_of_each_component_stays(spark, awkward):
    kept = nearcopies.keep_one(awkward, 5, 80)
    assert kept.columns == awkward.columns
    everything = nearcopies.near_copies(awkward, 5, 80).collect()
    worded = {str(r.component_id) for r in everything if r.n_shingles}
    wordless = sum(r.n_shingles == 0 for r in everything)
    rows = kept.collect()
    assert sum(not shingles(r.text, 5) for r in rows) == wordless
    assert sum(bool(shingles(r.text, 5)) for r in rows) >= len(worded)
    assert {str(r.doc_id) for r in rows if shingles(r.text, 5)} == worded


def test_estimates_are_unbiased():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 1500, np.uint64)
    one, two = np.unique(pool[:1200]), np.unique(pool[300:])
    values = nearcopies.signatures([one, two], 400)
    assert abs((values[0] == values[1]).mean() - 900 / 1500) < 0.06


@pytest.mark.parametrize("links", [
    [(1, 2), (2, 3), (3, 4), (4, 5)], [(9, k) for k in range(1, 9)], [(k, k + 1) for k in range(1, 40)], [(5, 1), (5, 2), (7, 2), (7, 3), (8, 9)], [],
])
@pytest.mark.parametrize("few_rows", [0, 1000])
def test_components(spark, links, few_rows):
    scratch = Scratch(spark, few_rows)
    nodes = sorted({n for pair in links for n in pair} | {100})
    labels = scratch.save(spark.createDataFrame([(n, n) for n in nodes], "node long, comp long"))
    merged = components.merge(scratch, labels, spark.createDataFrame(links, "a long, b long"))
    label = {n: n for n in nodes}
    for _ in nodes:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert {r.node: r.comp for r in merged.collect()} == label
