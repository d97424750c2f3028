"""Benchmark passages: planted with and without edits, against plain dynamic programming."""

import random

import numpy as np
import pyarrow as pa
import pytest

from granero.llm import decontamination as D
from tests.llm.conftest import sentence

ITEMS = "item_id long, text string"


def infix_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        last, row = row, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(last[j - 1] + (c != d), last[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        k = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[k] = "z"
        elif kind == 1:
            chars.insert(k, "q")
        else:
            del chars[k]
    return "".join(chars)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_awkward_rows(spark, awkward, nothing):
    text = awkward.where("doc_id = 8").first().text
    bench = spark.createDataFrame([(1, text[10:200]), (2, None), (3, ""), (4, "short"), (None, "never there " * 12), (5, text[300:380].upper())], ITEMS)
    found = D.find_passages(awkward, bench).collect()
    assert {(r.item_id, r.doc_id) for r in found} == {(i, d) for i in (1, 5) for d in (7, 8, 9, None)}
    for r in found:
        if r.edits == 0 and r.item_id == 1 and r.doc_id == 8:
            assert text[r.start : r.start + r.length] == text[10:200]
    kept = D.drop_contaminated(awkward, bench)
    assert kept.columns == awkward.columns
    assert rows(kept) == sorted((tuple(r) for r in awkward.collect() if r.text is None or text[10:100] not in r.text and r.doc_id != 9), key=str)
    assert rows(D.drop_contaminated(awkward, spark.createDataFrame([], ITEMS))) == rows(awkward)
    assert D.find_passages(awkward, spark.createDataFrame([], ITEMS)).count() == 0
    assert D.find_passages(nothing, bench).count() == 0 and D.drop_contaminated(nothing, bench).count() == 0


@pytest.mark.parametrize("block_chars", [1 << 20, 300])
def test_planted_passages_with_edits(spark, block_chars):
    rng = random.Random(11)
    items = [(k, sentence(rng, rng.randrange(10, 50))) for k in range(12)]
    docs, planted = [], set()
    for d in range(80):
        body = [sentence(rng, 60) for _ in range(rng.randrange(1, 6))]
        if d % 2:
            k, text = items[rng.randrange(12)]
            limit = int(min(len(text), 96) * 0.08)
            body.insert(rng.randrange(len(body) + 1), edited(rng, text, rng.randrange(limit + 1)).replace(" ", rng.choice([" ", "\n", "  "])))
            planted.add((d, k))
        docs.append((d, rng.choice([" ", "\n"]).join(body)))
    found = D.find_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, ITEMS), block_chars=block_chars)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == planted


def test_search_finds_all_windows_within_budget():
    """Every (document, window) whose distance is within the budget, and no other, by full dynamic programming."""
    rng = random.Random(5)
    rules = D.Rules(q=4, edits=0.1, window=40, stride=20, shortest=20)
    items = [(k, sentence(rng, 16)) for k in range(4)]
    index = D.Index.of(items, rules)
    docs = []
    for _ in range(25):
        text = sentence(rng, 12) + edited(rng, items[rng.randrange(4)][1], rng.randrange(9)) + sentence(rng, 6)
        docs.append(text)
    texts, _, bounds = D.normalized(*D.code_points(pa.array(docs)))
    found = {(m[0], m[1]) for m in D.search(index, texts, bounds, rules)}
    for d in range(len(docs)):
        own = texts[bounds[d] : bounds[d + 1] - 1].tolist()
        for w, window in enumerate(index.windows):
            assert ((d, w) in found) == (infix_distance(window.tolist(), own) <= index.budgets[w]), (d, w)


def test_alignment_in_a_band():
    rng = random.Random(1)
    for _ in range(60):
        window = np.array([rng.randrange(1, 4) for _ in range(20)], np.uint32)
        text = np.array([rng.randrange(1, 4) for _ in range(30)], np.uint32)
        edits, end = D.align(window, text, -25, 35)
        assert edits == infix_distance(window.tolist(), text.tolist()) and 0 <= end <= 30


def test_a_budget_without_shared_grams_is_refused():
    with pytest.raises(ValueError):
        D.Index.of([(1, "a" * 50)], D.Rules(q=6, edits=0.2))


def test_driver_table_passages(spark, folder):
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    norm = lambda t: " ".join((t or "").lower().split())
    texts = [(r.doc_id, norm(r.text)) for r in docs.collect()]
    exact = {(d, r.item_id) for r in bench.collect() for d, t in texts if norm(r.text) in t}
    assert exact <= {(r.doc_id, r.item_id) for r in D.find_passages(docs, bench).collect()}


def found_in(items, docs):
    """(document, item) of the matches, without Spark."""
    index = D.Index.of(items, D.Rules())
    texts, _, bounds = D.normalized(*D.code_points(pa.array(docs)))
    return {(m[0], index.items[m[1]]) for m in D.search(index, texts, bounds, D.Rules())}


@pytest.mark.parametrize("words", [13, 15, 20])
def test_quotes_at_all_offsets(words):
    rng = random.Random(words)
    items = [(k, sentence(rng, n)) for k, n in enumerate([14, 21, 40, 90])]
    docs, planted = [], set()
    for k, text in items:
        parts = text.split()
        for at in range(max(1, len(parts) - words + 1)):
            planted.add((len(docs), k))
            docs.append(f"{sentence(rng, 30)} {' '.join(parts[at : at + words])} {sentence(rng, 30)}")
        docs.append(f"{sentence(rng, 30)} {' '.join(parts[3:9])} {sentence(rng, 30)}")
    assert found_in(items, docs) == planted


def test_short_quotes_reach_the_result(spark):
    rng = random.Random(3)
    item = sentence(rng, 60)
    quote = " ".join(item.split()[20:33])
    docs = [(k, f"{sentence(rng, 50)} {q} {sentence(rng, 50)}") for k, q in enumerate([quote, quote[:30] + "#" + quote[31:], ""])]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], ITEMS)
    found = {r.doc_id: r for r in D.find_passages(table, bench).collect()}
    assert set(found) == {0, 1}
    assert all(docs[d][1].index(quote[35:]) + len(quote[35:]) <= found[d].start + found[d].length for d in found)
    assert found[0].start <= docs[0][1].index(quote) and found[0].length < len(quote) + 20
    assert [r.doc_id for r in D.drop_contaminated(table, bench).collect()] == [2]


def test_quotes_of_text_without_spaces():
    rng = random.Random(8)
    text = "".join(chr(0x4E00 + rng.randrange(4000)) for _ in range(400))
    docs = ["".join(chr(0x6E00 + rng.randrange(4000)) for _ in range(50)) + text[at : at + 112] for at in range(0, 289)]
    assert found_in([(1, text)], docs) == {(d, 1) for d in range(289)}


def test_many_alignments_equal_single_ones():
    rng = random.Random(2)
    draw = lambda n: np.array([rng.randrange(1, 4) for _ in range(n)], np.uint32)
    windows, texts = [draw(rng.randrange(5, 40)) for _ in range(300)], [draw(rng.randrange(0, 60)) for _ in range(300)]
    lows, widths = np.array([rng.randrange(-20, 30) for _ in range(300)]), np.array([rng.randrange(1, 20) for _ in range(300)])
    edits, ends = D.align_many(windows, texts, lows, widths)
    for k in range(300):
        best = D.align(windows[k], texts[k], int(lows[k]), int(lows[k] + widths[k] - 1))
        if best[0] <= len(windows[k]):
            assert (edits[k], ends[k]) == best
        else:
            assert edits[k] > len(windows[k])
