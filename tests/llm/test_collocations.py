"""Collocations against plain counting with Python's integers."""

import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest

from granero.llm import collocations
from granero.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least=100, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(len(words)):
                for size in range(1, min(5, len(words) - k) + 1):
                    counts[lang, tuple(words[k : k + size])] += 1
    frequent = {key: times for key, times in counts.items() if times >= least}
    inside = {}
    for (lang, phrase), times in frequent.items():
        for i in range(len(phrase)):
            for j in range(i + 1, len(phrase) + 1):
                if j - i < len(phrase):
                    key = lang, phrase[i:j]
                    inside[key] = max(inside.get(key, 0), times)
    out = {}
    for (lang, phrase), a in frequent.items():
        if len(phrase) > 1 and 100 * inside.get((lang, phrase), 0) < 100 * a:
            n = totals[lang]
            cuts = []
            for k in range(1, len(phrase)):
                l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
                cuts.append((1000 * a * n // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), l, r, n))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, phrase, l, r, n) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(rows)


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(rng, number):
    words = ["The", "of", "Straße", "ÄPFEL", "x|y", "|", "new", "york", "city", "a\x00b", "\x1c", "é", "on", "rare1", "rare2", "rare3"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r", "\x0c", " ", " "]
    shared = "".join(rng.choice(words) + rng.choice(ends) for _ in range(400))
    out = []
    for _ in range(number):
        own = "".join(rng.choices(words, [9, 9, 3, 1, 2, 5, 4, 4, 4, 1, 1, 1, 3, 1, 1, 1])[0] + rng.choice(ends) for _ in range(rng.randint(0, 120)))
        out.append((rng.choice(["en", "de", None, "und"]), rng.choice([own, own, own + shared, shared, None, "", "new york " * 30])))
    return out


@pytest.mark.parametrize("least,top,bits", [(20, 2000, 27), (7, 15, 15), (100, 5, 20)])
def test_equals_plain_counting(spark, least, top, bits):
    docs = texts(random.Random(least), 300)
    frame = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    found = rows_of(collocations.collocations(frame, least, top, bits))
    assert found == plain(docs, least, top)
    assert len(found) > 10


def test_awkward_rows(spark, awkward, nothing):
    docs = [(r.lang, r.text) for r in awkward.collect()]
    assert rows_of(collocations.collocations(awkward, 3, 500, 20)) == plain(docs, 3, 500)
    assert collocations.collocations(nothing).count() == 0


def test_large_products(spark):
    phrase = spark.createDataFrame([("en", "p q " * 60_000)], "lang string, text string")
    found = rows_of(collocations.collocations(phrase))
    assert found == plain([("en", "p q " * 60_000)])


def test_query(spark, folder):
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["lang", "text"]).to_pylist()
    assert rows_of(QUERIES["op13_collocations"](spark, folder)) == plain([(d["lang"], d["text"]) for d in docs])
