"""Periodic runs against a brute force that compares every word with every later one."""

import hashlib
import random
from array import array

import numpy as np
import pyarrow.parquet as pq

from granero.llm import periods
from granero.llm.queries import QUERIES, repeat_tail


def plain_runs(words, least=12):
    numbers = {}
    codes = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int32)
    found = {}
    for period in range(1, len(codes) // 2 + 1):
        same = np.concatenate(([False], codes[period:] == codes[:-period], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= max(period, least - period):
                found.setdefault((start, end - start + period), period)
    return sorted((start, period, length) for (start, length), period in found.items())


def plain_collapsed(words, runs):
    gone = {k for start, period, length in runs for k in range(start + period, start + length)}
    return " ".join(word.decode() for k, word in enumerate(words) if k not in gone)


def made(rng, longest):
    n, letters = rng.randint(0, longest), rng.choice([1, 2, 3, 30])
    words = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 4) if n else 0):
        start, period = rng.randrange(n), 1 + rng.randrange(max(1, n // 3))
        for k in range(start + period, min(n, start + rng.randint(period, 6 * period))):
            words[k] = words[k - period]
    return words


def test_tiles_hold_all_runs_and_fragments_stitch():
    rng = random.Random(11)
    for _ in range(300):
        documents = [made(rng, rng.choice([14, 70, 400])) for _ in range(rng.randint(0, 5))]
        stretches = {}
        for doc, stride, anchor, count, base, words in periods.tiles([np.array(d, np.int32) for d in documents]):
            for period, parts in periods.solve(array("i", words.tobytes()), stride, anchor, count).items():
                stretches.setdefault((doc, period), []).extend((lo + base, hi + base) for lo, hi in parts)
        found = [{} for _ in documents]
        for (doc, period), parts in sorted(stretches.items()):
            joined = []
            for lo, hi in sorted(parts):
                if joined and lo <= joined[-1][1]:
                    joined[-1][1] = max(hi, joined[-1][1])
                else:
                    joined.append([lo, hi])
            for lo, hi in joined:
                if hi - lo >= max(period, 12 - period):
                    found[doc].setdefault((lo, hi - lo + period), period)
        assert [sorted((s, p, n) for (s, n), p in one.items()) for one in found] == [plain_runs(d) for d in documents]


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        word = array("i", [rng.randrange(2) for _ in range(rng.randint(0, 40))])
        plain = [0] + [next((n for n in range(len(word) - k) if word[n] != word[k + n]), len(word) - k) for k in range(1, len(word))]
        assert list(periods.z_function(word)) == plain[: len(word)]


def test_rows(spark, awkward, nothing):
    rng = random.Random(9)
    texts = [" ".join(f"w{k}" for k in made(rng, 900)) for _ in range(30)]
    texts += ["que " * 20_000, "a b c " * 5_000 + "d " + "a b c " * 5_000, "x " * 11, "x " * 12, "x \t\n" * 13 + "\x1c \x85", "A a " * 6]
    docs = awkward.unionByName(spark.createDataFrame([(100 + k, text) for k, text in enumerate(texts)], "doc_id long, text string"), allowMissingColumns=True)
    found = sorted(
        ((r.doc_id is not None, r.doc_id or 0, [tuple(one) for one in r.runs], r.collapsed) for r in periods.periodic_runs(docs).collect()), key=repr
    )
    wanted = []
    for r in docs.collect():
        words = (r.text or "").encode().split()
        if r.text == texts[30]:
            runs = [(0, 1, 20_000)]
        elif r.text == texts[31]:
            runs = [(0, 3, 15_000), (15_001, 3, 15_000), (0, 15_001, 30_001)]
            runs = [run for run in runs if run[1] != 15_001]  # 30,001 words are less than two such periods
        else:
            runs = plain_runs(words)
        wanted.append((r.doc_id is not None, r.doc_id or 0, runs, plain_collapsed(words, runs)))
    assert found == sorted(wanted, key=repr)
    assert periods.periodic_runs(nothing).count() == 0


def test_query(spark, folder):
    rows = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    docs = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(rows) == len(docs)
    some = 0
    for doc in docs:
        words = repeat_tail(doc["doc_id"], (doc["text"] or "").encode().split())
        if len(words) > 8000:
            continue
        runs, row = plain_runs(words), rows[doc["doc_id"]]
        some += bool(runs)
        best = max(runs, key=lambda run: (run[2], -run[0], -run[1]), default=None)
        lines = "".join(f"{start},{length},{period}\n" for start, period, length in runs)
        assert row.n_runs == len(runs)
        assert (row.start, row.period, row.length) == (best or (None, None, None))
        assert row.exponent_milli == (1000 * best[2] // best[1] if best else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
    assert some > 10
