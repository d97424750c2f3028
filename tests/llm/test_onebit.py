"""Nearest neighbours against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from granero.llm import onebit
from granero.llm.queries import op6_one_bit_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, asks):
    out = {}
    for i, (q, v) in enumerate(rows):
        if asks(q):
            scored = [(-float((np.array(w, float) * np.array(v, float)).sum()), c) for j, (c, w) in enumerate(rows) if j != i]
            out.setdefault(q, []).append(sorted(scored)[:k])
    return out


def usable(r, size):
    v = r.embedding
    return r.vec_id is not None and v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_recall_on_the_driver_table(spark, folder):
    for place in (folder, folder.replace("sf0.001", "sf0.1")):
        vectors = spark.read.parquet(f"{place}/embeddings.parquet").collect()
        rows = [(r.vec_id, r.embedding) for r in vectors if usable(r, 64)]
        want = brute(rows, 20, lambda q: q % 20 == 0)
        got = {}
        for r in op6_one_bit_neighbours(spark, place).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        hits = total = 0
        for q, answers in want.items():
            found = sorted(got[q])
            assert [rank for rank, _, _ in found] == list(range(1, 21))
            assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
            hits += len({v for _, v in answers[0]} & {v for _, v, _ in found})
            total += 20
            exact = {v: -s for s, v in sorted((-float((np.array(w, float) * np.array(dict(rows)[q], float)).sum()), c) for c, w in rows)} if q == 0 else {}
            for _, v, s in found if exact else []:
                assert s == pytest.approx(exact[v], abs=1e-15)
        assert hits / total > 0.99


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    common = [1.0, 2.0, 0.5, -1.0]
    rows = [(k, rng.standard_normal(4).tolist(), 0) for k in range(30)] + [(k, common, 1) for k in range(30, 45)]
    rows += [(100, None, 1), (120, [0.0] * 4, 1), (140, [1.0, None, 0.0, 1.0], 1), (160, [1.0, float("nan"), 0.0, 0.0], 1), (180, [float("inf"), 0.0, 0.0, 0.0], 1), (200, [1.0, 2.0], 1), (None, common, 1), (20, common, 1), (220, [], 1)]
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3).persist()
    good = [(r.vec_id, r.embedding) for r in vectors.collect() if usable(r, 4)]
    want = brute(good, 20, lambda q: q % 20 == 0)
    for block_rows in (7, 8192):
        got = {}
        for r in onebit.nearest(vectors, "pmod(vec_id, 20) = 0", 20, width=50.0, block_rows=block_rows).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
        assert got.keys() == want.keys()
        for q in want:
            assert sorted(got[q]) == sorted((k + 1, v) for answers in want[q] for k, (_, v) in enumerate(answers))
    vectors.unpersist()


def test_few_and_no_vectors(spark):
    three = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [-1.0, 0.0], 1)], SCHEMA)
    assert [(r["rank"], r.vec_id, r.score) for r in onebit.nearest(three, "vec_id = 0").orderBy("rank").collect()] == [(1, 1, 0.5), (2, 2, -1.0)]
    assert onebit.nearest(three, "vec_id = 7").count() == 0
    assert onebit.nearest(three.where("vec_id = 0"), "vec_id = 0").count() == 0
    assert onebit.nearest(three.limit(0), "vec_id = 0").count() == 0
    assert onebit.nearest(three.withColumn("embedding", F.lit(None).cast("array<float>")), "vec_id = 0").count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    vectors, queries = rng.standard_normal((3000, 64)), rng.standard_normal((20, 64))
    turn = onebit.rotation(64)
    bits, lengths, fits = onebit.encode(vectors, turn)
    assert bits.shape == (3000, 8)
    guess, error = onebit.estimates(queries, bits, lengths, fits, turn, 3.0)
    off = guess - queries @ vectors.T
    assert abs(off.mean()) < 0.1 and (np.abs(off) > error).mean() < 0.01
