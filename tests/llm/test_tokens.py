"""Encoding, token files and packing against the tokenizer itself."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from granero.llm import packing, token_files
from granero.llm.tokens import WordEncoder, vocabulary_path
from granero.session import shared_folder

_ENCODER = WordEncoder(vocabulary_path(), 1)
PARTS = ["the", "The", "water,", "stop.", "é", "é", "É", "İ.", "ǰ", "J̌", "<|endoftext|>", "<|startoftext|>", "<|", "it's", "we'LL", "x.,", "…", " ", "\n", "\t", " ", "\x1c", "12", "a1b", "😀", "Σας", "ΑΣ", "'s", "'", ",", ".", "!,", "ß", "ſ", "K"]


def ids_of(text):
    return _ENCODER.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@given(st.lists(st.one_of(st.text(max_size=12), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)), max_size=6))
@settings(max_examples=400, deadline=None)
def test_encoder_equals_the_library(texts):
    flat, bounds = _ENCODER.encode(texts)
    assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(t) for t in texts]


def test_encoder_after_its_memory_was_emptied(monkeypatch, folder):
    monkeypatch.setattr("granero.llm.tokens._MOST_WORDS", 50)
    texts = pq.read_table(f"{folder}/documents.parquet", columns=["text"]).column("text").to_pylist()[:40]
    for start in range(0, 40, 10):
        flat, bounds = _ENCODER.encode(texts[start : start + 10])
        assert [flat[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [ids_of(t) for t in texts[start : start + 10]]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def written(spark, docs, vocabulary, name):
    path = f"{shared_folder(spark)}/{name}"
    token_files.write_token_files(docs, path, vocabulary)
    return path


def test_token_files_round_trip(spark, awkward, vocabulary):
    path = written(spark, awkward, vocabulary, "tokens-awkward")
    rows = token_files.with_starts(token_files.read_token_files(spark, path)).orderBy("start").collect()
    assert sorted((r.doc_id is not None, r.doc_id, r.ids) for r in rows if r.doc_id is not None) == sorted(
        (True, r.doc_id, ids_of(r.text)) for r in awkward.collect() if r.doc_id is not None
    )
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    sums = token_files.with_checksums(token_files.with_starts(token_files.read_token_files(spark, path)).select("doc_id", "start", "ids"))
    assert sorted((r.start, r.ids_crc32) for r in sums.collect()) == sorted((r.start, crc(r.ids)) for r in rows)


def test_no_documents(spark, nothing, vocabulary):
    path = written(spark, nothing, vocabulary, "tokens-nothing")
    assert token_files.with_checksums(token_files.with_starts(token_files.read_token_files(spark, path)).select("doc_id", "start", "ids")).count() == 0
    assert packing.pack(nothing, vocabulary).count() == 0


def test_files_have_blooms_and_prune(spark, folder, vocabulary):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path = written(spark, docs, vocabulary, "tokens-pruned")
    one = token_files.read_token_files(spark, path, F.col("doc_id") == 77)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,77)]" in plan
    assert one.count() == docs.where("doc_id = 77").count()
    # Bloom filters that are asked to err less take more room.
    sizes = []
    for k, rate in enumerate((0.5, 0.0001)):
        token_files.write_token_files(docs, f"{path}-{k}", vocabulary, false_positives=rate, row_index_stride=1000)
        sizes.append(spark.read.format("binaryFile").load(f"{path}-{k}").agg(F.sum("length")).first()[0])
    assert sizes[0] < sizes[1]


def packed(frame):
    return frame.withColumn("ids_crc32", F.crc32("ids")).collect()


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing_places_every_token_once(spark, awkward, vocabulary, capacity):
    rows = packed(packing.pack(awkward, vocabulary, capacity=capacity, batch_docs=5))
    by_sequence, by_doc = {}, {}
    for r in rows:
        assert 0 < r.length <= capacity and len(r.ids) == 4 * r.length and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, np.frombuffer(r.ids, "<u4").tolist()))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    expected = {}
    for r in awkward.collect():
        ids = ids_of(r.text)
        expected.setdefault((r.doc_id, len(ids)), []).append(ids)
    assert {k: sorted(sum(v, [])) for k, v in expected.items()} == {k: sorted(sum((p[2] for p in v), [])) for k, v in by_doc.items()}
    for key, copies in expected.items():
        if len(copies) == 1:
            assert sum((p[2] for p in sorted(by_doc[key])), []) == copies[0]


@given(st.lists(st.integers(1, 70), min_size=1, max_size=60), st.sampled_from([8, 16, 31]))
@settings(max_examples=200, deadline=None)
def test_balanced_leaves_no_padding(sizes, capacity):
    pieces = packing.balanced(sizes, capacity, 1.0, 0.01)
    used = {}
    for doc, start, length, sequence, offset in pieces:
        used[sequence] = used.get(sequence, 0) + length
    assert sum(used.values()) == sum(sizes) and max(used.values()) <= capacity
    assert all(n == capacity or n & (n - 1) == 0 for n in used.values())
    assert sum(n == capacity for n in used.values()) >= sum(sizes) // capacity


def test_balanced_cost():
    """The long document's sequence costs most, so shorter ones go elsewhere while there is room."""
    shared = {}
    for doc, _, _, sequence, _ in packing.balanced([10, 4, 4, 4, 2], 12, 1.0, 1.0):
        shared.setdefault(sequence, []).append(doc)
    assert sorted(shared.values()) == [[0, 4], [1, 2, 3]]
