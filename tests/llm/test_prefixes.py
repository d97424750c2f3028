"""Prefix-wise encoding and decoding against the tokenizers library."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from granero.llm import prefixes
from granero.llm.prefixes import PrefixEncoder
from granero.llm.queries import QUERIES
from granero.llm.tokens import vocabulary_path

_OWN = PrefixEncoder(vocabulary_path())
PARTS = ["the", "The", "water,", "stop.", "é", "é", "Å", "İ.", "ǰ", "J̌", "Ⱥ", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "it's", "we'LL", "x.,", "…", " ", "\n", "\t", "\xa0", "\x85", "\x1c", "²½", "12", "a1b", "😀", "Σας", "ΑΣ", "'s", "'", ",", "!,", "ß", "ſ", "K", "\U0010ffffa", "aaaa", "ababab"]


@pytest.fixture(scope="module")
def library(vocabulary):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def both(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def own(texts):
    coded = [_OWN.encode(text) for text in texts]
    return list(zip([np.frombuffer(ids, "<u4").tolist() for ids in coded], _OWN.decode(coded).to_pylist()))


@given(st.lists(st.one_of(st.text(max_size=12), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)), max_size=6))
@settings(max_examples=500, deadline=None)
def test_equals_the_library(library, texts):
    assert own(texts) == [both(library, text) for text in texts]


def test_words_of_vocabulary_pieces(library):
    rng = random.Random(3)
    names = [name.strip().removesuffix("</w>") for name in _OWN.names.to_pylist() if name.isascii()]
    texts = ["".join(rng.choices(names, k=rng.randint(1, 5))) for _ in range(20_000)]
    assert own(texts) == [both(library, text) for text in texts]


def test_long_words_and_a_small_memory(library, monkeypatch):
    monkeypatch.setattr(prefixes, "MOST_WORDS", 20)
    monkeypatch.setattr(prefixes, "MOST_PAIRS", 20)
    rng = random.Random(5)
    texts = ["".join(rng.choices("abc", k=50_000)), "a" * 30_001, "=" * 3_000, "é" * 2_000, *("".join(rng.choices("aet ", k=60)) for _ in range(300))]
    assert own(texts) == [both(library, text) for text in texts]
    assert len(_OWN.words) <= 21 and len(_OWN.pairs) <= 20


def test_unknown_ids_are_left_out(library):
    ids = [320, 60_000, 267, 49_407]
    assert _OWN.decode([np.array(ids, "<u4").tobytes(), b""]).to_pylist() == [library.decode(ids, skip_special_tokens=False), ""]


def test_other_vocabularies_are_refused(vocabulary):
    with pytest.raises(ValueError):
        PrefixEncoder(vocabulary_path("byte_bpe_50k.json"))


def test_rows(spark, awkward, nothing, vocabulary, library):
    rows = prefixes.encode(awkward, vocabulary, with_text=True).collect()
    found = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, bytes(r.ids), r.decoded) for r in rows)
    wanted = []
    for r in awkward.collect():
        ids, text = both(library, r.text)
        wanted.append((r.doc_id is not None, r.doc_id or 0, len(ids), np.array(ids, "<u4").tobytes(), text))
    assert found == sorted(wanted)
    again = prefixes.decode(prefixes.encode(awkward, vocabulary), vocabulary)
    assert sorted(r.decoded for r in again.collect()) == sorted(r.decoded for r in rows)
    assert prefixes.encode(nothing, vocabulary, with_text=True).count() == prefixes.decode(prefixes.encode(nothing, vocabulary), vocabulary).count() == 0
    assert prefixes.decode(spark.sql("SELECT 1L AS doc_id, CAST(NULL AS BINARY) AS ids"), vocabulary).collect()[0].decoded == ""


def test_query(spark, folder, library):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()}
    rows = QUERIES["op12_prefix_encoding"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, text = both(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
