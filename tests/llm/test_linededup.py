"""Line dedup against a plain count, and its reversibility."""

import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from granero.llm import linededup
from granero.llm.linededup import CuckooFilter

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(SPACES).translate(LOWER)


def expected(texts, min_docs, min_length=1):
    counts = Counter(k for t in texts for k in {key(line) for line in (t or "").split("\n")})
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [line for line in lines if len(key(line)) < min_length or counts[key(line)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def result(df):
    return sorted((r.n_lines, r.n_dropped, r.kept_text) for r in df.collect())


def test_awkward_rows(spark, awkward):
    texts = [r.text for r in awkward.collect()]
    for min_docs in (1, 2, 3):
        cut = linededup.drop_frequent_lines(awkward, min_docs=min_docs, shards=4)
        assert result(cut) == sorted(expected(texts, min_docs))
        assert cut.columns == [*awkward.columns, "kept_text", "n_lines", "n_dropped"]


def test_long_keys_only(spark, awkward):
    texts = [r.text for r in awkward.collect()]
    assert result(linededup.drop_frequent_lines(awkward, min_docs=2, min_length=8)) == sorted(expected(texts, 2, 8))


def test_no_documents(spark, nothing):
    assert linededup.drop_frequent_lines(nothing).count() == 0


def test_a_hot_line_is_dealt_over_groups(spark):
    rng = random.Random(3)
    texts = ["\n".join(rng.choice(["hot", "Hot ", f"own {k}", f"pair {k // 2}"]) for _ in range(4)) + "\nhot" for k in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert result(linededup.drop_frequent_lines(docs, min_docs=2, shards=2, group_rows=50)) == sorted(expected(texts, 2))


def test_insertions_and_deletions_are_reversible(spark):
    rng = random.Random(5)
    docs = [(k, "\n".join(f"line {rng.randrange(40)}" for _ in range(6))) for k in range(90)]
    first, second, third = (spark.createDataFrame(docs[a:b], "doc_id long, text string") for a, b in ((0, 40), (40, 70), (70, 90)))
    table = linededup.count_references(first)
    filters = linededup.build_filters(table, 5, 3)
    for batch, sign in ((second, 1), (third, 1), (second, -1)):
        after = linededup.merge_references(table, linededup.count_references(batch), sign)
        filters = linededup.update_filters(filters, table, after, 5, 3)
        table = after
    fresh = linededup.count_references(first.unionByName(third))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(table) == rows(fresh)
    stored = {r["shard"]: CuckooFilter.from_bytes(bytes(r["filter"])) for r in filters.collect()}
    for r in fresh.collect():
        if r.refs >= 5:
            assert stored[r["hash"] % 3].contains(np.array([r["hash"]], np.int64)).all()
    texts = [t for _, t in docs[:40] + docs[70:]]
    cut = linededup.drop_frequent_lines(first.unionByName(third), 5, shards=3, references=table, filters=filters)
    assert result(cut) == sorted(expected(texts, 5))


def test_everything_deleted_leaves_nothing(spark, awkward):
    counts = linededup.count_references(awkward)
    assert linededup.merge_references(counts, counts, -1).count() == 0


@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300), st.data())
@settings(max_examples=60, deadline=None)
def test_cuckoo_filter_has_no_false_negatives(keys, data):
    keys = sorted(keys)
    built = CuckooFilter.from_bytes(CuckooFilter.of(keys, 10).to_bytes())
    assert built.contains(np.array(keys, np.int64)).all() if keys else True
    gone = data.draw(st.lists(st.sampled_from(keys), unique=True)) if keys else []
    for one in gone:
        assert built.delete(one)
    rest = [k for k in keys if k not in set(gone)]
    if rest:
        assert built.contains(np.array(rest, np.int64)).all()


def test_cuckoo_filter_is_mostly_right_about_strangers():
    rng = np.random.default_rng(1)
    keys, others = rng.integers(-(2**62), 2**62, 5000), rng.integers(-(2**62), 2**62, 20000)
    assert CuckooFilter.of(keys.tolist(), 5000).contains(others).mean() < 0.002


def test_digest_query_matches_texts(spark, folder):
    from granero.llm.queries import op2_line_dedup

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = dict(zip(texts, expected(list(texts.values()), 10)))
    for r in op2_line_dedup(spark, folder).collect():
        lines, dropped, kept = want[r.doc_id]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (lines, dropped, hashlib.sha256(kept.encode()).hexdigest())
