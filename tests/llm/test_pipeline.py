"""Each stage on what its predecessor kept, against a plain version of its rule."""

import functools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from granero.llm.caches import lean
from tests.llm.test_linededup import expected
from tests.llm.test_nearcopies import shingles
from tests.llm.test_quality import grams_of, model, plain_repeats

BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {"documents": docs}
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_order_and_columns(steps):
    assert [name for name, _ in P.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name in list(steps)[:-1]:
        assert steps[name].dtypes == steps["documents"].dtypes


def test_quality(spark, folder, steps):
    docs = [tuple(r) for r in steps["documents"].select("doc_id", "text", "lang").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()}
    p = functools.lru_cache(None)(model([t for d, t, _ in docs if d in trusted]))
    nll = {d: -sum(math.log(p(g)) for g in grams_of(t)) for d, t, _ in docs}
    size, lang = {d: len(t) for d, t, _ in docs}, {d: one for d, _, one in docs}
    mean = {}
    for one in set(lang.values()):
        own = [d for d in trusted if lang[d] == one]
        mean[one] = sum(nll[d] for d in own) / sum(size[d] for d in own)
    score = {d: (nll[d] + 100 * mean[lang[d]]) / (size[d] + 100) for d in nll}
    words = {d: plain_repeats(t) for d, t, _ in docs}
    share = {}
    for d, (n, repeats) in words.items():
        own = [words[t] for t in trusted if lang[t] == lang[d]]
        usual = sum(r for _, r in own) / sum(n for n, _ in own)
        share[d] = (repeats + 10 * usual) / (n + 10)
    limit, most = {}, {}
    for one in mean:
        own = [d for d in trusted if lang[d] == one]
        place = math.ceil(0.99 * len(own)) - 1
        limit[one] = sorted(score[d] for d in own)[place] + 0.15
        most[one] = sorted(share[d] for d in own)[place] + 0.1
    kept = {d for d in nll if score[d] <= limit[lang[d]] and share[d] <= most[lang[d]]}
    assert {r.doc_id for r in steps["quality_classifier"].collect()} == kept


def test_line_dedup(steps):
    before = steps["quality_classifier"].collect()
    want = {r.doc_id: kept for r, (_, _, kept) in zip(before, expected([r.text for r in before], 10))}
    after = steps["line_dedup"].collect()
    assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)


def test_near_dedup(steps):
    before = {r.doc_id: shingles(r.text, 5) for r in steps["line_dedup"].collect()}
    after = {r.doc_id: r.text for r in steps["near_dedup"].collect()}
    ids = sorted(before)
    group = {d: d for d in ids}
    for _ in range(5):
        for i, a in enumerate(ids):
            for b in ids[:i]:
                if before[a] and before[b] and 100 * len(before[a] & before[b]) >= 80 * len(before[a] | before[b]):
                    group[a] = group[b] = min(group[a], group[b])
    assert sorted(after) == sorted(set(group.values()))


def test_decontamination(spark, folder, steps):
    norm = lambda t: " ".join(t.lower().split())
    items = [norm(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before = steps["near_dedup"].collect()
    after = {r.doc_id for r in steps["decontamination"].collect()}
    for r in before:
        if any(item in norm(r.text) for item in items):
            assert r.doc_id not in after
    windows = {item[k : k + 24] for item in items for k in range(len(item) - 23)}
    for r in before:
        text = norm(r.text)
        if not any(text[k : k + 24] in windows for k in range(len(text) - 23)):
            assert r.doc_id in after  # nothing that even resembles an item


def test_packing(steps):
    from tests.llm.test_tokens import ids_of

    pieces = {}
    for r in steps["packing"].collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    want = {r.doc_id: ids_of(r.text) for r in steps["decontamination"].collect()}
    assert {d: sum((ids for _, ids in sorted(p)), []) for d, p in pieces.items()} == want


def test_run_is_the_chain(spark, folder, steps):
    whole = P.run(spark, folder)
    assert sorted((r.doc_id, r.start, r.length) for r in whole.collect())[:5] and whole.columns == steps["packing"].columns
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in steps["packing"].collect()}


def test_stages_take_awkward_and_no_rows(spark, folder, awkward, nothing):
    for docs in (awkward, nothing):
        columns = docs.columns
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == columns
            assert out.count() <= docs.count()
            assert out.dtypes == docs.dtypes


def test_extra_columns_of_any_name_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60).withColumns(
        {name: F.lit(7) for name in ("n_lines", "n_dropped", "kept_text", "row", "text_", "r1", "dropped", "score", "kept", "lang_", "idx", "block")}
    )
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes
        assert {tuple(r)[5:] for r in out.collect()} == {(7,) * 12}, name
        assert P.pack(spark, docs, folder).select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_rows_reach_python_in_small_batches(spark, folder, steps):
    docs = spark.createDataFrame([(k, "long text " * 50_000) for k in range(40)], "doc_id long, text string").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["bytes"])

    before = spark.conf.get(BATCH_LIMIT)
    spark.conf.unset(BATCH_LIMIT)
    try:
        for stage in (P.line_dedup, P.decontaminate, P.pack):
            spark.conf.unset(BATCH_LIMIT)
            stage(spark, steps["documents"].limit(20), folder)
            assert max(row.bytes for row in docs.mapInArrow(sizes, "bytes long").collect()) < 8 << 20
    finally:
        spark.conf.set(BATCH_LIMIT, before)


def test_workers_give_back_memory_when_a_task_ends():
    def anonymous():
        with open("/proc/self/smaps_rollup") as file:
            return next(int(line.split()[1]) for line in file if line.startswith("Anonymous:")) >> 10

    def work(batches):
        for batch in batches:
            points = [np.ones(10_000) for _ in range(3000)]  # 240 MB in pieces that stay on the heap
            table = pa.array([b"x" * 1000] * 100_000)  # 100 MB in Arrow's pool
            yield pa.RecordBatch.from_arrays([pa.array([len(points) + len(table)])], ["n"])

    start = anonymous()
    for _ in lean(work)([pa.RecordBatch.from_arrays([pa.array([1])], ["n"])]):
        assert anonymous() - start > 300
    assert anonymous() - start < 60
