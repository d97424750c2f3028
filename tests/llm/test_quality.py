"""The distributed Kneser-Ney model against a plain dictionary version, and the decisions it leads to."""

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from granero.llm import quality
from tests.llm.conftest import sentence

N = quality.ORDER


def grams_of(text, n=N):
    padded = "\x02" * (N - 1) + (text or "") + "\x03"
    return [padded[k - n + 1 : k + 1] for k in range(N - 1, len(padded))]


def model(trusted):
    """Probability of a character after a context, by the textbook's recursion."""
    counts = {N: Counter(g for t in trusted for g in grams_of(t))}
    for n in range(N - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts, contexts = {}, {}
    for n, table in counts.items():
        of = Counter(table.values())
        if of[1] and of[2] and of[3]:
            y = of[1] / (of[1] + 2 * of[2])
            raw = {k: k - (k + 1) * y * of[k + 1] / of[k] for k in (1, 2, 3)}
            discounts[n] = {k: min(max(d, 0.05), k - 0.05) for k, d in raw.items()}
        else:
            discounts[n] = {1: 0.5, 2: 0.75, 3: 0.9}
        contexts[n] = defaultdict(lambda: [0, 0.0])
        for g, c in table.items():
            contexts[n][g[:-1]][0] += c
            contexts[n][g[:-1]][1] += discounts[n][min(c, 3)]
    kinds = len(counts[1]) + 1

    def p(g):
        n = len(g)
        lower = p(g[1:]) if n > 1 else 1 / kinds
        if g[:-1] not in contexts[n]:
            return lower
        total, mass = contexts[n][g[:-1]]
        c = counts[n].get(g, 0)
        return ((c - discounts[n][min(c, 3)] if c else 0) + mass * lower) / total

    return p


def brute(rows, trusted_ids):
    p = model([t for d, t, _ in rows if d in trusted_ids])
    return {(d, t): -sum(math.log(p(g)) for g in grams_of(t)) for d, t, _ in rows}


@pytest.mark.parametrize("broadcast_ids", [10**6, 0])
def test_scores_equal_the_plain_model(spark, broadcast_ids):
    rng = random.Random(4)
    rows = [(k, sentence(rng, rng.randrange(1, 50)), rng.choice(["en", "de", None])) for k in range(60)] + [(60, "", "en"), (61, None, "en"), (62, "😀 ZZ", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    ids = [(k,) for k in range(0, 40)]
    judged = quality.score(docs, spark.createDataFrame(ids + ids, "doc_id long"), prior_chars=0.0, broadcast_ids=broadcast_ids).collect()
    want = brute(rows, {k for k, in ids})
    assert len(judged) == len(rows)
    for r in judged:
        text = rows[r.doc_id][1]
        assert r.n_chars == len(text or "")
        if r.n_chars:
            assert r.score == pytest.approx(want[r.doc_id, text] / r.n_chars, rel=1e-9)


def test_awkward_rows(spark, awkward, nothing):
    ids = awkward.select("doc_id")
    judged = quality.score(awkward, ids)
    assert judged.count() == awkward.count()
    assert judged.where("n_chars = 0 AND NOT kept").count() == 0
    assert quality.score(awkward, ids.limit(0)).where("NOT kept").count() == 0
    assert quality.score(nothing, ids).count() == 0
    kept = quality.drop_rejected(awkward, ids)
    assert kept.columns == awkward.columns and kept.count() == judged.where("kept").count()
    assert quality.drop_rejected(awkward, ids, broadcast_ids=0).count() == kept.count()


def test_an_input_whose_rows_move_between_readings(spark):
    docs = spark.createDataFrame([(k, f"some text here {k}", "en") for k in range(200)], "doc_id long, text string, lang string")
    moving = docs.repartition(5, F.rand())
    judged = quality.score(moving, docs.select("doc_id"), prior_chars=0.0).collect()
    want = brute([tuple(r) for r in docs.collect()], set(range(200)))
    assert len(judged) == 200
    for r in judged:
        text = f"some text here {r.doc_id}"
        assert r.score == pytest.approx(want[r.doc_id, text] / len(text), rel=1e-9)


def test_junk_goes_and_clean_text_stays(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    trusted = labels.where("quality = 1").where(~held_out).select("doc_id")
    judged = quality.score(docs, trusted).select("doc_id", "kept").join(labels, "doc_id").where(held_out).groupBy("quality").agg(
        F.avg(F.col("kept").cast("double")).alias("share")
    )
    share = {r.quality: r.share for r in judged.collect()}
    assert share[1] > 0.97 and share[0] < 0.5, share


def plain_repeats(text):
    w = (text or "").lower().split()
    near = range(2, quality.PHRASE_LAG + 1)
    return len(w), sum(i > 0 and w[i] == w[i - 1] or any(i > g and w[i] == w[i - g] and w[i - 1] == w[i - 1 - g] for g in near) for i in range(len(w)))


def test_repeats_equal_a_plain_count():
    rng = random.Random(9)
    texts = [None, "", " ", "one", "a a", "a", "a b a b", "b A a"] + [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(40))) for _ in range(200)]
    words, repeats = quality.repeated_words(pa.array(texts, pa.string()))
    assert list(zip(words.tolist(), repeats.tolist())) == [plain_repeats(t) for t in texts]


def test_clean_words_that_repeat_are_rejected(spark):
    rng = random.Random(6)
    clean = [sentence(rng, rng.randrange(20, 80)) for _ in range(300)]
    words = [rng.choice(clean[0].split()) for _ in range(40)]
    junk = ["water " * 60, " ".join(f"{w} {w}" for w in words), "the house of stone " * 15, clean[1] + " river" * 60]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(clean + junk)], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.score(docs, docs.where("doc_id < 200").select("doc_id")).where("kept").collect()}
    assert not kept & set(range(300, 304)) and len(kept) >= 295


def test_each_junk_class_of_the_driver_tables_goes(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    judged = quality.score(docs, labels.where("quality = 1").where(~held_out).select("doc_id")).select("doc_id", "kept")
    rows = judged.join(labels.where("quality = 0"), "doc_id").join(docs.select("doc_id", "text"), "doc_id").collect()

    def kind(text):
        w, share = text.lower().split(), lambda test: sum(map(test, text)) / max(1, len(text))
        if sum(a == b for a, b in zip(w, w[1:])) > 0.3 * len(w):
            return "repeated"
        return "capitals" if share(str.isupper) > 0.3 else "symbols or tables" if share(lambda c: not c.isalnum() and c != " ") > 0.1 else "other"

    kept, all_of = Counter(kind(r.text) for r in rows if r.kept), Counter(kind(r.text) for r in rows)
    print(kept, all_of)
    assert all_of["repeated"] > 100
    for name in ("repeated", "capitals", "symbols or tables"):
        assert kept[name] <= 0.05 * all_of[name], (name, kept, all_of)


def test_a_language_without_trusted_documents_is_kept_unjudged(spark):
    rng = random.Random(12)
    rows = [(k, sentence(rng, 40), "en") for k in range(60)] + [(60 + k, "жцщ юяф " * 3 + str(k) + " шхъ эьы" * 2, "ru") for k in range(9)] + [(69, "ЖЦ%# @@ " * 20, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    judged = {r.doc_id: r for r in quality.score(docs, docs.where("doc_id < 50").select("doc_id")).collect()}
    assert all(judged[k].kept and judged[k].threshold is None and judged[k].most_repeats is None for k in range(60, 69))
    assert not judged[69].kept and judged[0].threshold is not None


def test_rows_equal_in_id_and_text_are_judged_by_their_own_language(spark):
    rng = random.Random(6)
    english = [(k, sentence(rng, 40), "en") for k in range(60)]
    strange = "zqx@#kv " * 40
    docs = spark.createDataFrame([*english, (99, strange, "en"), (99, strange, "de"), (99, strange, None)], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(k,) for k in range(60)], "doc_id long")
    left = quality.drop_rejected(docs, trusted).where("doc_id = 99").collect()
    assert sorted(str(r.lang) for r in left) == ["None", "de"]


def test_blocks_are_the_same_however_rows_come_in_batches(monkeypatch):
    rng = random.Random(3)
    texts = [None, ""] + [sentence(rng, rng.randint(1, 300)) for _ in range(400)] + ["long " * 600_000, "", None]

    def blocks(rows_each):
        monkeypatch.setattr(quality, "BLOCK_BYTES", 20_000)
        monkeypatch.setattr(quality, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("Own", (), {"partitionId": staticmethod(lambda: 5)}))}))
        batches = [pa.RecordBatch.from_arrays([pa.array(texts[k : k + rows_each], pa.string())], ["text"]) for k in range(0, len(texts), rows_each)]
        found = list(quality._blocked(batches))
        assert len({(block, part) for block, part, _ in found}) == len(found)
        return [(block, text) for block, _, piece in found for text in piece.column("text").to_pylist()]

    whole = blocks(len(texts))
    assert [text for _, text in whole] == texts and len({block for block, _ in whole}) > 5
    assert all(blocks(rows_each) == whole for rows_each in (1, 7, 50, 130))
