"""Held-out accuracy of the language and toxicity models, and their defined results on awkward rows."""

import pyarrow as pa
import pytest

from granero.llm import language, toxicity
from granero.llm.queries import op5_language, op8_toxicity


@pytest.fixture(scope="module")
def larger(folder):
    return folder.replace("sf0.001", "sf0.1")


def test_language_held_out(spark, larger):
    got = op5_language(spark, larger)
    assert got.columns[:2] == ["doc_id", "held_out"] and set(got.columns) == {"doc_id", "held_out", "lang_pred", "score"}
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "lang")
    joined = got.join(docs, "doc_id").where("held_out")
    assert joined.where("lang_pred = lang").count() / joined.count() > 0.97
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert got.count() == docs.count()


def test_language_awkward(spark, awkward, nothing):
    model = language.train(awkward, "doc_id", "text", "lang")
    rows = language.predict(awkward, model).collect()
    texts = {r.doc_id: r.text for r in awkward.collect()}
    assert len(rows) == awkward.count()
    for r in rows:
        if r.doc_id not in (None, 3, 7):
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id] or "")), r
    empty = language.train(nothing, "doc_id", "text", "lang")
    assert {r.lang_pred for r in language.predict(awkward, empty).collect()} == {"und"}
    assert language.predict(nothing, model).count() == 0
    one = language.train(awkward.where("lang = 'en'"), "doc_id", "text", "lang")
    assert {r.lang_pred for r in language.predict(awkward, one).collect()} == {"en", "und"}


def test_language_three_in_a_family(spark):
    texts = {"en": "the house and the water of the river", "de": "das Haus und das Wasser der Straße", "nl": "het huis en het water van de straat", "fr": "la maison et l'eau de la rue où", "xx": "qqq zzz kkk jjj", "yy": "www vvv bbb ppp"}
    rows = [(10 * k + i, f"{text} {i}", lang) for k, (lang, text) in enumerate(texts.items()) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, "doc_id", "text", "lang")
    assert set(model.families) == {"germanic", "romance", "other"} and model.families["germanic"] == ["de", "en", "nl"]
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    assert got == {d: lang for d, _, lang in rows}


def test_a_rare_language_has_an_equal_share_of_its_family(spark):
    from granero.llm.scratch import Scratch

    rows = spark.sql("""SELECT lang, 'x' AS text, xxhash64(id) AS _order, id AS _tie, family FROM (
        SELECT id, CASE WHEN id % 1000 = 0 THEN 'fr' WHEN id % 1000 < 3 THEN 'pt' ELSE 'es' END AS lang, 'romance' AS family FROM range(20000)
        UNION ALL SELECT id, 'en', 'germanic' FROM range(30))""")
    chosen = language.choose(rows, 100, Scratch(spark))
    counts = {(r.kind, r.lang): r["count"] for r in chosen.groupBy("kind", "lang").count().collect()}
    assert counts == {
        ("lang", "fr"): 20, ("lang", "pt"): 40, ("lang", "es"): 100, ("lang", "en"): 30,
        ("family", "fr"): 20, ("family", "pt"): 40, ("family", "es"): 40, ("family", "en"): 30,
    }


def test_features_ignore_everything_between_words():
    one, two = language.features(pa.array(["Two WORDS", " two,\n12 words! "]))[0]
    assert abs(one - two).max() < 1e-6 or one @ two > 0.9


def test_toxicity_held_out(spark, larger):
    got = op8_toxicity(spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet")
    joined = got.join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    right = sum(r.toxic == r.predicted for r in joined) / len(joined)
    found = [r.predicted for r in joined if r.toxic]
    clean = [r.predicted for r in joined if not r.toxic]
    assert right > 0.93 and sum(found) / len(found) > 0.8 and sum(clean) / len(clean) < 0.06, (right, sum(found), len(found), sum(clean), len(clean))
    assert got.where("score < 0 OR score > 1 OR score IS NULL OR predicted <> CAST(score >= 0.5 AS INT)").count() == 0


@pytest.fixture(scope="module")
def insults():
    import random

    rng = random.Random(2)
    clean = "water stone river light house winter table paper green summer window garden".split()
    bad = ["idiot", "moron", "scumbag", "loser"]
    texts, toxic = [], []
    for k in range(240):
        body = [" ".join(rng.choice(clean) for _ in range(8)) for _ in range(4)]
        if k % 3 == 0:
            body.insert(rng.randrange(4), f"{rng.choice(clean)} {rng.choice(clean)} {rng.choice(bad)} {rng.choice(clean)}")
        texts.append(". ".join(body))
        toxic.append(int(k % 3 == 0))
    return texts, toxic


def test_gapped_and_spelled_insults(insults):
    import numpy as np

    model = toxicity.fit(insults[0], np.array(insults[1]) > 0)
    scorer = toxicity.Scorer(model)
    hidden = ["what an idxiot he is", "a river. you i d i o t, water", "such a mo-ron there", "l.o.s.e.r", "IDIOT", "water idi*ot stone", "scumxbag"]
    fine = ["water stone river light", "", None, "the window of the house", "i d e a s", "a b c d e"]
    assert (scorer.scores(hidden) >= 0.5).all(), scorer.scores(hidden)
    assert (scorer.scores(fine) < 0.5).all(), scorer.scores(fine)


def test_kernel_equals_its_definition():
    import itertools

    def features(word):
        out = {}
        codes = toxicity.letters([word])[0].tolist()
        for i, j, k in itertools.combinations(range(len(codes)), 3):
            if k - i < toxicity.SPAN and codes[i] and codes[j] and codes[k]:
                u = (codes[i], codes[j], codes[k])
                out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    def kernel(a, b):
        fa, fb = features(a), features(b)
        norm = (sum(v * v for v in fa.values()) * sum(v * v for v in fb.values())) ** 0.5
        return sum(v * fb.get(u, 0) for u, v in fa.items()) / norm if norm else 0.0

    landmarks = ["idiot", "stupid", "erererer"]
    words = ["idiot", "idxiot", "i.d.i.o.t", "stupidity", "er", "ererer", "water", "", "île", "idi", "stp"]
    near, kernels = toxicity.Kernel(landmarks)(words)
    got = dict(zip(near.tolist(), kernels.tolist()))
    for k, word in enumerate(words):
        want = [v if (v := kernel(word, mark)) >= toxicity.LEAST else 0.0 for mark in landmarks]
        assert got.get(k, [0.0] * 3) == pytest.approx(want), word


def test_toxicity_awkward(spark, awkward, nothing, insults):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(insults[0])], "doc_id long, text string")
    labels = spark.createDataFrame([(k, t) for k, t in enumerate(insults[1])] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.landmarks and toxicity.score(awkward, model).where("predicted = 1").count() == 0
    assert toxicity.score(nothing, model).count() == 0
    untaught = toxicity.train(docs, labels.where("toxic = 0"))
    assert {r.score for r in toxicity.score(awkward, untaught).collect()} == {0.0}
    assert {r.score for r in toxicity.score(awkward, toxicity.train(nothing, labels)).collect()} == {0.0}
