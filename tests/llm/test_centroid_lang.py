import random
import string

import pytest

from shelfwise.llm import centroid_lang as lang
from tests.llm.conftest import sentence


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", lang.held_out())
    model = lang.fit(docs.filter(~docs.held_out), per_language=60)
    rows = lang.predict(docs, model, keep=("doc_id", "held_out", "lang")).collect()
    tested = [r for r in rows if r.held_out]
    assert tested and sum(r.lang_pred == r.lang for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)
    assert len(model.languages) <= 4 * lang.CENTROIDS


@pytest.fixture(scope="module")
def model(make_docs):
    rows = [(i, t, g, None) for i, (t, g) in enumerate([("the cat and the dog in the house", "en"), ("le chat et le chien dans la maison", "fr")] * 20)]
    return lang.fit(make_docs(rows + [(99, None, "en", None), (98, "unlabelled", None, None), (97, "12 34", "xx", None)]))


def test_odd_rows_and_rejection(make_docs, odd_rows, model):
    rows = [*odd_rows, (50, "the dog and the cat", None, None), (51, "ლაშა ქართული ენა დიდი სახლი", None, None)]
    found = {(r.doc_id, r.text): r for r in lang.predict(make_docs(rows), model, keep=("doc_id", "text", "score"[:0] or "source")).collect()}
    assert len(lang.predict(make_docs(rows), model).collect()) == len(rows)
    for (key, text), r in found.items():
        letters = any(c.isalpha() for c in text or "")
        assert (r.lang_pred == "und") == (not letters), key
        if not letters:
            assert r.score == 0 and r.rejected
    known = found[50, "the dog and the cat"]
    assert known.lang_pred == "en" and known.score > 0.5 and not known.rejected
    assert found[51, "ლაშა ქართული ენა დიდი სახლი"].rejected


def test_nothing_learned_or_nothing_asked(make_docs, model):
    empty = lang.fit(make_docs([]))
    assert [(r.lang_pred, r.score, r.rejected) for r in lang.predict(make_docs([(1, "some text")]), empty).collect()] == [("und", 0.0, True)]
    assert lang.predict(make_docs([]), model).collect() == []


@pytest.mark.parametrize("left_out", ["de", "en", "es", "fr"])
def test_unknown_latin_languages_and_gibberish_are_rejected(spark, make_docs, sf_dir, left_out):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("held_out", lang.held_out())
    model = lang.fit(docs.filter(~docs.held_out & (docs.lang != left_out)))
    rows = [r for r in lang.predict(docs, model, keep=("lang", "held_out", "text")).collect() if any(c.isalpha() for c in r.text or "")]
    unknown, known = [r.rejected for r in rows if r.lang == left_out], [r.rejected for r in rows if r.lang != left_out]
    assert sum(unknown) >= 0.9 * len(unknown) > 0
    assert sum(known) <= 0.02 * len(known)
    rng = random.Random(6)
    texts = [(n, " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(n))) for n in (5, 20, 60, 200, 800)]
    texts += [(1000, "def f(x):\n    return [i for i in range(x) if i % 2 == 0]\nfor k, v in os.environ.items(): print(k, v)")]
    assert all(r.rejected for r in lang.predict(make_docs(texts), model).collect())


def test_rows_without_id_keep_the_sample_bounded(make_docs):
    rng = random.Random(12)
    rows = [(None, sentence(rng, 20), "en", "s") for _ in range(3000)] + [(None, "same text again", "fr", "s")] * 2000
    docs = make_docs(rows).selectExpr("doc_id AS id", "text", "lang")
    found = lang._sample(docs, "id", 50).groupBy("lang").count().collect()
    assert {r["lang"] for r in found} == {"en", "fr"} and all(r["count"] <= 50 for r in found)


def test_kept_text_is_passed_on(make_docs):
    rng = random.Random(13)
    docs = make_docs([(i, sentence(rng, 30), "en", "s") for i in range(20)])
    model = lang.fit(docs)
    both = [lang.predict(docs, model, keep=k).collect() for k in (("doc_id", "text"), ("doc_id",))]
    assert {r.doc_id: r.text for r in both[0]} == {r.doc_id: r.text for r in docs.collect()}
    assert {(r.doc_id, r.lang_pred, r.score) for r in both[0]} == {(r.doc_id, r.lang_pred, r.score) for r in both[1]}
