import random
import zlib

import numpy as np

from shelfwise.llm import toxicity as tx
from tests.llm.conftest import sentence

BAD = "grumbo snarfle zotrix".split()
LABELS = "doc_id long, toxic int, quality int, score string"


def corpus(n, seed=1):
    """Documents of which a fifth hold words of a toxic family, always with another ending."""
    rng = random.Random(seed)
    rows, toxic = [], {}
    for i in range(n):
        said = sentence(rng, rng.randint(5, 120)).split()
        toxic[i] = int(rng.random() < 0.2)
        if toxic[i]:
            for _ in range(rng.randint(1, 4)):
                said.insert(rng.randint(0, len(said)), rng.choice(BAD) + rng.choice(["", "en", "ita", "s", "ly"]))
        rows.append((i, " ".join(said), "en", "s"))
    return rows, toxic


def labels_of(spark, toxic, share=0.5):
    return spark.createDataFrame([(i, y, 1, "own") for i, y in toxic.items() if random.Random(i).random() < share], LABELS)


def is_held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_texts_are_told_apart(spark, make_docs):
    rows, toxic = corpus(1500)
    got = {r.doc_id: r for r in tx.toxicity(make_docs(rows), labels_of(spark, toxic)).collect()}
    assert len(got) == 1500 and all(r.held_out == is_held_out(i) for i, r in got.items())
    out = [i for i in got if is_held_out(i)]
    assert sum(got[i].predicted == toxic[i] for i in out) > 0.98 * len(out)
    assert all((r.score >= 0.3) == bool(r.predicted) and 0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_are_not_read(spark, make_docs):
    rows, toxic = corpus(400)
    turned = {i: 1 - y if is_held_out(i) else y for i, y in toxic.items()}
    scores = [{r.doc_id: round(r.score, 6) for r in tx.toxicity(make_docs(rows), labels_of(spark, t)).collect()} for t in (toxic, turned)]
    assert scores[0] == scores[1]


def test_scores_read_the_text_alone(spark, make_docs):
    rows, toxic = corpus(300)
    model = tx.fit(make_docs(rows), labels_of(spark, toxic))
    moved = [(i + 1000, t, "xx", None) for i, t, _, _ in rows]
    a = sorted(r.score for r in tx.score(make_docs(rows), model).collect())
    assert a == sorted(r.score for r in tx.score(make_docs(moved), model).collect())


def test_label_model_recovers_rates_and_discounts_copies(spark):
    rng = np.random.default_rng(3)
    n = 20_000
    y = rng.random(n) < 0.3
    votes = np.zeros((n, tx._BITS), bool)
    fires = [(0.6, 0.05), (0.5, 0.02), (0.4, 0.1), (0.7, 0.05), (0.55, 0.03)]
    for j, (bad, good) in enumerate(fires):
        votes[:, j] = rng.random(n) < np.where(y, bad, good)
    votes[:, 5] = votes[:, 4]
    seen = rng.random(n) < 0.05
    votes[:, tx.FEATURE_BITS], votes[:, tx.FEATURE_BITS + 1] = seen & y, seen & ~y
    masks = (votes.astype(np.int64) << np.arange(tx._BITS)).sum(axis=1)
    found, counts = np.unique(masks, return_counts=True)
    model = tx.fit_label_model(spark.createDataFrame([(int(m), int(c)) for m, c in zip(found, counts, strict=True)], "mask long, n long"))
    assert abs(model.prior - 0.3) < 0.03
    for j, (bad, good) in enumerate(fires):
        assert abs(model.rates[1, j] - bad) < 0.05 and abs(model.rates[0, j] - good) < 0.03
    assert model.weight[4] < 0.6 and model.weight[5] < 0.6 and min(model.weight[:4]) > 0.8
    assert (model.posterior(votes.astype(float)) > 0.5).astype(bool)[~seen].tolist().count(True) > 0


def test_logistic_is_at_its_minimum():
    rng = np.random.default_rng(5)
    x = rng.random((200, 6)) < 0.3
    target, weight = rng.random(200), rng.random(200) + 0.5
    rows, columns = np.nonzero(x)
    w, bias = tx._logistic(rows, columns, target, weight, 6)
    p = 1 / (1 + np.exp(-(x @ w + bias)))
    slope = weight / weight.sum() * (p - target)
    assert abs(slope.sum()) < 1e-4 and np.abs(x.T @ slope + tx.RIDGE * w).max() < 1e-4


def test_odd_rows_and_clashing_columns(spark, make_docs, odd_rows):
    rows, toxic = corpus(300)
    rows = [(i + 100, *r) for i, *r in rows] + odd_rows
    marks = labels_of(spark, {i + 100: y for i, y in toxic.items()} | {1: 0, 7: 1, 2: 0})
    got = tx.toxicity(make_docs(rows), marks).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    empty = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(empty) == 1


def test_without_labels_or_rows(spark, make_docs):
    none = spark.createDataFrame([], LABELS)
    got = tx.toxicity(make_docs([(1, "a b", "en", "s"), (2, None, None, None)]), none).collect()
    assert {round(r.score, 6) for r in got} == {0.1} and {r.predicted for r in got} == {0}
    assert tx.toxicity(make_docs([]), none).collect() == []


def test_copies_teach_once(spark, make_docs):
    rows, toxic = corpus(300)
    copies = [(1000 + i, rows[0][1], "en", "s") for i in range(50)]
    docs, marks = make_docs(rows + copies), labels_of(spark, toxic | {1000 + i: 1 for i in range(50)}, 1.0)
    known = tx._labelled(docs, marks, "doc_id", "text").collect()
    assert len(known) == 300
