import random
from collections import defaultdict

import numpy as np
import pytest

from shelfwise.llm import bm25_packing as packing
from shelfwise.llm.common import small_batches
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(packing.default_tokenizer())


def reference(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_are_the_tokenizers(encoder):
    rng = random.Random(1)
    alphabet = "aAbBeEéÉé \t\n\x85\xa0.,'’s!123ßẞΣσς漢字<|endoftext|>\U0001f600ﬁİ-_ ǅ\x00"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["don't it's we'll", "<|endoftext|> <|ENDOFTEXT|>x", "", None, "The THE the, the. the!! (the)", "a" * 5000]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == reference(encoder, text), text


def test_forgotten_words_are_learned_again(monkeypatch, encoder):
    monkeypatch.setattr(packing, "CACHE_WORDS", 20)
    rng = random.Random(2)
    texts = [sentence(rng, 30) for _ in range(1500)]
    assert packing.Encoder(packing.default_tokenizer()).encode(texts) == encoder.encode(texts)


def check(rows, texts, encoder, window):
    """Exact round trip: every id of every row in one piece, sequences without gaps or overflow."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length > 0
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    want = defaultdict(list)
    for key, text in texts:
        want[key].append(reference(encoder, text))
    assert by_doc.keys() == want.keys()
    for key, found in by_doc.items():
        if len(want[key]) == 1:
            found.sort(key=lambda r: r.start)
            got = [i for r in found for i in np.frombuffer(r.ids, "<u4").tolist()]
            assert got == want[key][0]
            assert [r.start for r in found] == np.cumsum([0, *(r.length for r in found)])[:-1].tolist()
            assert {r.doc_tokens for r in found} == {len(got)}
        else:
            assert sum(r.length for r in found) == sum(map(len, want[key]))
    for found in by_sequence.values():
        found.sort(key=lambda r: r.offset)
        assert [r.offset for r in found] == np.cumsum([0, *(r.length for r in found)])[:-1].tolist()
        assert sum(r.length for r in found) <= window
    return by_sequence


@pytest.mark.parametrize("window,shard", [(4096, 1 << 21), (64, 500)])
def test_round_trip(make_docs, odd_rows, encoder, window, shard):
    rng = random.Random(3)
    texts = [(i, t) for i, t, *_ in odd_rows] + [(100 + i, sentence(rng, rng.randint(0, 200))) for i in range(80)]
    rows = packing.pack(make_docs(texts), window=window, shard_tokens=shard).collect()
    sequences = check(rows, texts, encoder, window)
    short = [s for s in sequences.values() if sum(r.length for r in s) < window]
    assert len(short) <= 4  # one per partition


def test_neighbours_share_a_window():
    rng = random.Random(4)
    topics = [rng.sample(range(5000, 40000), 30) for _ in range(6)]
    docs = [((t, k), np.array(rng.choices(topics[t], k=40) + rng.choices(range(100), k=10), np.uint16)) for k in range(8) for t in range(6)]
    frequency = np.zeros(49408)
    for _, ids in docs:
        frequency[np.unique(ids)] += 1
    packer = packing.Packer(200, 0)
    packer.shard(docs, np.log1p((48 - frequency + 0.5) / (frequency + 0.5)), 50.0)
    windows = defaultdict(list)
    for doc, _, length, sequence, _ in packer.rows:
        windows[sequence].append((doc[0][0], length))
    pure = [len({t for t, _ in found}) == 1 for found in windows.values()]
    assert sum(pure) >= len(pure) - 1


def test_all_terms_of_the_seed_count():
    """Items share only terms with the seed that are not among its weightiest, item 2 more of them than item 1."""
    own = np.arange(1000, 1100)
    seed, far, near = np.concatenate([own, np.arange(60)]), np.arange(50, 70), np.arange(60)
    idf = np.full(2000, 0.5, np.float32)
    idf[own] = 9
    index = packing.Index([seed, far, near], idf, 60.0)
    scores = index.scores(0, np.zeros(3, dtype=bool))
    want = [sum(w for t, w in zip(index.terms[i], index.weights[i], strict=True) if t in set(seed.tolist())) for i in range(3)]
    assert np.allclose(scores, want) and scores[2] > scores[1] > 0
    assert np.allclose(index.scores(0, np.array([True, False, False]))[1:], want[1:])
    packer = packing.Packer(240, 0)
    packer.shard([(0, seed), (1, far), (2, near)], idf, 60.0)
    assert [r[0][0] for r in packer.rows] == [0, 2, 1]


def test_empty_table(make_docs):
    assert packing.pack(make_docs([])).collect() == []


def test_texts_reach_the_tokenizer_in_small_batches(spark, monkeypatch):
    setting, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(setting)
    whole = packing.stored

    def watched(df, label):
        seen.append((label, spark.conf.get(setting)))
        return whole(df, label)

    monkeypatch.setattr(packing, "stored", watched)
    packing.pack(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"))
    assert seen == [("tokens", "1000")] and spark.conf.get(setting) == before
    with small_batches(spark):
        with small_batches(spark):
            assert spark.conf.get(setting) == "1000"
        assert spark.conf.get(setting) == "1000"
    assert spark.conf.get(setting) == before


def test_a_word_of_one_piece_is_remembered_once():
    encoder = packing.Encoder(packing.default_tokenizer())
    apart = encoder.encode(["word", "Word,", ","])
    assert set(encoder.known) == {b"", b"word", b"Word,", b","}
    assert encoder.known[b"Word,"] == encoder.known[b"word"] + encoder.known[b","]
    assert encoder.encode(["word", "Word,", ","]) == apart == [packing.Encoder(packing.default_tokenizer()).encode([x])[0] for x in ("word", "Word,", ",")]
