import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfwise.llm import context_mix as mixing
from shelfwise.llm.common import words
from tests.llm.conftest import sentence

BITS = 14


def model_of(texts):
    counts = Counter()
    for t in texts:
        counts.update([*words(t), b""])
    ranked = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    vocabulary = [t for t, n in ranked if n >= mixing.MIN_COUNT or t == b""]
    spelled = np.zeros(mixing.BYTES, np.int64)
    for t, n in ranked:
        if t not in vocabulary:
            for c in t:
                spelled[c] += n
            spelled[256] += n
    return mixing.Code(vocabulary, [counts[t] for t in vocabulary], int(spelled[256]), spelled)


def test_code_is_a_prefix_code_and_spells_every_token():
    code = model_of(["a b a b c", "new words", "a ça"])
    length = code.length
    first, second = length[:mixing.BYTES], length[mixing.BYTES:]
    for part in (first, second):
        assert math.isclose(sum(2.0 ** -int(n) for n in part), 1.0)
    numbers, sizes = code.symbols([[b"a", b"\xff\x00zz"], []])
    assert numbers.tolist()[sizes[0] - 6:sizes[0] - 1] == [255, 0, 122, 122, 256] and sizes[1] == 2


def test_probabilities_of_all_next_symbols_sum_to_one():
    """Each node's two bits share one: total probability over all one-token texts that end at once is at most 1."""
    code = model_of(["a b c d e f", "a b c a b a", "a a a"])
    rng = np.random.default_rng(1)
    stretched = rng.normal(0, 2, (mixing.CONTEXTS, 1 << BITS)).astype(np.float32)

    def logp(texts):
        found = [mixing.decisions(texts, code, BITS, fill=True)]
        return mixing.mix(mixing.inputs_of(found, stretched), mixing.together(found), mixing.start_weights())[0]

    # the first decision of the first symbol: both ways together have probability 1
    found = mixing.decisions([[b"a"], [b"b"], [b"c"], [b"zz"]], code, BITS)
    signs, seen = found.signs[found.starts[:-1]], set()
    for k, text in enumerate([[b"a"], [b"b"], [b"c"], [b"zz"]]):
        seen.add(signs[k])
        assert logp([text])[0] < 0
    assert seen <= {1.0, -1.0}
    tokens = [t for t in code if t]
    assert np.exp(logp([[t] for t in tokens])).sum() <= 1 + 1e-6


def test_batches_and_order_do_not_matter():
    rng = random.Random(2)
    texts = [words(sentence(rng, rng.randint(0, 400))) for _ in range(40)] + [[], [b"x" * 3000]]
    code = model_of([" ".join(w.decode() for w in t) for t in texts[:20]])
    stretched = np.random.default_rng(3).normal(0, 1, (mixing.CONTEXTS, 1 << BITS)).astype(np.float32)

    def run(part):
        found = [mixing.decisions(p, code, BITS, fill=True) for p in part if p]
        return mixing.mix(mixing.inputs_of(found, stretched), mixing.together(found), mixing.start_weights())[0]

    whole = run([texts])
    split = run([texts[:7], texts[7:30], texts[30:]])
    alone = np.concatenate([run([[t]]) for t in texts])
    assert np.allclose(whole, split, rtol=1e-5) and np.allclose(whole, alone, rtol=1e-5)


def test_starting_weights_come_from_all_training_texts(spark):
    """Each decision is predicted without its own count, and tasks count by their decisions."""
    counts = np.array([0, 1, 62, 63, 64, 1000, 10**6, 2**32])
    back = mixing.decoded()[mixing.coded(counts)]
    assert (back[:4] == counts[:4]).all() and (np.abs(back / np.maximum(counts, 1) - 1)[4:] < 0.06).all()
    rng = random.Random(8)
    texts = [sentence(rng, rng.randint(1, 30)) for _ in range(600)]
    counted = Counter(t for x in texts for t in [*words(x), b""])
    known = sorted(counted, key=lambda t: (-counted[t], t))
    model = mixing.Model(known, [counted[t] for t in known], counted.total(), len(known), 0, np.zeros(mixing.BYTES, np.int64), len(known))
    code = model.code()
    every = mixing.decisions([words(t) for t in texts], code, BITS, fill=True)
    numbers = np.zeros((mixing.CONTEXTS, 1 << BITS, 2), np.int64)
    for k in range(mixing.CONTEXTS):
        np.add.at(numbers[k], (every.slots[k][every.signs != 0], (every.signs[every.signs != 0] > 0).astype(int)), 1)
    cells = mixing.coded(numbers[:, :, 1]) << 8 | mixing.coded(numbers[:, :, 0])
    got = mixing.left_out([every], cells)
    back = mixing.decoded()[mixing.coded(numbers)]
    for k in range(mixing.CONTEXTS):
        ones, zeros = (back[k, every.slots[k], bit] - (every.signs == sign) for bit, sign in ((1, 1), (0, -1)))
        assert np.allclose(got[k], mixing.stretch(np.maximum(ones, 0), np.maximum(zeros, 0)), rtol=1e-5)
    context = spark.sparkContext
    docs = context.parallelize([(t,) for t in texts], 2).toDF("text string")
    parts = [mixing.learn([words(t) for t in part], code, cells, BITS) for part in (texts[:300], texts[300:])]
    assert sum(n for _, n in parts) == len(every.signs)
    found = mixing._weights(docs, context.broadcast(model), context.broadcast(cells), BITS)
    assert np.allclose(found, sum(w * n for w, n in parts) / sum(n for _, n in parts), atol=1e-5)
    assert not any(np.allclose(found, w, atol=1e-3) for w, _ in parts)


def brute_base(rows):
    counts, held = Counter(), {}
    for key, text in rows:
        held[key] = key is not None and zlib.crc32(str(key).encode()) % 5 == 1
        if not held[key]:
            counts.update([*words(text), b""])
    total, distinct = sum(counts.values()), len(counts)
    scale = total + 0.5 * (distinct + 1)
    out = []
    for key, text in rows:
        tokens = [*words(text), b""]
        out.append((key, held[key], len(tokens), sum(t in counts for t in tokens), total, sum(math.log10((counts[t] + 0.5) / scale) for t in tokens)))
    return out


def test_base_columns_match_brute_force(monkeypatch, make_docs, odd_rows):
    monkeypatch.setattr(mixing, "TOP_TOKENS", 20)  # the rest is looked up by the join
    monkeypatch.setattr(mixing, "VOCABULARY", 10)
    rng = random.Random(4)
    rows = [(i, t) for i, t, *_ in odd_rows] + [(20 + i, sentence(rng, rng.randint(0, 60))) for i in range(60)]
    found = mixing.score(make_docs(rows), bits=16).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=str)
    assert got == sorted(((*x[:5], round(x[5], 6)) for x in brute_base(rows)), key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    for r in found:
        assert math.isclose(r.bits_per_byte, -r.score * math.log2(10) / max(r.n_bytes, 1))


def test_learning_helps_on_held_out_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [r for r in mixing.score(docs).collect() if r.held_out]
    bits = -sum(r.score for r in rows) * math.log2(10) / sum(r.n_bytes for r in rows)
    assert rows and bits < 3.5  # 8 without a model


@pytest.mark.parametrize("rows", [[], [(1, None)], [(6, "only held out")]])
def test_little_or_nothing_to_learn_from(make_docs, rows):
    found = mixing.score(make_docs(rows), bits=15).collect()
    assert len(found) == len(rows) and all(math.isfinite(r.score) for r in found)


def test_texts_come_in_small_batches(spark, monkeypatch):
    """In every stage that is written; the session's setting is back afterwards."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(setting), []
    store = mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, label: seen.append((label, int(spark.conf.get(setting)))) or store(df, label))
    docs = spark.createDataFrame([(i, "a b c") for i in range(10)], "doc_id bigint, text string")
    assert mixing.score(docs, bits=BITS + 2).count() == 10
    assert seen == [("counts", 1000), ("tables", 1000), ("scores", 1000)]
    assert spark.conf.get(setting) == before
