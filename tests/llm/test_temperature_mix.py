import math
import random
from collections import Counter, defaultdict

import duckdb
import pytest

from shelfwise.llm import temperature_mix as mixing
from shelfwise.llm.sql import op3
from tests.llm.conftest import sentence


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    return [(i, sentence(rng, rng.randint(1, 60)), None, "hot" if i % 3 else f"s{i % 5}") for i in range(1500)]


def test_skewed_sources_match_sql(make_docs, skewed):
    import pyarrow as pa

    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in skewed], "text": [r[1] for r in skewed], "source": [r[3] for r in skewed]}))
    want = sorted(con.execute(op3()).fetchall())
    got = sorted(tuple(r) for r in mixing.mix(make_docs(skewed)).collect())
    assert got == want
    assert max(r[2] for r in got) >= 1  # small sources are passed twice


@pytest.mark.parametrize("entropy,repeats", [(0.95, 2.0), (1.0, 1.2), (0.5, 1.0)])
def test_targets_budgets_and_permutations(make_docs, skewed, entropy, repeats):
    target = mixing.Target(0.8, entropy, repeats)
    rows = mixing.mix(make_docs(skewed), target).collect()
    tokens, drawn = Counter(), Counter()
    for _, text, _, source in skewed:
        tokens[source] += len(text.split())
    by_pass = defaultdict(list)
    for r in rows:
        drawn[r.source] += r.n_tokens
        by_pass[r.source, r["pass"]].append(r)
    total = sum(tokens.values())
    half = max(len(r[1].split()) for r in skewed) / 2
    assert abs(sum(drawn.values()) - 0.8 * total) <= half * len(tokens) + len(tokens)
    for source, n in tokens.items():
        assert drawn[source] <= repeats * n + half
    for (source, k), found in by_pass.items():
        found.sort(key=lambda r: r.start)
        assert len({r.doc_id for r in found}) == len(found)  # a pass repeats nothing
        if drawn[source] >= (k + 1) * tokens[source]:
            at = 0
            for r in found:
                assert r.start == at
                at += r.n_tokens
    if entropy < 1:
        share = {s: n / sum(drawn.values()) for s, n in drawn.items()}
        reached = -sum(p * math.log(p) for p in share.values()) / math.log(len(share))
        natural = -sum(n / total * math.log(n / total) for n in tokens.values()) / math.log(len(tokens))
        assert reached > natural - 0.02


def test_whole_passes_keep_every_document(make_docs, skewed):
    ids, tokens = Counter(r[0] for r in skewed), Counter()
    for _, text, _, source in skewed:
        tokens[source] += len(text.split())
    for repeats in (1.0, 1.5, 3.0):
        target = mixing.Target(None, 1.0, repeats)
        rows = mixing.mix(make_docs(skewed), target).collect()
        drawn, times = Counter(), Counter()
        for r in rows:
            drawn[r.source] += r.n_tokens
            times[r.doc_id] += 1
        assert times.keys() == ids.keys()
        assert drawn["hot"] == tokens["hot"]
        assert max(drawn[s] / n for s, n in tokens.items()) <= repeats + 30 / min(tokens.values())
        if repeats == 1.0:
            assert times == ids
        if repeats == 3.0:
            assert max(drawn[s] / n for s, n in tokens.items()) > 2


def test_even_sources_are_drawn_once(make_docs):
    rng = random.Random(9)
    rows = [(i, sentence(rng, 30), "en", f"s{i % 4}") for i in range(400)]
    drawn = Counter(r.doc_id for r in mixing.mix(make_docs(rows), mixing.Target(None, 0.95, 2.0)).collect())
    assert drawn == Counter(range(400))


def test_one_long_document_does_not_end_a_pass(make_docs):
    rng = random.Random(10)
    rows = [(i, sentence(rng, 3000 if i == 7 else 20), "en", "s") for i in range(300)]
    got = mixing.mix(make_docs(rows), mixing.Target(0.9, 0.95, 1.0)).collect()
    total = 3000 + 299 * 20
    assert abs(sum(r.n_tokens for r in got) - 0.9 * total) <= 1500


def test_odd_rows(make_docs, odd_rows):
    rows = mixing.mix(make_docs(odd_rows), mixing.Target(3.0, 0.5, 9.0)).collect()
    passes = Counter((r.doc_id, r.source) for r in rows)
    assert passes[7, "s2"] == 2 * passes[4, "s2"] > 0
    assert passes[9, None] > 0 and passes[1, "s1"] > 0
    assert passes[3, ""] == 0  # its source has no tokens
    assert mixing.mix(make_docs([])).collect() == []
