import random
import re
from collections import Counter, defaultdict

import numpy as np

from shelfwise.llm import collocations as co

NAMES = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute(rows, min_count=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for row in rows:
        text, lang = row[1] or "", (row[2] if len(row) > 2 else None) or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i:i + k]] = max(longer[p[i:i + k]], a)
        found = []
        for p, a in often.items():
            if p in longer and 100 * longer[p] >= 80 * a:
                continue
            score, _, cut = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), " ".join(p), a, counts[p[:cut]], counts[p[cut:]], score))
        out += [(lang, i, x[3], *x[4:7], n[lang], x[7]) for i, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(*NAMES).collect())


def some_docs(seed, docs, words=40, langs=("en", "de", None)):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "New", "york", "É", "b\x00", "b\x01c", "b", "b\x02", "\x01", "a\x1fb", *(f"w{i}" for i in range(30))]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! "]
    return [(i, "".join(rng.choice(vocabulary[:rng.randint(1, len(vocabulary))]) + rng.choice(ends) for _ in range(rng.randint(0, words))),
             rng.choice(langs)) for i in range(docs)]


def test_matches_brute_force(make_docs):
    rows = some_docs(1, 400)
    assert found(co.collocations(make_docs(rows))) == brute(rows)


def test_tiny_budgets_split_hot_prefixes(make_docs, monkeypatch):
    rows = some_docs(2, 300, 60) + [(1000 + i, "very very very very very common words here", "en") for i in range(200)]
    whole = brute(rows, min_count=5, top=300)
    monkeypatch.setattr(co, "MAX_GROUPS", 1 << 20)
    assert found(co.collocations(make_docs(rows), 5, 300, budget=40)) == whole
    assert found(co.collocations(make_docs(rows), 5, 300)) == whole


def test_chunks_do_not_cut_phrases(make_docs, monkeypatch):
    rows = some_docs(3, 60, 400)
    monkeypatch.setattr(co, "_CHUNK_BYTES", 300)
    monkeypatch.setattr(co, "_KNOWN", 20)
    assert found(co.collocations(make_docs(rows))) == brute(rows)


def test_groups_keep_to_the_budget(make_docs):
    docs = co._own(make_docs(some_docs(4, 400, 60)), "text", "lang")
    words = co.word_counts(docs).cache()
    pairs = co.pair_counts(docs, co._Frequent(words, co._word_code("phrase")), 1).cache()
    starts, hot = co._groups(pairs, 12)
    assert len(starts) > 10 and len(hot) > 3
    sizes = Counter()
    for r in pairs.collect():
        if bytes(r.key) not in hot:
            sizes[co.bisect_right(starts, bytes(r.key))] += r.f
    assert max(sizes.values()) <= 24 and min(sizes) == 1 and max(sizes) == len(starts)


def test_filters_know_every_frequent_word_and_pair(make_docs):
    docs = co._own(make_docs(some_docs(5, 200)), "text", "lang")
    words = co.word_counts(docs).cache()
    frequent = co._Frequent(words, co._word_code("phrase"))
    pairs = co.pair_counts(docs, frequent, 1).cache()
    often = co._Frequent(pairs, co._pair_code())
    for r in pairs.collect():
        w = co._Words(r.lang, frequent)
        assert (w.numbers([x.encode() for x in r.phrase.split(" ")]) > 0).all()
        first, second = w.codes[w.numbers([x.encode() for x in r.phrase.split(" ")])]
        assert often.may_have(co._pair_codes(np.array([first]), np.array([second]))).all()


def test_full_filters_change_nothing(make_docs, monkeypatch):
    rows = some_docs(6, 200)
    monkeypatch.setattr(co._Frequent, "may_have", lambda self, codes: np.ones(len(codes), bool))
    monkeypatch.setattr(co._Frequent, "may_have_one", lambda self, code: True)
    assert found(co.collocations(make_docs(rows))) == brute(rows)


def test_odd_rows(make_docs, odd_rows):
    rows = [(*r[:3], r[3]) for r in odd_rows] * 31
    assert found(co.collocations(make_docs(rows))) == brute(rows)
    assert found(co.collocations(make_docs([]))) == []


def test_scores_past_64_bits(spark):
    expr = "(2000000BD * CAST(a AS decimal(28, 0))) div (CAST(l AS decimal(20, 0)) + CAST(r AS decimal(20, 0))) AS s"
    a = 9_223_372_036_854_775_807
    assert spark.createDataFrame([(a, a, a)], "a long, l long, r long").selectExpr(expr).first().s == 1_000_000
