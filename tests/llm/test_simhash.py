import random
from collections import defaultdict

import xxhash

from shelfwise.llm import simhash
from shelfwise.llm.common import components
from tests.llm.conftest import sentence


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, fps=None):
    fps = fps or [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    low = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)].append(key)
    return sorted(((key, f"{fps[i]:016x}", min(low[find(i)], default=None)) for i, (key, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_groups_match_brute_force(make_docs, odd_rows):
    rng = random.Random(1)
    rows = [(i, t) for i, t, *_ in odd_rows]
    for i in range(60):
        text = sentence(rng, rng.randint(1, 120))
        rows.append((100 + 10 * i, text))
        for k in range(rng.randint(0, 4)):
            rows.append((101 + 10 * i + k, text + " " + sentence(rng, 1)))
    assert result(simhash.near_duplicate_groups(make_docs(rows))) == brute(rows)


def test_hot_buckets_lose_no_link(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    fps = {base} | {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)} | {rng.getrandbits(64) for _ in range(40)}
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")

    def groups(hot):
        rows = components(simhash.links(df, hot_bucket=hot)).collect()
        return sorted((r.node, r.root) for r in rows)

    assert groups(3) == groups(10_000)
    assert len(groups(3)) >= 40


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1200), 1000)}


def test_empty_table(make_docs):
    assert simhash.near_duplicate_groups(make_docs([])).collect() == []
