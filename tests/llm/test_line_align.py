import random
from itertools import combinations

from shelfwise.llm import line_align as lines
from tests.llm.conftest import sentence


def longest(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_increasing_equal_and_complete_without_repeats():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.sample(range(1, 60), rng.randint(0, 25))
        b = [x for x in a if rng.random() < 0.7]
        for _ in range(rng.randint(0, 6)):
            b.insert(rng.randint(0, len(b)), rng.randint(100, 200))
        found = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:], strict=False))
        assert len(found) == longest(a, b)  # unique lines in one order: nothing is missed


def test_repeated_lines_align_by_occurrence():
    assert lines.patience([1, 1, 1], [1, 1]) == [(0, 0), (1, 1)]
    assert lines.patience([5, 1, 1, 6], [7, 1, 1, 8]) == [(1, 1), (2, 2)]
    assert lines.patience([], [1]) == []


def test_short_runs_stay_and_blank_lines_break_no_run():
    words = [3, 0, 3, 9, 2]
    assert lines.deleted_lines([1, 2, 0, 50], [1, 0, 2, 9, 50], words, 5) == [0, 2]
    assert lines.deleted_lines([1, 2, 0, 50], [1, 0, 2, 9, 50], words, 7) == []


def brute(rows, min_words=5):
    """Every pair of different texts that share a line, aligned; earlier by id, null last, then content."""
    import hashlib

    def order(row):
        return row[0] is None, row[0] or 0, hashlib.md5((row[1] or "").encode()).hexdigest()

    def keys(text):
        return [b" ".join(line.encode().split()).decode() or 0 for line in (text or "").split("\n")]

    distinct = {}
    for row in sorted(rows, key=order):
        distinct.setdefault(row[1] or "", row)
    cut = {text: set() for text in distinct}
    for a, b in combinations(sorted(distinct.values(), key=order), 2):
        ours, theirs = keys(a[1]), keys(b[1])
        counts = [len(x.encode().split()) if x else 0 for x in theirs]
        cut[b[1] or ""] |= set(lines.deleted_lines(ours, theirs, counts, min_words))
    out = []
    for key, text in rows:
        whole = text or ""
        copy = distinct[whole][0] != key and sum(len(x.encode().split()) for x in keys(text) if x) >= min_words
        kept = [x for i, x in enumerate(whole.split("\n")) if i not in cut[whole]]
        if copy:
            out.append((key, ""))
        elif cut[whole]:
            out.append((key, "\n".join(kept) if any(x.encode().strip() for x in kept) else ""))
        else:
            out.append((key, text))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def corpus():
    rng = random.Random(2)
    pool = [sentence(rng, rng.randint(1, 9)) for _ in range(40)]
    common = sentence(rng, 12)
    rows = []
    for i in range(60):
        found = [sentence(rng, rng.randint(4, 9)) for _ in range(rng.randint(1, 5))]
        for _ in range(rng.randint(0, 3)):
            found.insert(rng.randint(0, len(found)), rng.choice(pool))
        if i % 3:
            found.append(common)
        rows.append((i, "\n".join(found)))
    return rows + [(100 + i, rows[i][1]) for i in range(12)]


def test_all_pairs_match_brute_force(make_docs, odd_rows):
    rows = corpus() + [(i + 1000 if i is not None else None, t) for i, t, *_ in odd_rows]
    assert result(lines.dedup_lines(make_docs(rows), rare=10_000)) == brute(rows)


def test_common_lines_lose_no_repeat(make_docs):
    """With few lines counted as rare, every line of a block still goes from all but its first document."""
    rng = random.Random(3)
    passage = sentence(rng, 60)
    rows = [(i, "\n".join([sentence(rng, 9), passage, sentence(rng, 9)])) for i in range(30)]
    found = result(lines.dedup_lines(make_docs(rows), rare=2))
    assert [passage in t for _, t in sorted(found)] == [True] + [False] * 29
    assert all(len(t.split("\n")) == 2 for _, t in sorted(found)[1:])


def spread(rng, passages, docs, own=3):
    """Documents with most of some passages of a few lines each, in any order, own lines between them."""
    out = []
    for i in range(docs):
        parts = rng.sample(passages, rng.randint(1, len(passages)))
        lines_ = [x for p in parts for x in (*p, *(sentence(rng, rng.randint(1, 7)) for _ in range(rng.randint(0, own))))]
        out.append((i, "\n".join(lines_)))
    return out


def test_common_passages_in_any_order_match_brute_force(make_docs):
    for seed, (docs, many) in enumerate([(12, 2), (30, 3), (60, 4), (45, 9)]):
        rng = random.Random(20 + seed)
        passages = [[sentence(rng, rng.randint(1, 6)) for _ in range(rng.randint(1, 4))] for _ in range(many)]
        rows = spread(rng, passages, docs)
        assert result(lines.dedup_lines(make_docs(rows))) == brute(rows)


def test_two_orders_of_two_passages(make_docs):
    rng = random.Random(6)
    one, two = sentence(rng, 60), sentence(rng, 60)
    rows = [(1, f"{two}\n{one}")] + [(i, "\n".join([sentence(rng, 9), one, sentence(rng, 9), two])) for i in range(2, 21)]
    found = result(lines.dedup_lines(make_docs(rows)))
    assert found == brute(rows) and sum(one in t for _, t in found) + sum(two in t for _, t in found) == 3


def test_block_of_short_common_lines(make_docs):
    rng = random.Random(7)
    a, b = sentence(rng, 3), sentence(rng, 3)
    rows = [(1, f"{a}\n{sentence(rng, 9)}"), (2, f"{b}\n{sentence(rng, 9)}")] + [
        (i, f"{sentence(rng, 9)}\n{a}\n\n{b}\n{sentence(rng, 9)}") for i in range(3, 21)]
    found = result(lines.dedup_lines(make_docs(rows)))
    assert found == brute(rows) and sum(a in t and b in t for _, t in found) == 1


def test_windows_cover_every_run():
    rng = random.Random(8)
    for _ in range(300):
        n = rng.randint(1, 12)
        hashes = [rng.choice([0, *range(1, 30)]) for _ in range(n)]
        words = [rng.randint(1, 6) if h else 0 for h in hashes]
        kept = [i for i, h in enumerate(hashes) if h]
        cuts = [tuple(p) for spans in lines.windows(hashes, words, 5).values() for p in spans]
        for i in range(len(kept)):
            for j in range(i + 1, len(kept) + 1):
                run = kept[i:j]
                if sum(words[x] for x in run) >= 5:
                    assert {x for c in cuts if set(c) <= set(run) for x in c} == set(run)


def test_names_that_clash_are_kept(spark):
    rows = [(i, "one two three four five six" if i else "one two three four five six\nlast line here", "x", "y", "z", i) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _content string, _first string, __mask string, _copy int")
    found = lines.dedup_lines(docs).orderBy("doc_id").collect()
    assert [(r._content, r._first, r["__mask"], r._copy) for r in found] == [("x", "y", "z", i) for i in range(4)]


def test_clean_documents_and_other_columns_stay(make_docs):
    rng = random.Random(4)
    rows = [(i, "\n".join(sentence(rng, 8) for _ in range(3)) + " \r\n") for i in range(20)]
    found = lines.dedup_lines(make_docs(rows))
    assert result(found) == sorted(rows, key=str)
    assert {r.fingerprint for r in found.collect()} == {"own"} and found.filter("n_deleted > 0 OR is_copy").count() == 0
    assert lines.dedup_lines(make_docs([])).collect() == []
