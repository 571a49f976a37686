import random

from shelfwise.llm import rule_ledger as rules
from tests.llm.conftest import sentence


def brute(text):
    text = text or ""
    spaced = text
    for c in "\t\n\x0b\x0c\r":
        spaced = spaced.replace(c, " ")
    words = [w for w in spaced.split(" ") if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measurements_match_brute_force(make_docs, odd_rows):
    rng = random.Random(4)
    rows = [(i, t) for i, t, *_ in odd_rows]
    for i in range(100):
        parts = [sentence(rng, rng.randint(1, 12)) for _ in range(4)]
        rows.append((20 + i, "\n".join(rng.choice(parts) + rng.choice(["", "#", " | <", "\r"]) for _ in range(rng.randint(0, 9)))))
    found = rules.verdicts(make_docs(rows)).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=str)
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_labelled_documents(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = rules.verdicts(docs).join(labels, "doc_id").select("quality", "kept", "n_words", "base_failed").collect()
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert all(not r.kept for r in bad) and all(r.kept for r in good)


def test_ablations_agree_with_evaluating_anew(make_docs):
    rng = random.Random(6)
    rows = [(i, rng.choice(["A! " * 30, "# x " * 25, "ok " * 5, sentence(rng, 40), "same line\n" * 12])) for i in range(80)]
    ledger = rules.ledger(make_docs(rows))
    bits = [r.failed_bits for r in ledger.collect()]
    found = {(r.version, r.rule): r for r in rules.ablations(ledger).collect()}
    for version, names in rules.POLICIES.items():
        for name in names:
            mask, less = rules.policy_mask(names), rules.policy_mask(tuple(n for n in names if n != name))
            r = found[version, name]
            assert r.n_rows == 80 and r.n_kept == sum(not b & mask for b in bits)
            assert r.n_kept_without == sum(not b & less for b in bits) == r.n_kept + r.n_only


def test_empty_table(make_docs):
    assert rules.verdicts(make_docs([])).collect() == []
    assert {r.n_rows for r in rules.ablations(rules.ledger(make_docs([]))).collect()} == {0}
