"""Quality rules as a ledger: each rule is evaluated once per document, policies and ablations read only its bits.

A ledger row holds the measurements of a document and ``failed_bits``, where bit i is set if rule i failed. A policy is a version
name with a mask of rules; applying it, comparing versions and leaving rules out never read a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_caps_words", "n_bangs", "n_stutters")


@dataclass(frozen=True)
class Rule:
    """A named condition on measurements that is true for a failing document."""

    name: str
    fails: str


#: Bit i of ``failed_bits`` belongs to rule i. New rules go to the end, so stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("capitals", "10 * n_caps_words > 3 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("exclamations", "10 * n_bangs > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 16 * n_words"),
    Rule("stutter", "5 * n_stutters > n_words"),
)
#: Versioned policies: the names of the rules that a kept document must pass.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols"),
    "v2": tuple(rule.name for rule in RULES),
}


def policy_mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    place = {rule.name: i for i, rule in enumerate(rules)}
    return sum(1 << place[name] for name in set(names))


def _repeated_words(ids: np.ndarray, window: int) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(window):
        mixed = (mixed + ids[i:i + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    ordered = np.sort(mixed)
    if not (ordered[1:] == ordered[:-1]).any():  # equal windows have equal values, so none repeats
        return 0
    suspects = np.flatnonzero(np.isin(mixed, ordered[1:][ordered[1:] == ordered[:-1]]))
    # exact: compare the windows themselves, as rows of word numbers
    rows = ids[suspects[:, None] + np.arange(window)]
    _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = suspects[counts[inverse.reshape(-1)] > 1]
    step = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + window, -1)
    return int((np.cumsum(step) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """Values of ``MEASURES`` of one whole text; null counts as empty."""
    text = text or ""
    data = text.encode()
    found = data.split()
    place = {word: i for i, word in enumerate(dict.fromkeys(found))}
    ids = np.fromiter(map(place.__getitem__, found), dtype=np.int64, count=len(found))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(found), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines),
        len(lines) - len(set(lines)), _repeated_words(ids, WINDOW), sum(map(bytes.isupper, found)), text.count("!"),
        int((ids[1:] == ids[:-1]).sum()),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per input row: id, the measurements, ``failed_bits``. Other columns are not read; null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(x.as_py()) for x in batch.column(1)]
            columns = [pa.array(list(column), pa.int64()) for column in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", *MEASURES])

    kind = docs.schema[id_col].dataType.simpleString()
    measured = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, {', '.join(f'{name} long' for name in MEASURES)}")
    bits: Column = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits + F.when(F.expr(rule.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return measured.withColumnRenamed("id", id_col).withColumn("failed_bits", bits)


def passes(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a ledger row meets a policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(policy_mask(names, rules)).cast("long")) == 0


def ablations(rows: DataFrame, policies: dict[str, tuple[str, ...]] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule adds to each policy: version, rule, rows failing it, rows only it removes, rows kept with and without it.

    The ledger is first folded to one row per pattern of bits (at most 2 to the number of rules), map-side.
    An empty ledger gives zero counts.
    """
    patterns = rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    total, pick = F.coalesce(F.sum("n"), F.lit(0)), lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    found = []
    for version, names in policies.items():
        mask = F.lit(policy_mask(names, rules)).cast("long")
        for i, rule in enumerate(rules):
            if rule.name in names:
                bit, failed = F.lit(1 << i).cast("long"), F.col("failed_bits").bitwiseAND(mask)
                found.append(F.struct(
                    F.lit(version).alias("version"), F.lit(rule.name).alias("rule"), total.alias("n_rows"),
                    pick(F.col("failed_bits").bitwiseAND(bit) != 0).alias("n_failed"),
                    pick(failed == bit).alias("n_only"), pick(failed == 0).alias("n_kept"),
                    pick((failed == 0) | (failed == bit)).alias("n_kept_without")))
    return patterns.agg(F.array(*found).alias("found")).select(F.inline("found"))


def verdicts(docs: DataFrame, version: str = "v2", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger with ``base_failed`` and ``kept``, the verdict of one policy version; kept is false if the base policy fails."""
    base = passes(POLICIES["base"])
    return ledger(docs, id_col, text_col).withColumn("base_failed", ~base).withColumn("kept", base & passes(POLICIES[version]))
