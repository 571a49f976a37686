"""Phrase collocations by vertical partitioning of the suffixes of a corpus.

Every word of a piece begins a suffix, cut off after four words. Prefixes of two words are counted over the corpus and put into groups of about a
memory budget of occurrences each, contiguous in key order; a prefix over the budget has groups of its own, dealt by its third word. The
suffixes of a group meet in one task, in order, and its depth-truncated subtrees are built from them with no other group's help: equal
prefixes are neighbours, so only the path to the current leaf is held, and the count of a node is the total of its leaves. No phrase is more
frequent than its words and pairs, so a suffix also ends before a rare word or pair.

A key is language and words with a zero byte between them, the lowest byte there is, so that all suffixes of a prefix are neighbours.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored, tidy
from shelfwise.operators.grouping import prefix_sums

DEPTH = 4
#: Occurrences of a group, unless the corpus would then have more than ``MAX_GROUPS`` of them.
BUDGET, MAX_GROUPS = 1 << 18, 8192
MIN_COUNT = 30
TOP = 2000
#: Bits a frequent word or pair has in its filter, and the filter's largest size (2^27 bits, 16 MB): a fuller filter spares less work, results stay.
FILTER_BITS, MAX_FILTER = 16, 27
_BUCKET = 1 << 15
_CHUNK_BYTES = 1 << 23
_KNOWN = 1 << 19
_SEPARATORS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n" * 10 + b" ")
#: Stands where a piece ends; no UTF-8 text holds this byte.
_END = b"\xff"


def _tokens(texts: list[bytes]) -> list[bytes]:
    """Words of all texts with a mark wherever a piece ends."""
    return b"\n".join(texts).lower().translate(_SEPARATORS).replace(b"\n", b" \xff ").split()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[bytes]]]:
    """Texts by language, some megabytes at a time; a text is never cut."""
    now: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
            if text.is_valid:
                data = text.as_py()
                now.setdefault(lang.as_py(), []).append(data)
                size += len(data)
                if size >= _CHUNK_BYTES:
                    yield now
                    now, size = {}, 0
    if now:
        yield now


def _own(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, f) of every word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for chunk in _chunks(batches):
            for lang, texts in chunk.items():
                counts.setdefault(lang, Counter()).update(_tokens(texts))
            if sum(map(len, counts.values())) > _KNOWN:
                yield from out(counts)
                counts = {}
        yield from out(counts)

    def out(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(_END, None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(list(found), pa.binary()).cast(pa.string()),
                 pa.array(list(found.values()), pa.int64())], ["lang", "phrase", "f"])

    partial = _own(docs, text_col, lang_col).mapInArrow(tidy(run), "lang string, phrase string, f long")
    return partial.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


class _Frequent:
    """A filter of bounded size that knows every frequent word or pair, and a few others."""

    def __init__(self, rows: DataFrame, code: Column):
        self.bits = 1 << min(MAX_FILTER, max(15, (FILTER_BITS * rows.count()).bit_length()))
        at = code.bitwiseAND(F.lit(self.bits - 1)) + 1
        # at most bits / 32768 rows of 4 KB
        found = rows.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("map"))
        self.table = np.zeros(self.bits // 8, np.uint8)
        for r in found.toLocalIterator():
            start = (r.bucket - 1) * _BUCKET // 8
            self.table[start:start + _BUCKET // 8] = np.frombuffer(r.map, np.uint8)

        self.bytes = self.table.tobytes()

    def may_have(self, codes: np.ndarray) -> np.ndarray:
        at = codes & np.uint64(self.bits - 1)
        return (self.table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def may_have_one(self, code: int) -> bool:
        at = code & self.bits - 1
        return bool(self.bytes[at >> 3] >> (at & 7) & 1)


def _word_code(word: str) -> Column:
    return F.xxhash64(F.col("lang"), F.expr(word))


def _pair_code() -> Column:
    """Of a phrase of two words, from the codes of both, the second turned by seven bits."""
    first, second = _word_code("split(phrase, ' ')[0]"), _word_code("split(phrase, ' ')[1]")
    return first.bitwiseXOR(F.shiftrightunsigned(second, 7).bitwiseOR(F.shiftleft(second, 57)))


def _pair_codes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return first ^ (second >> np.uint64(7) | second << np.uint64(57))


def _escaped(word: bytes) -> bytes:
    """The same order, without zero bytes."""
    return word.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01") if b"\x00" in word or b"\x01" in word else word


def _plain(word: bytes) -> bytes:
    return re.sub(rb"\x01([\x01\x02])", lambda m: b"\x00" if m[1] == b"\x01" else b"\x01", word, flags=re.DOTALL) if b"\x01" in word else word


class _Numbers(dict):
    """Numbers of a language's words, given when a word is first met."""

    def __init__(self, seed: int, frequent: _Frequent):
        self.seed, self.frequent, self.names, self.codes = seed, frequent, [b""], [0]
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word, self.seed)
        if not self.frequent.may_have_one(code):
            self[word] = 0
            return 0
        self[word] = number = len(self.names)
        self.names.append(_escaped(word))
        self.codes.append(code)
        return number


class _Words:
    """Numbers of a language's frequent words from one on; a rare word, like the end of a piece, ends a suffix and is zero."""

    def __init__(self, lang: str, frequent: _Frequent):
        name = lang.encode()
        self.lang = _escaped(name)
        self.known = _Numbers(xxhash.xxh64_intdigest(name, 42), frequent)
        self.names = self.known.names

    @property
    def codes(self) -> np.ndarray:
        return np.array(self.known.codes, np.uint64)

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))

    def pairs(self, tokens: list[bytes]) -> tuple[pa.Array, pa.Array]:
        """Keys of the distinct pairs with their counts."""
        ids = self.numbers(tokens)
        both = ids[:-1] << 32 | ids[1:]
        found, counts = np.unique(both[(ids[:-1] > 0) & (ids[1:] > 0)], return_counts=True)
        names = pa.array(self.names, pa.binary())
        parts = names.take(pa.array(found >> 32)), names.take(pa.array(found & (1 << 32) - 1))
        return pc.binary_join_element_wise(pa.scalar(self.lang, pa.binary()), *parts, pa.scalar(b"\x00", pa.binary())), pa.array(counts, pa.int64())

    def suffixes(self, tokens: list[bytes], pairs: _Frequent) -> Iterator[tuple[bytes, bytes, int]]:
        """Distinct suffixes of three or four words as the key of the first two, the rest, and their count, by pair."""
        ids = self.numbers(tokens)
        codes = self.codes[ids]
        go_on = (ids[:-1] > 0) & (ids[1:] > 0)
        go_on[go_on] = pairs.may_have(_pair_codes(codes[:-1][go_on], codes[1:][go_on]))
        at = np.flatnonzero(go_on[:-1] & go_on[1:])
        more = np.append(go_on, [False, False])[at + 2]
        last = np.where(more, np.append(ids, 0)[np.minimum(at + 3, len(ids))], 0)
        high, low = ids[at] << 32 | ids[at + 1], ids[at + 2] << 32 | last
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(order))).tolist()
        mask, names = (1 << 32) - 1, self.names
        for h, w, count in zip(high[starts].tolist(), low[starts].tolist(), counts, strict=True):
            rest = names[w >> 32]
            yield b"\x00".join((self.lang, names[h >> 32], names[h & mask])), b"%b\x00%b" % (rest, names[w & mask]) if w & mask else rest, count


def _by_language(batches: Iterator[pa.RecordBatch], frequent: _Frequent) -> Iterator[tuple[_Words, list[bytes]]]:
    """Words of a language in each chunk; texts are whole."""
    known: dict[str, _Words] = {}
    for chunk in _chunks(batches):
        for lang, texts in chunk.items():
            yield known.setdefault(lang, _Words(lang, frequent)), _tokens(texts)
        if sum(len(w.known) for w in known.values()) > _KNOWN:
            known = {}


def pair_counts(docs: DataFrame, frequent: _Frequent, min_count: int) -> DataFrame:
    """(lang, phrase, f, key) of every pair of words that occurs ``min_count`` times or more."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, tokens in _by_language(batches, frequent):
            keys, counts = words.pairs(tokens)
            for at in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([keys[at:at + (1 << 16)], counts[at:at + (1 << 16)]], ["key", "f"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [[_plain(p).decode() for p in k.split(b"\x00")] for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in parts], pa.string()), pa.array([f"{p[1]} {p[2]}" for p in parts], pa.string()), batch.column(1),
                 batch.column(0)], ["lang", "phrase", "f", "key"])

    partial = docs.mapInArrow(count, "key binary, f long").groupBy("key").agg(F.sum("f").alias("f"))
    return partial.filter(F.col("f") >= min_count).mapInArrow(named, "lang string, phrase string, f long, key binary")


def _groups(pairs: DataFrame, budget: int) -> tuple[list[bytes], dict[bytes, tuple[int, int]]]:
    """First keys of the groups, in order, and (first group, groups) of each pair over the budget. At most about three a budget."""
    placed = prefix_sums(pairs.filter(F.col("f") <= budget), [F.col("key").asc()], "f")
    starts = placed.groupBy(F.floor((F.col("running") - F.col("f")) / F.lit(budget)).alias("group")).agg(F.min("key").alias("key"))
    first = sorted(bytes(r.key) for r in starts.select("key").toLocalIterator())
    hot, at = {}, len(first) + 1
    for r in pairs.filter(F.col("f") > budget).select("key", "f").orderBy("key").toLocalIterator():
        hot[bytes(r.key)] = at, -(-r.f // budget)
        at += -(-r.f // budget)
    return first, hot


def _nodes(batches: Iterator[pa.RecordBatch], min_count: int) -> Iterator[pa.RecordBatch]:
    """Nodes of three words or more of the subtrees, from suffixes in order; a node is done when the path leaves it."""
    path: list[bytes] = []
    totals: list[int] = []
    out: list[tuple[str, str, int, int]] = []

    def leave(depth: int) -> None:
        while len(path) > depth:
            total = totals.pop()
            if len(path) > 3 and total >= min_count:
                lang, *found = map(_plain, path)
                out.append((lang.decode(), b" ".join(found).decode(), len(found), total))
            path.pop()
            if totals:
                totals[-1] += total

    def record() -> pa.RecordBatch:
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.int64()), strict=True)], ["lang", "phrase", "k", "f"])

    last = None
    for batch in batches:
        for key, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if key != last:
                words = key.split(b"\x00")
                same, most = 0, min(len(words), len(path))
                while same < most and words[same] == path[same]:
                    same += 1
                leave(same)
                path += words[same:]
                totals += [0] * (len(words) - same)
                last = key
            totals[-1] += n
        if out:
            yield record()
            out.clear()
    leave(0)
    if out:
        yield record()


def phrase_counts(docs: DataFrame, words: DataFrame, min_count: int = MIN_COUNT, budget: int = BUDGET,
                  text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, k, f) of every phrase of two to four words that occurs ``min_count`` times or more; ``words`` as from ``word_counts``."""
    own = _own(docs, text_col, lang_col)
    frequent = _Frequent(words.filter(F.col("f") >= min_count), _word_code("phrase"))
    pairs = stored(pair_counts(own, frequent, min_count), "pairs")
    often = _Frequent(pairs, _pair_code())
    budget = max(budget, (pairs.agg(F.sum("f")).first()[0] or 0) // MAX_GROUPS)
    starts, hot = _groups(pairs, budget)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, tokens in _by_language(batches, frequent):
            keys, groups, counts, last = [], [], [], None
            for pair, rest, n in words.suffixes(tokens, often):
                if pair != last:
                    last, group, split = pair, bisect_right(starts, pair), hot.get(pair)
                keys.append(b"%b\x00%b" % (pair, rest))
                groups.append(split[0] + zlib.crc32(rest.partition(b"\x00")[0]) % split[1] if split else group)
                counts.append(n)
            for at in range(0, len(keys), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(groups[part], pa.int32()), pa.array(keys[part], pa.binary()), pa.array(counts[part], pa.int64())],
                    ["group", "key", "n"])

    suffixes = own.mapInArrow(tidy(run), "group int, key binary, n long")
    ordered = suffixes.repartition("group").sortWithinPartitions("key").select("key", "n")
    nodes = ordered.mapInArrow(lambda batches: _nodes(batches, min_count), "lang string, phrase string, k int, f long")
    return pairs.select("lang", "phrase", F.lit(2).alias("k"), "f").unionByName(nodes)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, budget: int = BUDGET,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts, A-Z lower-cased, are split at ``. , ; : ! ?`` and line ends into pieces and those at blanks and tabs into words. A phrase of two
    to four words occurring a times, a >= ``min_count``, is cut where floor(2000000 a / (l + r)) is lowest, l and r being the counts of its
    parts, ties at the earlier cut. Phrases that lie in a longer such phrase with at least 0.8 of their count are dropped. Order is by score and
    a, descending, and by phrase in UTF-8; n counts the language's words. A null text counts as empty, a null language is ``und``; repeated rows
    count each; an empty table gives no rows; other columns are not read.
    """
    words = stored(word_counts(docs, text_col, lang_col), "word-counts")
    phrases = stored(phrase_counts(docs, words, min_count, budget, text_col, lang_col), "phrases")
    counts = words.filter(F.col("f") >= min_count).unionByName(phrases.drop("k"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    cuts = phrases.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", F.expr("substring_index(phrase, ' ', cut)").alias("left"),
        F.expr("substring_index(phrase, ' ', cut - k)").alias("right"))
    # decimals hold 38 digits; the quotient is at most a million
    score = F.expr("(2000000BD * CAST(a AS decimal(28, 0))) div (CAST(l AS decimal(20, 0)) + CAST(r AS decimal(20, 0)))")
    best = (
        cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).groupBy("lang", "phrase")
        .agg(F.min(F.struct(score.alias("score"), "cut", "l", "r", "a")).alias("b")).select("lang", "phrase", "b.a", "b.l", "b.r", "b.score")
    )
    inner = phrases.filter("k > 2").select(
        "lang", "f", "k", "phrase", F.explode(F.expr(
            "flatten(transform(sequence(2, k - 1), many -> transform(sequence(1, k - many + 1), at -> struct(at, many))))")).alias("s")
    ).select("lang", "f", F.expr("array_join(slice(split(phrase, ' '), s.at, s.many), ' ')").alias("phrase"))
    widest = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(widest, ["lang", "phrase"], "left").filter(
        "longer IS NULL OR 100BD * CAST(longer AS decimal(20, 0)) < 80BD * CAST(a AS decimal(20, 0))")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
