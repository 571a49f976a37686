"""Line deduplication by pairwise alignment: shared rare lines find the pairs, patience diff aligns them.

Identical texts are folded first. What can be deleted is a run of lines of some words or more, so documents are looked up by the shortest such
windows that begin or end at each line (mostly a single line). All holders of a rare window are paired. Holders of a common one are aligned with
its earliest holder; where that leaves the window in a later document, because the two hold their common lines in different orders, with
the next holders, ever more of them, until the window is gone or no earlier holder is left. The result is that of aligning all pairs.

Every pair is aligned as two sequences of line hashes, and the runs of aligned lines are deleted from the later document. All alignments see
the original texts, so their order doesn't matter.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import stored, tidy

#: A window in at most so many different texts is rare. It decides how pairs are found, not what is deleted.
RARE = 8
#: Holders tried in the next round, as a multiple of those before.
WIDEN = 8
#: Runs of aligned lines with fewer words stay.
MIN_BLOCK_WORDS = 5


def _unique(a: Sequence[int], b: Sequence[int], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Places of lines that are unique in both ranges; without any, places of the same occurrence of a repeated line."""
    def once(x: Sequence[int], low: int, high: int) -> dict[int, int]:
        found: dict[int, int] = {}
        for i in range(low, high):
            found[x[i]] = -1 if x[i] in found else i
        return found

    ours, theirs = once(a, a0, a1), once(b, b0, b1)
    pairs = [(i, theirs[h]) for h, i in ours.items() if i >= 0 and theirs.get(h, -1) >= 0]
    if pairs or not ours.keys() & theirs.keys():
        return pairs

    def numbered(x: Sequence[int], low: int, high: int) -> dict[tuple[int, int], int]:
        seen: dict[int, int] = {}
        found = {}
        for i in range(low, high):
            seen[x[i]] = seen.get(x[i], 0) + 1
            found[x[i], seen[x[i]]] = i
        return found

    ours2, theirs2 = numbered(a, a0, a1), numbered(b, b0, b1)
    return [(i, theirs2[k]) for k, i in ours2.items() if k in theirs2]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain that increases in both places, by patience sorting; ``pairs`` increase in the first."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        back[k] = ends[at - 1] if at else -1
        if at == len(tops):
            tops.append(j)
            ends.append(k)
        else:
            tops[at], ends[at] = j, k
    chain = []
    k = ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) of equal lines, increasing in both: ends first, then unique lines, then the gaps between."""
    matched: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        chain = _increasing(sorted(_unique(a, b, a0, a1, b0, b1)))
        if not chain:
            continue
        matched.extend(chain)
        for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *chain], [*chain, (a1, b1)], strict=True):
            if i + 1 < k and j + 1 < m:
                todo.append((i + 1, k, j + 1, m))
    return sorted(matched)


def deleted_lines(a: Sequence[int], b: Sequence[int], words: Sequence[int], min_words: int = MIN_BLOCK_WORDS) -> list[int]:
    """Places in ``b`` that lie in runs of lines aligned with ``a``; 0 stands for a line without words and breaks no run."""
    ours, theirs = [i for i, h in enumerate(a) if h], [j for j, h in enumerate(b) if h]
    out: list[int] = []
    run: list[int] = []
    last = (-2, -2)
    for i, j in [*patience([a[i] for i in ours], [b[j] for j in theirs]), (-2, -2)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[x] for x in run) >= min_words:
                out.extend(run)
            run = []
        last = (i, j)
        run.append(theirs[j] if j >= 0 else -1)
    return out


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Record batches a few rows at a time, as their lists take many times the room."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _lines(docs: DataFrame) -> DataFrame:
    """(id, content, hashes, words) of rows that have a word; one hash and word count per line, 0 for lines without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            keep, hashes, words = [], [], []
            for k, x in enumerate(batch.column(2)):
                found = [line.split() for line in (x.as_py() or "").encode().split(b"\n")]
                if any(found):
                    keep.append(k)
                    hashes.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(w)) or 1 if w else 0 for w in found], np.uint64).view(np.int64))
                    words.append([len(w) for w in found])
            own = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own.column(0), own.column(1), pa.array(hashes, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32()))],
                ["id", "content", "hashes", "words"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "content", "text").mapInArrow(
        tidy(run), f"id {kind}, content string, hashes array<bigint>, words array<int>")


def windows(hashes: Sequence[int], words: Sequence[int], min_words: int) -> dict[int, list[list[int]]]:
    """Shortest windows of ``min_words`` or more that begin or end at a line, by hash; places of their lines, without lines that have no words."""
    at = [i for i, h in enumerate(hashes) if h]
    found: dict[int, list[list[int]]] = {}
    cuts = set()
    end, total = 0, 0
    for start in range(len(at)):
        while end < len(at) and total < min_words:
            total += words[at[end]]
            end += 1
        if total >= min_words:
            cuts.add((start, end))
        total -= words[at[start]]
    start, total = len(at), 0
    for end in range(len(at), 0, -1):
        while start > 0 and total < min_words:
            start -= 1
            total += words[at[start]]
        if total >= min_words:
            cuts.add((start, end))
        total -= words[at[end - 1]]
    for start, end in sorted(cuts):
        places = at[start:end]
        one = hashes[places[0]] if len(places) == 1 else xxhash.xxh3_64_intdigest(np.array([hashes[i] for i in places], np.int64).tobytes())
        found.setdefault(one - (1 << 64) if one >= 1 << 63 else one, []).append(places)
    return found


def _holders(texts: DataFrame, min_words: int) -> DataFrame:
    """(h, doc, places): each text's windows; ``doc`` orders texts, earlier ones first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows, hashes, places = [], [], []
            for k, (h, w) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                for one, spans in windows(h, w, min_words).items():
                    rows.append(k)
                    hashes.append(one)
                    places.append(spans)
            doc = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), doc, pa.array(places, pa.list_(pa.list_(pa.int32())))], ["h", "doc", "places"])

    own = texts.select(F.struct("first.missing", "first.id", "content").alias("doc"), "hashes", "words")
    return own.mapInArrow(tidy(run), f"h bigint, doc {own.schema['doc'].dataType.simpleString()}, places array<array<int>>")


def _shared(texts: DataFrame, min_words: int) -> DataFrame:
    """Holders of windows that several texts have, with their number and the earliest."""
    holders = _holders(texts, min_words)
    lines = holders.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("lead")).filter("n > 1")
    return stored(holders.join(lines, "h"), "lines")


def _first_pairs(shared: DataFrame, rare: int) -> DataFrame:
    """(a, b): contents of an earlier and a later text: all holders of a rare window, each holder of a common one with the earliest."""
    few = shared.filter(F.col("n") <= rare)
    a, b = few.select("h", F.col("doc").alias("earlier")), few.select(F.col("h").alias("h2"), F.col("doc").alias("later"))
    close = a.join(b, (a.h == b.h2) & (F.col("earlier") < F.col("later"))).select(
        F.col("earlier.content").alias("a"), F.col("later.content").alias("b"))
    far = shared.filter((F.col("n") > rare) & (F.col("doc") != F.col("lead"))).select(
        F.col("lead.content").alias("a"), F.col("doc.content").alias("b"))
    return close.unionByName(far).distinct()


def _left_over(shared: DataFrame, found: DataFrame, rare: int, tried: int) -> DataFrame:
    """(h, doc) of common windows that stay in a later text though holders beyond the first ``tried`` may align them."""
    lines = found.groupBy("content").agg(F.flatten(F.collect_list("found")).alias("found"))
    common = shared.filter((F.col("n") > max(rare, tried)) & (F.col("doc") != F.col("lead"))).select("h", "doc", "places")
    stays = F.exists("places", lambda p: F.size(F.array_except(p, F.coalesce("found", F.array().cast("array<int>")))) > 0)
    return common.join(lines, F.col("doc.content") == F.col("content"), "left").filter(stays).select("h", "doc")


def _next_pairs(shared: DataFrame, left: DataFrame, tried: int, upto: int) -> DataFrame:
    """Texts of ``left`` with the holders of their window after the first ``tried``, up to ``upto``."""
    order = Window.partitionBy("h").orderBy("doc")
    # ranks up to a bound are cut in every task before they meet
    holders = shared.select("h", "doc").join(left.select("h").distinct(), "h", "left_semi").withColumn("at", F.row_number().over(order)).filter(
        (F.col("at") <= upto)).filter(F.col("at") > tried).select("h", F.col("doc").alias("earlier"))
    return left.join(holders, "h").filter(F.col("earlier") < F.col("doc")).select(
        F.col("earlier.content").alias("a"), F.col("doc.content").alias("b")).distinct()


def _aligned(pairs: DataFrame, texts: DataFrame, min_words: int) -> DataFrame:
    """(content, found): the lines one pair deletes from the later text, where it deletes any."""
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            ours, theirs, words = (batch.column(i).to_pylist() for i in (1, 2, 3))
            found = [deleted_lines(x, y, w, min_words) for x, y, w in zip(ours, theirs, words, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["content", "found"])

    ours = texts.select(F.col("content").alias("a"), F.col("hashes").alias("ours"))
    theirs = texts.select(F.col("content").alias("b"), F.col("hashes").alias("theirs"), "words")
    both = pairs.join(ours, "a").join(theirs, "b").select("b", "ours", "theirs", "words")
    lines = both.mapInArrow(tidy(align), "content string, found array<int>").select("content", F.explode("found").alias("line"))
    return lines.groupBy("content").agg(F.collect_set("line").alias("found"))


def _deleted(texts: DataFrame, rare: int, min_words: int) -> DataFrame:
    """(content, mask): the lines to delete from later texts, over all pairs that delete any."""
    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch.column(1).to_pylist():
                mask = np.zeros(max(found) + 1, dtype=bool)
                mask[found] = True
                out.append(mask)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.bool_()))], ["content", "mask"])

    shared = _shared(texts, min_words)
    found = stored(_aligned(_first_pairs(shared, rare), texts, min_words), "deleted")
    tried = 1
    while True:
        left = stored(_left_over(shared, found, rare, tried), "left")
        if left.isEmpty():
            break
        more = stored(_aligned(_next_pairs(shared, left, tried, tried * WIDEN), texts, min_words), "deleted")
        found, tried = found.unionByName(more), tried * WIDEN
    return found.groupBy("content").agg(F.flatten(F.collect_list("found")).alias("found")).mapInArrow(tidy(masks), "content string, mask array<boolean>")


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while (name := f"_{name}") in taken:
        pass
    return name


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: int = RARE,
                min_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """``docs`` with the text without lines aligned with earlier documents, and n_lines, n_deleted, is_copy.

    Earlier means a smaller id; a null id is last, ties go by content. An identical text of ``min_words`` or more loses all lines
    (is_copy); rows repeated with their id are one document and keep the same lines. Null and word-free texts stay as they
    are. Columns named n_lines, n_deleted or is_copy are replaced, others kept; lines without words stay, unless nothing else is left.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).alias("id"), F.md5(text).alias("content"), text.alias("text"))
    folded = _lines(own).groupBy("content").agg(
        F.min(F.struct(F.isnull("id").alias("missing"), "id")).alias("first"), F.count(F.lit(1)).alias("copies"),
        F.first("hashes").alias("hashes"), F.first("words").alias("words"))
    texts = stored(folded, "texts")
    masks = _deleted(texts, rare, min_words)
    content, first, mask, is_copy = (_unused(docs, c) for c in ("content", "first", "mask", "copy"))
    total = F.aggregate("words", F.lit(0).cast("long"), lambda s, x: s + x)
    verdicts = (
        texts.select("content", F.when((F.col("copies") > 1) & (total >= min_words), F.col("first")).alias("first"))
        .join(masks, "content", "left").filter("first IS NOT NULL OR mask IS NOT NULL")
        .select(F.col("content").alias(content), F.col("first").alias(first), F.col("mask").alias(mask))
    )
    lines = F.split(F.col(text_col), "\n", -1)
    copy = F.coalesce(F.col(first).isNotNull() & ~F.col(f"{first}.id").eqNullSafe(F.col(id_col)), F.lit(False))

    def gone(i: Column) -> Column:
        return F.coalesce(F.get(mask, i), F.lit(False))

    kept = F.filter(lines, lambda x, i: ~gone(i))
    left = F.when(F.exists(kept, lambda x: x.rlike(r"[^\x20\x09-\x0D]")), F.concat_ws("\n", kept)).otherwise("")
    joined = docs.withColumn(content, F.md5(text)).join(verdicts, content, "left").withColumn(is_copy, copy)
    touched = F.col(is_copy) | F.col(mask).isNotNull()
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    return joined.withColumns({
        "n_lines": n_lines.cast("int"),
        "n_deleted": F.when(F.col(is_copy), n_lines).when(F.col(mask).isNotNull(), n_lines - F.size(kept)).otherwise(0).cast("int"),
        "is_copy": F.col(is_copy),
        text_col: F.when(F.col(is_copy), F.lit("")).when(touched, left).otherwise(F.col(text_col)),
    }).drop(content, first, mask, is_copy)
