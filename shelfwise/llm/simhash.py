"""Near-duplicate groups by SimHash: pigeonhole blocks, join on blocks, verified Hamming distance, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import components, stored, tidy, words

BITS = 64
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Signed 64-bit fingerprint of one text; 0 without words. A bit is set if set in over half the shingle hashes."""
    found = words(text)
    if not found:
        return 0
    if len(found) < shingle_words:
        shingles: Iterable[bytes] = [b" ".join(found)]
        total = 1
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(shingle_words)), strict=False))
        total = len(found) - shingle_words + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype="<u8", count=total)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, _CHUNK):
        part = hashes[start:start + _CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(id, fp: long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x.as_py(), shingle_words) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), f"id {kind}, fp long")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _tables(blocks: int, max_bits: int) -> list[int]:
    """Masks of every choice of ``blocks - max_bits`` blocks; two fingerprints that close agree on one of them."""
    if not 0 < max_bits < blocks <= BITS:
        raise ValueError("blocks must exceed max_bits")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(parts, blocks - max_bits)]


def _close(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def links(fps: DataFrame, max_bits: int = 2, blocks: int = 5, hot_bucket: int = 512) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect exactly what pairs within ``max_bits`` connect.

    Buckets up to ``hot_bucket`` are joined with themselves and verified. A larger one is not paired: every
    fingerprint in it is listed under each way of clearing ``max_bits`` of the bits its key leaves free, so
    close ones meet in groups of at most ``2 ** max_bits`` and each group gives a star of edges.
    """
    masks = _tables(blocks, max_bits)
    keys = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)
    ])).alias("k")).select("k.t", "k.key", "fp")
    sizes = keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(keys.join(sizes, ["t", "key"]), "buckets")
    cold = shared.filter(F.col("n") <= hot_bucket)
    a, b = cold.select("t", "key", F.col("fp").alias("a")), cold.select("t", "key", F.col("fp").alias("b"))
    pairs = (
        a.join(b, (a.t == b.t) & (a.key == b.key) & (F.col("a") < F.col("b")) & _close(F.col("a"), F.col("b"), max_bits))
        .select("a", "b")
    )
    free = [[i for i in range(BITS) if not m >> i & 1] for m in masks]
    # at most len(masks) * C(free bits, max_bits) rows, fixed by the parameters
    clear = fps.sparkSession.createDataFrame(
        [(t, _signed(sum(1 << i for i in chosen))) for t, bits in enumerate(free) for chosen in combinations(bits, max_bits)],
        "t int, clear long")
    close = (
        shared.filter(F.col("n") > hot_bucket).join(F.broadcast(clear), "t")
        .groupBy("clear", F.col("fp").bitwiseAND(F.bitwise_not("clear")).alias("rest"))
        .agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    )
    stars = close.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a < b")
    return pairs.unionByName(stars).distinct()


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 2,
                          shingle_words: int = 3, blocks: int = 5, hot_bucket: int = 512) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id, component_key.

    Fingerprints link at ``max_bits`` or fewer differing bits; a component is all that links reach. ``component_id`` is its
    smallest id (null if it has none), ``component_key`` its smallest fingerprint as a signed number. Copies share a
    fingerprint and enter the join as one row. A null text counts as empty, a text without words has fingerprint zero and
    links like any other; a null id and repeated rows each keep their row; other columns are not read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("low"))
    groups = components(links(distinct.select("fp"), max_bits, blocks, hot_bucket))
    keyed = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = keyed.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = keyed.select("fp", "root").join(lowest, "root")
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id", F.col("root").alias("component_key"))
