"""Exact distinct counts that roll up: bitmaps of whole-number keys, merged by OR at any coarser grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.grouping import prefix_sums


def numbered(df: DataFrame, key: str) -> DataFrame:
    """(key, number): the distinct non-null values of a column of any type, numbered without gaps from 1 in their order."""
    values = df.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("_one", F.lit(1))
    return prefix_sums(values, [F.col(key).asc()], "_one").select(key, F.col("position").alias("number"))


def distinct_bitmaps(df: DataFrame, by: Sequence[str], **keys: str) -> DataFrame:
    """``by``, ``kind``, ``bucket`` and ``bits``: which values of each key occur per grain, 32,768 to a row of at most 4 KB.

    ``keys`` maps a kind to a column of whole numbers; NULLs don't count. Bits are set map-side, so a hot grain is shuffled as bitmaps.
    """
    kinds = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("bigint").alias("v")) for kind, c in keys.items()]))
    listed = df.select(*by, kinds.alias("_k")).select(*by, "_k.kind", "_k.v").filter(F.col("v").isNotNull())
    return listed.groupBy(*by, "kind", F.bitmap_bucket_number("v").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """``by`` and one exact distinct count per kind, at any grain of columns ``bitmaps`` has."""
    merged = bitmaps.groupBy(*by, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))), F.lit(0)).alias(kind) for kind in kinds])
