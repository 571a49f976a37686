"""Grouping facts by dimension attributes, ranking and prefix sums that never funnel into one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import shared_folder

# How an aggregate is taken over rows, and over partial results of itself.
FIRST = {"sum": F.sum, "count": F.count, "count_if": F.count_if, "max": F.max, "min": F.min}
MERGE = {"sum": F.sum, "count": F.sum, "count_if": F.sum, "max": F.max, "min": F.min}
_BYTES = {"b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30}


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (-1 means never)."""
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")).strip().lower()
    text = text[:-1] if len(text) > 2 and text.endswith("b") and text[-2] in _BYTES else text
    return int(text[:-1]) * _BYTES[text[-1]] if text[-1] in _BYTES else int(text)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the estimated size of ``df`` stays under the broadcast threshold."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate <= broadcast_limit(df)


def rollup(fact: DataFrame, dim: DataFrame, on: tuple[str, str], attrs: Sequence[str], by: Sequence[str] = (),
           **aggs: tuple[str, str | Column]) -> DataFrame:
    """Aggregate ``fact`` by its own columns ``by`` and attributes of ``dim``; ``on`` is (fact key, dimension key).

    A dimension under the broadcast threshold is joined first, so only one row per attribute value
    and task is shuffled. A larger one is joined after the fact has been reduced to one row per key,
    so a hot key never reaches the join as more than one row.
    """
    fact_key, dim_key = on
    side = dim.select(F.col(dim_key).alias(fact_key), *[a for a in attrs if a != fact_key])
    first = [FIRST[kind](value).alias(name) for name, (kind, value) in aggs.items()]
    if fits_broadcast(side):
        return fact.join(F.broadcast(side), fact_key).groupBy(*by, *attrs).agg(*first)
    merged = [MERGE[kind](name).alias(name) for name, (kind, _) in aggs.items()]
    return fact.groupBy(*dict.fromkeys([*by, fact_key])).agg(*first).join(side, fact_key).groupBy(*by, *attrs).agg(*merged)


def topk(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows of a total order; planned as one bounded heap per task plus a final merge."""
    return df.orderBy(*order).limit(k)


def share_of_total(value: str | Column) -> Column:
    """``value`` over its sum across all rows. For grains of bounded size (category, region) only."""
    everything = F.sum(value).over(Window.partitionBy(F.lit(1)))
    return F.col(value).cast("double") / F.nullif(everything.cast("double"), F.lit(0.0))


def prefix_sums(df: DataFrame, order: Sequence[Column], value: str) -> DataFrame:
    """Running sum of ``value`` along a total order over all rows, in two parallel phases.

    Adds ``position``, ``running``, ``grand_total`` and ``row_total``. Rows are range-partitioned and stored
    once, so slice numbers cannot move under recomputation; each slice is summed on its own, and the
    slice totals (one row per slice) give every slice its offset.
    """
    shared_folder(df.sparkSession)
    sliced = df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()).checkpoint()
    within = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(F.lit(1))
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_slice",
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.sum("_sum").over(everywhere).alias("grand_total"),
            F.sum("_rows").over(everywhere).alias("row_total"),
        )
    )
    # one row per slice, at most spark.sql.shuffle.partitions rows
    return (
        sliced.withColumn("_running", F.sum(value).over(within))
        .withColumn("_position", F.row_number().over(within))
        .join(F.broadcast(offsets), "_slice")
        .withColumn("position", F.col("_position") + F.col("_rows_before"))
        .withColumn("running", F.col("_running") + F.col("_sum_before"))
        .drop("_slice", "_running", "_position", "_sum_before", "_rows_before")
    )


def global_rank(df: DataFrame, value: str, name: str, within: Sequence[str] = ()) -> DataFrame:
    """Rank of every row by descending ``value`` among rows equal in ``within``, with gaps on ties, without ordering all rows in one task.

    Ranks are found on distinct values, then looked up; a value shared by many rows is one row on the lookup side.
    """
    counts = df.groupBy(*within, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = prefix_sums(counts, [*[F.col(c).asc() for c in within], F.col(value).desc()], "_n").select(
        *[F.col(c).alias(f"_{c}") for c in within], F.col(value).alias("_value"), (F.col("running") - F.col("_n")).alias("_before"))
    ranked = placed.withColumn(name, F.col("_before") + 1)
    for_rows = F.col(value).eqNullSafe(F.col("_value"))
    if within:
        keys = [f"_{c}" for c in within]
        first = placed.groupBy(*[F.col(k).alias(f"{k}_first") for k in keys]).agg(F.min("_before").alias("_first"))
        same = [F.col(k).eqNullSafe(F.col(f"{k}_first")) for k in keys]
        ranked = placed.join(first, reduce(lambda a, b: a & b, same)).withColumn(name, F.col("_before") - F.col("_first") + 1)
        ranked = ranked.drop(*[f"{k}_first" for k in keys], "_first")
        for_rows = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in within], for_rows)
    return df.join(ranked, for_rows).drop("_value", "_before", *[f"_{c}" for c in within])


def exact_quantile(df: DataFrame, value: str, q: float) -> DataFrame:
    """One row, one column ``quantile``: exact, linearly interpolated between neighbours.

    Works on distinct values with their counts, so repeated values cost one row each.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    placed = prefix_sums(counts, [F.col(value).asc()], "_n")
    target = (F.col("grand_total") - 1) * F.lit(float(q))
    # zero-based positions running - _n ... running - 1 hold this value
    holds = [
        F.when((F.col("running") > at) & (F.col("running") - F.col("_n") <= at), F.col(value).cast("double"))
        for at in (F.floor(target), F.ceil(target))
    ]
    return placed.select(
        holds[0].alias("_low"), holds[1].alias("_high"), (target - F.floor(target)).alias("_part")
    ).agg(
        (F.max("_low") + (F.max("_high") - F.max("_low")) * F.max("_part")).alias("quantile")
    )
