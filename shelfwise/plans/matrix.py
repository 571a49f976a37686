"""Measures over a matrix: details, subtotals and total in one table.

Every fact is read once, down to the finest grain asked for; the levels above come from that small result by grouping sets. What adds up is
merged; closing balances and daily averages are summed per day and level first, then taken at each level's own last day or averaged; distinct
keys are kept one row each. What fits none of these is worked out level by level.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.grouping import MERGE
from shelfwise.plans.measures import ADDITIVE, MEASURES, SNAPSHOT, SPECIAL, Filters, context, grouped

TOTAL = "total"
#: Balances that don't add up over days: aggregate and column of the daily sums, and filters of their own.
CLOSING: dict[str, tuple[str, str, dict[str, object]]] = {
    "closing_value": ("sum", "on_hand_value", {}), "closing_units": ("sum", "on_hand_qty", {}),
    "below_rows": ("count_if", "is_below_reorder_flag", {}),
    "reorder_rows": ("count_if", "is_below_reorder_flag", {"on_order_qty": 0, "is_active": True}),
}
#: Distinct keys: block, fact and column.
DISTINCT = {"baskets": ("fact_sales", "order_id")}
DAY = "snapshot_date_key"


def level_name(level: Sequence[str]) -> str:
    return ", ".join(level) or TOTAL


def _level_id(level: Sequence[str], columns: Sequence[str]) -> int:
    """What ``grouping_id`` gives for a level: one bit a column, set where the column is rolled up, the first column highest."""
    return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in level)


def rolled(df: DataFrame, columns: Sequence[str], levels: Sequence[Sequence[str]], extra: Sequence[str], *aggs: Column) -> DataFrame:
    """``aggs`` at every level by grouping sets, ``extra`` columns being part of each; ``_level`` tells a rolled-up column from a NULL in it."""
    if not columns and not extra:
        return df.agg(*aggs).select(F.lit(0).cast("bigint").alias("_level"), "*")
    sets = [[F.col(c) for c in [*level, *extra]] for level in levels]
    out = df.groupingSets(sets, *[F.col(c) for c in [*columns, *extra]]).agg(F.grouping_id().alias("_id"), *aggs)
    return out.withColumn("_level", F.shiftright("_id", len(extra)).cast("bigint")).drop("_id")


def matrix(star, names: Sequence[str], levels: Sequence[Sequence[str]], filters: Filters = None) -> DataFrame:
    """``level``, the grain columns (NULL where rolled up) and the named measures, one row per level and grain value found in any fact involved.

    ``levels`` lists grains, ``()`` being the total, which always has a row; each is a set of its own.
    """
    columns = list(dict.fromkeys(c for level in levels for c in level))
    ids = {_level_id(level, columns): level for level in levels}
    if len(ids) != len(levels):
        raise ValueError("a level is given twice")
    blocks = list(dict.fromkeys(b for n in names for b in MEASURES[n][0]))
    parts = []

    per_fact: dict[str, dict] = {}
    for block in blocks:
        if block in ADDITIVE:
            fact, *aggregate = ADDITIVE[block]
            per_fact.setdefault(fact, {})[block] = tuple(aggregate)
    for fact, aggs in per_fact.items():
        fine = grouped(star, fact, columns, filters, **aggs)
        parts.append(rolled(fine, columns, levels, (), *[MERGE[kind](b).alias(b) for b, (kind, _) in aggs.items()]))

    def daily(own: dict[str, object], **aggs) -> DataFrame:
        fine = grouped(star, SNAPSHOT, [*columns, DAY], {**(filters or {}), **own}, **aggs)
        return rolled(fine, columns, levels, (DAY,), *[MERGE[kind](b).alias(b) for b, (kind, _) in aggs.items()])

    balances: dict[tuple, dict] = {}
    for block in blocks:
        if block in CLOSING:
            kind, column, own = CLOSING[block]
            balances.setdefault(tuple(own.items()), {})[block] = (kind, column)
    for own, aggs in balances.items():
        parts.append(daily(dict(own), **aggs).groupBy("_level", *columns).agg(*[F.max_by(b, DAY).alias(b) for b in aggs]))
    if "average_value" in blocks:
        per_day = daily({}, v=("sum", "on_hand_value"))
        parts.append(per_day.groupBy("_level", *columns).agg((F.sum("v").cast("double") / F.count("v")).alias("average_value")))
    for block in blocks:
        if block in DISTINCT:
            fact, key = DISTINCT[block]
            keys = context(star, fact, columns, filters).select(*columns, key).filter(F.col(key).isNotNull()).distinct()
            once = rolled(keys, columns, levels, (key,), F.lit(1).alias("_one"))
            parts.append(once.groupBy("_level", *columns).agg(F.count(F.lit(1)).alias(block)))
    rest = [b for b in blocks if b in SPECIAL and b not in CLOSING and b not in DISTINCT and b != "average_value"]
    for build in dict.fromkeys(SPECIAL[b] for b in rest):
        for at, level in ids.items():
            part = build(star, list(level), filters)
            parts.append(part.select(F.lit(at).cast("bigint").alias("_level"), *level, *[c for c in part.columns if c in rest]))

    if () in map(tuple, levels):
        # the total has a row even over nothing, and counts nothing there
        counts = [b for b in blocks if b in DISTINCT or (b in ADDITIVE and ADDITIVE[b][1] != "sum")]
        nothing = star.spark.range(1).select(F.lit(_level_id((), columns)).cast("bigint").alias("_level"), *[F.lit(0).cast("bigint").alias(b) for b in counts])
        parts.append(nothing)
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    joined = stacked.groupBy("_level", *columns).agg(*[F.max(b).alias(b) for b in blocks])
    label = reduce(lambda c, item: c.when(F.col("_level") == item[0], level_name(item[1])), ids.items(), F.when(F.lit(False), ""))
    return joined.select(label.alias("level"), *columns, *[MEASURES[n][1]().alias(n) for n in names])
