"""Points in time that filters hang on: latest snapshot, the two calendar anchors, trailing windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import from_date_key, month_of_key, to_date_key


def latest_snapshot_key(snap: DataFrame) -> DataFrame:
    """One row: the last snapshot date key, looked up inside the last month partition only."""
    last_month = snap.agg(F.max("snapshot_month")).scalar()
    return snap.filter(F.col("snapshot_month") == last_month).agg(
        F.max("snapshot_date_key").alias("snapshot_date_key")
    )


def latest_snapshot(snap: DataFrame) -> DataFrame:
    """Snapshot rows of the last date.

    The month filter prunes partitions, the date filter prunes row groups. Both values come from scalar subqueries:
    a join on the maximum would read every partition.
    """
    last_month = snap.agg(F.max("snapshot_month")).scalar()
    last_key = latest_snapshot_key(snap).scalar()
    return snap.filter((F.col("snapshot_month") == last_month) & (F.col("snapshot_date_key") == last_key))


def as_of_snapshot(star) -> DataFrame:
    """One row: last calendar day not after the latest snapshot."""
    last_key = latest_snapshot_key(star.snapshot).scalar()
    return star.dates.filter(F.col("date_key") <= last_key).agg(F.max("full_date").alias("as_of_date"))


def as_of_calendar(star) -> DataFrame:
    """One row: last day of the calendar, which may lie after the latest snapshot."""
    return star.dates.agg(F.max("full_date").alias("as_of_date"))


def anchor_day(star, anchor: str) -> Column:
    return {"calendar": as_of_calendar, "snapshot": as_of_snapshot}[anchor](star).scalar()


def trailing_window(sales: DataFrame, anchor: Column, days: int) -> DataFrame:
    """Sales on or after ``anchor - days`` (both ends included, so ``days + 1`` calendar days)."""
    first = to_date_key(F.date_sub(anchor, days))
    return sales.filter((F.col("sale_month") >= month_of_key(first)) & (F.col("date_key") >= first))


def demand_rate(star, keys: list[str], days: int = 90, anchor: str = "calendar") -> DataFrame:
    """Average daily units over the trailing window, per ``keys``."""
    return (
        trailing_window(star.sales, anchor_day(star, anchor), days)
        .groupBy(*keys)
        .agg((F.sum("units_sold_qty").cast("double") / F.lit(float(days))).alias("daily_demand"))
    )


def last_sale(star) -> DataFrame:
    """Per product, the day it last sold."""
    return star.sales.groupBy("product_key").agg(from_date_key(F.max("date_key")).alias("last_sold_date"))


def current_stock(star) -> DataFrame:
    """Per product, quantity and value at the latest snapshot."""
    return (
        latest_snapshot(star.snapshot)
        .groupBy("product_key")
        .agg(F.sum("on_hand_qty").alias("on_hand_qty"), F.sum("on_hand_value").alias("on_hand_value"))
    )


def stock_with_last_sale(star) -> DataFrame:
    """Current stock per product, kept when the product never sold (NULL date)."""
    return current_stock(star).join(last_sale(star), "product_key", "left")


def semi_closing(snap: DataFrame, group_cols: list[str], **values: str) -> DataFrame:
    """Closing balance: sums at the last date that has rows within each group's own context.

    ``values`` maps output name to summed column. Two grouped aggregations, no join and no window.
    """
    if not group_cols:
        return latest_snapshot(snap).agg(*[F.sum(c).alias(n) for n, c in values.items()])
    daily = snap.groupBy(*group_cols, "snapshot_date_key").agg(*[F.sum(c).alias(n) for n, c in values.items()])
    return daily.groupBy(*group_cols).agg(*[F.max_by(n, "snapshot_date_key").alias(n) for n in values])


def semi_avg_daily(snap: DataFrame, group_cols: list[str], **values: str) -> DataFrame:
    """Average of per-date totals; dates without rows do not count."""
    daily = snap.groupBy(*group_cols, "snapshot_date_key").agg(*[F.sum(c).alias(n) for n, c in values.items()])
    return daily.groupBy(*group_cols).agg(
        *[(F.sum(n).cast("double") / F.count(n)).alias(n) for n in values]
    )


def at_closing(snap: DataFrame, group_cols: list[str]) -> DataFrame:
    """Rows at each group's own closing date."""
    if not group_cols:
        return latest_snapshot(snap)
    closing = snap.groupBy(*[F.col(c).alias(f"_{c}") for c in group_cols]).agg(
        F.max("snapshot_date_key").alias("_closing")
    )
    match = F.col("snapshot_date_key") == F.col("_closing")
    for c in group_cols:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return snap.join(closing, match, "left_semi")
