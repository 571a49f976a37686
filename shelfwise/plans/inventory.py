"""Inventory health questions q01 to q12."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import (
    age_band, col, double, from_date_key, mean, percent, rounded, safe_ratio, stale, supply_band, total,
)
from shelfwise.operators.anchors import (
    anchor_day, current_stock, demand_rate, latest_snapshot, stock_with_last_sale,
)
from shelfwise.operators.grouping import rollup, topk


def q01(star) -> DataFrame:
    """Product-locations at or below reorder point with nothing on order, largest shortfall first."""
    return (
        latest_snapshot(star.snapshot)
        .filter(F.col("is_below_reorder_flag") & (F.col("on_order_qty") == 0))
        .join(star.product.select("product_key", "sku", "product_name"), "product_key")
        .join(star.location.select("location_key", "location_name", "location_type"), "location_key")
        .orderBy((F.col("reorder_point") - F.col("on_hand_qty")).desc(), "sku", "location_name")
        .select("sku", "product_name", "location_name", "location_type", "on_hand_qty", "reorder_point", "on_order_qty")
    )


def q02(star) -> DataFrame:
    """Stocked-out lines, all lines and their share, by region."""
    return (
        rollup(
            latest_snapshot(star.snapshot), star.location, ("location_key", "location_key"), ["region"],
            stockout_lines=("count_if", F.col("is_stockout_flag")), total_lines=("count", F.lit(1)),
        )
        .withColumn("stockout_pct", percent("stockout_lines", "total_lines", 2))
        .orderBy(F.desc("stockout_pct"), "region")
    )


def days_of_supply(star, keys: list[str], days: int = 90, anchor: str = "snapshot") -> DataFrame:
    """Latest stock per row with daily demand and days of supply; stock without demand is kept."""
    return (
        latest_snapshot(star.snapshot)
        .join(demand_rate(star, keys, days, anchor), keys, "left")
        .withColumn("days_of_supply", safe_ratio("on_hand_qty", "daily_demand"))
    )


def q03(star, k: int = 200) -> DataFrame:
    """Days of supply and risk band of stocked product-locations, scarcest first."""
    covered = days_of_supply(star, ["product_key", "location_key"]).filter("on_hand_qty > 0")
    named = covered.join(star.product.select("product_key", "sku"), "product_key").join(
        star.location.select("location_key", "location_name"), "location_key"
    )
    rows = named.select(
        "sku", "location_name", "on_hand_qty",
        F.round("daily_demand", 3).alias("avg_daily_demand"),
        F.round("days_of_supply", 1).alias("days_of_supply"),
        supply_band("days_of_supply", F.col("daily_demand").isNotNull()).alias("supply_band"),
    )
    return topk(rows, k, F.asc_nulls_last("days_of_supply"), F.asc("sku"), F.asc("location_name"))


def dead_stock(star, days: int = 180, anchor: str = "snapshot") -> DataFrame:
    """Products in stock that never sold or last sold more than ``days`` before the anchor."""
    return stock_with_last_sale(star).filter(
        (F.col("on_hand_qty") > 0) & stale("last_sold_date", anchor_day(star, anchor), days)
    )


def q04(star) -> DataFrame:
    return (
        dead_stock(star)
        .join(star.product.select("product_key", "sku", "product_name", "category"), "product_key")
        .select("sku", "product_name", "category", "on_hand_qty", double("on_hand_value").alias("trapped_value"),
                "last_sold_date")
        .orderBy(F.desc("trapped_value"), "sku")
    )


def overstock(star, threshold: float = 120, days: int = 90, keep_no_demand: bool = False) -> DataFrame:
    """Products holding more than ``threshold`` days of supply.

    Without recent demand there is no ratio: such products are left out unless ``keep_no_demand``.
    """
    joined = current_stock(star).join(
        demand_rate(star, ["product_key"], days), "product_key", "left" if keep_no_demand else "inner"
    ).withColumn("days_of_supply", safe_ratio("on_hand_qty", "daily_demand"))
    over = F.col("days_of_supply") > threshold
    return joined.filter(over | F.col("daily_demand").isNull() if keep_no_demand else over)


def q05(star) -> DataFrame:
    return (
        overstock(star)
        .join(star.product.select("product_key", "sku", "category"), "product_key")
        .select("sku", "category", "on_hand_qty", double("on_hand_value").alias("on_hand_value"),
                F.round("days_of_supply", 0).alias("days_of_supply"))
        .orderBy(F.desc("on_hand_value"), "sku")
    )


def q06(star) -> DataFrame:
    """Stock value and product count by time since the last sale."""
    return (
        stock_with_last_sale(star)
        .groupBy(age_band("last_sold_date", anchor_day(star, "calendar")).alias("age_band"))
        .agg(total("on_hand_value").alias("inventory_value"), F.count(F.lit(1)).alias("sku_count"))
        .orderBy("age_band")
    )


def cogs_and_row_average(star) -> DataFrame:
    """Per category: cost of goods sold and the mean of single snapshot row values."""
    cogs = rollup(star.sales, star.product, ("product_key", "product_key"), ["category"], cogs=("sum", "cogs_amount"))
    held = rollup(
        star.snapshot, star.product, ("product_key", "product_key"), ["category"],
        value=("sum", "on_hand_value"), rows=("count", "on_hand_value"),
    )
    return cogs.join(held, "category").withColumn("row_average", safe_ratio("value", "rows"))


def q07(star) -> DataFrame:
    """Turnover by category over the mean row value."""
    return (
        cogs_and_row_average(star)
        .select(
            "category", rounded("cogs").alias("total_cogs"),
            F.round("row_average", 0).alias("avg_inventory_value"),
            safe_ratio("cogs", "row_average", digits=2).alias("inventory_turnover"),
        )
        .orderBy(F.desc_nulls_last("inventory_turnover"), "category")
    )


def fanout_totals(star) -> DataFrame:
    """What joining every sale of a product to every snapshot row of it would add up to, without that join.

    A product with n sales and m snapshot rows repeats each sale max(m, 1) times and each snapshot row max(n, 1) times.
    """
    sold = star.sales.groupBy("product_key").agg(F.sum("cogs_amount").alias("s"), F.count(F.lit(1)).alias("n"))
    held = star.snapshot.groupBy("product_key").agg(
        F.sum("on_hand_value").alias("v"), F.count("on_hand_value").alias("k"), F.count(F.lit(1)).alias("m")
    )
    wide = "decimal(38,2)"
    n, m = F.greatest(F.coalesce("n", F.lit(1)), F.lit(1)), F.greatest(F.coalesce("m", F.lit(1)), F.lit(1))
    return (
        star.product.select("product_key", "category")
        .join(sold, "product_key", "left")
        .join(held, "product_key", "left")
        .groupBy("category")
        .agg(
            F.sum((F.col("s").cast("decimal(24,2)") * m.cast("decimal(12,0)")).cast(wide)).alias("total_cogs"),
            F.sum((F.col("v").cast("decimal(24,2)") * n.cast("decimal(12,0)")).cast(wide)).alias("value_sum"),
            F.sum((F.coalesce("k", F.lit(0)) * n).cast("decimal(38,0)")).alias("value_rows"),
        )
    )


def q08(star) -> DataFrame:
    """Days inventory outstanding by category over the repeated rows of the sales-by-snapshot product."""
    average = safe_ratio("value_sum", "value_rows")
    return (
        fanout_totals(star)
        .select("category", safe_ratio(F.lit(365), safe_ratio("total_cogs", average), digits=1).alias("dio_days"))
        .orderBy(F.desc_nulls_last("dio_days"), "category")
    )


def gmroi_by_product(star) -> DataFrame:
    """Margin, mean row value and their ratio per product that has both."""
    margin = star.sales.groupBy("product_key").agg(F.sum("gross_margin_amount").alias("gm"))
    held = star.snapshot.groupBy("product_key").agg(mean("on_hand_value").alias("avg_cost"))
    return margin.join(held, "product_key").filter("avg_cost > 0").withColumn("gmroi", safe_ratio("gm", "avg_cost"))


def q09(star, k: int = 25) -> DataFrame:
    rows = gmroi_by_product(star).join(star.product.select("product_key", "sku", "category"), "product_key").select(
        "sku", "category", rounded("gm").alias("gross_margin"), F.round("avg_cost", 0).alias("avg_inv_cost"),
        F.round("gmroi", 2).alias("gmroi"),
    )
    return topk(rows, k, F.desc("gmroi"), F.asc("sku"))


def q10(star, k: int = 20) -> DataFrame:
    """Products holding most value, ranked. Only the first ``k`` rows are ranked, which ranks them the same."""
    rows = current_stock(star).join(
        star.product.select("product_key", "sku", "product_name", "category"), "product_key"
    ).select("sku", "product_name", "category", "on_hand_qty", double("on_hand_value").alias("inventory_value"))
    best = topk(rows, k, F.desc("inventory_value"), F.asc("sku"))
    return best.withColumn(
        "value_rank", F.rank().over(Window.orderBy(F.desc("inventory_value"))).cast("bigint")
    )


def month_end_value(star) -> DataFrame:
    """Per month, the value at its last snapshot date."""
    daily = star.snapshot.groupBy("snapshot_month", "snapshot_date_key").agg(F.sum("on_hand_value").alias("v"))
    monthly = daily.groupBy("snapshot_month").agg(
        F.max("snapshot_date_key").alias("last_key"), F.max_by("v", "snapshot_date_key").alias("v")
    )
    day = from_date_key("last_key")
    return monthly.select(F.year(day).alias("year"), F.month(day).alias("month_number"), "v")


def q11(star) -> DataFrame:
    """Month-end value and change against the previous month that has one. One row per month is ordered."""
    previous = F.lag("v").over(Window.orderBy("year", "month_number"))
    return (
        month_end_value(star)
        .select("year", "month_number", rounded("v").alias("inventory_value"),
                rounded(F.col("v") - previous).alias("mom_change"))
        .orderBy("year", "month_number")
    )


def q12(star, k: int = 25) -> DataFrame:
    """Products most often found stocked out."""
    rows = (
        star.snapshot.groupBy("product_key")
        .agg(F.count_if(col("is_stockout_flag")).alias("stockout_days"), F.count(F.lit(1)).alias("observed_days"))
        .filter("stockout_days > 0")
        .join(star.product.select("product_key", "sku", "product_name", "category"), "product_key")
        .select("sku", "product_name", "category", "stockout_days", "observed_days",
                percent("stockout_days", "observed_days", 1).alias("stockout_rate_pct"))
    )
    return topk(rows, k, F.desc("stockout_days"), F.asc("sku"))
