"""Executive and exception questions q49 to q54."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import double, percent, rounded, safe_ratio, stale
from shelfwise.operators.anchors import anchor_day, current_stock, demand_rate, latest_snapshot, stock_with_last_sale
from shelfwise.operators.grouping import topk
from shelfwise.plans.sales import stockout_loss


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One row out of several one-row results with different columns: a union folded by ``max``, not a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def sales_totals(star) -> DataFrame:
    return star.sales.agg(
        F.sum("net_sales_amount").alias("revenue"), F.sum("gross_margin_amount").alias("margin"),
        F.sum("cogs_amount").alias("cogs"), F.sum("discount_amount").alias("discount"),
    )


def closing_totals(star) -> DataFrame:
    return latest_snapshot(star.snapshot).agg(
        F.sum("on_hand_value").alias("closing_value"), F.count_if(F.col("is_stockout_flag")).alias("closing_stockouts")
    )


def q49(star) -> DataFrame:
    """One-row scorecard. Turnover here divides by mean row value times number of products ever in stock."""
    products = star.snapshot.groupBy("product_key").agg(
        F.sum("on_hand_value").alias("v"), F.count("on_hand_value").alias("n")
    )
    held = products.agg((safe_ratio(F.sum("v"), F.sum("n")) * F.count(F.lit(1))).alias("held"))
    return side_by_side(sales_totals(star), closing_totals(star), held).select(
        rounded("revenue").alias("total_revenue"),
        percent("margin", "revenue", 1).alias("gross_margin_pct"),
        rounded("closing_value").alias("current_inventory_value"),
        safe_ratio("cogs", "held", digits=2).alias("approx_turnover"),
        F.col("closing_stockouts").alias("current_stockouts"),
    )


def q50(star, k: int = 100) -> DataFrame:
    """Reorder-now worklist: active products at or below reorder point with nothing on order."""
    rows = (
        latest_snapshot(star.snapshot)
        .filter(F.col("is_below_reorder_flag") & (F.col("on_order_qty") == 0))
        .join(star.product.filter("is_active").select("product_key", "sku", "product_name"), "product_key")
        .join(star.location.select("location_key", "location_name"), "location_key")
        .select("sku", "product_name", "location_name", "on_hand_qty", "reorder_point", "safety_stock_qty",
                (F.col("reorder_point") - F.col("on_hand_qty")).alias("shortfall"))
    )
    return topk(rows, k, F.desc("shortfall"), F.asc("sku"), F.asc("location_name"))


def markdown_candidates(star, threshold: float = 180, no_demand: float = 9999, days: int = 90) -> DataFrame:
    """Products over ``threshold`` days of supply; without recent demand they count as ``no_demand`` days."""
    supply = safe_ratio("on_hand_qty", "daily_demand")
    return (
        current_stock(star).join(demand_rate(star, ["product_key"], days), "product_key", "left")
        .withColumn("days_of_supply", supply)
        .filter(F.coalesce("days_of_supply", F.lit(float(no_demand))) > threshold)
    )


def q51(star, k: int = 50) -> DataFrame:
    rows = markdown_candidates(star).join(star.product.select("product_key", "sku", "category"), "product_key").select(
        "sku", "category", rounded("on_hand_value").alias("inventory_value"),
        F.round("days_of_supply", 0).alias("days_of_supply"),
    )
    return topk(rows, k, F.desc("inventory_value"), F.asc("sku"))


def q52(star) -> DataFrame:
    """Value of stale stock, of all stock, and the share."""
    dead = stale("last_sold_date", anchor_day(star, "calendar"))
    return stock_with_last_sale(star).agg(
        F.sum(F.when(dead, F.col("on_hand_value"))).alias("dead"), F.sum("on_hand_value").alias("all")
    ).select(
        rounded("dead").alias("dead_stock_value"), rounded("all").alias("total_inventory_value"),
        percent("dead", "all", 1).alias("dead_stock_pct"),
    )


def q53(star) -> DataFrame:
    return (
        star.product.groupBy("abc_class", "xyz_class").agg(F.count(F.lit(1)).alias("sku_count"))
        .orderBy("abc_class", "xyz_class")
    )


def q54(star) -> DataFrame:
    """Discounts given, refunds paid and estimated sales lost to empty shelves."""
    refunds = star.returns.agg(F.sum("refund_amount").alias("refunds"))
    lost = stockout_loss(star).agg(F.sum("loss").alias("lost"))
    return side_by_side(star.sales.agg(F.sum("discount_amount").alias("discount")), refunds, lost).select(
        rounded("discount").alias("discount_leakage"), rounded("refunds").alias("returns_leakage"),
        F.round("lost", 0).alias("est_stockout_lost_revenue"),
    )


def mv_executive_kpis(star) -> DataFrame:
    """The one-row summary that is stored after each load."""
    from shelfwise.plans.views import vw_dead_stock

    dead = vw_dead_stock(star).agg(F.count(F.lit(1)).alias("dead_stock_skus"))
    return side_by_side(sales_totals(star), closing_totals(star), dead).select(
        double("revenue").alias("total_revenue"), double("margin").alias("total_gross_margin"),
        double("closing_value").alias("current_inventory_value"), F.col("closing_stockouts").alias("current_stockouts"),
        "dead_stock_skus",
    )
