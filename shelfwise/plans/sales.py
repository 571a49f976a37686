"""Sales and demand questions q13 to q24."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import double, from_date_key, mean, percent, rounded, safe_ratio, to_date_key, total
from shelfwise.operators.anchors import anchor_day, trailing_window
from shelfwise.operators.grouping import prefix_sums, rollup, topk

LOCATION = ("location_key", "location_key")
PRODUCT = ("product_key", "product_key")
DAY = ("date_key", "date_key")


def store_totals(star) -> DataFrame:
    """Revenue, margin and units per store."""
    return rollup(
        star.sales, star.location.filter(F.col("location_type") == "STORE"), LOCATION, ["location_name", "region"],
        revenue=("sum", "net_sales_amount"), margin=("sum", "gross_margin_amount"), units=("sum", "units_sold_qty"),
    )


def q13(star, k: int = 10) -> DataFrame:
    rows = store_totals(star).select("location_name", "region", double("revenue").alias("net_revenue"), "units")
    return topk(rows, k, F.desc("net_revenue"), F.asc("location_name"))


def q14(star) -> DataFrame:
    """Revenue by region and category."""
    by_region = star.sales.join(star.location.select("location_key", "region"), "location_key")
    return (
        rollup(by_region, star.product, PRODUCT, ["category"], by=["region"], r=("sum", "net_sales_amount"))
        .select("region", "category", double("r").alias("revenue"))
        .orderBy("region", F.desc("revenue"), "category")
    )


def monthly_sales(star) -> DataFrame:
    """Revenue and units per calendar month, read off the date key."""
    monthly = star.sales.groupBy("sale_month").agg(
        F.sum("net_sales_amount").alias("revenue"), F.sum("units_sold_qty").alias("units")
    )
    first = from_date_key(F.col("sale_month") * 100 + 1)
    return monthly.select(F.year(first).alias("year"), F.month(first).alias("month_number"), "revenue", "units")


def q15(star) -> DataFrame:
    """Monthly revenue and growth against the previous month that has sales."""
    previous = F.lag("revenue").over(Window.orderBy("year", "month_number"))
    return (
        monthly_sales(star)
        .select("year", "month_number", rounded("revenue").alias("revenue"),
                percent(F.col("revenue") - previous, previous, 1).alias("mom_growth_pct"))
        .orderBy("year", "month_number")
    )


def q16(star, k: int = 25, days: int = 90) -> DataFrame:
    """Steepest declines, last ``days`` against the ``days`` before. No recent sale means NULL, which drops the product."""
    anchor = anchor_day(star, "calendar")
    recent_from = to_date_key(F.date_sub(anchor, days))
    key, units = F.col("date_key"), F.col("units_sold_qty")
    rows = (
        trailing_window(star.sales, anchor, 2 * days)
        .groupBy("product_key")
        .agg(F.sum(F.when(key >= recent_from, units)).alias("recent_units"),
             F.sum(F.when(key < recent_from, units)).alias("prior_units"))
        .filter("prior_units > 0 AND recent_units < prior_units")
        .join(star.product.select("product_key", "sku", "product_name", "category"), "product_key")
        .select("sku", "product_name", "category", "prior_units", "recent_units",
                percent(F.col("recent_units") - F.col("prior_units"), "prior_units", 1).alias("change_pct"))
    )
    return topk(rows, k, F.asc("change_pct"), F.asc("sku"))


def q17(star, k: int = 20) -> DataFrame:
    rows = (
        star.sales.groupBy("product_key")
        .agg(F.sum("units_sold_qty").alias("units"), total("net_sales_amount").alias("revenue"))
        .join(star.product.select("product_key", "sku", "product_name", "category"), "product_key")
        .select("sku", "product_name", "category", "units", "revenue")
    )
    return topk(rows, k, F.desc("revenue"), F.asc("sku"))


def q18(star) -> DataFrame:
    """Margin share of revenue by category."""
    return (
        rollup(star.sales, star.product, PRODUCT, ["category"],
               r=("sum", "net_sales_amount"), m=("sum", "gross_margin_amount"))
        .select("category", rounded("r").alias("revenue"), rounded("m").alias("gross_margin"),
                percent("m", "r", 2).alias("margin_pct"))
        .orderBy(F.desc("margin_pct"), "category")
    )


def daily_sales(star) -> DataFrame:
    """Revenue and units per day: everything the calendar questions need, one row per day."""
    return star.sales.groupBy("date_key").agg(
        F.sum("net_sales_amount").alias("revenue"), F.sum("units_sold_qty").alias("units")
    )


def q19(star) -> DataFrame:
    """Weekend against weekday revenue per selling day. Days are already distinct after the daily sums."""
    return (
        daily_sales(star).join(star.dates.select("date_key", "is_weekend"), "date_key")
        .groupBy(F.when(F.col("is_weekend"), "Weekend").otherwise("Weekday").alias("day_type"))
        .agg(F.count(F.lit(1)).alias("days"), F.sum("revenue").alias("r"))
        .select("day_type", "days", rounded("r").alias("revenue"),
                safe_ratio("r", "days", digits=0).alias("avg_daily_revenue"))
        .orderBy(F.desc("avg_daily_revenue"))
    )


def q20(star) -> DataFrame:
    return (
        daily_sales(star).join(star.dates.select("date_key", "month_number", "month_name", "season"), "date_key")
        .groupBy("month_number", "month_name", "season")
        .agg(rounded(F.sum("revenue")).alias("revenue"), F.sum("units").alias("units"))
        .orderBy("month_number")
    )


def q21(star) -> DataFrame:
    """Promoted against unpromoted sale lines."""
    return (
        star.sales
        .groupBy(F.when(F.col("promotion_key").isNull(), "No Promotion").otherwise("Promoted").alias("promo_status"))
        .agg(F.count(F.lit(1)).alias("sale_lines"), F.sum("units_sold_qty").alias("units"),
             F.round(mean("units_sold_qty"), 2).alias("avg_units_per_line"),
             rounded(F.sum("net_sales_amount")).alias("revenue"))
    )


def q22(star) -> DataFrame:
    """Number of baskets, mean units and mean value. Means of sums need only the totals and the basket count."""
    baskets = star.sales.groupBy("order_id").agg(
        F.sum("units_sold_qty").alias("units"), F.sum("net_sales_amount").alias("value")
    )
    return baskets.agg(
        F.count(F.lit(1)).alias("baskets"),
        F.round(mean("units"), 2).alias("avg_units_per_basket"),
        F.round(mean("value"), 2).alias("avg_basket_value"),
    )


def pareto_curve(star, measure: str = "net_sales_amount") -> DataFrame:
    """Products along the cumulative revenue curve, largest first."""
    revenue = star.sales.groupBy("product_key").agg(F.sum(measure).alias("revenue"))
    return prefix_sums(revenue, [F.col("revenue").desc(), F.col("product_key").asc()], "revenue")


def q23(star, steps: int = 20) -> DataFrame:
    """Cumulative revenue share at about ``steps`` evenly spaced ranks."""
    step = F.greatest(F.expr(f"row_total div {int(steps)}"), F.lit(1))
    return (
        pareto_curve(star)
        .filter(F.col("position") % step == 0)
        .select(F.col("position").alias("rev_rank"), percent("position", "row_total", 1).alias("sku_pct"),
                percent("running", "grand_total", 1).alias("cumulative_revenue_pct"))
        .orderBy("rev_rank")
    )


def stockout_loss(star) -> DataFrame:
    """Per (product, location): stocked-out snapshot rows x mean units per sale line x mean sold price.

    Pairs that never sold have no estimate and drop out.
    """
    pair = ["product_key", "location_key"]
    sold = star.sales.groupBy(*pair).agg(mean("units_sold_qty").alias("units"), mean("unit_price").alias("price"))
    out = star.snapshot.filter("is_stockout_flag").groupBy(*pair).agg(F.count(F.lit(1)).alias("rows"))
    return out.join(sold, pair).select(*pair, (F.col("rows") * F.col("units") * F.col("price")).alias("loss"))


def q24(star) -> DataFrame:
    return (
        stockout_loss(star).join(star.product.select("product_key", "category"), "product_key")
        .groupBy("category").agg(F.round(F.sum("loss"), 0).alias("est_lost_revenue"))
        .orderBy(F.desc("est_lost_revenue"), "category")
    )
