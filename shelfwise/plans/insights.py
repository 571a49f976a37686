"""Metrics the metric catalogue defines beyond the questions and measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import double, percent, safe_ratio, total
from shelfwise.operators.anchors import current_stock, demand_rate, latest_snapshot
from shelfwise.operators.grouping import rollup, share_of_total
from shelfwise.plans.executive import side_by_side
from shelfwise.plans.inventory import dead_stock, gmroi_by_product, overstock
from shelfwise.plans.measures import measure
from shelfwise.plans.sales import PRODUCT
from shelfwise.plans.supplier import SUPPLIER, product_suppliers


def k_in_stock_rate(star) -> DataFrame:
    """Share of observed snapshot rows in stock, per location."""
    return rollup(
        star.snapshot, star.location, ("location_key", "location_key"), ["location_name"],
        held=("count_if", ~F.col("is_stockout_flag")), observed=("count", F.lit(1)),
    ).select("location_name", safe_ratio("held", "observed").alias("in_stock_rate"))


def k_sell_through(star) -> DataFrame:
    """Units sold over units received, per category."""
    sold = rollup(star.sales, star.product, PRODUCT, ["category"], units_sold=("sum", "units_sold_qty"))
    came = rollup(star.orders, star.product, PRODUCT, ["category"], units_received=("sum", "received_qty"))
    return sold.join(came, "category", "left").withColumn("sell_through", safe_ratio("units_sold", "units_received"))


def k_excess_pct(star) -> DataFrame:
    """Overstock value as a share of all stock value."""
    over = overstock(star).agg(total("on_hand_value").alias("overstock_value"))
    whole = current_stock(star).agg(total("on_hand_value").alias("total_value"))
    return side_by_side(over, whole).withColumn("excess_pct", percent("overstock_value", "total_value"))


def k_net_revenue(star) -> DataFrame:
    """Gross sales less discounts and refunds."""
    sold = star.sales.agg(F.sum("gross_sales_amount").alias("gross"), F.sum("discount_amount").alias("discounts"))
    back = star.returns.agg(F.sum("refund_amount").alias("refunds"))
    return side_by_side(sold, back).select(
        double("gross").alias("gross_sales"), double("discounts").alias("discounts"), double("refunds").alias("refunds"),
        double(F.col("gross") - F.coalesce("discounts", F.lit(0)) - F.coalesce("refunds", F.lit(0))).alias("net_revenue"),
    )


def k_sales_velocity(star) -> DataFrame:
    """Slope of monthly units over calendar months per product, months without sales counting as zero.

    The zeros need no rows: they add nothing to the sums of units and of month times units, while the month sums
    come from the calendar.
    """
    first = star.dates.agg(F.min(F.col("year") * 12 + F.col("month_number"))).scalar()
    line = F.expr("sale_month div 100") * 12 + F.col("sale_month") % 100 - first
    sums = star.sales.groupBy("product_key").agg(
        F.sum("units_sold_qty").alias("y"), F.sum(F.col("units_sold_qty").cast("bigint") * line).alias("xy")
    )
    months = star.dates.select((F.col("year") * 12 + F.col("month_number")).alias("m")).distinct().agg(
        F.struct(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("m") - first).alias("x"),
            F.sum((F.col("m") - first) * (F.col("m") - first)).alias("xx"),
        )
    ).scalar()
    n, x, xx = months["n"], months["x"], months["xx"]
    slope = safe_ratio(n * F.col("xy") - x * F.col("y"), n * xx - x * x)
    return sums.join(star.product.select("product_key", "sku"), "product_key").select(
        "sku", F.round(slope, 6).alias("units_per_month")
    )


def k_defect_rate(star) -> DataFrame:
    """Returned units of the products a supplier delivers over the units it delivered."""
    back = star.returns.groupBy("product_key").agg(F.sum("returned_qty").alias("back"))
    returned = product_suppliers(star).join(back, "product_key").groupBy("supplier_key").agg(F.sum("back").alias("back"))
    came = star.orders.groupBy("supplier_key").agg(F.sum("received_qty").alias("units_received"))
    return (
        came.join(returned, "supplier_key", "left").join(star.supplier.select("supplier_key", "supplier_name"), "supplier_key")
        .withColumn("units_returned", F.coalesce("back", F.lit(0)))
        .select("supplier_name", "units_returned", "units_received",
                safe_ratio("units_returned", "units_received").alias("defect_rate"))
    )


def i_tier_stockout_share(star) -> DataFrame:
    """Per reliability tier: its share of suppliers beside its share of currently stocked-out products."""
    out = latest_snapshot(star.snapshot).filter("is_stockout_flag").select("product_key").distinct()
    linked = product_suppliers(star).join(out, "product_key", "left_semi")
    tiers = star.supplier.groupBy("reliability_tier").agg(F.count(F.lit(1)).alias("suppliers"))
    hits = rollup(linked, star.supplier, SUPPLIER, ["reliability_tier"], stocked_out_skus=("count", F.lit(1)))
    both = tiers.join(hits, "reliability_tier", "left").withColumn(
        "stocked_out_skus", F.coalesce("stocked_out_skus", F.lit(0))
    )
    return both.select(
        "reliability_tier", "suppliers", "stocked_out_skus",
        F.round(F.lit(100.0) * share_of_total("suppliers"), 1).alias("supplier_share_pct"),
        F.round(F.lit(100.0) * share_of_total("stocked_out_skus"), 1).alias("stockout_share_pct"),
    )


def i_gmroi_below_one(star) -> DataFrame:
    """Number and share of products earning less than their stock costs."""
    return gmroi_by_product(star).agg(
        F.count(F.lit(1)).alias("products"), F.count_if(F.col("gmroi") < 1).alias("below_one"),
    ).withColumn("below_one_pct", percent("below_one", "products", 1))


def i_trapped_capital(star) -> DataFrame:
    """Value in dead or overstocked products (each once), its share of stock, and how many months of COGS it equals."""
    dead = dead_stock(star).select("product_key", "on_hand_value", F.lit(True).alias("dead"), F.lit(False).alias("over"))
    over = overstock(star).select("product_key", "on_hand_value", F.lit(False).alias("dead"), F.lit(True).alias("over"))
    either = dead.unionByName(over).groupBy("product_key").agg(
        F.max("on_hand_value").alias("v"), F.max("dead").alias("dead"), F.max("over").alias("over")
    )
    trapped = either.agg(
        F.sum(F.when(F.col("dead"), F.col("v"))).alias("dead_value"),
        F.sum(F.when(F.col("over"), F.col("v"))).alias("over_value"), F.sum("v").alias("trapped_value"),
    )
    whole = current_stock(star).agg(F.sum("on_hand_value").alias("stock_value"))
    cost = star.sales.agg(F.sum("cogs_amount").alias("cogs"))
    months = star.dates.select("year", "month_number").distinct().agg(F.count(F.lit(1)).alias("months"))
    monthly = safe_ratio("cogs", "months")
    return side_by_side(trapped, whole, cost, months).select(
        double("dead_value").alias("dead_value"), double("over_value").alias("over_value"),
        double("trapped_value").alias("trapped_value"), percent("trapped_value", "stock_value", 1).alias("trapped_pct"),
        safe_ratio("trapped_value", monthly, digits=2).alias("months_of_cogs"),
    )


def i_category_card(star) -> DataFrame:
    """Revenue, margin share, turnover and stock-out rate per category."""
    return measure(star, ["total_revenue", "gross_margin_pct", "turnover", "stockout_rate"], ["category"])


def fill_days_of_supply(star) -> DataFrame:
    """The latest snapshot with its days of supply filled in from recent demand at (product, location)."""
    pair = ["product_key", "location_key"]
    rows = latest_snapshot(star.snapshot).drop("days_of_supply").join(
        demand_rate(star, pair, anchor="snapshot"), pair, "left"
    )
    days = safe_ratio("on_hand_qty", "daily_demand")
    return rows.withColumn("days_of_supply", F.round(days, 2)).select(*pair, "snapshot_date_key", "on_hand_qty", "days_of_supply")


INSIGHTS = {f.__name__: f for f in (
    k_in_stock_rate, k_sell_through, k_excess_pct, k_net_revenue, k_sales_velocity, k_defect_rate, i_tier_stockout_share,
    i_gmroi_below_one, i_trapped_capital, i_category_card, fill_days_of_supply)}
