"""Store and product questions q43 to q48."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import QUADRANT_LABELS, percent, rounded, safe_ratio
from shelfwise.operators.grouping import rollup, share_of_total, topk
from shelfwise.plans.sales import PRODUCT, store_totals


def q43(star) -> DataFrame:
    """Stores ranked by revenue, gaps on ties. One row per store is ordered."""
    return (
        store_totals(star)
        .select("location_name", "region", rounded("revenue").alias("revenue"),
                percent("margin", "revenue", 1).alias("margin_pct"),
                F.rank().over(Window.orderBy(F.desc("revenue"))).cast("bigint").alias("revenue_rank"))
        .orderBy(F.desc("revenue"), "location_name")
    )


def peer_average(value: str, group: str):
    """Mean of ``value`` over the rows sharing ``group``."""
    peers = Window.partitionBy(group)
    return safe_ratio(F.sum(value).over(peers), F.count(value).over(peers))


def q44(star) -> DataFrame:
    """Stores below the mean revenue of the stores of their region."""
    return (
        store_totals(star)
        .withColumn("peers", peer_average("revenue", "region"))
        .withColumn("own", F.col("revenue").cast("double"))
        .filter("own < peers")
        .select("location_name", "region", F.round("own", 0).alias("revenue"), F.round("peers", 0).alias("region_avg"),
                percent(F.col("own") - F.col("peers"), "peers", 1).alias("vs_region_pct"))
        .orderBy("vs_region_pct", "location_name")
    )


def q45(star, k: int = 50) -> DataFrame:
    """Products by revenue with their quadrant against mean revenue and mean margin share.

    A product without margin share falls through to the last label.
    """
    perf = star.sales.groupBy("product_key").agg(
        F.sum("net_sales_amount").alias("revenue"),
        percent(F.sum("gross_margin_amount"), F.sum("net_sales_amount")).alias("margin_pct"),
    ).join(star.product.select("product_key", "sku", "category"), "product_key")
    means = perf.agg(
        F.struct(
            safe_ratio(F.sum("revenue"), F.count("revenue")).alias("r"),
            # summed at fixed precision so that the mean does not depend on row order
            safe_ratio(F.sum(F.col("margin_pct").cast("decimal(28,12)")), F.count("margin_pct")).alias("m"),
        ).alias("means")
    ).scalar()
    high_sales = F.col("revenue").cast("double") >= means["r"]
    high_margin = F.col("margin_pct") >= means["m"]
    label = (
        F.when(high_sales & high_margin, QUADRANT_LABELS[True, True])
        .when(high_sales & ~high_margin, QUADRANT_LABELS[True, False])
        .when(~high_sales & high_margin, QUADRANT_LABELS[False, True])
        .otherwise(QUADRANT_LABELS[False, False])
    )
    rows = perf.select(
        "sku", "category", rounded("revenue").alias("revenue"), F.round("margin_pct", 1).alias("margin_pct"),
        label.alias("quadrant"),
    )
    return topk(rows, k, F.desc("revenue"), F.asc("sku"))


def q46(star) -> DataFrame:
    return (
        rollup(star.sales, star.product, PRODUCT, ["category"], r=("sum", "net_sales_amount"))
        .select("category", rounded("r").alias("revenue"),
                F.round(F.lit(100.0) * share_of_total("r"), 1).alias("revenue_share_pct"))
        .orderBy(F.desc("revenue"), "category")
    )


def q47(star, k: int = 25, min_units: int = 20) -> DataFrame:
    """Highest return rates among products that sold more than ``min_units``."""
    sold = star.sales.groupBy("product_key").agg(F.sum("units_sold_qty").alias("units_sold"))
    back = star.returns.groupBy("product_key").agg(F.sum("returned_qty").alias("back"))
    rows = (
        sold.filter(F.col("units_sold") > min_units)
        .join(star.product.select("product_key", "sku", "product_name", "category"), "product_key")
        .join(back, "product_key", "left")
        .withColumn("units_returned", F.coalesce("back", F.lit(0)))
        .select("sku", "product_name", "category", "units_sold", "units_returned",
                percent("units_returned", "units_sold", 2).alias("return_rate_pct"))
    )
    return topk(rows, k, F.desc("return_rate_pct"), F.asc("sku"))


def q48(star) -> DataFrame:
    return (
        star.returns.groupBy("return_reason_code")
        .agg(F.count(F.lit(1)).alias("return_events"), F.sum("returned_qty").alias("units"),
             rounded(F.sum("refund_amount")).alias("refund_value"))
        .orderBy(F.desc("units"), "return_reason_code")
    )
