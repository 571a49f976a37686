"""Supplier questions q25 to q34."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import percent, rounded, safe_ratio
from shelfwise.operators.anchors import latest_snapshot
from shelfwise.operators.grouping import rollup, topk

SUPPLIER = ("supplier_key", "supplier_key")


def delivery_totals(star, attrs: list[str]) -> DataFrame:
    """Additive delivery counts per supplier attribute, from one pass over the order lines."""
    return rollup(
        star.orders, star.supplier, SUPPLIER, attrs,
        po_lines=("count", F.lit(1)),
        otif_lines=("count_if", F.col("is_otif_flag")),
        late_lines=("count_if", F.col("is_late_flag")),
        lead_sum=("sum", "lead_time_days"),
        lead_rows=("count", "lead_time_days"),
        ordered=("sum", "ordered_qty"),
        received=("sum", "received_qty"),
        spend=("sum", "po_line_amount"),
    )


def q25(star, k: int = 20, min_lines: int = 5) -> DataFrame:
    rows = delivery_totals(star, ["supplier_name", "reliability_tier"]).filter(F.col("po_lines") >= min_lines).select(
        "supplier_name", "reliability_tier", "po_lines", percent("otif_lines", "po_lines", 1).alias("otif_pct")
    )
    return topk(rows, k, F.asc("otif_pct"), F.asc("supplier_name"))


def q26(star, k: int = 20, min_lines: int = 5) -> DataFrame:
    """Longest mean lead times. Lines not yet received count as lines but carry no lead time."""
    rows = delivery_totals(star, ["supplier_name", "reliability_tier"]).filter(F.col("po_lines") >= min_lines).select(
        "supplier_name", "reliability_tier", safe_ratio("lead_sum", "lead_rows", digits=1).alias("avg_lead_days"),
        "po_lines",
    )
    return topk(rows, k, F.desc_nulls_last("avg_lead_days"), F.asc("supplier_name"))


def lead_spread(star) -> DataFrame:
    """Lines, mean lead time and its sample deviation per supplier key (keys and names are one to one)."""
    return star.orders.groupBy("supplier_key").agg(
        F.count(F.lit(1)).alias("po_lines"),
        safe_ratio(F.sum("lead_time_days"), F.count("lead_time_days")).alias("avg_lead"),
        F.stddev_samp("lead_time_days").alias("lead_sd"),
    )


def q27(star, k: int = 20, min_lines: int = 5) -> DataFrame:
    rows = (
        lead_spread(star).filter(F.col("po_lines") >= min_lines)
        .join(star.supplier.select("supplier_key", "supplier_name", "reliability_tier"), "supplier_key")
        .select("supplier_name", "reliability_tier", F.round("avg_lead", 1).alias("avg_lead"),
                F.round("lead_sd", 2).alias("lead_time_stddev"))
    )
    return topk(rows, k, F.desc_nulls_last("lead_time_stddev"), F.asc("supplier_name"))


def q28(star, k: int = 20, min_lines: int = 5) -> DataFrame:
    rows = delivery_totals(star, ["supplier_name"]).filter(F.col("po_lines") >= min_lines).select(
        "supplier_name", "po_lines", percent("late_lines", "po_lines", 1).alias("late_rate_pct")
    )
    return topk(rows, k, F.desc("late_rate_pct"), F.asc("supplier_name"))


def product_suppliers(star) -> DataFrame:
    """Every supplier that ever supplied a product."""
    return star.orders.select("product_key", "supplier_key").distinct()


def q29(star, k: int = 20) -> DataFrame:
    """Return rate of the products each supplier delivers; a product with several suppliers counts for each."""
    sold = star.sales.groupBy("product_key").agg(F.sum("units_sold_qty").alias("sold"))
    back = star.returns.groupBy("product_key").agg(F.sum("returned_qty").alias("back"))
    rows = (
        product_suppliers(star).join(sold, "product_key", "left").join(back, "product_key", "left")
        .groupBy("supplier_key").agg(F.sum("sold").alias("sold"), F.sum("back").alias("back"))
        .join(star.supplier.select("supplier_key", "supplier_name"), "supplier_key")
        .groupBy("supplier_name").agg(F.sum("sold").alias("units_sold"), F.sum("back").alias("back"))
        .filter("units_sold > 0")
        .withColumn("units_returned", F.coalesce("back", F.lit(0)))
        .select("supplier_name", "units_returned", "units_sold",
                percent("units_returned", "units_sold", 2).alias("return_rate_pct"))
    )
    return topk(rows, k, F.desc("return_rate_pct"), F.asc("supplier_name"))


def q30(star, k: int = 20) -> DataFrame:
    rows = delivery_totals(star, ["supplier_name"]).filter("ordered > 0").select(
        "supplier_name", "ordered", "received", percent("received", "ordered", 1).alias("fill_rate_pct")
    )
    return topk(rows, k, F.asc_nulls_last("fill_rate_pct"), F.asc("supplier_name"))


def q31(star, k: int = 20) -> DataFrame:
    """Suppliers by number of their products stocked out somewhere right now."""
    out = latest_snapshot(star.snapshot).filter("is_stockout_flag").select("product_key").distinct()
    rows = rollup(
        product_suppliers(star).join(out, "product_key", "left_semi"), star.supplier, SUPPLIER,
        ["supplier_name", "reliability_tier"], stocked_out_skus=("count", F.lit(1)),
    )
    return topk(rows, k, F.desc("stocked_out_skus"), F.asc("supplier_name"))


def q32(star, k: int = 20) -> DataFrame:
    """Spend and distinct order numbers. Lines are first reduced to one row per supplier and order."""
    orders = star.orders.groupBy("supplier_key", "po_number").agg(F.sum("po_line_amount").alias("amount"))
    rows = (
        orders.join(star.supplier.select("supplier_key", "supplier_name", "country"), "supplier_key")
        .groupBy("supplier_name", "country")
        .agg(rounded(F.sum("amount")).alias("total_spend"), F.count_distinct("po_number").alias("purchase_orders"))
    )
    return topk(rows, k, F.desc("total_spend"), F.asc("supplier_name"))


def scorecard(star, attrs: list[str], min_lines: int = 5, weights=(0.5, 0.3, -0.2)) -> DataFrame:
    """OTIF, lead time, fill rate, spend and the weighted score."""
    otif, fill, lead = weights
    return (
        delivery_totals(star, attrs).filter(F.col("po_lines") >= min_lines)
        .withColumn("otif", percent("otif_lines", "po_lines"))
        .withColumn("lead", safe_ratio("lead_sum", "lead_rows"))
        .withColumn("fill", percent("received", "ordered"))
        .withColumn("score", F.lit(otif) * F.col("otif") + F.lit(fill) * F.col("fill") + F.lit(lead) * F.col("lead"))
    )


def q33(star) -> DataFrame:
    return (
        scorecard(star, ["supplier_key", "supplier_name", "reliability_tier"]).select(
            "supplier_name", "reliability_tier", F.round("otif", 1).alias("otif_pct"),
            F.round("lead", 1).alias("avg_lead_days"), F.round("fill", 1).alias("fill_pct"),
            rounded("spend").alias("total_spend"), F.round("score", 1).alias("composite_score"),
        )
        .orderBy(F.desc_nulls_last("composite_score"), "supplier_name")
    )


def q34(star) -> DataFrame:
    """Products bought from exactly one supplier, by category. Minimum equal to maximum needs no distinct count."""
    single = star.orders.groupBy("product_key").agg(
        F.min("supplier_key").alias("lo"), F.max("supplier_key").alias("hi")
    ).filter("lo = hi")
    return (
        single.join(star.product.select("product_key", "category"), "product_key")
        .groupBy("category").agg(F.count(F.lit(1)).alias("single_source_skus"))
        .orderBy(F.desc("single_source_skus"), "category")
    )
