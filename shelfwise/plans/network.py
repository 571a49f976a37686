"""Warehouse and network questions q35 to q42."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import double, percent, rounded, safe_ratio
from shelfwise.operators.anchors import latest_snapshot
from shelfwise.operators.grouping import rollup, share_of_total, topk

LOCATION = ("location_key", "location_key")


def _warehouses(star) -> DataFrame:
    return star.location.filter(F.col("location_type") == "WAREHOUSE")


def q35(star, rate: float = 0.25) -> DataFrame:
    """Mean row value per warehouse and its yearly carrying cost."""
    held = rollup(
        star.snapshot, _warehouses(star), LOCATION, ["location_name"],
        v=("sum", "on_hand_value"), n=("count", "on_hand_value"),
    )
    average = safe_ratio("v", "n")
    return held.select(
        "location_name", F.round(average, 0).alias("avg_inventory_value"),
        F.round(average * rate, 0).alias("annual_holding_cost"),
    ).orderBy(F.desc("annual_holding_cost"), "location_name")


def q36(star) -> DataFrame:
    return (
        rollup(latest_snapshot(star.snapshot), _warehouses(star), LOCATION, ["location_name"], v=("sum", "on_hand_value"))
        .select("location_name", rounded("v").alias("inventory_value"))
        .orderBy(F.desc("inventory_value"), "location_name")
    )


def routes(star, attr: str) -> DataFrame:
    """Transfers per (source, destination) attribute; reduced to location pairs before the two role joins."""
    pairs = star.transfers.groupBy("source_location_key", "dest_location_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("transfer_qty").alias("q"), F.sum("transfer_cost").alias("c")
    )
    source = star.location.select(F.col("location_key").alias("source_location_key"), F.col(attr).alias("source"))
    target = star.location.select(F.col("location_key").alias("dest_location_key"), F.col(attr).alias("destination"))
    return (
        pairs.join(source, "source_location_key").join(target, "dest_location_key")
        .groupBy("source", "destination")
        .agg(F.sum("n").alias("transfers"), F.sum("q").alias("units"), F.sum("c").alias("cost"))
    )


def q37(star, k: int = 20) -> DataFrame:
    rows = routes(star, "location_name").select(
        "source", "destination", "transfers", "units", double("cost").alias("total_cost")
    )
    return topk(rows, k, F.desc("units"), F.asc("source"), F.asc("destination"))


def signed_flows(star) -> DataFrame:
    """Every transfer twice: leaving its source, entering its destination."""
    out = star.transfers.select(F.col("source_location_key").alias("location_key"), (-F.col("transfer_qty")).alias("qty"))
    into = star.transfers.select(F.col("dest_location_key").alias("location_key"), F.col("transfer_qty").alias("qty"))
    return out.unionByName(into)


def q38(star) -> DataFrame:
    return rollup(
        signed_flows(star), star.location, LOCATION, ["location_name", "location_type"], net_units_flow=("sum", "qty")
    ).orderBy(F.desc("net_units_flow"), "location_name")


def q39(star, k: int = 20) -> DataFrame:
    rows = (
        star.transfers.groupBy("product_key")
        .agg(F.count(F.lit(1)).alias("transfer_events"), F.sum("transfer_qty").alias("units_moved"))
        .join(star.product.select("product_key", "sku", "product_name"), "product_key")
        .select("sku", "product_name", "transfer_events", "units_moved")
    )
    return topk(rows, k, F.desc("units_moved"), F.asc("sku"))


def q40(star) -> DataFrame:
    return (
        rollup(latest_snapshot(star.snapshot), _warehouses(star), LOCATION,
               ["location_name", "warehouse_capacity_units"], units_on_hand=("sum", "on_hand_qty"))
        .withColumn("utilisation_pct", percent("units_on_hand", "warehouse_capacity_units", 1))
        .orderBy(F.desc_nulls_last("utilisation_pct"), "location_name")
    )


def q41(star) -> DataFrame:
    """Each region's share of stock value beside its share of revenue; shares over the regions that have both."""
    stock = rollup(latest_snapshot(star.snapshot), star.location, LOCATION, ["region"], v=("sum", "on_hand_value"))
    sales = rollup(star.sales, star.location, LOCATION, ["region"], r=("sum", "net_sales_amount"))
    return (
        stock.join(sales, "region")
        .select("region", F.round(F.lit(100.0) * share_of_total("v"), 1).alias("inv_share_pct"),
                F.round(F.lit(100.0) * share_of_total("r"), 1).alias("sales_share_pct"))
        .orderBy(F.desc("inv_share_pct"), "region")
    )


def q42(star) -> DataFrame:
    return (
        routes(star, "region").filter("source <> destination")
        .select(F.col("source").alias("from_region"), F.col("destination").alias("to_region"), "transfers", "units")
        .orderBy(F.desc("units"), "from_region", "to_region")
    )
