"""Row-level security and drill-through: what a user may see, and the detail behind one entity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.sources.star import Star

# How each fact reaches its location.
LOCATION_KEY = {"fact_sales": "location_key", "fact_inventory_snapshot": "location_key",
                "fact_purchase_order": "dest_location_key", "fact_returns": "location_key"}


def row_policy(star: Star, principal: str | None = None, mapping: DataFrame | None = None, warehouse_only: bool = False,
               transfer_scope: str = "both") -> Star:
    """The star as one user sees it: locations of the user's regions, or warehouses only, or everything.

    ``mapping`` has ``email`` and ``region``; a user it does not list sees nothing. Facts are limited by a semi join on the
    allowed locations. A transfer is visible if both ends are allowed, or one with ``transfer_scope="either"``.
    """
    if principal is None and not warehouse_only:
        return star
    allowed = star.location
    if principal is not None:
        if mapping is None:
            raise ValueError("a principal needs a mapping of users to regions")
        mine = mapping.filter(F.col("email") == principal).select("region")
        allowed = allowed.join(mine, "region", "left_semi").select(*star.location.columns)
    if warehouse_only:
        allowed = allowed.filter(F.col("location_type") == "WAREHOUSE")

    def limited(fact: DataFrame, key: str) -> DataFrame:
        return fact.join(allowed.select(F.col("location_key").alias(key)), key, "left_semi").select(*fact.columns)

    tables = {name: limited(star.table(name), key) for name, key in LOCATION_KEY.items()}
    moved = star.transfers
    if transfer_scope == "both":
        tables["fact_stock_transfer"] = limited(limited(moved, "source_location_key"), "dest_location_key")
    else:
        for end in ("source", "dest"):
            mark = allowed.select(F.col("location_key").alias(f"{end}_location_key"), F.lit(True).alias(f"_{end}"))
            moved = moved.join(mark, f"{end}_location_key", "left")
        seen = F.coalesce("_source", "_dest").isNotNull()
        tables["fact_stock_transfer"] = moved.filter(seen).select(*star.transfers.columns)
    return star.replaced(dim_location=allowed, **tables)


@dataclass(frozen=True)
class Scope:
    """What one user sees, as the arguments of ``row_policy``."""

    name: str
    principal: str | None = None
    warehouse_only: bool = False
    transfer_scope: str = "both"

    @property
    def everything(self) -> bool:
        return self.principal is None and not self.warehouse_only


def _bits(scopes: Sequence[Scope], chosen) -> int:
    return sum(1 << i for i, s in enumerate(scopes) if chosen(s))


def location_masks(star: Star, scopes: Sequence[Scope], mapping: DataFrame | None = None) -> DataFrame:
    """(location_key, mask): bit i is set where scope i allows the location. At most 62 scopes."""
    if len(scopes) > 62:
        raise ValueError("too many scopes for one mask")
    users = _bits(scopes, lambda s: s.principal is not None)
    if users and mapping is None:
        raise ValueError("a principal needs a mapping of users to regions")
    masks = star.location.select("location_key", "region", "location_type")
    if users:
        own = reduce(lambda c, p: c.when(F.col("email") == p, F.lit(_bits(scopes, lambda s: s.principal == p)).cast("bigint")),
                     {s.principal for s in scopes if s.principal is not None}, F.when(F.lit(False), F.lit(0).cast("bigint")))
        regions = mapping.select("region", own.alias("_own")).groupBy("region").agg(F.bit_or("_own").alias("_own"))
        masks = masks.join(regions, "region", "left")
    else:
        masks = masks.withColumn("_own", F.lit(None).cast("bigint"))
    mine = F.coalesce("_own", F.lit(0).cast("bigint")).bitwiseOR(F.lit(_bits(scopes, lambda s: s.principal is None)).cast("bigint"))
    open_here = F.lit(_bits(scopes, lambda s: not s.warehouse_only)).cast("bigint")
    here = F.when(F.col("location_type") == "WAREHOUSE", F.lit(_bits(scopes, lambda s: True)).cast("bigint")).otherwise(open_here)
    return masks.select("location_key", mine.bitwiseAND(here).alias("mask"))


def with_scopes(star: Star, table: str, scopes: Sequence[Scope], mapping: DataFrame | None = None) -> DataFrame:
    """A fact with ``scope_mask``: bit i is set where scope i shows the row. All scopes are told by one pass over the fact."""
    masks = location_masks(star, scopes, mapping)
    fact = star.table(table)
    whole = F.lit(_bits(scopes, lambda s: s.everything)).cast("bigint")

    def at(df: DataFrame, key: str, name: str) -> DataFrame:
        side = masks.select(F.col("location_key").alias(key), F.col("mask").alias(name))
        return df.join(side, key, "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))

    if table in LOCATION_KEY:
        return at(fact, LOCATION_KEY[table], "_mask").select(*fact.columns, F.col("_mask").bitwiseOR(whole).alias("scope_mask"))
    ends = at(at(fact, "source_location_key", "_source"), "dest_location_key", "_dest")
    both = F.lit(_bits(scopes, lambda s: s.transfer_scope == "both")).cast("bigint")
    either = F.lit(_bits(scopes, lambda s: s.transfer_scope != "both")).cast("bigint")
    seen = F.col("_source").bitwiseAND(F.col("_dest")).bitwiseAND(both).bitwiseOR(F.col("_source").bitwiseOR(F.col("_dest")).bitwiseAND(either))
    return ends.select(*fact.columns, seen.bitwiseOR(whole).alias("scope_mask"))


def scope_counts(star: Star, scopes: Sequence[Scope], mapping: DataFrame | None = None) -> DataFrame:
    """(scope, table_name, row_count) of every fact, each fact read once."""
    parts = []
    for table in [*LOCATION_KEY, "fact_stock_transfer"]:
        # masks are few, so a fact shrinks to a handful of rows in every task
        masks = with_scopes(star, table, scopes, mapping).groupBy("scope_mask").agg(F.count(F.lit(1)).alias("n"))
        sums = [F.coalesce(F.sum(F.when(F.col("scope_mask").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, F.col("n"))), F.lit(0)) for i in range(len(scopes))]
        found = F.array(*[F.struct(F.lit(s.name).alias("scope"), v.alias("row_count")) for s, v in zip(scopes, sums, strict=True)])
        parts.append(masks.agg(found.alias("f")).select(F.explode("f").alias("f")).select(
            "f.scope", F.lit(table).alias("table_name"), "f.row_count"))
    return reduce(DataFrame.unionByName, parts)


def supplier_lines(star, **where) -> DataFrame:
    """Order lines of the suppliers matching ``where`` (attribute = value), with product and dates."""
    chosen = star.supplier
    for attr, value in where.items():
        chosen = chosen.filter(F.col(attr) == value)
    return (
        star.orders.join(chosen.select("supplier_key", "supplier_name"), "supplier_key")
        .join(star.product.select("product_key", "sku", "category"), "product_key")
        .select("supplier_name", "po_number", "sku", "category", "order_date_key", "expected_date_key", "received_date_key",
                "ordered_qty", "received_qty", "lead_time_days", "is_late_flag", "is_complete_flag", "is_otif_flag")
    )


def lead_time_history(star, **where) -> DataFrame:
    """Monthly lead time of the chosen suppliers."""
    month = F.expr("order_date_key div 100")
    lines = supplier_lines(star, **where)
    return lines.groupBy("supplier_name", month.cast("int").alias("order_month")).agg(
        F.count(F.lit(1)).alias("po_lines"),
        (F.sum("lead_time_days").cast("double") / F.nullif(F.count("lead_time_days").cast("double"), F.lit(0.0))).alias("avg_lead_days"),
    )


def affected_products(star, **where) -> DataFrame:
    """Products of the chosen suppliers that are stocked out now."""
    from shelfwise.operators.anchors import latest_snapshot

    out = latest_snapshot(star.snapshot).filter("is_stockout_flag").select("product_key")
    chosen = star.supplier
    for attr, value in where.items():
        chosen = chosen.filter(F.col(attr) == value)
    return (
        star.orders.join(chosen.select("supplier_key", "supplier_name"), "supplier_key")
        .select("supplier_name", "product_key").distinct()
        .join(out, "product_key", "left_semi")
        .join(star.product.select("product_key", "sku"), "product_key").select("supplier_name", "sku")
    )
