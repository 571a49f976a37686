"""The 39 measures of the semantic layer: each at any grain, under any filter.

``measure(star, names, group_cols, filters)`` evaluates several at once. Measures on the same fact share one pass;
results of different facts meet by union and one more grouping at the (small) result grain, which treats NULL
grain values as equal and needs no join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import (
    double, from_date_key, health_status, mean, month_number_line, safe_ratio, to_date_key, total,
)
from shelfwise.operators.anchors import semi_closing
from shelfwise.operators.grouping import FIRST, MERGE, fits_broadcast, global_rank
from shelfwise.schema import PRIMARY_KEY, SCHEMAS
from shelfwise.session import scratch_folder

Filters = Mapping[str, Any] | None

# Which key of a fact leads to which dimension.
ROLES: dict[str, dict[str, str]] = {
    "fact_sales": {"dim_date": "date_key", "dim_product": "product_key", "dim_location": "location_key",
                   "dim_customer": "customer_key", "dim_employee": "employee_key", "dim_promotion": "promotion_key"},
    "fact_inventory_snapshot": {"dim_date": "snapshot_date_key", "dim_product": "product_key",
                                "dim_location": "location_key"},
    "fact_purchase_order": {"dim_date": "order_date_key", "dim_product": "product_key",
                            "dim_supplier": "supplier_key", "dim_location": "dest_location_key"},
    "fact_returns": {"dim_date": "return_date_key", "dim_product": "product_key", "dim_location": "location_key",
                     "dim_customer": "customer_key"},
}


def owner(fact: str, attr: str) -> str:
    """The dimension an attribute is read from when looking from ``fact``.

    A location attribute wins over one of the same name elsewhere (region), a product attribute over the rest.
    """
    for dim in ("dim_product", "dim_location", "dim_date", "dim_supplier", "dim_customer", "dim_employee", "dim_promotion"):
        if dim in ROLES[fact] and attr in SCHEMAS[dim].fieldNames():
            return dim
    raise ValueError(f"{attr} cannot be reached from {fact}")


def _allowed(attr: str, wanted: Any) -> Column:
    if isinstance(wanted, (list, tuple, set)):
        return F.col(attr).isin(list(wanted))
    return F.col(attr) == wanted


def _sides(star, fact: str, group_cols: Sequence[str], filters: Filters):
    """The fact filtered on its own columns, and for every dimension needed: (fact key, filtered side, attributes kept)."""
    df, own = star.table(fact), set(SCHEMAS[fact].fieldNames())
    filters = dict(filters or {})
    needed: dict[str, set[str]] = {}
    for attr in [*group_cols, *filters]:
        if attr not in own:
            needed.setdefault(owner(fact, attr), set()).add(attr)
    for attr in [a for a in filters if a in own]:
        df = df.filter(_allowed(attr, filters.pop(attr)))
    sides = []
    for dim, attrs in needed.items():
        side = star.table(dim)
        for attr in attrs & set(filters):
            side = side.filter(_allowed(attr, filters[attr]))
        keep = sorted(attrs & set(group_cols))
        key = ROLES[fact][dim]
        sides.append((key, side.select(F.col(PRIMARY_KEY[dim][0]).alias(key), *keep)))
    return df, sides


def context(star, fact: str, group_cols: Sequence[str] = (), filters: Filters = None) -> DataFrame:
    """Fact rows under a filter, with the grouping attributes attached. Only dimensions that are needed are joined."""
    df, sides = _sides(star, fact, group_cols, filters)
    return reduce(lambda left, side: left.join(side[1], side[0]), sides, df)


def grouped(star, fact: str, group_cols: Sequence[str], filters: Filters = None, **aggs: tuple[str, str | Column]) -> DataFrame:
    """Aggregates of a fact at any grain under a filter; ``aggs`` as in ``rollup``.

    Small dimensions are joined first. If one is too large to broadcast, the fact is reduced to one row per combination of
    keys before any join.
    """
    df, sides = _sides(star, fact, group_cols, filters)
    first = [FIRST[kind](value).alias(name) for name, (kind, value) in aggs.items()]
    if all(fits_broadcast(side) for _, side in sides):
        joined = reduce(lambda left, side: left.join(F.broadcast(side[1]), side[0]), sides, df)
        return joined.groupBy(*group_cols).agg(*first)
    own = [c for c in group_cols if c in df.columns]
    partial_rows = df.groupBy(*dict.fromkeys([*(key for key, _ in sides), *own])).agg(*first)
    joined = reduce(lambda left, side: left.join(side[1], side[0]), sides, partial_rows)
    return joined.groupBy(*group_cols).agg(*[MERGE[kind](name).alias(name) for name, (kind, _) in aggs.items()])


# Building blocks that add up over rows: name -> (fact, kind of aggregate, column).
ADDITIVE: dict[str, tuple[str, str, str | Column]] = {
    "revenue": ("fact_sales", "sum", "net_sales_amount"),
    "cogs": ("fact_sales", "sum", "cogs_amount"),
    "margin": ("fact_sales", "sum", "gross_margin_amount"),
    "units": ("fact_sales", "sum", "units_sold_qty"),
    "discount": ("fact_sales", "sum", "discount_amount"),
    "stock_rows": ("fact_inventory_snapshot", "count", "snapshot_date_key"),
    "out_rows": ("fact_inventory_snapshot", "count_if", "is_stockout_flag"),
    "lines": ("fact_purchase_order", "count", "po_line_key"),
    "otif_lines": ("fact_purchase_order", "count_if", "is_otif_flag"),
    "late_lines": ("fact_purchase_order", "count_if", "is_late_flag"),
    "lead_sum": ("fact_purchase_order", "sum", "lead_time_days"),
    "lead_rows": ("fact_purchase_order", "count", "lead_time_days"),
    "ordered": ("fact_purchase_order", "sum", "ordered_qty"),
    "received": ("fact_purchase_order", "sum", "received_qty"),
    "spend": ("fact_purchase_order", "sum", "po_line_amount"),
    "returned": ("fact_returns", "sum", "returned_qty"),
}
SNAPSHOT = "fact_inventory_snapshot"


def _daily_stock(star, group_cols, filters, **aggs):
    return grouped(star, SNAPSHOT, [*group_cols, "snapshot_date_key"], filters, **aggs)


def _at_last_day(daily: DataFrame, group_cols, *names: str) -> DataFrame:
    """Daily totals at the last day each group has."""
    return daily.groupBy(*group_cols).agg(*[F.max_by(n, "snapshot_date_key").alias(n) for n in names])


def _closing_value(star, group_cols, filters):
    values = {"closing_value": "on_hand_value", "closing_units": "on_hand_qty"}
    if not group_cols and not filters:
        return semi_closing(star.snapshot, [], **values)
    daily = _daily_stock(star, group_cols, filters, **{n: ("sum", c) for n, c in values.items()})
    return _at_last_day(daily, group_cols, *values)


def _average_value(star, group_cols, filters):
    daily = _daily_stock(star, group_cols, filters, v=("sum", "on_hand_value"))
    return daily.groupBy(*group_cols).agg((F.sum("v").cast("double") / F.count("v")).alias("average_value"))


def _below_rows(star, group_cols, filters):
    daily = _daily_stock(star, group_cols, filters, below_rows=("count_if", "is_below_reorder_flag"))
    return _at_last_day(daily, group_cols, "below_rows")


def _out_products(star, group_cols, filters):
    """Products out of stock on the closing day. Empty positions are folded to products per day before anything meets."""
    grain = list(group_cols)
    days = _daily_stock(star, grain, filters, _n=("count", "product_key"))
    closing = days.groupBy(*grain).agg(F.max("snapshot_date_key").alias("_closing"))
    empty = {**(filters or {}), "is_stockout_flag": True}
    out = grouped(star, SNAPSHOT, list(dict.fromkeys([*grain, "snapshot_date_key", "product_key"])), empty, _n=("count", "product_key"))
    hits = meet(out, closing, grain).filter(F.col("snapshot_date_key") == F.col("_closing"))
    counts = hits.groupBy(*grain).agg(F.count_distinct("product_key").alias("_out"))
    return meet(closing, counts, grain, "left").select(*grain, F.coalesce("_out", F.lit(0)).alias("out_products"))


def _reorder_rows(star, group_cols, filters):
    """The closing date is looked up under the narrowed filter, as the measure nests it."""
    narrowed = {**(filters or {}), "on_order_qty": 0, "is_active": True}
    daily = _daily_stock(star, group_cols, narrowed, reorder_rows=("count_if", "is_below_reorder_flag"))
    return _at_last_day(daily, group_cols, "reorder_rows")


def reaches(fact: str, attr: str) -> bool:
    """Whether a fact can be grouped or filtered by an attribute."""
    return attr in SCHEMAS[fact].fieldNames() or any(attr in SCHEMAS[dim].fieldNames() for dim in ROLES[fact])


def meet(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name, NULL meeting NULL."""
    if not columns:
        return left.join(right, F.lit(True), how)
    side = right.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns])
    return left.join(side, match, how).drop(*[f"_of_{c}" for c in columns])


def calendar_columns(fact: str, columns) -> list[str]:
    return [c for c in columns if c not in SCHEMAS[fact].fieldNames() and owner(fact, c) == "dim_date"]


def _closing_stock(star, group_cols, grain, filters) -> DataFrame:
    """``v``, the stock value at the last day of each (grain, product).

    The last days come first, a small table of one row each; where it can be broadcast, only rows of those days are summed, and months that hold none
    are not opened. Else all days are summed and the last is taken.
    """
    path = scratch_folder(star.spark, "closing")
    grouped(star, SNAPSHOT, grain, filters, _closing=("max", "snapshot_date_key")).write.parquet(path)
    closing = star.spark.read.parquet(path)
    if not fits_broadcast(closing):
        return _at_last_day(_daily_stock(star, grain, filters, v=("sum", "on_hand_value")), grain, "v")
    side = F.broadcast(closing.withColumn("_month", F.expr("_closing div 100").cast("int")).withColumnsRenamed({c: f"_of_{c}" for c in grain}))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in grain])
    at_close = (F.col("snapshot_month") == F.col("_month")) & (F.col("snapshot_date_key") == F.col("_closing"))
    rows = context(star, SNAPSHOT, group_cols, filters).join(side, at_close & same, "left_semi")
    return rows.groupBy(*grain).agg(F.sum("on_hand_value").alias("v"))


def _dead_value(star, group_cols, filters, days: int = 180):
    """Stock of products not sold for ``days`` before the last day of the period that grain and filters leave."""
    grain = list(dict.fromkeys([*group_cols, "product_key"]))
    stock = _closing_stock(star, group_cols, grain, filters)
    sold = grouped(star, "fact_sales", grain, filters, _last=("max", "date_key"))
    periods, limits = calendar_columns(SNAPSHOT, group_cols), star.dates
    for attr in calendar_columns(SNAPSHOT, filters or {}):
        limits = limits.filter(_allowed(attr, filters[attr]))
    threshold = to_date_key(F.date_sub(F.max("full_date"), days))
    found = meet(stock, sold, grain, "left")
    if periods:  # one row per period of the calendar
        found = meet(found, F.broadcast(limits.groupBy(*periods).agg(threshold.alias("_threshold"))), periods, "left")
    else:
        found = found.withColumn("_threshold", limits.agg(threshold).scalar())
    dead = found.filter(F.col("_last").isNull() | (F.col("_last") < F.col("_threshold")))
    return dead.groupBy(*group_cols).agg(total("v").alias("dead_value"))


def _lost_sales(star, group_cols, filters):
    """Stock-out rows x mean units per sale line at (product, location) x list price; sales obey the filters they can carry."""
    pair = ["product_key", "location_key"]
    empty = {**(filters or {}), "is_stockout_flag": True}
    rows = grouped(star, SNAPSHOT, list(dict.fromkeys([*group_cols, *pair])), empty, n=("count", "snapshot_date_key"))
    carried = {a: v for a, v in (filters or {}).items() if reaches("fact_sales", a)}
    sums = grouped(star, "fact_sales", pair, carried, _units=("sum", "units_sold_qty"), _rows=("count", "units_sold_qty"))
    demand = sums.select(*pair, safe_ratio("_units", "_rows").alias("u"))
    priced = rows.join(demand, pair).join(star.product.select("product_key", double("unit_price").alias("p")), "product_key")
    return priced.groupBy(*group_cols).agg(F.round(F.sum(F.col("n") * F.col("u") * F.col("p")), 2).alias("lost_sales"))


def _baskets(star, group_cols, filters):
    return context(star, "fact_sales", group_cols, filters).groupBy(*group_cols).agg(F.count_distinct("order_id").alias("baskets"))


def _lead_spread(star, group_cols, filters):
    rows = context(star, "fact_purchase_order", group_cols, filters)
    return rows.groupBy(*group_cols).agg(F.stddev_pop("lead_time_days").alias("lead_spread"))


# Building blocks that do not add up over rows.
SPECIAL: dict[str, Callable[..., DataFrame]] = {
    "closing_value": _closing_value,
    "closing_units": _closing_value,
    "average_value": _average_value,
    "out_products": _out_products,
    "below_rows": _below_rows,
    "reorder_rows": _reorder_rows,
    "dead_value": _dead_value,
    "lost_sales": _lost_sales,
    "baskets": _baskets,
    "lead_spread": _lead_spread,
}

CARRYING_RATE = 0.25
SCORE_WEIGHTS = (0.5, 0.3, -0.2)


def _score() -> Column:
    otif, fill, lead = SCORE_WEIGHTS
    return (
        F.lit(otif) * (safe_ratio("otif_lines", "lines") * 100)
        + F.lit(fill) * (safe_ratio("received", "ordered") * 100)
        + F.lit(lead) * safe_ratio("lead_sum", "lead_rows")
    )


# name -> (building blocks, expression over them)
MEASURES: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "total_revenue": (("revenue",), lambda: double("revenue")),
    "total_cogs": (("cogs",), lambda: double("cogs")),
    "gross_margin": (("margin",), lambda: double("margin")),
    "gross_margin_pct": (("margin", "revenue"), lambda: safe_ratio("margin", "revenue")),
    "units_sold": (("units",), lambda: F.col("units")),
    "total_discount": (("discount",), lambda: double("discount")),
    "avg_basket_value": (("revenue", "baskets"), lambda: safe_ratio("revenue", "baskets")),
    "inventory_value": (("closing_value",), lambda: double("closing_value")),
    "on_hand_units": (("closing_units",), lambda: F.col("closing_units")),
    "avg_inventory_value": (("average_value",), lambda: F.col("average_value")),
    "turnover": (("cogs", "average_value"), lambda: safe_ratio("cogs", "average_value")),
    "dio": (("cogs", "average_value"), lambda: safe_ratio(F.lit(365), safe_ratio("cogs", "average_value"))),
    "gmroi": (("margin", "average_value"), lambda: safe_ratio("margin", "average_value")),
    "stockout_sku_count": (("out_products",), lambda: F.col("out_products")),
    "stockout_rate": (("out_rows", "stock_rows"), lambda: safe_ratio("out_rows", "stock_rows")),
    "below_reorder_count": (("below_rows",), lambda: F.col("below_rows")),
    "annual_carrying_cost": (("average_value",), lambda: F.col("average_value") * CARRYING_RATE),
    "dead_stock_value": (("dead_value",), lambda: F.col("dead_value")),
    "po_line_count": (("lines",), lambda: F.col("lines")),
    "otif_pct": (("otif_lines", "lines"), lambda: safe_ratio("otif_lines", "lines")),
    "late_rate": (("late_lines", "lines"), lambda: safe_ratio("late_lines", "lines")),
    "avg_lead_time": (("lead_sum", "lead_rows"), lambda: safe_ratio("lead_sum", "lead_rows")),
    "lead_time_var": (("lead_spread",), lambda: F.round("lead_spread", 6)),
    "po_fill_rate": (("received", "ordered"), lambda: safe_ratio("received", "ordered")),
    "supplier_spend": (("spend",), lambda: double("spend")),
    "supplier_score": (("otif_lines", "lines", "received", "ordered", "lead_sum", "lead_rows"), _score),
    "return_rate": (("returned", "units"), lambda: safe_ratio("returned", "units")),
    "est_lost_sales": (("lost_sales",), lambda: F.col("lost_sales")),
    "reorder_now_count": (("reorder_rows",), lambda: F.col("reorder_rows")),
    "health_status": (("out_rows", "stock_rows"), lambda: health_status(safe_ratio("out_rows", "stock_rows"))),
}


def measure(star, names: Sequence[str], group_cols: Sequence[str] = (), filters: Filters = None) -> DataFrame:
    """The grain columns and the named measures, one row per grain value found in any fact involved."""
    group_cols = list(group_cols)
    blocks = dict.fromkeys(b for n in names for b in MEASURES[n][0])
    per_fact: dict[str, dict[str, tuple[str, str | Column]]] = {}
    for block in blocks:
        if block in ADDITIVE:
            fact, *aggregate = ADDITIVE[block]
            per_fact.setdefault(fact, {})[block] = tuple(aggregate)
    parts = [grouped(star, fact, group_cols, filters, **aggs) for fact, aggs in per_fact.items()]
    for build in dict.fromkeys(SPECIAL[b] for b in blocks if b in SPECIAL):
        part = build(star, group_cols, filters)
        parts.append(part.select(*group_cols, *[c for c in part.columns if c in blocks]))
    if len(parts) > 1:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        joined = stacked.groupBy(*group_cols).agg(*[F.max(b).alias(b) for b in blocks])
    else:
        joined = parts[0]
    return joined.select(*group_cols, *[MEASURES[n][1]().alias(n) for n in names])


# -- period measures: calendar distance on a month line; every month of the calendar with a figure has a row ------------


def monthly_revenue(star, group_cols: Sequence[str] = (), filters: Filters = None) -> DataFrame:
    grain = [*group_cols, "year", "month_number"]
    return grouped(star, "fact_sales", grain, filters, revenue=("sum", "net_sales_amount"))


def _periods(filters: Filters) -> tuple[dict[str, Any], dict[str, Any]]:
    """Filters on rows, and those that only choose the months shown: a comparison looks beyond them."""
    chosen = {a: v for a, v in (filters or {}).items() if a in ("year", "month_number")}
    return {a: v for a, v in (filters or {}).items() if a not in chosen}, chosen


def _shown(df: DataFrame, star, chosen: dict[str, Any]) -> DataFrame:
    """Rows on a month line ``_line`` that lie in the calendar, with year and month; months are few and bounded."""
    months = star.dates.select("year", "month_number").distinct().withColumn("_line", month_number_line("year", "month_number"))
    for attr, wanted in chosen.items():
        months = months.filter(_allowed(attr, wanted))
    return df.join(F.broadcast(months), "_line")


def period_compare(df: DataFrame, value: str, months: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """``value`` and ``prior``, the value ``months`` away (negative is earlier), per group and month line.

    Each value is offered to its own month and to the month it is compared with, and one grouping brings them together, so a month
    without value that has a prior one appears and no join is needed.
    """
    line = month_number_line("year", "month_number")
    none = F.lit(None).cast(df.schema[value].dataType)
    own = df.select(*group_cols, line.alias("_line"), F.col(value), none.alias("prior"))
    moved = df.select(*group_cols, (line - months).alias("_line"), none.alias(value), F.col(value).alias("prior"))
    return own.unionByName(moved).groupBy(*group_cols, "_line").agg(F.max(value).alias(value), F.max("prior").alias("prior"))


def _compared(star, group_cols, filters, months: int, name: str, growth: bool) -> DataFrame:
    kept, chosen = _periods(filters)
    df = _shown(period_compare(monthly_revenue(star, group_cols, kept), "revenue", months, group_cols), star, chosen)
    now = F.when(F.col("prior").isNotNull(), F.coalesce("revenue", F.lit(0)))
    value = safe_ratio(now - F.col("prior"), "prior") if growth else double("prior")
    return df.select(*group_cols, "year", "month_number", value.alias(name))


def ytd(df: DataFrame, value: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Running total within the calendar year per month line: a month's value is offered to the rest of its year, at most 12 rows."""
    line, left = month_number_line("year", "month_number"), F.lit(12) - F.col("month_number")
    return df.withColumn("_line", F.explode(F.sequence(line, line + left))).groupBy(*group_cols, "_line").agg(F.sum(value).alias("ytd"))


def rolling_daily_avg(star, months: int = 3, group_cols: Sequence[str] = (), filters: Filters = None) -> DataFrame:
    """Per month, the mean revenue of the days with sales in the ``months`` months up to its last calendar day.

    A day is offered to its own and the following ``months`` months by an equality on the month line.
    """
    daily = grouped(star, "fact_sales", [*group_cols, "date_key"], filters, revenue=("sum", "net_sales_amount"))
    day = from_date_key("date_key")
    offered = daily.withColumn("_day", day).withColumn(
        "_line", F.explode(F.sequence(month_number_line(F.year(day), F.month(day)),
                                      month_number_line(F.year(day), F.month(day)) + months))
    )
    ends = star.dates.groupBy("year", "month_number").agg(F.max("full_date").alias("_end")).withColumn(
        "_line", month_number_line("year", "month_number")
    )
    inside = (F.col("_day") > F.add_months("_end", -months)) & (F.col("_day") <= F.col("_end"))
    # one row per calendar month
    return (
        offered.join(F.broadcast(ends), "_line").filter(inside)
        .groupBy(*group_cols, "year", "month_number").agg(mean("revenue").alias("revenue_3m_avg"))
    )


def m_revenue_ly(star, group_cols=(), filters=None):
    return _compared(star, group_cols, filters, -12, "revenue_ly", growth=False)


def m_revenue_yoy_pct(star, group_cols=(), filters=None):
    return _compared(star, group_cols, filters, -12, "revenue_yoy_pct", growth=True)


def m_revenue_pm(star, group_cols=(), filters=None):
    return _compared(star, group_cols, filters, -1, "revenue_pm", growth=False)


def m_revenue_mom_pct(star, group_cols=(), filters=None):
    return _compared(star, group_cols, filters, -1, "revenue_mom_pct", growth=True)


def m_revenue_ytd(star, group_cols=(), filters=None):
    kept, chosen = _periods(filters)
    df = _shown(ytd(monthly_revenue(star, group_cols, kept), "revenue", group_cols), star, chosen)
    return df.select(*group_cols, "year", "month_number", double("ytd").alias("revenue_ytd"))


def m_revenue_3m_avg(star, group_cols=(), filters=None):
    return rolling_daily_avg(star, 3, group_cols, filters)


# -- measures relative to other rows of the result ---------------------------------------------------------------------


def m_revenue_rank(star, group_cols=("location_name",), filters=None):
    """Rank by revenue of the last column of the grain that isn't a part of the calendar, within the others; gaps on ties.

    Locations are few enough for an ordered window per context; anything else is ranked in slices.
    """
    group_cols = list(group_cols)
    df = grouped(star, "fact_sales", group_cols, filters, r=("sum", "net_sales_amount"))
    entities = [c for c in group_cols if c not in calendar_columns("fact_sales", group_cols)] or group_cols
    others = [c for c in group_cols if c != entities[-1]] if entities else []
    if {owner("fact_sales", c) for c in group_cols if not reaches_own(c)} <= {"dim_location", "dim_date"}:
        rank = F.rank().over(Window.partitionBy(*others).orderBy(F.desc("r"))).cast("bigint")
        return df.select(*group_cols, rank.alias("revenue_rank"))
    return global_rank(df, "r", "revenue_rank", others).select(*group_cols, "revenue_rank")


def reaches_own(column: str, fact: str = "fact_sales") -> bool:
    return column in SCHEMAS[fact].fieldNames()


def m_store_vs_region_pct(star, group_cols=("location_name",), filters=None):
    """Distance of each row from the mean over all locations of its region in the same context, warehouses included.

    The context is the grain without columns of the location.
    """
    grain = list(dict.fromkeys([*group_cols, "region"]))
    context_cols = [c for c in grain if c != "location_key" and (reaches_own(c) or owner("fact_sales", c) != "dim_location")]
    stores = grouped(star, "fact_sales", [*context_cols, "region", "location_key"], filters, _store=("sum", "net_sales_amount"))
    peers = stores.groupBy(*context_cols, "region").agg(safe_ratio(F.sum("_store"), F.count("_store")).alias("_avg"))
    df = grouped(star, "fact_sales", grain, filters, r=("sum", "net_sales_amount"))
    return meet(df, peers, [*context_cols, "region"]).select(
        *grain, safe_ratio(double("r") - F.col("_avg"), "_avg").alias("store_vs_region_pct"))


def m_category_share(star, group_cols=("category",), filters=None):
    """Share of revenue once the category filter is removed; other grain columns stay in the denominator."""
    group_cols = list(dict.fromkeys([*group_cols, "category"]))
    others = [c for c in group_cols if c != "category"]
    open_filters = {k: v for k, v in (filters or {}).items() if k != "category"}
    df = grouped(star, "fact_sales", group_cols, open_filters, r=("sum", "net_sales_amount"))
    whole = F.sum("r").over(Window.partitionBy(*(others or [F.lit(1)])))
    shared = df.select(*group_cols, safe_ratio("r", whole).alias("category_share"))
    wanted = (filters or {}).get("category")
    return shared if wanted is None else shared.filter(_allowed("category", wanted))


def _single(name: str, star, group_cols=(), filters=None) -> DataFrame:
    return measure(star, [name], group_cols, filters)


# Every measure as a function of (star, group_cols, filters).
FUNCTIONS: dict[str, Callable[..., DataFrame]] = {f"m_{n}": partial(_single, n) for n in MEASURES}
FUNCTIONS.update({
    f.__name__: f for f in (
        m_revenue_ly, m_revenue_yoy_pct, m_revenue_pm, m_revenue_mom_pct, m_revenue_ytd, m_revenue_3m_avg,
        m_revenue_rank, m_store_vs_region_pct, m_category_share)
})
