"""Small hand-made stars: rows as dictionaries, columns not named are NULL."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import types as T

from shelfwise.operators.calendar import dim_date_build
from shelfwise.schema import SCHEMAS, TABLES
from shelfwise.sources.star import Star, with_month


def table(spark, name, rows):
    schema = SCHEMAS[name]
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

    def cell(field, row):
        value = row.get(field.name)
        return Decimal(str(value)) if value is not None and isinstance(field.dataType, T.DecimalType) else value

    data = [tuple(cell(f, row) for f in schema.fields) for row in rows]
    return with_month(spark.createDataFrame(data, loose), name)


def calendar(spark, first, last):
    days = spark.createDataFrame([(first, last)], "first_day date, last_day date")
    return dim_date_build(days)


def star(spark, first=date(2024, 1, 1), last=date(2024, 12, 31), **tables):
    known = {name: table(spark, name, rows) for name, rows in tables.items()}
    known.setdefault("dim_date", calendar(spark, first, last))
    for name in TABLES:
        if name not in known:
            known[name] = table(spark, name, [])
    return Star(spark, known.__getitem__)


def key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def product(k, **more):
    return {"product_key": k, "sku": f"S{k}", "product_name": f"P{k}", "category": "c", "subcategory": "s",
            "unit_cost": 1, "unit_price": 2, "is_active": True, **more}


def location(k, region="R", kind="STORE", **more):
    return {"location_key": k, "location_id": f"L{k}", "location_type": kind, "location_name": f"N{k}", "region": region,
            "is_active": True, **more}


def sale(k, day, p=1, loc=1, qty=1, price=2, cost=1, discount=0, **more):
    gross = qty * price
    return {"sales_key": k, "order_id": f"O{k}", "date_key": key(day), "product_key": p, "location_key": loc,
            "units_sold_qty": qty, "unit_price": price, "gross_sales_amount": gross, "discount_amount": discount,
            "net_sales_amount": gross - discount, "unit_cost": cost, "cogs_amount": qty * cost,
            "gross_margin_amount": gross - discount - qty * cost, **more}


def stock(k, day, p=1, loc=1, qty=1, value=None, on_order=0, reorder=5, **more):
    return {"snapshot_key": k, "snapshot_date_key": key(day), "product_key": p, "location_key": loc, "on_hand_qty": qty,
            "on_hand_value": qty if value is None else value, "on_order_qty": on_order, "reorder_point": reorder,
            "safety_stock_qty": 2, "is_below_reorder_flag": qty <= reorder, "is_stockout_flag": qty == 0, **more}


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


DAY = timedelta(days=1)
