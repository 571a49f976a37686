"""Subtotals over a matrix and distinct counts from bitmaps."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.distinct import distinct_bitmaps, distinct_counts, numbered
from shelfwise.plans.matrix import level_name, matrix
from shelfwise.plans.measures import measure
from tests.tiny import rows, star

LEVELS = [("region", "category"), ("region",), ()]
LINES = ["po_line_count", "otif_pct", "late_rate", "avg_lead_time", "lead_time_var", "po_fill_rate", "supplier_spend", "supplier_score"]


@pytest.mark.parametrize("names", [
    ["total_revenue", "gross_margin_pct", "units_sold", "avg_basket_value", "return_rate"],
    ["inventory_value", "on_hand_units", "below_reorder_count", "reorder_now_count", "stockout_rate", "stockout_sku_count"],
    ["turnover", "gmroi", "dio", "annual_carrying_cost", "dead_stock_value"], LINES])
@pytest.mark.parametrize("filters", [None, "one category", {"category": "no such"}])
def test_every_level_is_the_measure_at_that_grain(derived_star, names, filters):
    s, _ = derived_star
    if filters == "one category":
        filters = {"category": s.product.agg(F.min("category")).first()[0], "is_active": True}
    if names is LINES and filters:
        filters = {"reliability_tier": filters["category"] if filters["category"] == "no such" else "Gold"}
    got = matrix(s, names, LEVELS, filters).cache()
    for level in LEVELS:
        want = measure(s, names, level, filters)
        at = got.filter(F.col("level") == level_name(level)).select(*want.columns)
        digits = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in want.dtypes]
        assert rows(at.select(*digits)) == rows(want.select(*digits))
    got.unpersist()


def test_a_null_attribute_is_not_a_subtotal(spark):
    s = star(spark, dim_product=[{"product_key": 1, "category": None}, {"product_key": 2, "category": "c"}],
             fact_sales=[{"sales_key": i, "date_key": 20240105, "product_key": 1 + i % 2, "net_sales_amount": 1 + i, "order_id": "o"} for i in range(4)])
    got = rows(matrix(s, ["total_revenue", "avg_basket_value"], [("category",), ()]), "level", "category", "total_revenue", "avg_basket_value")
    assert set(got) == {("category", None, 4.0, 4.0), ("category", "c", 6.0, 6.0), ("total", None, 10.0, 10.0)}


def test_levels_are_checked(derived_star):
    with pytest.raises(ValueError):
        matrix(derived_star[0], ["total_revenue"], [("region", "category"), ("category", "region")])


def test_one_scan_per_fact(derived_star):
    s, _ = derived_star
    plan = matrix(s, ["total_revenue", "inventory_value"], LEVELS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("net_sales_amount#") > 0 and sum("Relation" in line and "net_sales_amount" in line for line in plan.splitlines()) == 1


def test_bitmaps_count_like_distinct(spark):
    rng = random.Random(4)
    data = [(rng.randint(0, 2), rng.choice("xyz"), rng.choice([None, *range(5), 32767, 32768, 32769, 10 ** 9]), rng.randint(1, 70_000)) for _ in range(3000)]
    df = spark.createDataFrame(data, "a int, b string, k long, n int")
    bitmaps = distinct_bitmaps(df, ["a", "b"], k="k", n="n").cache()
    for by in (["a", "b"], ["b"], []):
        want = df.groupBy(*by).agg(F.count_distinct("k").alias("k"), F.count_distinct("n").alias("n"))
        assert rows(distinct_counts(bitmaps, by, ("k", "n")), *want.columns) == rows(want)
    bitmaps.unpersist()


def test_numbers_have_no_gaps(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("é",)], "s string")
    assert rows(numbered(df, "s"), "s", "number") == [("a", 1), ("b", 2), ("é", 3)]
    assert numbered(df.limit(0), "s").count() == 0
