"""What must hold when tables outgrow one task: alternative join shapes, sliced windows, pruning, skew."""

import random
import re
from datetime import date

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from shelfwise.operators.anchors import latest_snapshot, trailing_window
from shelfwise.operators.clean import dedupe_natural
from shelfwise.operators.grouping import broadcast_limit, exact_quantile, fits_broadcast, global_rank, prefix_sums, rollup
from shelfwise.operators.ledger import as_of_fill, cut_at_blocks, ledger_rollforward, month_blocks, open_orders, stock_runs
from shelfwise.operators.quality import Reference, check_references
from tests.tiny import product, rows, sale, star


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_dimension_path_gives_the_same_rows(spark, derived_star, no_broadcast):
    s, _ = derived_star
    assert broadcast_limit(s.product) == -1 and not fits_broadcast(s.product)
    aggs = dict(r=("sum", "net_sales_amount"), n=("count", F.lit(1)), hi=("max", "units_sold_qty"), lo=("min", "units_sold_qty"),
                promoted=("count_if", F.col("promotion_key").isNotNull()))
    late = rollup(s.sales, s.product, ("product_key", "product_key"), ["category"], **aggs)
    assert "BroadcastHashJoin" not in plan_of(late)
    late_rows = rows(late)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    early = rollup(s.sales, s.product, ("product_key", "product_key"), ["category"], **aggs)
    assert "BroadcastHashJoin" in plan_of(early)
    assert late_rows == rows(early)


@pytest.mark.parametrize("name", ["q02", "q07", "q13", "q18", "q25", "q31", "q33", "q14", "q24", "q29", "q38", "q41", "win_lag_delta", "vw_dead_stock", "kpi_report", "dq_report",
                                  "m_turnover", "m_inventory_value", "m_dead_stock_value", "m_reorder_now_count", "m_revenue_ytd",
                                  "m_est_lost_sales", "m_avg_basket_value", "m_stockout_sku_count", "m_supplier_score"])
def test_questions_without_broadcast(spark, sf_dir, no_broadcast, name):
    shuffled = rows(queries()[name](spark, sf_dir))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert shuffled == rows(queries()[name](spark, sf_dir))


def test_prefix_sums_equal_one_window(spark):
    rng = random.Random(11)
    data = [(i, rng.choice([0, 1, 1, 5, 7, 900])) for i in range(5000)]
    df = spark.createDataFrame(data, "k int, v int").repartition(7)
    order = [F.desc("v"), F.asc("k")]
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(1))
    want = df.select("k", "v", F.row_number().over(Window.orderBy(*order)).alias("position"), F.sum("v").over(w).alias("running"),
                     F.sum("v").over(everything).alias("grand_total"), F.count("v").over(everything).alias("row_total"))
    got = prefix_sums(df, order, "v").select("k", "v", "position", "running", "grand_total", "row_total")
    assert rows(got) == rows(want)


def test_prefix_sums_of_nothing(spark):
    assert prefix_sums(spark.createDataFrame([], "k int, v int"), [F.asc("k")], "v").count() == 0


def test_sliced_rank_equals_window_rank(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, rng.choice([1, 1, 2, 3, 50])) for i in range(2000)], "k int, v int")
    want = df.select("k", F.rank().over(Window.orderBy(F.desc("v"))).cast("bigint"))
    assert rows(global_rank(df, "v", "r").select("k", "r")) == rows(want)


@pytest.mark.parametrize("q", [0.0, 0.5, 0.99, 1.0])
def test_exact_quantile(spark, q):
    rng = random.Random(2)
    values = [rng.choice([0, 0, 0, 3, 8, 21, rng.randint(0, 500)]) for _ in range(3001)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v int")
    assert exact_quantile(df, "v", q).first()[0] == pytest.approx(np.quantile(values, q))


def test_latest_snapshot_prunes_partitions_and_columns(derived_star):
    s, _ = derived_star
    plan = plan_of(latest_snapshot(s.snapshot).select("product_key", "on_hand_qty"))
    partition = re.search(r"PartitionFilters: \[([^\]]*\])", plan).group(1)
    assert "snapshot_month" in partition and "ubquery" in partition
    read = [{c.split(":")[0] for c in found.split(",")} for found in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]
    # the last month comes from the partition listing
    assert "LocalTableScan [snapshot_month" in plan
    # the scan itself reads three columns, the subqueries read the date key or nothing
    assert max(read, key=len) == {"snapshot_date_key", "product_key", "on_hand_qty"}


def test_trailing_window_prunes_partitions(derived_star):
    s, _ = derived_star
    recent = trailing_window(s.sales, F.lit(date(2001, 8, 1)), 30).select("product_key")
    rows_read = recent.count()
    assert 0 < rows_read < s.sales.count()
    plan = plan_of(recent)
    assert "sale_month" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)


def test_repeated_rows_fold_before_the_shuffle(spark):
    hot = spark.range(30000).select(F.col("id").alias("sales_key"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("x"))
    deduped = dedupe_natural(hot)
    assert plan_of(deduped).count("HashAggregate") >= 2
    assert deduped.filter("x = 1 AND copies > 9000").select("sales_key").first()[0] == 0
    assert deduped.agg(F.sum("copies")).first()[0] == 30000


def test_one_key_with_a_third_of_all_rows(spark, no_broadcast):
    """Sums, ledger and ranks stay right when a third of the rows share product, place and day."""
    n = 60000
    i = F.col("id")
    hot = i % 3 == 0
    fact = spark.range(n).select(
        F.when(hot, 1).otherwise(i % 997 + 2).alias("product_key"), F.when(hot, 1).otherwise(i % 25).cast("int").alias("location_key"),
        F.when(hot, 20240105).otherwise(20240101 + i % 28).cast("int").alias("date_key"), (i % 5 + 1).cast("int").alias("qty"))
    dim = spark.range(1, 1000).select(F.col("id").alias("product_key"), (F.col("id") % 7).alias("category"))
    grouped = rollup(fact, dim, ("product_key", "product_key"), ["category"], q=("sum", "qty"), n=("count", F.lit(1)))
    assert "partial_sum" in plan_of(grouped) and grouped.agg(F.sum("n")).first()[0] == n
    assert rows(grouped) == rows(fact.join(dim, "product_key").groupBy("category").agg(F.sum("qty"), F.count(F.lit(1))))

    keys = ["product_key", "location_key"]
    moved = ledger_rollforward(fact.filter("qty = 5"), fact, None, keys, "date_key")
    assert moved.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] <= 28
    demanded, got, missed = moved.agg(F.sum("demand"), F.sum("sold"), F.sum("unmet")).first()
    assert demanded == fact.agg(F.sum("qty")).first()[0] == got + missed
    ranked = global_rank(fact.select("qty"), "qty", "r").groupBy("qty", "r").agg(F.count(F.lit(1)))
    assert rows(ranked) == [(q, (5 - q) * (n // 5) + 1, n // 5) for q in range(1, 6)]


def test_snapshot_days_and_sales_amounts_meet_no_shuffle(derived_star):
    """Stretches of stock and narrow sale lines are shuffled; a row per day, or amounts, only exist after that."""
    _, built = derived_star
    for table, column in (("fact_inventory_snapshot", "snapshot_date_key"), ("fact_sales", "gross_sales_amount")):
        after, *before = re.split(r"Exchange hashpartitioning\(\w+_month", plan_of(getattr(built, table)()))
        assert len(before) == 1 and column in after and "Exchange" not in after
        assert "as_of_key" not in before[0] and "gross_sales_amount" not in before[0]


def test_stretches_of_stock_are_dealt_to_blocks_of_months(spark, derived_star):
    """A stretch is shuffled once for a block, not for every month in it."""
    _, built = derived_star
    plan = plan_of(built.fact_inventory_snapshot())
    assert "Exchange hashpartitioning(_block_of_month" in plan
    assert built.get("fact_inventory_snapshot").groupBy("snapshot_key").count().filter("count > 1").isEmpty()
    # sixty months of one date, then two of thirty
    days = spark.createDataFrame([(m, m) for m in range(60)] + [(60 + d, 60 + d // 30) for d in range(60)], "_at bigint, _month int")
    blocks = month_blocks(days, 40)
    assert rows(blocks.groupBy("_block_of_month").agg(F.min("_month"), F.max("_month"))) == [(0, 0, 39), (1, 40, 60), (2, 61, 61)]
    runs = spark.createDataFrame([(1, 0, 61), (2, 3, 39), (3, 39, 40), (4, 61, 61)], "product_key bigint, _month int, _until_month int")
    assert rows(cut_at_blocks(runs, blocks), "product_key", "_block_of_month", "_month", "_until_month") == [
        (1, 0, 0, 39), (1, 1, 40, 60), (1, 2, 61, 61), (2, 0, 3, 39), (3, 0, 39, 39), (3, 1, 40, 40), (4, 2, 61, 61)]


def test_value_and_alarms_are_worked_out_before_days(derived_star):
    """Once for a stretch and month, below the sort, not for every day the join makes of it."""
    _, built = derived_star
    plan = built.fact_inventory_snapshot()._jdf.queryExecution().optimizedPlan().toString()
    days, below = plan.split("Sort [snapshot_month", 1)
    assert "decimal" not in days and "decimal" in below.split("RepartitionByExpression", 1)[0]
    rows_ = built.get("fact_inventory_snapshot").join(built.get("dim_product").select("product_key", "unit_cost"), "product_key")
    right = (F.col("on_hand_value") == (F.col("on_hand_qty") * F.col("unit_cost")).cast("decimal(18,2)")) & (
        F.col("is_below_reorder_flag") == (F.col("on_hand_qty") <= F.col("reorder_point"))) & (F.col("is_stockout_flag") == (F.col("on_hand_qty") == 0))
    assert rows_.count() and rows_.filter(~right).isEmpty()


def test_references_meet_dimensions_without_a_join(spark):
    """Only the one row a check is joined; the keys of a dimension are never gathered in the driver. Rows, unknown keys and repeated dimension rows count right."""
    day = date(2024, 1, 5)
    s = star(spark, dim_product=[product(1), product(2), product(2)], fact_sales=[sale(k, day, p=p) for k, p in enumerate((1, 1, 2, None, 9, 8, 9))])
    rule = Reference("fact_sales", "product_key", "dim_product")
    found = check_references(s, "fact_sales", [rule, Reference("fact_sales", "date_key", "dim_date")])
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    assert rows(found) == [("fact_sales.date_key -> dim_date", True, 0, 7, None), (rule.name, True, 3, 7, "8, 9")]


def test_ledger_takes_its_opening_without_a_join(spark, derived_star):
    """The derived ledger meets no list of positions, and only keys, day and the two sums are dealt to its windows; unknown keys open with nothing."""
    _, built = derived_star
    plan = plan_of(built.ledger())
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    dealt = re.search(r"Exchange hashpartitioning\(product_key\S*, location_key\S*, \d+\).*\n.*?(\w+)", plan)
    assert dealt and dealt[1] == "HashAggregate"  # no column is worked out before it
    keys, schema = ["product_key", "location_key"], "product_key bigint, location_key int, date_key int, qty int"
    receipts = spark.createDataFrame(
        [(20, 1, 20240102, 3), (20, None, 20240101, None), (None, 2, 20240101, 2), (23, 4, 20240103, None), (41, 3, 20240104, None)], schema)
    demand = spark.createDataFrame(
        [(23, 4, 20240101, 8), (20, None, 20240103, 1), (None, 2, 20240102, 5), (23, 4, 20240101, 20), (39, 1, 20240101, None), (41, 3, 20240101, None)], schema)
    pairs = demand.select(*keys).unionByName(receipts.select(*keys)).distinct().withColumn("opening_qty", built.opening_qty())
    joined = ledger_rollforward(receipts, demand, pairs, keys, "date_key")
    direct = ledger_rollforward(receipts, demand, built.opening_qty(), keys, "date_key")
    assert rows(direct) == rows(joined)
    assert rows(direct.filter("product_key = 41"), "on_hand") == [(None,), (None,)]  # no quantity is known yet
    assert rows(direct.filter("product_key = 23"), "date_key", "on_hand", "sold", "unmet") == [(20240101, 0, 18, 10), (20240103, 0, 0, 0)]


def test_stretches_of_stock_equal_filled_days(spark):
    """Also with unknown quantities, orders without a date or a place, and positions that were on order before they had stock."""
    days = [20240100 + d for d in range(1, 32)] + [20240200 + d for d in range(1, 11)]
    calendar = spark.createDataFrame([(d,) for d in days], "date_key int")
    dates = calendar.filter("date_key in (20240131, 20240203, 20240204, 20240210)")
    ledger = spark.createDataFrame(
        [(1, 1, 20240102, 5), (1, 1, 20240103, 7), (1, 1, 20240204, None), (2, 1, 20240203, 0), (2, None, 20240105, 3), (3, 2, 20240210, 9)],
        "product_key bigint, location_key int, date_key int, on_hand bigint")
    po = spark.createDataFrame(
        [(1, 1, 20240101, 20240203, 4), (1, 1, None, None, 2), (2, 1, 20240101, None, 6), (2, None, 20240101, None, 8), (3, 2, None, None, 1),
         (3, 2, 20240204, 20240210, None), (4, 1, 20240101, None, 3)],
        "product_key bigint, dest_location_key int, order_date_key int, received_date_key int, ordered_qty int")
    pair = ["product_key", "location_key"]
    want = as_of_fill(ledger, pair, "date_key", dates, calendar, ["on_hand"]).join(
        open_orders(po, dates, calendar), [*pair, "as_of_key"], "left").select(*pair, "as_of_key", "on_hand", F.coalesce("on_order_qty", F.lit(0)))
    runs, at = stock_runs(ledger, po, dates, calendar)
    got = runs.join(at, F.col("_at").between(F.col("_slot"), F.col("_until"))).select(*pair, "date_key", "on_hand", "on_order_qty")
    assert sorted(map(str, got.collect())) == sorted(str(r).replace("as_of_key", "date_key").replace("coalesce(on_order_qty, 0)", "on_order_qty")
                                                     for r in want.collect())
    months = runs.agg(F.min("_month"), F.max("_until_month")).first()
    assert tuple(months) == (2024 * 12, 2024 * 12 + 1)
