"""Reading and writing the star."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from shelfwise.plans.incremental import _closing_part
from shelfwise.plans.load import gated_load, materialize
from shelfwise.plans.views import register_views
from shelfwise.schema import SCHEMAS, stored_schema
from shelfwise.sources.sinks import COST_BASED, incremental_refresh, refresh_stats, register_tables, sample_rows, sink_star, sink_table
from shelfwise.sources.star import from_csv, from_parquet
from shelfwise.sources.versions import publish
from tests.tiny import location, product, rows, sale, star, stock

DAY = date(2024, 1, 31)


def small(spark, **more):
    tables = dict(
        dim_product=[product(1), product(2, category="d")], dim_location=[location(1), location(2, kind="WAREHOUSE")],
        fact_sales=[sale(k, date(2024, 1 + k % 3, 5), p=1 + k % 2) for k in range(1, 9)],
        fact_inventory_snapshot=[stock(1, date(2024, 1, 31)), stock(2, date(2024, 2, 29), qty=0), stock(3, date(2024, 3, 31), p=2, qty=9)],
    )
    return star(spark, **{**tables, **more})


def test_csv_quirks(spark, tmp_path):
    (tmp_path / "dim_location.sample.csv").write_text(
        "region,location_key,location_id,location_type,location_name,store_size_sqft,warehouse_capacity_units,is_active\n"
        "North,1,L1,STORE,One,18931.0,,True\nSouth,2,L2,WAREHOUSE,Two,,50000.0,False\n")
    (tmp_path / "dim_customer.sample.csv").write_text(
        "customer_key,customer_id,loyalty_tier,is_loyalty_member,region\n1,C1,None,False,\n2,C2,,True,East\n")
    s = from_csv(spark, str(tmp_path), ".sample.csv")
    assert s.location.schema.fieldNames() == SCHEMAS["dim_location"].fieldNames()
    assert rows(s.location, "location_key", "store_size_sqft", "warehouse_capacity_units", "is_active", "city") == [
        (1, 18931, None, True, None), (2, None, 50000, False, None)]
    assert rows(s.customer, "customer_key", "loyalty_tier", "region") == [(1, "None", None), (2, None, "East")]


def test_round_trip_in_both_formats(spark, tmp_path):
    s = small(spark)
    sink_star(s, str(tmp_path / "p"))
    sink_star(s, str(tmp_path / "c"), fmt="csv")
    stored, text = from_parquet(spark, str(tmp_path / "p")), from_csv(spark, str(tmp_path / "c"))
    for name in SCHEMAS:
        columns = SCHEMAS[name].fieldNames()
        assert rows(stored.table(name), *columns) == rows(s.table(name), *columns) == rows(text.table(name), *columns)
    assert stored.sales.schema == spark.read.schema(stored_schema("fact_sales")).parquet(str(tmp_path / "p" / "fact_sales")).schema
    assert sorted(p.name for p in (tmp_path / "p" / "fact_sales").iterdir() if "=" in p.name) == [
        "sale_month=202401", "sale_month=202402", "sale_month=202403"]


def test_unpartitioned_parquet_gets_its_month(spark, tmp_path):
    s = small(spark)
    s.snapshot.drop("snapshot_month").write.parquet(str(tmp_path / "fact_inventory_snapshot"))
    read = from_parquet(spark, str(tmp_path), partitioned=False).snapshot
    assert rows(read, "snapshot_month") == [(202401,), (202402,), (202403,)]


def test_incremental_refresh_leaves_old_months_alone(spark, tmp_path):
    s = small(spark)
    sink_table(s.snapshot, str(tmp_path), "fact_inventory_snapshot")
    incremental_refresh(s.snapshot.withColumn("on_hand_qty", F.lit(77)), str(tmp_path), "fact_inventory_snapshot", 202402)
    read = from_parquet(spark, str(tmp_path)).snapshot
    assert rows(read, "snapshot_month", "on_hand_qty") == [(202401, 1), (202402, 77), (202403, 77)]


def test_statistics_reach_the_catalog(spark, tmp_path):
    tables = ["fact_sales", "fact_inventory_snapshot"]
    sink_star(small(spark), str(tmp_path), tables)
    register_tables(spark, str(tmp_path), tables, "stats_test")
    assert rows(refresh_stats(spark, tables, "stats_test")) == [("fact_inventory_snapshot", 3), ("fact_sales", 8)]
    assert rows(spark.table("stats_test.fact_sales"), "sales_key")[0] == (1,)


def test_sample_is_in_key_order(spark):
    assert rows(sample_rows(small(spark).sales, "fact_sales", 3), "sales_key") == [(1,), (2,), (3,)]


def test_gate_lets_repaired_data_through(spark, tmp_path):
    twin = sale(3, DAY)
    raw = small(spark, fact_sales=[{**sale(1, DAY), "unit_price": None}, twin, {**twin, "sales_key": 4}])
    staging, warehouse = str(tmp_path / "staging"), str(tmp_path / "warehouse")
    assert gated_load(raw, staging, warehouse)
    loaded = from_parquet(spark, warehouse)
    assert rows(loaded.sales, "sales_key", "unit_price") == [(1, Decimal("2.00")), (3, Decimal("2.00"))]
    assert spark.read.parquet(f"{staging}/check_results").count() == 12
    assert spark.read.parquet(f"{warehouse}/mv_executive_kpis").count() == 1


def test_gate_blocks_orphans(spark, tmp_path):
    raw = small(spark, fact_sales=[sale(1, DAY, p=404)])
    warehouse = tmp_path / "warehouse"
    assert not gated_load(raw, str(tmp_path / "staging"), str(warehouse))
    assert not warehouse.exists()


def test_sql_users_find_tables_and_views(spark, tmp_path):
    s = small(spark)
    register_views(s)
    got = spark.sql("SELECT category, sum(units_sold_qty) AS u FROM vw_sales_enriched GROUP BY category")
    assert rows(got) == [("c", 4), ("d", 4)]
    assert spark.sql("SELECT count(*) FROM vw_current_inventory").first()[0] == 1
    assert materialize(s, str(tmp_path)).count() == 1


def test_histograms_change_the_order_of_joins(spark, tmp_path):
    """Nearly all of ``x`` lies at the low end: only a histogram tells that ``x > 5`` keeps little, so that its table should be met first."""
    tables = {
        "f": spark.range(20_000).selectExpr("id % 1000 AS k1", "id % 997 AS k2", "id AS v"),
        "d1": spark.range(1000).selectExpr("id AS k1", "CASE WHEN id < 995 THEN id % 3 ELSE id END AS x", "id AS w1"),
        "d2": spark.range(997).selectExpr("id AS k2", "id AS y", "id AS w2"),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    spark.sql(f"CREATE DATABASE orders_test LOCATION '{tmp_path}/_catalog'")
    for name in tables:
        spark.catalog.createTable(f"orders_test.{name}", path=str(tmp_path / name), source="parquet")
    query = """SELECT v, w1, w2 FROM orders_test.f JOIN orders_test.d2 ON f.k2 = d2.k2 JOIN orders_test.d1 ON f.k1 = d1.k1
               WHERE x > 5 AND y < 300"""
    before = {k: spark.conf.get(k) for k in COST_BASED}
    order = {}
    try:
        for k, v in COST_BASED.items():
            spark.conf.set(k, v)
        for histograms in (False, True):
            refresh_stats(spark, list(tables), "orders_test", {"d1": ["x"], "d2": ["y"]} if histograms else None)
            plan = spark.sql(query)._jdf.queryExecution().optimizedPlan().toString()
            relations = [line for line in plan.splitlines() if "Relation" in line]
            depth = {name: next(line.index("Relation") for line in relations if column in line) for name, column in (("d1", "x#"), ("d2", "y#"))}
            order[histograms] = max(depth, key=depth.get)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert order == {False: "d2", True: "d1"}


def test_stored_months_are_written_again_as_they_come(spark, tmp_path):
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    days = [date(2024, m, d) for m in (1, 2) for d in (3, 1, 2)]
    s = star(spark, fact_inventory_snapshot=[stock(q, day, qty=q) for q, day in enumerate(days)])
    # by product, not by day
    first = sink_table(s.snapshot.coalesce(1).sortWithinPartitions("snapshot_month", "on_hand_qty"), str(tmp_path / "a"), "fact_inventory_snapshot", in_order=True)
    stored = from_parquet(spark, str(tmp_path / "a")).snapshot
    again = sink_table(stored, str(tmp_path / "b"), "fact_inventory_snapshot", by_month=True)
    published = publish(spark, str(tmp_path / "c"), {"fact_inventory_snapshot": stored}, by_month=["fact_inventory_snapshot"])
    incremental_refresh(stored, str(tmp_path / "a"), "fact_inventory_snapshot", 202402, by_month=True)
    folders = [again, first, *(f"{tmp_path}/c/fact_inventory_snapshot/load={load}" for load in set(published.tables["fact_inventory_snapshot"].months.values()))]
    for folder in folders:
        for month, held in ((202401, [0, 1, 2]), (202402, [3, 4, 5])):
            files = spark.read.parquet(f"{folder}/snapshot_month={month}")
            assert len(files.inputFiles()) == 1
            assert [r[0] for r in files.select("on_hand_qty").collect()] == held
    assert spark.conf.get(setting) == before


def test_a_load_writes_stored_months_as_they_come(spark, tmp_path):
    """From the extract to staging if the caller says so, and from there to the warehouse always."""
    days = [date(2024, m, d) for m in (1, 2) for d in (3, 1, 2)]
    s = small(spark)
    held = star(spark, fact_inventory_snapshot=[stock(q, day, qty=q) for q, day in enumerate(days)]).snapshot
    sink_table(held.coalesce(1).sortWithinPartitions("snapshot_month", "on_hand_qty"), str(tmp_path / "a"), "fact_inventory_snapshot", in_order=True)
    raw = s.replaced(fact_inventory_snapshot=from_parquet(spark, str(tmp_path / "a")).snapshot)
    assert gated_load(raw, str(tmp_path / "staging"), str(tmp_path / "warehouse"), by_month=["fact_inventory_snapshot"])
    [load] = [p.name for p in (tmp_path / "warehouse" / "fact_inventory_snapshot").iterdir() if p.name.startswith("load=")]
    for folder in ("staging/fact_inventory_snapshot", f"warehouse/fact_inventory_snapshot/{load}"):
        for month, want in ((202401, [0, 1, 2]), (202402, [3, 4, 5])):
            files = spark.read.parquet(f"{tmp_path}/{folder}/snapshot_month={month}")
            assert [r[0] for r in files.select("on_hand_qty").collect()] == want


def test_closings_are_grouped_after_other_days_have_gone(spark):
    s = star(spark, fact_inventory_snapshot=[stock(d, date(2024, 1, d)) for d in (1, 2, 3)] + [stock(9, date(2024, 1, 2), 2)])
    closing = _closing_part(s.snapshot)
    assert rows(closing, "snapshot_date_key", "product_key", "held") == [(20240103, 1, 1)]
    plan = closing._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [snapshot_month") < plan.index("Join Inner")
