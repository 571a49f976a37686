"""Published versions, the resumed ledger, the summary kept from parts."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfwise.operators.ledger import ledger_rollforward
from shelfwise.plans.executive import mv_executive_kpis
from shelfwise.plans.incremental import kpis_from_parts, load_ledger, refresh_kpis
from shelfwise.sources.star import from_parquet
from shelfwise.sources.versions import (
    PublishConflict, changed_months, expire, publish, read_star, read_table, read_version, version_numbers,
)
from tests.tiny import rows, star

KEYS = ["k"]
MONTHS = {"t": "m"}


def frame(spark, *values):
    return spark.createDataFrame(list(values), "m int, v int")


def read(spark, folder, number=None):
    return rows(read_table(spark, folder, read_version(spark, folder, number), "t"), "m", "v")


def test_months_are_replaced_and_others_keep_their_files(spark, tmp_path):
    folder = str(tmp_path)
    first = publish(spark, folder, {"t": frame(spark, (1, 10), (2, 20), (3, 30))}, MONTHS)
    then = publish(spark, folder, {"t": frame(spark, (2, 21), (4, 40))}, MONTHS, whole=False)
    assert read(spark, folder) == [(1, 10), (2, 21), (3, 30), (4, 40)]
    assert read(spark, folder, 1) == [(1, 10), (2, 20), (3, 30)]
    assert then.tables["t"].months["1"] == first.tables["t"].months["1"]
    assert changed_months(first, then, "t") == (["2", "4"], [])
    publish(spark, folder, {"t": frame(spark, (9, 90))}, MONTHS)
    assert read(spark, folder) == [(9, 90)]


def test_failed_load_is_never_seen(spark, tmp_path):
    folder = str(tmp_path)
    publish(spark, folder, {"t": frame(spark, (1, 10)), "u": frame(spark, (1, 1))}, MONTHS)
    broken = frame(spark, (1, 11), (2, 20)).withColumn("v", F.when(F.col("m") == 2, F.raise_error(F.lit("cut off")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        publish(spark, folder, {"u": frame(spark, (1, 2)), "t": broken}, MONTHS, whole=False, threads=1)
    assert read(spark, folder) == [(1, 10)] and version_numbers(spark, folder) == [1]
    assert rows(read_table(spark, folder, read_version(spark, folder), "u"), "v") == [(1,)]


def test_readers_keep_their_version(spark, tmp_path):
    folder = str(tmp_path)
    s = star(spark, dim_promotion=[{"promotion_key": 1}])
    publish(spark, folder, {"dim_promotion": s.promotion})
    reader = from_parquet(spark, folder)
    publish(spark, folder, {"dim_promotion": star(spark, dim_promotion=[{"promotion_key": k} for k in (1, 2)]).promotion})
    assert reader.promotion.count() == 1
    assert from_parquet(spark, folder).promotion.count() == 2
    assert read_star(spark, folder, 1).promotion.count() == 1


def test_second_of_two_loads_from_one_version_is_refused(spark, tmp_path):
    folder = str(tmp_path)
    base = publish(spark, folder, {"t": frame(spark, (1, 10))}, MONTHS)
    publish(spark, folder, {"t": frame(spark, (2, 20))}, MONTHS, base, whole=False)
    with pytest.raises(PublishConflict):
        publish(spark, folder, {"t": frame(spark, (3, 30))}, MONTHS, base, whole=False)
    assert read(spark, folder) == [(1, 10), (2, 20)]


def test_expired_versions_leave_what_newer_ones_need(spark, tmp_path):
    folder = str(tmp_path)
    publish(spark, folder, {"t": frame(spark, (1, 10), (2, 20))}, MONTHS)
    for v in (21, 22):
        publish(spark, folder, {"t": frame(spark, (2, v))}, MONTHS, whole=False)
    assert expire(spark, folder, keep=1) == [1, 2]
    assert read(spark, folder) == [(1, 10), (2, 22)]
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("load=")]) == 2
    with pytest.raises(FileNotFoundError):
        read_version(spark, folder, 1)


def test_month_filter_opens_only_its_months(spark, tmp_path):
    folder = str(tmp_path)
    publish(spark, folder, {"t": frame(spark, (1, 10), (2, 20), (3, 30))}, MONTHS)
    publish(spark, folder, {"t": frame(spark, (2, 21))}, MONTHS, whole=False)
    df = read_table(spark, folder, read_version(spark, folder), "t").filter("m = 2")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan and rows(df, "v") == [(21,)]


def test_types_follow_the_table(spark, tmp_path):
    folder = str(tmp_path)
    publish(spark, folder, {"t": frame(spark, (1, 10))}, MONTHS)
    publish(spark, folder, {"t": frame(spark, (2, 20)).withColumn("v", F.col("v").cast("long"))}, MONTHS, whole=False)
    assert read(spark, folder) == [(1, 10), (2, 20)]


def moves(spark, data):
    return spark.createDataFrame(data, "k int, d int, qty int")


def days(rng, n):
    return [(rng.randint(1, 6), 20240100 + 100 * rng.randint(0, 3) + rng.randint(1, 9), rng.randint(0, 12)) for _ in range(n)]


def test_resumed_ledger_equals_the_whole(spark, tmp_path):
    rng = random.Random(8)
    receipts, demand = days(rng, 120), days(rng, 160)
    opening = spark.createDataFrame([(1, 5), (2, 0), (7, 9)], "k int, opening_qty int")
    whole = ledger_rollforward(moves(spark, receipts), moves(spark, demand), opening, KEYS, "d")
    for turn in range(3):
        folder = str(tmp_path / str(turn))
        cuts = [lambda r: r[1] < 20240200 and r[0] != 3, lambda r: r[1] < 20240306 and r[2] % 3, lambda r: True] if turn else [lambda r: rng.random() < .5, lambda r: True]
        left = receipts, demand
        for chosen in cuts:
            picked = [[chosen(r) for r in part] for part in left]
            now = [[r for r, p in zip(part, ps, strict=True) if p] for part, ps in zip(left, picked, strict=True)]
            left = [[r for r, p in zip(part, ps, strict=True) if not p] for part, ps in zip(left, picked, strict=True)]
            load_ledger(spark, folder, moves(spark, now[0]), moves(spark, now[1]), opening, KEYS, "d")
        got = read_table(spark, folder, read_version(spark, folder), "ledger").drop("ledger_month")
        assert rows(got, *whole.columns) == rows(whole)


def test_ledger_without_late_rows_leaves_old_months(spark, tmp_path):
    folder = str(tmp_path)
    first = load_ledger(spark, folder, moves(spark, [(1, 20240105, 9), (2, 20240207, 4)]), moves(spark, [(1, 20240110, 3)]), None, KEYS, "d")
    then = load_ledger(spark, folder, moves(spark, [(1, 20240301, 1)]), moves(spark, [(3, 20240302, 5)]), None, KEYS, "d")
    assert changed_months(first, then, "ledger") == (["202403"], [])
    last = load_ledger(spark, folder, moves(spark, [(2, 20240201, 1)]), moves(spark, []), None, KEYS, "d")
    assert changed_months(then, last, "ledger") == (["202402"], [])
    assert rows(read_table(spark, folder, last, "ledger_state"), "k", "on_hand") == [(1, 7), (2, 5), (3, 0)]


def test_summary_reads_the_changed_month_alone(spark, derived_star, tmp_path, monkeypatch):
    s, _ = derived_star
    folder, parts = str(tmp_path / "w"), str(tmp_path / "p")
    months = publish(spark, folder, {"fact_sales": s.sales, "fact_inventory_snapshot": s.snapshot}).tables["fact_sales"].months
    made = refresh_kpis(spark, folder, parts)
    assert set(made["kpi_sales"]) == set(months)
    assert rows(kpis_from_parts(spark, parts, s.dates, s.product)) == rows(mv_executive_kpis(s))
    assert refresh_kpis(spark, folder, parts) == {"kpi_sales": [], "kpi_last_sale": [], "kpi_closing": []}
    month = sorted(months)[3]
    publish(spark, folder, {"fact_sales": s.sales.filter(F.col("sale_month") == int(month)).limit(5)}, whole=False)
    opened = []

    def seen(*args):
        df = read_table(*args)
        if args[3].startswith("fact_"):
            opened.extend(df.inputFiles())
        return df

    monkeypatch.setattr("shelfwise.plans.incremental.read_table", seen)
    assert refresh_kpis(spark, folder, parts) == {"kpi_sales": [month], "kpi_last_sale": [month], "kpi_closing": []}
    assert opened and all(f"/sale_month={month}/" in f for f in opened)
    assert rows(kpis_from_parts(spark, parts, s.dates, s.product)) == rows(mv_executive_kpis(from_parquet_of(spark, folder, s)))


def from_parquet_of(spark, folder, s):
    now = from_parquet(spark, folder)
    return s.replaced(fact_sales=now.sales, fact_inventory_snapshot=now.snapshot)


def test_summary_forgets_months_taken_away(spark, tmp_path):
    folder, parts = str(tmp_path / "w"), str(tmp_path / "p")
    sale = {"net_sales_amount": 3, "gross_margin_amount": 1, "product_key": 1}
    s = star(spark, fact_sales=[{**sale, "sales_key": 1, "date_key": 20240105}, {**sale, "sales_key": 2, "date_key": 20240205}])
    publish(spark, folder, {"fact_sales": s.sales, "fact_inventory_snapshot": s.snapshot})
    refresh_kpis(spark, folder, parts)
    publish(spark, folder, {"fact_sales": s.sales.filter("sale_month = 202402")})
    refresh_kpis(spark, folder, parts)
    got = kpis_from_parts(spark, parts, s.dates, s.product).first()
    assert (got.total_revenue, got.current_inventory_value, got.dead_stock_skus) == (3.0, None, 0)
