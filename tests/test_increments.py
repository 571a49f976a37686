"""Layout along a curve, repeats of earlier extracts, checks that merge."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators.quality import Reference, Row, Unique, run_checks
from shelfwise.plans import incremental
from shelfwise.plans.check_state import checks_from_state, refresh_checks
from shelfwise.plans.incremental import load_new_sales
from shelfwise.sources.sinks import curve_value, curve_write, files_met
from shelfwise.sources.versions import changed_months, publish, read_star, read_table, read_version
from tests.tiny import rows, star


def cube(spark, n=8):
    return spark.createDataFrame([(a, b, c) for a in range(n) for b in range(n) for c in range(n)], "a int, b int, c int")


def test_curve_interleaves_ranks(spark):
    placed, name = curve_value(cube(spark), ["a", "b", "c"], bits=3)
    for r in placed.collect():
        want = sum((v >> bit & 1) << (3 * bit + 2 - at) for at, v in enumerate((r.a, r.b, r.c)) for bit in range(3))
        assert r[name] == want


def test_few_values_use_the_whole_range(spark):
    df = spark.createDataFrame([(i % 2, i, None) for i in range(64)], "a int, b int, c int")
    placed, name = curve_value(df, ["a", "b", "c"], bits=3)
    assert {r.a for r in placed.filter(F.col(name) >= 1 << 8).collect()} == {1}
    assert placed.count() == 64
    assert curve_value(df.limit(0), ["a"])[0].count() == 0


def test_places_are_found_in_few_rounds(spark):
    """One comparison a key and round, not one for every rank; unknown keys come last."""
    df = spark.createDataFrame([(i % 97, i, None if i % 10 == 0 else i % 3) for i in range(500)], "a int, b bigint, c int")
    placed, name = curve_value(df, ["a", "b", "c"])
    assert placed._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") <= 3 * 7
    seen = placed.collect()
    for at, k in enumerate("abc"):
        rank = {}
        for r in seen:
            rank.setdefault(r[k], set()).add(sum((r[name] >> (bit * 3 + 2 - at) & 1) << bit for bit in range(6)))
        assert all(len(found) == 1 for found in rank.values())
        in_order = [rank[v].pop() for v in sorted(rank, key=lambda v: (v is None, v))]
        assert in_order == sorted(in_order) and in_order[0] == 0


def test_every_path_meets_few_files(spark, tmp_path):
    df, path = cube(spark, 16), str(tmp_path / "t")
    curve_write(df, path, ["a", "b", "c"], files=64, bits=4)
    assert rows(spark.read.parquet(path)) == rows(df)
    met = {r.path: (r.met, r.files) for r in files_met(spark, path, df.schema, a=(3, 3), b=(9, 9), c=(0, 1)).collect()}
    assert all(m * 2 < n and n > 30 for m, n in met.values())


def facts(spark, keyed):
    sale = {"order_id": "o", "product_key": 1, "location_key": 1, "units_sold_qty": 1}
    return star(spark, fact_sales=[{**sale, "sales_key": k, "date_key": d, "units_sold_qty": u} for k, d, u in keyed]).sales


def stored(spark, folder):
    return rows(read_table(spark, folder, read_version(spark, folder), "fact_sales"), "date_key", "units_sold_qty")


def test_repeats_of_earlier_extracts_go(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    first = load_new_sales(spark, folder, facts(spark, [(1, 20240105, 1), (2, 20240105, 1), (3, 20240205, 2), (4, 20240307, 3)]))
    assert stored(spark, folder) == [(20240105, 1), (20240205, 2), (20240307, 3)]
    opened = []

    def seen(spark_, folder_, version, name, months=None):
        opened.append((name, tuple(months or ())))
        return read_table(spark_, folder_, version, name, months)

    monkeypatch.setattr(incremental, "read_table", seen)
    then = load_new_sales(spark, folder, facts(spark, [(1, 20240205, 2), (2, 20240206, 5), (3, 20240206, 5), (4, 20240408, 4)]))
    assert stored(spark, folder) == [(20240105, 1), (20240205, 2), (20240206, 5), (20240307, 3), (20240408, 4)]
    assert changed_months(first, then, "fact_sales") == (["202402", "202404"], [])
    assert {m for _, months in opened for m in months} == {"202402"}
    last = load_new_sales(spark, folder, facts(spark, [(9, 20240307, 3)]))
    assert changed_months(then, last, "fact_sales") == ([], [])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_into_extracts_gives_the_distinct_rows(spark, tmp_path, seed):
    rng = random.Random(seed)
    every = [(i, 20240100 + 100 * rng.randint(0, 2) + rng.randint(1, 3), rng.choice([None, 1, 2])) for i in range(60)]
    folder = str(tmp_path)
    for part in range(3):
        load_new_sales(spark, folder, facts(spark, [r for r in every if rng.random() < 0.6 or part == 2]))
    assert set(stored(spark, folder)) == {r[1:] for r in every} and len(stored(spark, folder)) == len({r[1:] for r in every})


def test_equal_digests_are_not_enough(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    folder = str(tmp_path)
    load_new_sales(spark, folder, facts(spark, [(1, 20240105, 1)]))
    load_new_sales(spark, folder, facts(spark, [(1, 20240105, 1), (2, 20240105, 2)]))
    assert stored(spark, folder) == [(20240105, 1), (20240105, 2)]


RULES = [Row("fact_sales", "units", "units_sold_qty <= 0"), Reference("fact_sales", "product_key", "dim_product"),
         Unique("fact_sales", ("order_id",)), Unique("dim_product", ("sku",))]


def test_check_state_equals_a_full_run(spark, tmp_path):
    rng = random.Random(6)
    folder, state = str(tmp_path / "w"), str(tmp_path / "s")

    def tables(months, products):
        s = star(spark, dim_product=[{"product_key": p, "sku": f"s{p % 3}"} for p in products], fact_sales=[
            {"sales_key": i, "date_key": 20240100 + 100 * rng.choice(months) + 3, "order_id": f"o{rng.randint(0, 9)}", "location_key": 1,
             "product_key": rng.choice([None, 1, 2, 3, 9]), "units_sold_qty": rng.choice([0, 1, None])} for i in range(20)])
        return {"fact_sales": s.sales, "dim_product": s.product}

    first = tables([0, 1], [1, 2])
    publish(spark, folder, first)
    assert refresh_checks(spark, folder, state, RULES)["fact_sales"] == ["202401", "202402"]
    for change in ({"fact_sales": tables([1, 2], [1])["fact_sales"]}, {"dim_product": tables([0], [1, 2, 3])["dim_product"]}):
        publish(spark, folder, change, whole=False)
        read = refresh_checks(spark, folder, state, RULES)
        assert read == {"fact_sales": ["202402", "202403"] if "fact_sales" in change else [], "dim_product": ["all"] if "dim_product" in change else []}
        assert rows(checks_from_state(spark, folder, state, RULES)) == rows(run_checks(read_star(spark, folder), RULES))
    assert refresh_checks(spark, folder, state, RULES) == {"fact_sales": [], "dim_product": []}
    publish(spark, folder, {"fact_sales": first["fact_sales"].filter("sale_month = 202401")})
    refresh_checks(spark, folder, state, RULES[:3])
    assert rows(checks_from_state(spark, folder, state, RULES[:3])) == rows(run_checks(read_star(spark, folder), RULES[:3]))
