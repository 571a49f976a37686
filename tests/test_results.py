"""Whole results of every registered query against independent SQL in another engine."""

import pytest

from __spark_entry__ import entry
from oracle.registry import all_sql
from shelfwise.plans.catalog import IN_CONTEXT, all_queries
from tests.compare import compare, duck

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_names_cover_the_catalogue():
    assert [q for q in QUERIES if q[0] == "q" and q[1:].isdigit()] == [f"q{n:02d}" for n in range(1, 55)]
    assert len([q for q in QUERIES if q.startswith("m_") and q not in {"m_revenue_rank_by_sku", *IN_CONTEXT}]) == 39
    assert len([q for q in QUERIES if q.startswith("vw_")]) == 5


@pytest.mark.parametrize("name", list(QUERIES))
def test_result(spark, con, sf_dir, name):
    outcome = compare(spark, con, sf_dir, name, QUERIES[name], SQL[name])
    assert outcome["problem"] == ""
    assert outcome["shunned"] == []


def test_flagship(spark):
    df = entry(spark)
    assert df.columns == ["sku", "product_name", "location_name", "on_hand_qty", "reorder_point", "safety_stock_qty", "shortfall"]
    assert 0 < df.count() <= 100
