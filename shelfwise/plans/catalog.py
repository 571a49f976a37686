"""Every query by name, bound to the star derived from a data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.plans.blocks import BLOCKS
from shelfwise.plans.executive import mv_executive_kpis
from shelfwise.plans.insights import INSIGHTS
from shelfwise.plans.measures import FUNCTIONS
from shelfwise.plans.questions import QUESTIONS
from shelfwise.plans.reports import REPORTS
from shelfwise.plans.views import VIEWS
from shelfwise.sources.derived import derived

Query = Callable[[SparkSession, str], DataFrame]

# The grain each measure is shown at; measures work at any other.
GRAINS: dict[str, tuple[str, ...]] = {
    **{m: ("category",) for m in (
        "m_total_revenue", "m_total_cogs", "m_gross_margin", "m_gross_margin_pct", "m_units_sold", "m_avg_inventory_value",
        "m_turnover", "m_dio", "m_gmroi", "m_dead_stock_value", "m_return_rate", "m_category_share", "m_est_lost_sales",
        "m_revenue_ytd")},
    **{m: ("region",) for m in (
        "m_total_discount", "m_avg_basket_value", "m_inventory_value", "m_on_hand_units", "m_stockout_sku_count",
        "m_below_reorder_count", "m_annual_carrying_cost", "m_reorder_now_count", "m_revenue_3m_avg", "m_revenue_yoy_pct")},
    **{m: ("year", "month_number") for m in ("m_stockout_rate", "m_health_status")},
    **{m: ("reliability_tier",) for m in (
        "m_po_line_count", "m_otif_pct", "m_late_rate", "m_avg_lead_time", "m_lead_time_var")},
    **{m: ("supplier_name",) for m in ("m_po_fill_rate", "m_supplier_spend", "m_supplier_score")},
    **{m: ("location_name",) for m in ("m_revenue_rank", "m_store_vs_region_pct")},
}
# The same measures in a narrower context: entry -> measure, grain, filters.
IN_CONTEXT: dict[str, tuple[str, tuple[str, ...], dict[str, object] | None]] = {
    "m_revenue_rank_by_year": ("m_revenue_rank", ("location_name", "year"), None),
    "m_revenue_rank_by_sku_year": ("m_revenue_rank", ("sku", "year"), None),
    "m_store_vs_region_pct_by_year": ("m_store_vs_region_pct", ("location_name", "year"), None),
    "m_store_vs_region_pct_by_category": ("m_store_vs_region_pct", ("category",), None),
    "m_revenue_ly_by_category": ("m_revenue_ly", ("category",), {"year": 1999}),
    "m_dead_stock_value_by_year": ("m_dead_stock_value", ("year",), None),
    "m_dead_stock_value_in_1999": ("m_dead_stock_value", ("category",), {"year": 1999}),
    "m_est_lost_sales_in_1999": ("m_est_lost_sales", ("category",), {"year": 1999}),
}
SURROGATES = ("sales_key", "snapshot_key", "po_line_key", "return_key", "transfer_key")


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    """Money leaves the library as decimal; comparisons across engines use doubles."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _bound(function: Callable[..., DataFrame], whole: bool = False, grain: tuple[str, ...] | None = None) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star, built = derived(spark, sf_dir)
        if whole:
            df = function(star, built)
        elif grain is not None:
            df = function(star, grain)
        else:
            df = function(star)
        # surrogate keys of facts are assigned on load and mean nothing to another engine
        return decimals_as_doubles(df.drop(*SURROGATES))

    return run


def all_queries() -> dict[str, Query]:
    plain = {**QUESTIONS, **VIEWS, "mv_executive_kpis": mv_executive_kpis, **REPORTS, **INSIGHTS}
    found = {name: _bound(function) for name, function in plain.items()}
    found.update({name: _bound(function, grain=GRAINS.get(name, ())) for name, function in FUNCTIONS.items()})
    found["m_revenue_rank_by_sku"] = _bound(FUNCTIONS["m_revenue_rank"], grain=("sku",))
    for name, (measure_name, grain, filters) in IN_CONTEXT.items():
        found[name] = _bound(partial(FUNCTIONS[measure_name], filters=filters), grain=grain)
    found.update({name: _bound(function, whole=True) for name, function in BLOCKS.items()})
    return found
