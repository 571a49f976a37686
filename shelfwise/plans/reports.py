"""The KPI report, the data sets behind the exploratory charts, and the spreadsheet summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import col, double, mean, safe_ratio, stale, total
from shelfwise.operators.anchors import anchor_day, latest_snapshot, semi_avg_daily, stock_with_last_sale
from shelfwise.operators.grouping import exact_quantile, rollup
from shelfwise.plans.executive import side_by_side
from shelfwise.plans.sales import LOCATION, PRODUCT, monthly_sales, pareto_curve
from shelfwise.plans.supplier import SUPPLIER

# KPI names in report order, and the tier order of the OTIF chart.
KPIS = ("Total Revenue", "Gross Margin %", "Current Inventory Value", "Inventory Turnover", "Days Inventory Outstanding",
        "GMROI", "Stock-out Rate", "Dead-stock % (value)", "Annual Carrying Cost", "Supplier OTIF %", "Average Lead Time")
TIER_ORDER = ("Gold", "Silver", "Bronze")


def kpi_report(star, rate: float = 0.25, dead_days: int = 180) -> DataFrame:
    """Eleven headline figures as (kpi, value) rows."""
    sales = star.sales.agg(total("net_sales_amount").alias("revenue"), total("gross_margin_amount").alias("margin"),
                           total("cogs_amount").alias("cogs"))
    closing = latest_snapshot(star.snapshot).agg(
        total("on_hand_value").alias("value"), F.count_if(col("is_stockout_flag")).alias("out"), F.count(F.lit(1)).alias("rows")
    )
    average = semi_avg_daily(star.snapshot, [], avg="on_hand_value")
    dead = stock_with_last_sale(star).agg(
        total(F.when(stale("last_sold_date", anchor_day(star, "calendar"), dead_days), F.col("on_hand_value"))).alias("dead")
    )
    lines = star.orders.agg(
        F.count_if(col("is_otif_flag")).alias("otif"), F.count(F.lit(1)).alias("lines"), mean("lead_time_days").alias("lead")
    )
    zero = F.lit(0.0)

    def or_zero(num, den):
        return F.coalesce(safe_ratio(num, den), zero)

    turnover = or_zero("cogs", "avg")
    values = (
        F.col("revenue"), or_zero("margin", "revenue"), F.col("value"), turnover, or_zero(F.lit(365), turnover),
        or_zero("margin", "avg"), safe_ratio("out", "rows"), or_zero(F.coalesce("dead", zero), "value"),
        F.col("avg") * rate, safe_ratio("otif", "lines"), F.col("lead"),
    )
    return side_by_side(sales, closing, average, dead, lines).select(
        F.inline(F.array(*[F.struct(F.lit(k).alias("kpi"), v.alias("value")) for k, v in zip(KPIS, values)]))
    )


def eda_revenue_by_month(star) -> DataFrame:
    """Revenue by month of the year over all years."""
    return monthly_sales(star).groupBy("month_number").agg(total("revenue").alias("revenue")).orderBy("month_number")


def eda_revenue_by_category(star) -> DataFrame:
    return rollup(star.sales, star.product, PRODUCT, ["category"], r=("sum", "net_sales_amount")).select(
        "category", double("r").alias("revenue")
    ).orderBy("revenue", "category")


def eda_pareto(star) -> DataFrame:
    """Every product on the cumulative revenue curve: share of products against share of revenue."""
    return pareto_curve(star).select(
        "product_key", F.col("position").alias("rev_rank"), safe_ratio("position", "row_total", 100.0).alias("sku_pct"),
        safe_ratio("running", "grand_total", 100.0).alias("cumulative_revenue_pct"),
    )


def eda_otif_by_tier(star) -> DataFrame:
    """OTIF share for each tier in fixed order; a tier without order lines shows NULL."""
    tiers = star.spark.range(1).select(
        F.posexplode(F.array(*[F.lit(t) for t in TIER_ORDER])).alias("_place", "reliability_tier")
    ).withColumn("tier_order", F.col("_place") + 1)
    found = rollup(star.orders, star.supplier, SUPPLIER, ["reliability_tier"],
                   good=("count_if", F.col("is_otif_flag")), n=("count", F.lit(1)))
    return tiers.join(found, "reliability_tier", "left").select(
        "tier_order", "reliability_tier", safe_ratio("good", "n", 100.0).alias("otif_pct")
    ).orderBy("tier_order")


def eda_onhand_hist(star, q: float = 0.99, bins: int = 40) -> DataFrame:
    """Histogram of on-hand quantity clipped at its exact ``q`` quantile: equal-width bins from minimum to clip value.

    Rows are folded to distinct quantities first.
    """
    counts = star.snapshot.groupBy("on_hand_qty").agg(F.count(F.lit(1)).alias("n"))
    cap = exact_quantile(star.snapshot, "on_hand_qty", q).scalar()
    clipped = counts.select(F.least(double("on_hand_qty"), cap).alias("x"), "n")
    bounds = clipped.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    # the last bin is closed on the right
    place = F.least(F.width_bucket("x", lo, hi, F.lit(bins)), F.lit(bins))
    return clipped.withColumn("bin", place.cast("int")).groupBy("bin").agg(F.sum("n").alias("snapshot_rows")).select(
        "bin", F.round(lo + (F.col("bin") - 1) * (hi - lo) / bins, 6).alias("bin_from"), "snapshot_rows"
    )


def eda_top20_share(star, part: float = 0.2) -> DataFrame:
    """Revenue share of the best ``floor(part * n)`` products."""
    best = F.col("position") <= F.floor(F.col("row_total") * part)
    return pareto_curve(star).agg(
        F.count_if(best).alias("top_products"), safe_ratio(F.sum(F.when(best, F.col("revenue"))), F.sum("revenue")).alias("revenue_share")
    )


def agg_conditional_excel(star) -> DataFrame:
    """The spreadsheet's conditional sums in one long table: sheet, label, figure, value."""

    def long(df: DataFrame, sheet: str, label: str, **figures: str) -> DataFrame:
        return df.select(F.lit(sheet).alias("sheet"), F.col(label).cast("string").alias("label"), F.inline(F.array(*[
            F.struct(F.lit(n).alias("figure"), double(c).alias("value")) for n, c in figures.items()
        ])))

    by_category = rollup(star.sales, star.product, PRODUCT, ["category"],
                         r=("sum", "net_sales_amount"), m=("sum", "gross_margin_amount"))
    by_region = rollup(star.sales, star.location, LOCATION, ["region"], r=("sum", "net_sales_amount"))
    by_month = monthly_sales(star).groupBy("month_number").agg(F.sum("revenue").alias("r"))
    by_tier = eda_otif_by_tier(star).filter("otif_pct IS NOT NULL")
    cards = kpi_report(star).filter(F.col("kpi").isin("Total Revenue", "Gross Margin %", "Current Inventory Value",
                                                      "Stock-out Rate", "Supplier OTIF %"))
    parts = [
        long(by_category, "category", "category", revenue="r", margin="m"), long(by_region, "region", "region", revenue="r"),
        long(by_month, "month", "month_number", revenue="r"), long(by_tier, "tier", "reliability_tier", otif_pct="otif_pct"),
        long(cards, "cards", "kpi", value="value"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


REPORTS = {f.__name__: f for f in (
    kpi_report, eda_revenue_by_month, eda_revenue_by_category, eda_pareto, eda_otif_by_tier, eda_onhand_hist,
    eda_top20_share, agg_conditional_excel)}
