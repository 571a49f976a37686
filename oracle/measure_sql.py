"""DuckDB SQL for measures, reports and catalogue metrics."""

from __future__ import annotations

from oracle.question_sql import PO, SUPPLIES
from oracle.star_sql import pct, ratio, usd

N = "count(*)::BIGINT"
SALES_C = "f_sales JOIN d_product USING (product_key)"
SALES_L = "f_sales JOIN d_location USING (location_key)"
SNAP_C = "f_snap JOIN d_product USING (product_key)"
SNAP_L = "f_snap JOIN d_location USING (location_key)"


def by(grain: str, value: str, source: str, name: str) -> str:
    return f"SELECT {grain}, {value} AS {name} FROM {source} GROUP BY ALL"


DAILY_C = f"(SELECT category, sum(d) / 100e0 / count(*) AS avg_value FROM (SELECT category, date_key, sum(value_c)::DOUBLE AS d FROM {SNAP_C} GROUP BY ALL) GROUP BY ALL)"
DAILY_L = f"(SELECT region, sum(d) / 100e0 / count(*) AS avg_value FROM (SELECT region, date_key, sum(value_c)::DOUBLE AS d FROM {SNAP_L} GROUP BY ALL) GROUP BY ALL)"
MONEY_C = f"(SELECT category, {usd('cogs_c')} AS cogs, {usd('margin_c')} AS margin FROM {SALES_C} GROUP BY ALL)"
CLOSE_L = f"(SELECT s.* FROM (SELECT *, max(date_key) OVER (PARTITION BY region) AS last_key FROM {SNAP_L}) s WHERE date_key = last_key)"
MONTHS = "(SELECT {g} year, month_number, sum(net_c) AS c FROM f_sales JOIN d_date USING (date_key) {j} GROUP BY ALL)"


def shifted(months: int, expression: str, name: str, grain: str = "", join: str = "", where: str = "TRUE") -> str:
    """``a`` is the month's own revenue, ``b`` that of the month compared with; any month of the calendar with either has a row."""
    m = MONTHS.format(g=grain, j=join)
    g = grain.rstrip(",")
    groups = f"(SELECT DISTINCT {g} FROM {m})" if grain else "(SELECT 1)"
    same_a, same_b = (f"AND g.{g} IS NOT DISTINCT FROM a.{g}", f"AND g.{g} IS NOT DISTINCT FROM b.{g}") if grain else ("", "")
    return f"""SELECT {f'g.{g}, ' if grain else ''}l.year, l.month_number, {expression} AS {name}
               FROM (SELECT DISTINCT year, month_number FROM d_date WHERE {where}) l CROSS JOIN {groups} g
               LEFT JOIN {m} a ON a.year = l.year AND a.month_number = l.month_number {same_a}
               LEFT JOIN {m} b ON b.year * 12 + b.month_number = l.year * 12 + l.month_number - {months} {same_b}
               WHERE a.c IS NOT NULL OR b.c IS NOT NULL"""


GROWTH = ratio("(coalesce(a.c, 0) - b.c) / 100e0", "b.c / 100e0")
SCORE = f"""0.5e0 * ({ratio('count(*) FILTER (WHERE is_otif)', 'count(*)')} * 100) + 0.3e0 * ({ratio('sum(received_qty)', 'sum(ordered_qty)')} * 100)
            + -0.2e0 * ({ratio('sum(lead_days)', 'count(lead_days)')})"""
STALE_CAL = "last_sold_date IS NULL OR last_sold_date < anchor - 180"
OUT_MONTH = f"(SELECT year(day)::INTEGER AS year, month(day)::INTEGER AS month_number, {ratio('count(*) FILTER (WHERE is_out)', 'count(*)')} AS rate FROM f_snap GROUP BY ALL)"

MEASURE_SQL: dict[str, str] = {
    "m_total_revenue": by("category", usd("net_c"), SALES_C, "total_revenue"),
    "m_total_cogs": by("category", usd("cogs_c"), SALES_C, "total_cogs"),
    "m_gross_margin": by("category", usd("margin_c"), SALES_C, "gross_margin"),
    "m_gross_margin_pct": by("category", ratio(usd("margin_c"), usd("net_c")), SALES_C, "gross_margin_pct"),
    "m_units_sold": by("category", "sum(units_sold_qty)::BIGINT", SALES_C, "units_sold"),
    "m_total_discount": by("region", usd("disc_c"), SALES_L, "total_discount"),
    "m_avg_basket_value": by("region", ratio(usd("net_c"), "count(DISTINCT order_id)"), SALES_L, "avg_basket_value"),
    "m_inventory_value": by("region", usd("value_c"), CLOSE_L, "inventory_value"),
    "m_on_hand_units": by("region", "sum(on_hand)::BIGINT", CLOSE_L, "on_hand_units"),
    "m_avg_inventory_value": f"SELECT category, avg_value AS avg_inventory_value FROM {DAILY_C}",
    "m_turnover": f"SELECT category, {ratio('cogs', 'avg_value')} AS turnover FROM {MONEY_C} JOIN {DAILY_C} USING (category)",
    "m_dio": f"SELECT category, 365e0 / nullif({ratio('cogs', 'avg_value')}, 0) AS dio FROM {MONEY_C} JOIN {DAILY_C} USING (category)",
    "m_gmroi": f"SELECT category, {ratio('margin', 'avg_value')} AS gmroi FROM {MONEY_C} JOIN {DAILY_C} USING (category)",
    "m_stockout_sku_count": by("region", "count(DISTINCT CASE WHEN is_out THEN product_key END)::BIGINT", CLOSE_L, "stockout_sku_count"),
    "m_stockout_rate": f"SELECT year, month_number, rate AS stockout_rate FROM {OUT_MONTH}",
    "m_below_reorder_count": by("region", "(count(*) FILTER (WHERE is_below))::BIGINT", CLOSE_L, "below_reorder_count"),
    "m_annual_carrying_cost": f"SELECT region, avg_value * 0.25e0 AS annual_carrying_cost FROM {DAILY_L}",
    "m_dead_stock_value": f"""
        SELECT category, {usd('value_c')} AS dead_stock_value
        FROM (SELECT *, max(date_key) OVER (PARTITION BY product_key) AS last_key FROM f_snap) JOIN d_product USING (product_key)
        LEFT JOIN sold_last USING (product_key), cal_day WHERE date_key = last_key AND ({STALE_CAL}) GROUP BY ALL""",
    "m_po_line_count": by("reliability_tier", N, PO, "po_line_count"),
    "m_otif_pct": by("reliability_tier", ratio("count(*) FILTER (WHERE is_otif)", "count(*)"), PO, "otif_pct"),
    "m_late_rate": by("reliability_tier", ratio("count(*) FILTER (WHERE is_late)", "count(*)"), PO, "late_rate"),
    "m_avg_lead_time": by("reliability_tier", ratio("sum(lead_days)", "count(lead_days)"), PO, "avg_lead_time"),
    "m_lead_time_var": by("reliability_tier", "round(stddev_pop(lead_days), 6)", PO, "lead_time_var"),
    "m_po_fill_rate": by("supplier_name", ratio("sum(received_qty)", "sum(ordered_qty)"), PO, "po_fill_rate"),
    "m_supplier_spend": by("supplier_name", usd("amount_c"), PO, "supplier_spend"),
    "m_supplier_score": by("supplier_name", SCORE, PO, "supplier_score"),
    "m_return_rate": f"""SELECT category, {ratio('b', 'u')} AS return_rate
        FROM (SELECT category, sum(units_sold_qty) AS u FROM {SALES_C} GROUP BY ALL)
        FULL JOIN (SELECT category, sum(returned_qty) AS b FROM f_ret JOIN d_product USING (product_key) GROUP BY ALL) USING (category)""",
    "m_est_lost_sales": f"""
        SELECT category, round(sum(n * u * (price_c / 100e0)), 2) AS est_lost_sales
        FROM (SELECT product_key, location_key, count(*) AS n FROM f_snap WHERE is_out GROUP BY ALL)
        JOIN (SELECT product_key, location_key, {ratio('sum(units_sold_qty)', 'count(*)')} AS u FROM f_sales GROUP BY ALL) USING (product_key, location_key)
        JOIN d_product USING (product_key) GROUP BY ALL""",
    "m_reorder_now_count": f"""
        SELECT region, (count(*) FILTER (WHERE is_below))::BIGINT AS reorder_now_count
        FROM (SELECT *, max(date_key) OVER (PARTITION BY region) AS last_key FROM {SNAP_L} JOIN d_product USING (product_key)
              WHERE on_order = 0 AND is_active) WHERE date_key = last_key GROUP BY ALL""",
    "m_health_status": f"""SELECT year, month_number, CASE WHEN rate > 0.05 THEN '🔴 Critical' WHEN rate > 0.02 THEN '🟠 Watch' ELSE '🟢 Healthy' END AS health_status FROM {OUT_MONTH}""",
    "m_revenue_ly": shifted(12, "b.c / 100e0", "revenue_ly"),
    "m_revenue_ly_by_category": shifted(12, "b.c / 100e0", "revenue_ly", "category,", "JOIN d_product USING (product_key)", "year = 1999"),
    "m_revenue_yoy_pct": shifted(12, GROWTH, "revenue_yoy_pct", "region,", "JOIN d_location USING (location_key)"),
    "m_revenue_pm": shifted(1, "b.c / 100e0", "revenue_pm"),
    "m_revenue_mom_pct": shifted(1, GROWTH, "revenue_mom_pct"),
    "m_revenue_ytd": """
        WITH m AS (SELECT category, year, month_number, sum(net_c) AS c FROM f_sales JOIN d_product USING (product_key) JOIN d_date USING (date_key) GROUP BY ALL)
        SELECT m.category, l.year, l.month_number, sum(c) / 100e0 AS revenue_ytd
        FROM (SELECT DISTINCT year, month_number FROM d_date) l JOIN m ON m.year = l.year AND m.month_number <= l.month_number GROUP BY ALL""",
    "m_revenue_3m_avg": f"""
        WITH e AS (SELECT year, month_number, max(full_date) AS e FROM d_date GROUP BY ALL),
             d AS (SELECT region, day, sum(net_c) AS c FROM {SALES_L} GROUP BY ALL)
        SELECT region, year, month_number, {ratio(usd('c'), 'count(*)')} AS revenue_3m_avg
        FROM e JOIN d ON day <= e AND day > e - INTERVAL 3 MONTH GROUP BY ALL""",
    "m_revenue_rank": f"SELECT location_name, rank() OVER (ORDER BY sum(net_c) DESC) AS revenue_rank FROM {SALES_L} GROUP BY ALL",
    "m_revenue_rank_by_sku": f"SELECT sku, rank() OVER (ORDER BY sum(net_c) DESC) AS revenue_rank FROM {SALES_C} GROUP BY ALL",
    "m_store_vs_region_pct": f"""
        WITH r AS (SELECT location_name, region, sum(net_c)::BIGINT AS c FROM {SALES_L} GROUP BY ALL),
             a AS (SELECT region, (sum(c) / 100e0) / count(*) AS m FROM r GROUP BY ALL)
        SELECT location_name, region, (c / 100e0 - m) / nullif(m, 0) AS store_vs_region_pct FROM r JOIN a USING (region)""",
    "m_revenue_rank_by_year": f"""SELECT location_name, year, rank() OVER (PARTITION BY year ORDER BY c DESC) AS revenue_rank
        FROM (SELECT location_name, year, sum(net_c) AS c FROM {SALES_L} JOIN d_date USING (date_key) GROUP BY ALL)""",
    "m_revenue_rank_by_sku_year": f"""SELECT sku, year, rank() OVER (PARTITION BY year ORDER BY c DESC) AS revenue_rank
        FROM (SELECT sku, year, sum(net_c) AS c FROM {SALES_C} JOIN d_date USING (date_key) GROUP BY ALL)""",
    "m_store_vs_region_pct_by_year": f"""
        WITH r AS (SELECT location_name, region, year, sum(net_c)::BIGINT AS c FROM {SALES_L} JOIN d_date USING (date_key) GROUP BY ALL),
             a AS (SELECT region, year, (sum(c) / 100e0) / count(*) AS m FROM r GROUP BY ALL)
        SELECT location_name, year, region, (c / 100e0 - m) / nullif(m, 0) AS store_vs_region_pct FROM r JOIN a USING (region, year)""",
    "m_store_vs_region_pct_by_category": f"""
        WITH r AS (SELECT category, region, location_key, sum(net_c)::BIGINT AS c FROM {SALES_L} JOIN d_product USING (product_key) GROUP BY ALL)
        SELECT category, region, (sum(c) / 100e0 - (sum(c) / 100e0) / count(*)) / nullif((sum(c) / 100e0) / count(*), 0) AS store_vs_region_pct
        FROM r GROUP BY ALL""",
    "m_dead_stock_value_by_year": f"""
        WITH s AS (SELECT year(day)::INTEGER AS year, product_key, date_key, sum(value_c) AS c FROM f_snap GROUP BY ALL),
             z AS (SELECT year, product_key, max_by(c, date_key) AS c FROM s GROUP BY ALL),
             l AS (SELECT year(day)::INTEGER AS year, product_key, max(day) AS last_day_sold FROM f_sales GROUP BY ALL),
             t AS (SELECT year, max(full_date) - 180 AS threshold FROM d_date GROUP BY ALL)
        SELECT year, {usd('c')} AS dead_stock_value FROM z LEFT JOIN l USING (year, product_key) JOIN t USING (year)
        WHERE last_day_sold IS NULL OR last_day_sold < threshold GROUP BY ALL""",
    "m_dead_stock_value_in_1999": f"""
        WITH s AS (SELECT product_key, date_key, sum(value_c) AS c FROM f_snap WHERE year(day) = 1999 GROUP BY ALL),
             z AS (SELECT product_key, max_by(c, date_key) AS c FROM s GROUP BY ALL),
             l AS (SELECT product_key, max(day) AS last_day_sold FROM f_sales WHERE year(day) = 1999 GROUP BY ALL)
        SELECT category, {usd('c')} AS dead_stock_value FROM z LEFT JOIN l USING (product_key) JOIN d_product USING (product_key)
        WHERE last_day_sold IS NULL OR last_day_sold < DATE '1999-12-31' - 180 GROUP BY ALL""",
    "m_est_lost_sales_in_1999": f"""
        SELECT category, round(sum(n * u * (price_c / 100e0)), 2) AS est_lost_sales
        FROM (SELECT product_key, location_key, count(*) AS n FROM f_snap WHERE is_out AND year(day) = 1999 GROUP BY ALL)
        JOIN (SELECT product_key, location_key, {ratio('sum(units_sold_qty)', 'count(*)')} AS u FROM f_sales WHERE year(day) = 1999 GROUP BY ALL)
             USING (product_key, location_key)
        JOIN d_product USING (product_key) GROUP BY ALL""",
    "m_category_share": f"SELECT category, {usd('net_c')} / (SELECT {usd('net_c')} FROM f_sales) AS category_share FROM {SALES_C} GROUP BY ALL",
}

KPI_TOTALS = f"""
    WITH s AS (SELECT {usd('net_c')} AS r, {usd('margin_c')} AS m, {usd('cogs_c')} AS c FROM f_sales),
         a AS (SELECT sum(d) / 100e0 / count(*) AS avg FROM (SELECT date_key, sum(value_c)::DOUBLE AS d FROM f_snap GROUP BY ALL)),
         z AS (SELECT {usd('value_c')} AS v, {ratio('count(*) FILTER (WHERE is_out)', 'count(*)')} AS o FROM snap_now),
         x AS (SELECT sum(v::DECIMAL(18,2))::DOUBLE AS dead FROM stock LEFT JOIN sold_last USING (product_key), cal_day WHERE {STALE_CAL}),
         p AS (SELECT {ratio('count(*) FILTER (WHERE is_otif)', 'count(*)')} AS otif, {ratio('sum(lead_days)', 'count(lead_days)')} AS lead FROM f_po)"""
KPI_ROWS = """
    SELECT 'Total Revenue' AS kpi, r AS value FROM s UNION ALL SELECT 'Gross Margin %', m / r FROM s
    UNION ALL SELECT 'Current Inventory Value', v FROM z UNION ALL SELECT 'Inventory Turnover', c / avg FROM s, a
    UNION ALL SELECT 'Days Inventory Outstanding', 365e0 / (c / avg) FROM s, a UNION ALL SELECT 'GMROI', m / avg FROM s, a
    UNION ALL SELECT 'Stock-out Rate', o FROM z UNION ALL SELECT 'Dead-stock % (value)', dead / v FROM x, z
    UNION ALL SELECT 'Annual Carrying Cost', avg * 0.25e0 FROM a UNION ALL SELECT 'Supplier OTIF %', otif FROM p
    UNION ALL SELECT 'Average Lead Time', lead FROM p"""
OTIF_TIER = f"SELECT reliability_tier, {ratio('count(*) FILTER (WHERE is_otif)', 'count(*)', None, '100e0')} AS otif_pct FROM {PO} GROUP BY ALL"
CURVE = """(SELECT product_key, c, row_number() OVER w AS rk, sum(c) OVER (w ROWS UNBOUNDED PRECEDING) / 100e0 AS upto, sum(c) OVER () / 100e0 AS whole, count(*) OVER () AS n
           FROM (SELECT product_key, sum(net_c)::BIGINT AS c FROM f_sales GROUP BY ALL) WINDOW w AS (ORDER BY c DESC, product_key))"""
DEAD = "SELECT product_key, v FROM stock LEFT JOIN sold_last USING (product_key), snap_day WHERE q > 0 AND (last_sold_date IS NULL OR last_sold_date < anchor - 180)"
OVER = f"SELECT product_key, v FROM stock JOIN rate90 USING (product_key) WHERE {ratio('q', 'adr')} > 120"

REPORT_SQL: dict[str, str] = {
    "kpi_report": KPI_TOTALS + KPI_ROWS,
    "eda_revenue_by_month": f"SELECT month_number, {usd('net_c')} AS revenue FROM f_sales JOIN d_date USING (date_key) GROUP BY ALL",
    "eda_revenue_by_category": by("category", usd("net_c"), SALES_C, "revenue"),
    "eda_pareto": f"SELECT product_key, rk AS rev_rank, {pct('rk', 'n')} AS sku_pct, {pct('upto', 'whole')} AS cumulative_revenue_pct FROM {CURVE}",
    "eda_otif_by_tier": f"""SELECT o AS tier_order, reliability_tier, otif_pct
        FROM (VALUES (1, 'Gold'), (2, 'Silver'), (3, 'Bronze')) t(o, reliability_tier) LEFT JOIN ({OTIF_TIER}) USING (reliability_tier)""",
    "eda_onhand_hist": """
        WITH c AS (SELECT quantile_cont(on_hand, 0.99) AS cap FROM f_snap), x AS (SELECT least(on_hand::DOUBLE, cap) AS x FROM f_snap, c),
             b AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
             k AS (SELECT least(floor(40 * (x - lo) / (hi - lo)) + 1, 40)::INTEGER AS bin, lo, hi FROM x, b)
        SELECT bin, round(lo + (bin - 1) * (hi - lo) / 40, 6) AS bin_from, count(*)::BIGINT AS snapshot_rows FROM k GROUP BY ALL""",
    "eda_top20_share": f"""SELECT (count(*) FILTER (WHERE rk <= floor(n * 0.2)))::BIGINT AS top_products,
        {ratio("sum(c) FILTER (WHERE rk <= floor(n * 0.2)) / 100e0", usd('c'))} AS revenue_share FROM {CURVE}""",
    "agg_conditional_excel": f"""{KPI_TOTALS}
        SELECT 'category' AS sheet, category AS label, 'revenue' AS figure, {usd('net_c')} AS value FROM {SALES_C} GROUP BY ALL
        UNION ALL SELECT 'category', category, 'margin', {usd('margin_c')} FROM {SALES_C} GROUP BY ALL
        UNION ALL SELECT 'region', region, 'revenue', {usd('net_c')} FROM {SALES_L} GROUP BY ALL
        UNION ALL SELECT 'month', month_number::VARCHAR, 'revenue', {usd('net_c')} FROM f_sales JOIN d_date USING (date_key) GROUP BY ALL
        UNION ALL SELECT 'tier', reliability_tier, 'otif_pct', otif_pct FROM ({OTIF_TIER})
        UNION ALL SELECT 'cards', kpi, 'value', value FROM ({KPI_ROWS})
                  WHERE kpi IN ('Total Revenue', 'Gross Margin %', 'Current Inventory Value', 'Stock-out Rate', 'Supplier OTIF %')""",
    "k_in_stock_rate": by("location_name", ratio("count(*) FILTER (WHERE NOT is_out)", "count(*)"), SNAP_L, "in_stock_rate"),
    "k_sell_through": f"""SELECT category, u AS units_sold, r AS units_received, {ratio('u', 'r')} AS sell_through
        FROM (SELECT category, sum(units_sold_qty)::BIGINT AS u FROM {SALES_C} GROUP BY ALL)
        LEFT JOIN (SELECT category, sum(received_qty)::BIGINT AS r FROM f_po JOIN d_product USING (product_key) GROUP BY ALL) USING (category)""",
    "k_excess_pct": f"""SELECT o AS overstock_value, t AS total_value, {pct('o', 't')} AS excess_pct
        FROM (SELECT sum(v::DECIMAL(18,2))::DOUBLE AS o FROM ({OVER})), (SELECT sum(v::DECIMAL(18,2))::DOUBLE AS t FROM stock)""",
    "k_net_revenue": f"""SELECT g / 100e0 AS gross_sales, d / 100e0 AS discounts, r / 100e0 AS refunds, (g - d - r) / 100e0 AS net_revenue
        FROM (SELECT sum(gross_c) AS g, sum(disc_c) AS d FROM f_sales), (SELECT sum(refund_c) AS r FROM f_ret)""",
    "k_sales_velocity": """
        WITH m AS (SELECT DISTINCT year * 12 + month_number AS x FROM d_date),
             s AS (SELECT product_key, (date_key // 10000) * 12 + (date_key // 100) % 100 AS x, sum(units_sold_qty) AS u FROM f_sales GROUP BY ALL)
        SELECT sku, round(regr_slope(coalesce(u, 0), x), 6) AS units_per_month
        FROM (SELECT DISTINCT product_key FROM s) CROSS JOIN m LEFT JOIN s USING (product_key, x) JOIN d_product USING (product_key) GROUP BY ALL""",
    "k_defect_rate": f"""
        SELECT supplier_name, coalesce(b, 0)::BIGINT AS units_returned, r AS units_received, {ratio('coalesce(b, 0)', 'r')} AS defect_rate
        FROM (SELECT supplier_key, sum(received_qty)::BIGINT AS r FROM f_po GROUP BY ALL)
        LEFT JOIN (SELECT supplier_key, sum(returned_qty) AS b FROM ({SUPPLIES}) JOIN f_ret USING (product_key) GROUP BY ALL) USING (supplier_key)
        JOIN d_supplier USING (supplier_key)""",
    "i_tier_stockout_share": f"""
        WITH t AS (SELECT reliability_tier, {N} AS suppliers FROM d_supplier GROUP BY ALL),
             h AS (SELECT reliability_tier, {N} AS hits FROM ({SUPPLIES}) SEMI JOIN (SELECT product_key FROM snap_now WHERE is_out) USING (product_key)
                   JOIN d_supplier USING (supplier_key) GROUP BY ALL)
        SELECT reliability_tier, suppliers, coalesce(hits, 0) AS stocked_out_skus,
               round(100e0 * (suppliers::DOUBLE / (SELECT sum(suppliers) FROM t)), 1) AS supplier_share_pct,
               round(100e0 * (coalesce(hits, 0)::DOUBLE / (SELECT sum(hits) FROM h)), 1) AS stockout_share_pct
        FROM t LEFT JOIN h USING (reliability_tier)""",
    "i_gmroi_below_one": f"""
        WITH g AS (SELECT {ratio('gm', 'a')} AS g FROM (SELECT product_key, {usd('margin_c')} AS gm FROM f_sales GROUP BY ALL)
                   JOIN (SELECT product_key, {ratio(usd('value_c'), 'count(*)')} AS a FROM f_snap GROUP BY ALL) USING (product_key) WHERE a > 0)
        SELECT {N} AS products, (count(*) FILTER (WHERE g < 1))::BIGINT AS below_one, {pct('count(*) FILTER (WHERE g < 1)', 'count(*)', 1)} AS below_one_pct FROM g""",
    "i_trapped_capital": f"""
        WITH dd AS ({DEAD}), oo AS ({OVER}),
             t AS (SELECT (SELECT sum(v::DECIMAL(18,2)) FROM dd)::DOUBLE AS d, (SELECT sum(v::DECIMAL(18,2)) FROM oo)::DOUBLE AS o,
                          (SELECT sum(v::DECIMAL(18,2)) FROM (FROM dd UNION FROM oo))::DOUBLE AS u, (SELECT sum(v::DECIMAL(18,2)) FROM stock)::DOUBLE AS w,
                          (SELECT {usd('cogs_c')} FROM f_sales) AS c, (SELECT count(DISTINCT date_key // 100) FROM d_date) AS m)
        SELECT d AS dead_value, o AS over_value, u AS trapped_value, {pct('u', 'w', 1)} AS trapped_pct,
               {ratio('u', ratio('c', 'm'), 2)} AS months_of_cogs FROM t""",
    "i_category_card": f"""
        SELECT category, r AS total_revenue, {ratio('m', 'r')} AS gross_margin_pct, {ratio('c', 'avg_value')} AS turnover, o AS stockout_rate
        FROM (SELECT category, {usd('net_c')} AS r, {usd('margin_c')} AS m, {usd('cogs_c')} AS c FROM {SALES_C} GROUP BY ALL)
        JOIN {DAILY_C} USING (category)
        JOIN (SELECT category, {ratio('count(*) FILTER (WHERE is_out)', 'count(*)')} AS o FROM {SNAP_C} GROUP BY ALL) USING (category)""",
    "fill_days_of_supply": f"""
        SELECT product_key, location_key, date_key AS snapshot_date_key, on_hand AS on_hand_qty, {ratio('on_hand', 'adr', 2)} AS days_of_supply
        FROM snap_now LEFT JOIN (SELECT product_key, location_key, sum(units_sold_qty) / 90e0 AS adr FROM f_sales, snap_day
                                 WHERE day >= anchor - 90 GROUP BY ALL) USING (product_key, location_key)""",
}
