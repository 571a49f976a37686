"""DuckDB SQL for the 54 questions and the views."""

from __future__ import annotations

from oracle.star_sql import pct, ratio, usd

N = "count(*)::BIGINT"
STORES = "f_sales JOIN d_location USING (location_key) WHERE location_type = 'STORE'"
STORE_REVENUE = f"SELECT location_name, region, {usd('net_c')} AS r FROM {STORES} GROUP BY ALL"
PO = "f_po JOIN d_supplier USING (supplier_key)"
LOSS = f"""
    SELECT product_key, (o.n * s.u * s.p) AS loss
    FROM (SELECT product_key, location_key, count(*) AS n FROM f_snap WHERE is_out GROUP BY ALL) o
    JOIN (SELECT product_key, location_key, {ratio('sum(units_sold_qty)', 'count(*)')} AS u,
                 {ratio(usd('price_c'), 'count(price_c)')} AS p FROM f_sales GROUP BY ALL) s USING (product_key, location_key)"""
SUPPLIES = "SELECT DISTINCT product_key, supplier_key FROM f_po"

QUESTION_SQL: dict[str, str] = {
    "q01": """
        SELECT sku, product_name, location_name, location_type, on_hand AS on_hand_qty, reorder_point, on_order AS on_order_qty
        FROM snap_now JOIN d_product USING (product_key) JOIN d_location USING (location_key) WHERE is_below AND on_order = 0""",
    "q02": f"""
        SELECT region, (count(*) FILTER (WHERE is_out))::BIGINT AS stockout_lines, {N} AS total_lines,
               {pct('count(*) FILTER (WHERE is_out)', 'count(*)', 2)} AS stockout_pct
        FROM snap_now JOIN d_location USING (location_key) GROUP BY region""",
    "q03": f"""
        WITH need AS (SELECT product_key, location_key, sum(units_sold_qty) / 90e0 AS adr FROM f_sales, snap_day
                      WHERE day >= anchor - 90 GROUP BY ALL)
        SELECT sku, location_name, on_hand AS on_hand_qty, round(adr, 3) AS avg_daily_demand,
               {ratio('on_hand', 'adr', 1)} AS days_of_supply,
               CASE WHEN adr IS NULL THEN 'No recent demand' WHEN {ratio('on_hand', 'adr')} < 7 THEN 'Critical (<7d)'
                    WHEN {ratio('on_hand', 'adr')} < 21 THEN 'Watch (<21d)' ELSE 'Healthy' END AS supply_band
        FROM snap_now LEFT JOIN need USING (product_key, location_key)
        JOIN d_product USING (product_key) JOIN d_location USING (location_key)
        WHERE on_hand > 0 ORDER BY days_of_supply NULLS LAST, sku, location_name LIMIT 200""",
    "q04": """
        SELECT sku, product_name, category, q AS on_hand_qty, v AS trapped_value, last_sold_date
        FROM stock JOIN d_product USING (product_key) LEFT JOIN sold_last USING (product_key), snap_day
        WHERE q > 0 AND (last_sold_date IS NULL OR last_sold_date < anchor - 180)""",
    "q05": f"""
        SELECT sku, category, q AS on_hand_qty, v AS on_hand_value, {ratio('q', 'adr', 0)} AS days_of_supply
        FROM stock JOIN rate90 USING (product_key) JOIN d_product USING (product_key) WHERE {ratio('q', 'adr')} > 120""",
    "q06": f"""
        SELECT CASE WHEN last_sold_date >= anchor - 30 THEN '1. 0-30d' WHEN last_sold_date >= anchor - 60 THEN '2. 31-60d'
                    WHEN last_sold_date >= anchor - 90 THEN '3. 61-90d' WHEN last_sold_date >= anchor - 180 THEN '4. 91-180d'
                    ELSE '5. 180+ / never' END AS age_band,
               round(sum(v::DECIMAL(18,2))::DOUBLE, 2) AS inventory_value, {N} AS sku_count
        FROM stock LEFT JOIN sold_last USING (product_key), cal_day GROUP BY age_band""",
    "q07": f"""
        SELECT category, round(c, 0) AS total_cogs, round(a, 0) AS avg_inventory_value, {ratio('c', 'a', 2)} AS inventory_turnover
        FROM (SELECT category, {usd('cogs_c')} AS c FROM f_sales JOIN d_product USING (product_key) GROUP BY category)
        JOIN (SELECT category, {ratio(usd('value_c'), 'count(*)')} AS a FROM f_snap JOIN d_product USING (product_key) GROUP BY category)
        USING (category)""",
    "q08": f"""
        SELECT category, round(365e0 / nullif({ratio('c', 'a')}, 0), 1) AS dio_days
        FROM (SELECT category, {usd('cogs_c')} AS c, {ratio(usd('value_c'), 'count(value_c)')} AS a
              FROM d_product p LEFT JOIN (SELECT product_key, cogs_c FROM f_sales) f ON f.product_key = p.product_key
              LEFT JOIN (SELECT product_key, value_c FROM f_snap) s ON s.product_key = p.product_key GROUP BY category)""",
    "q09": f"""
        SELECT sku, category, round(gm, 0) AS gross_margin, round(a, 0) AS avg_inv_cost, {ratio('gm', 'a', 2)} AS gmroi
        FROM (SELECT product_key, {usd('margin_c')} AS gm FROM f_sales GROUP BY ALL)
        JOIN (SELECT product_key, {ratio(usd('value_c'), 'count(*)')} AS a FROM f_snap GROUP BY ALL) USING (product_key)
        JOIN d_product USING (product_key) WHERE a > 0 ORDER BY gmroi DESC, sku LIMIT 25""",
    "q10": """
        SELECT sku, product_name, category, q AS on_hand_qty, v AS inventory_value, rank() OVER (ORDER BY v DESC) AS value_rank
        FROM stock JOIN d_product USING (product_key) ORDER BY inventory_value DESC, sku LIMIT 20""",
    "q11": f"""
        WITH m AS (SELECT year(day)::INTEGER AS year, month(day)::INTEGER AS month_number, sum(value_c)::BIGINT AS c
                   FROM f_snap s WHERE date_key = (SELECT max(date_key) FROM f_snap z WHERE z.date_key // 100 = s.date_key // 100)
                   GROUP BY ALL)
        SELECT year, month_number, round(c / 100e0, 0) AS inventory_value,
               round((c - lag(c) OVER (ORDER BY year, month_number)) / 100e0, 0) AS mom_change FROM m""",
    "q12": f"""
        SELECT sku, product_name, category, (count(*) FILTER (WHERE is_out))::BIGINT AS stockout_days, {N} AS observed_days,
               {pct('count(*) FILTER (WHERE is_out)', 'count(*)', 1)} AS stockout_rate_pct
        FROM f_snap JOIN d_product USING (product_key) GROUP BY ALL HAVING count(*) FILTER (WHERE is_out) > 0
        ORDER BY stockout_days DESC, sku LIMIT 25""",
    "q13": f"""
        SELECT location_name, region, {usd('net_c')} AS net_revenue, sum(units_sold_qty)::BIGINT AS units FROM {STORES}
        GROUP BY ALL ORDER BY net_revenue DESC, location_name LIMIT 10""",
    "q14": f"""
        SELECT region, category, {usd('net_c')} AS revenue
        FROM f_sales JOIN d_location USING (location_key) JOIN d_product USING (product_key) GROUP BY ALL""",
    "q15": f"""
        WITH m AS (SELECT year, month_number, sum(net_c)::BIGINT AS c FROM f_sales JOIN d_date USING (date_key) GROUP BY ALL),
             p AS (SELECT *, lag(c) OVER (ORDER BY year, month_number) AS b FROM m)
        SELECT year, month_number, round(c / 100e0, 0) AS revenue, {pct('(c - b) / 100e0', 'b / 100e0', 1)} AS mom_growth_pct FROM p""",
    "q16": f"""
        SELECT sku, product_name, category, prior_units, recent_units, {pct('recent_units - prior_units', 'prior_units', 1)} AS change_pct
        FROM (SELECT product_key, (sum(units_sold_qty) FILTER (WHERE day >= anchor - 90))::BIGINT AS recent_units,
                     (sum(units_sold_qty) FILTER (WHERE day >= anchor - 180 AND day < anchor - 90))::BIGINT AS prior_units
              FROM f_sales, cal_day GROUP BY product_key)
        JOIN d_product USING (product_key) WHERE prior_units > 0 AND recent_units < prior_units
        ORDER BY change_pct, sku LIMIT 25""",
    "q17": f"""
        SELECT sku, product_name, category, sum(units_sold_qty)::BIGINT AS units, {usd('net_c')} AS revenue
        FROM f_sales JOIN d_product USING (product_key) GROUP BY ALL ORDER BY revenue DESC, sku LIMIT 20""",
    "q18": f"""
        SELECT category, round({usd('net_c')}, 0) AS revenue, round({usd('margin_c')}, 0) AS gross_margin,
               {pct(usd('margin_c'), usd('net_c'), 2)} AS margin_pct
        FROM f_sales JOIN d_product USING (product_key) GROUP BY category""",
    "q19": f"""
        SELECT if(is_weekend, 'Weekend', 'Weekday') AS day_type, count(DISTINCT date_key)::BIGINT AS days,
               round({usd('net_c')}, 0) AS revenue, {ratio(usd('net_c'), 'count(DISTINCT date_key)', 0)} AS avg_daily_revenue
        FROM f_sales JOIN d_date USING (date_key) GROUP BY day_type""",
    "q20": f"""
        SELECT month_number, month_name, season, round({usd('net_c')}, 0) AS revenue, sum(units_sold_qty)::BIGINT AS units
        FROM f_sales JOIN d_date USING (date_key) GROUP BY ALL""",
    "q21": f"""
        SELECT if(promotion_key IS NULL, 'No Promotion', 'Promoted') AS promo_status, {N} AS sale_lines,
               sum(units_sold_qty)::BIGINT AS units, {ratio('sum(units_sold_qty)', 'count(*)', 2)} AS avg_units_per_line,
               round({usd('net_c')}, 0) AS revenue FROM f_sales GROUP BY promo_status""",
    "q22": f"""
        SELECT {N} AS baskets, {ratio('sum(u)', 'count(*)', 2)} AS avg_units_per_basket,
               {ratio(usd('c'), 'count(*)', 2)} AS avg_basket_value
        FROM (SELECT order_id, sum(units_sold_qty) AS u, sum(net_c) AS c FROM f_sales GROUP BY order_id)""",
    "q23": f"""
        WITH r AS (SELECT product_key, sum(net_c) AS c FROM f_sales GROUP BY product_key),
             k AS (SELECT row_number() OVER w AS rev_rank, sum(c) OVER (w ROWS UNBOUNDED PRECEDING) / 100e0 AS upto,
                          sum(c) OVER () / 100e0 AS whole, count(*) OVER () AS n FROM r WINDOW w AS (ORDER BY c DESC, product_key))
        SELECT rev_rank, {pct('rev_rank', 'n', 1)} AS sku_pct, {pct('upto', 'whole', 1)} AS cumulative_revenue_pct
        FROM k WHERE rev_rank % greatest(n // 20, 1) = 0""",
    "q24": f"""
        SELECT category, round(sum(loss), 0) AS est_lost_revenue FROM ({LOSS}) JOIN d_product USING (product_key) GROUP BY category""",
    "q25": f"""
        SELECT supplier_name, reliability_tier, {N} AS po_lines, {pct('count(*) FILTER (WHERE is_otif)', 'count(*)', 1)} AS otif_pct
        FROM {PO} GROUP BY ALL HAVING count(*) >= 5 ORDER BY otif_pct, supplier_name LIMIT 20""",
    "q26": f"""
        SELECT supplier_name, reliability_tier, {ratio('sum(lead_days)', 'count(lead_days)', 1)} AS avg_lead_days, {N} AS po_lines
        FROM {PO} GROUP BY ALL HAVING count(*) >= 5 ORDER BY avg_lead_days DESC NULLS LAST, supplier_name LIMIT 20""",
    "q27": f"""
        SELECT supplier_name, reliability_tier, {ratio('sum(lead_days)', 'count(lead_days)', 1)} AS avg_lead,
               round(stddev_samp(lead_days), 2) AS lead_time_stddev
        FROM {PO} GROUP BY ALL HAVING count(*) >= 5 ORDER BY lead_time_stddev DESC NULLS LAST, supplier_name LIMIT 20""",
    "q28": f"""
        SELECT supplier_name, {N} AS po_lines, {pct('count(*) FILTER (WHERE is_late)', 'count(*)', 1)} AS late_rate_pct
        FROM {PO} GROUP BY ALL HAVING count(*) >= 5 ORDER BY late_rate_pct DESC, supplier_name LIMIT 20""",
    "q29": f"""
        SELECT supplier_name, coalesce(sum(b), 0)::BIGINT AS units_returned, sum(u)::BIGINT AS units_sold,
               {pct('coalesce(sum(b), 0)', 'sum(u)', 2)} AS return_rate_pct
        FROM ({SUPPLIES}) JOIN d_supplier USING (supplier_key)
        LEFT JOIN (SELECT product_key, sum(units_sold_qty) AS u FROM f_sales GROUP BY ALL) USING (product_key)
        LEFT JOIN (SELECT product_key, sum(returned_qty) AS b FROM f_ret GROUP BY ALL) USING (product_key)
        GROUP BY supplier_name HAVING sum(u) > 0 ORDER BY return_rate_pct DESC, supplier_name LIMIT 20""",
    "q30": f"""
        SELECT supplier_name, sum(ordered_qty)::BIGINT AS ordered, sum(received_qty)::BIGINT AS received,
               {pct('sum(received_qty)', 'sum(ordered_qty)', 1)} AS fill_rate_pct
        FROM {PO} GROUP BY ALL HAVING sum(ordered_qty) > 0 ORDER BY fill_rate_pct NULLS LAST, supplier_name LIMIT 20""",
    "q31": f"""
        SELECT supplier_name, reliability_tier, {N} AS stocked_out_skus
        FROM (SELECT DISTINCT product_key FROM snap_now WHERE is_out) JOIN ({SUPPLIES}) USING (product_key)
        JOIN d_supplier USING (supplier_key) GROUP BY ALL ORDER BY stocked_out_skus DESC, supplier_name LIMIT 20""",
    "q32": f"""
        SELECT supplier_name, country, round({usd('amount_c')}, 0) AS total_spend, count(DISTINCT po_number)::BIGINT AS purchase_orders
        FROM {PO} GROUP BY ALL ORDER BY total_spend DESC, supplier_name LIMIT 20""",
    "q33": f"""
        SELECT supplier_name, reliability_tier, round(o, 1) AS otif_pct, round(l, 1) AS avg_lead_days, round(f, 1) AS fill_pct,
               round(s, 0) AS total_spend, round(0.5e0 * o + 0.3e0 * f + -0.2e0 * l, 1) AS composite_score
        FROM (SELECT supplier_key, {pct('count(*) FILTER (WHERE is_otif)', 'count(*)')} AS o,
                     {ratio('sum(lead_days)', 'count(lead_days)')} AS l, {pct('sum(received_qty)', 'sum(ordered_qty)')} AS f,
                     {usd('amount_c')} AS s FROM f_po GROUP BY ALL HAVING count(*) >= 5)
        JOIN d_supplier USING (supplier_key)""",
    "q34": f"""
        SELECT category, {N} AS single_source_skus
        FROM (SELECT product_key FROM f_po GROUP BY ALL HAVING count(DISTINCT supplier_key) = 1)
        JOIN d_product USING (product_key) GROUP BY category""",
    "q35": f"""
        SELECT location_name, round(a, 0) AS avg_inventory_value, round(a * 0.25e0, 0) AS annual_holding_cost
        FROM (SELECT location_name, {ratio(usd('value_c'), 'count(*)')} AS a FROM f_snap JOIN d_location USING (location_key)
              WHERE location_type = 'WAREHOUSE' GROUP BY ALL)""",
    "q36": f"""
        SELECT location_name, round({usd('value_c')}, 0) AS inventory_value FROM snap_now JOIN d_location USING (location_key)
        WHERE location_type = 'WAREHOUSE' GROUP BY ALL""",
    "q37": f"""
        SELECT a.location_name AS source, b.location_name AS destination, {N} AS transfers, sum(qty)::BIGINT AS units,
               {usd('cost_c')} AS total_cost
        FROM f_trf JOIN d_location a ON a.location_key = src_key JOIN d_location b ON b.location_key = dst_key
        GROUP BY ALL ORDER BY units DESC, source, destination LIMIT 20""",
    "q38": """
        SELECT location_name, location_type, sum(CASE WHEN location_key = dst_key THEN qty ELSE -qty END)::BIGINT AS net_units_flow
        FROM f_trf JOIN d_location ON location_key IN (src_key, dst_key) GROUP BY ALL""",
    "q39": f"""
        SELECT sku, product_name, {N} AS transfer_events, sum(qty)::BIGINT AS units_moved
        FROM f_trf JOIN d_product USING (product_key) GROUP BY ALL ORDER BY units_moved DESC, sku LIMIT 20""",
    "q40": f"""
        SELECT location_name, warehouse_capacity_units, sum(on_hand)::BIGINT AS units_on_hand,
               {pct('sum(on_hand)', 'max(warehouse_capacity_units)', 1)} AS utilisation_pct
        FROM snap_now JOIN d_location USING (location_key) WHERE location_type = 'WAREHOUSE' GROUP BY ALL""",
    "q41": f"""
        WITH i AS (SELECT region, {usd('value_c')} AS v FROM snap_now JOIN d_location USING (location_key) GROUP BY ALL),
             s AS (SELECT region, {usd('net_c')} AS r FROM f_sales JOIN d_location USING (location_key) GROUP BY ALL)
        SELECT region, round(100e0 * (v / (SELECT sum(v::DECIMAL(18,2))::DOUBLE FROM i SEMI JOIN s USING (region))), 1) AS inv_share_pct,
               round(100e0 * (r / (SELECT sum(r::DECIMAL(18,2))::DOUBLE FROM s SEMI JOIN i USING (region))), 1) AS sales_share_pct
        FROM i JOIN s USING (region)""",
    "q42": f"""
        SELECT a.region AS from_region, b.region AS to_region, {N} AS transfers, sum(qty)::BIGINT AS units
        FROM f_trf JOIN d_location a ON a.location_key = src_key JOIN d_location b ON b.location_key = dst_key
        WHERE a.region <> b.region GROUP BY ALL""",
    "q43": f"""
        SELECT location_name, region, round({usd('net_c')}, 0) AS revenue, {pct(usd('margin_c'), usd('net_c'), 1)} AS margin_pct,
               rank() OVER (ORDER BY sum(net_c) DESC) AS revenue_rank FROM {STORES} GROUP BY ALL""",
    "q44": f"""
        SELECT location_name, region, round(r, 0) AS revenue, round(a, 0) AS region_avg, {pct('r - a', 'a', 1)} AS vs_region_pct
        FROM ({STORE_REVENUE})
        JOIN (SELECT region, sum(r::DECIMAL(18,2))::DOUBLE / count(*) AS a FROM ({STORE_REVENUE}) GROUP BY region) USING (region)
        WHERE r < a""",
    "q45": f"""
        WITH p AS (SELECT product_key, {usd('net_c')} AS r, {pct(usd('margin_c'), usd('net_c'))} AS m FROM f_sales GROUP BY ALL),
             c AS (SELECT avg(r) AS ar, avg(m) AS am FROM p)
        SELECT sku, category, round(r, 0) AS revenue, round(m, 1) AS margin_pct,
               CASE WHEN r >= ar AND m >= am THEN 'Star (high sales, high margin)'
                    WHEN r >= ar AND m < am THEN 'Traffic driver (high sales, low margin)'
                    WHEN r < ar AND m >= am THEN 'Niche (low sales, high margin)'
                    ELSE 'Review (low sales, low margin)' END AS quadrant
        FROM p JOIN d_product USING (product_key), c ORDER BY revenue DESC, sku LIMIT 50""",
    "q46": f"""
        SELECT category, round({usd('net_c')}, 0) AS revenue,
               round(100e0 * ({usd('net_c')} / (SELECT {usd('net_c')} FROM f_sales)), 1) AS revenue_share_pct
        FROM f_sales JOIN d_product USING (product_key) GROUP BY category""",
    "q47": f"""
        SELECT sku, product_name, category, u AS units_sold, coalesce(b, 0)::BIGINT AS units_returned,
               {pct('coalesce(b, 0)', 'u', 2)} AS return_rate_pct
        FROM (SELECT product_key, sum(units_sold_qty)::BIGINT AS u FROM f_sales GROUP BY ALL) JOIN d_product USING (product_key)
        LEFT JOIN (SELECT product_key, sum(returned_qty) AS b FROM f_ret GROUP BY ALL) USING (product_key)
        WHERE u > 20 ORDER BY return_rate_pct DESC, sku LIMIT 25""",
    "q48": f"""
        SELECT reason AS return_reason_code, {N} AS return_events, sum(returned_qty)::BIGINT AS units,
               round({usd('refund_c')}, 0) AS refund_value FROM f_ret GROUP BY ALL""",
    "q49": f"""
        SELECT round(r, 0) AS total_revenue, {pct('m', 'r', 1)} AS gross_margin_pct, round(v, 0) AS current_inventory_value,
               {ratio('c', 'a * k', 2)} AS approx_turnover, o AS current_stockouts
        FROM (SELECT {usd('net_c')} AS r, {usd('margin_c')} AS m, {usd('cogs_c')} AS c FROM f_sales),
             (SELECT {usd('value_c')} AS v, (count(*) FILTER (WHERE is_out))::BIGINT AS o FROM snap_now),
             (SELECT {ratio(usd('value_c'), 'count(*)')} AS a, count(DISTINCT product_key) AS k FROM f_snap)""",
    "q50": """
        SELECT sku, product_name, location_name, on_hand AS on_hand_qty, reorder_point, safety_stock AS safety_stock_qty,
               reorder_point - on_hand AS shortfall
        FROM snap_now JOIN d_product USING (product_key) JOIN d_location USING (location_key)
        WHERE is_below AND on_order = 0 AND is_active ORDER BY shortfall DESC, sku, location_name LIMIT 100""",
    "q51": f"""
        SELECT sku, category, round(v, 0) AS inventory_value, {ratio('q', 'adr', 0)} AS days_of_supply
        FROM stock JOIN d_product USING (product_key) LEFT JOIN rate90 USING (product_key)
        WHERE coalesce({ratio('q', 'adr')}, 9999) > 180 ORDER BY inventory_value DESC, sku LIMIT 50""",
    "q52": f"""
        WITH s AS (SELECT v::DECIMAL(18,2) AS v, last_sold_date IS NULL OR last_sold_date < anchor - 180 AS dead
                   FROM stock LEFT JOIN sold_last USING (product_key), cal_day),
             t AS (SELECT (sum(v) FILTER (WHERE dead))::DOUBLE AS d, sum(v)::DOUBLE AS a FROM s)
        SELECT round(d, 0) AS dead_stock_value, round(a, 0) AS total_inventory_value, {pct('d', 'a', 1)} AS dead_stock_pct FROM t""",
    "q53": f"""
        SELECT coalesce(abc_class, 'C') AS abc_class, xyz_class, {N} AS sku_count
        FROM d_product LEFT JOIN abc USING (product_key) LEFT JOIN xyz USING (product_key) GROUP BY ALL""",
    "q54": f"""
        SELECT (SELECT round({usd('disc_c')}, 0) FROM f_sales) AS discount_leakage,
               (SELECT round({usd('refund_c')}, 0) FROM f_ret) AS returns_leakage,
               (SELECT round(sum(loss), 0) FROM ({LOSS})) AS est_stockout_lost_revenue""",
    "vw_sales_enriched": """
        SELECT order_id, full_date, year, month_number, season, sku, product_name, category, subcategory,
               coalesce(abc_class, 'C') AS abc_class, location_name, location_type, region, units_sold_qty::INTEGER AS units_sold_qty,
               net_c / 100e0 AS net_sales_amount, cogs_c / 100e0 AS cogs_amount, margin_c / 100e0 AS gross_margin_amount,
               promotion_key IS NOT NULL AS is_promoted
        FROM f_sales JOIN d_date USING (date_key) JOIN d_product USING (product_key) LEFT JOIN abc USING (product_key)
        JOIN d_location USING (location_key)""",
    "vw_current_inventory": """
        SELECT product_key, location_key, sku, category, location_name, location_type, region, on_hand AS on_hand_qty,
               value_c / 100e0 AS on_hand_value, on_order AS on_order_qty, reorder_point, safety_stock AS safety_stock_qty,
               is_below AS is_below_reorder_flag, is_out AS is_stockout_flag
        FROM snap_now JOIN d_product USING (product_key) JOIN d_location USING (location_key)""",
    "vw_supplier_scorecard": f"""
        SELECT supplier_key, supplier_name, reliability_tier, {N} AS po_lines,
               {pct('count(*) FILTER (WHERE is_otif)', 'count(*)', 1)} AS otif_pct,
               {ratio('sum(lead_days)', 'count(lead_days)', 1)} AS avg_lead_days,
               round(stddev_samp(lead_days), 2) AS lead_time_stddev,
               {pct('sum(received_qty)', 'sum(ordered_qty)', 1)} AS fill_rate_pct, round({usd('amount_c')}, 0) AS total_spend
        FROM {PO} GROUP BY ALL""",
    "vw_reorder_worklist": """
        SELECT sku, category, location_name, region, on_hand AS on_hand_qty, reorder_point, reorder_point - on_hand AS shortfall_qty
        FROM snap_now JOIN d_product USING (product_key) JOIN d_location USING (location_key)
        WHERE is_below AND on_order = 0 AND is_active""",
    "vw_dead_stock": f"""
        SELECT product_key, sku, category, sum(on_hand)::BIGINT AS on_hand_qty, {usd('value_c')} AS trapped_value, last_sold_date
        FROM snap_now JOIN d_product USING (product_key) LEFT JOIN sold_last USING (product_key), snap_day
        WHERE on_hand > 0 AND (last_sold_date IS NULL OR last_sold_date < anchor - 180) GROUP BY ALL""",
    "mv_executive_kpis": f"""
        SELECT (SELECT {usd('net_c')} FROM f_sales) AS total_revenue, (SELECT {usd('margin_c')} FROM f_sales) AS total_gross_margin,
               (SELECT {usd('value_c')} FROM snap_now) AS current_inventory_value,
               (SELECT {N} FROM snap_now WHERE is_out) AS current_stockouts,
               (SELECT count(DISTINCT product_key)::BIGINT FROM snap_now LEFT JOIN sold_last USING (product_key), snap_day
                WHERE on_hand > 0 AND (last_sold_date IS NULL OR last_sold_date < anchor - 180)) AS dead_stock_skus""",
}
