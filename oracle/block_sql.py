"""DuckDB SQL for the building blocks, cleaning, checks and derivations."""

from __future__ import annotations

from oracle.question_sql import LOSS, PO, STORE_REVENUE
from oracle.star_sql import ratio, usd
from shelfwise.schema import NATURAL_KEY, PRIMARY_KEY, REFERENCES, REQUIRED

N = "count(*)::BIGINT"

# Table -> relation in the derived star (None: fixed number of rows) and the summed figure.
RELATIONS: dict[str, tuple[str, str]] = {
    "dim_date": ("d_date", "sum(date_key)::DOUBLE"),
    "dim_product": ("d_product", "sum(price_c) / 100e0"),
    "dim_supplier": ("d_supplier", "sum(supplier_key)::DOUBLE"),
    "dim_location": ("d_location", "sum(location_key)::DOUBLE"),
    "dim_customer": ("d_customer", "sum(customer_key)::DOUBLE"),
    "dim_employee": ("(SELECT unnest(range(1, 121)) AS k)", "sum(k)::DOUBLE"),
    "dim_promotion": ("(SELECT unnest(range(7, 11)) AS k)", "sum(k)::DOUBLE"),
    "fact_sales": ("f_sales", "sum(net_c) / 100e0"),
    "fact_inventory_snapshot": ("f_snap", "sum(value_c) / 100e0"),
    "fact_purchase_order": ("f_po", "sum(amount_c) / 100e0"),
    "fact_returns": ("f_ret", "sum(refund_c) / 100e0"),
    "fact_stock_transfer": ("f_trf", "sum(cost_c) / 100e0"),
}
CLEANED = """SELECT DISTINCT r.* REPLACE (coalesce(r.price_c, cat.price_c) AS price_c) FROM
             (SELECT DISTINCT * FROM raw_sales) r JOIN cat ON cat.pk = r.product_key"""
# two lines that differ only in a missing price stay two lines, so DISTINCT must come before the price is filled
FILLED = CLEANED.replace("SELECT DISTINCT r.*", "SELECT r.*")
RAW = {**{t: r for t, (r, _) in RELATIONS.items()}, "fact_sales": "raw_sales"}


def checksum_sql(replace: dict[str, str] | None = None, tables=tuple(RELATIONS)) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {N} AS row_count, {RELATIONS[t][1]} AS figure FROM {(replace or {}).get(t, RELATIONS[t][0])}"
        for t in tables
    )


FILLED_NET = f"(SELECT * REPLACE (units_sold_qty * price_c - disc_c AS net_c) FROM ({FILLED}))"


def _check(name: str, table: str, violations: str, critical: bool = True, total: str = "count(*)", sample: bool | str = False) -> str:
    listed = f", {sample} AS sample" if isinstance(sample, str) else ", NULL::VARCHAR AS sample" if sample else ""
    return (f"SELECT '{name}' AS check_name, {str(critical).lower()} AS is_critical, ({violations})::BIGINT AS violations, "
            f"(SELECT {total} FROM {RAW[table]})::BIGINT AS total{listed}")


# Columns of the derived star under other names here, and the column rows are chosen by.
NAMES = {
    ("fact_inventory_snapshot", "snapshot_date_key"): "date_key", ("fact_purchase_order", "order_date_key"): "order_key",
    ("fact_purchase_order", "expected_date_key"): "expected_key", ("fact_purchase_order", "received_date_key"): "received_key",
    ("fact_purchase_order", "dest_location_key"): "location_key", ("fact_returns", "return_date_key"): "date_key",
    ("fact_stock_transfer", "transfer_date_key"): "date_key", ("fact_stock_transfer", "source_location_key"): "src_key",
    ("fact_stock_transfer", "dest_location_key"): "dst_key", ("dim_employee", "home_location_key"): "k % 20",
    ("dim_employee", "employee_key"): "k", ("dim_promotion", "promotion_key"): "k",
}


def _marker(table: str) -> str:
    key = "product_key" if table.startswith("fact_") else PRIMARY_KEY[table][0]
    return NAMES.get((table, key), key)


def _orphans(table: str, column: str, dim: str) -> str:
    key = NAMES.get((table, column), column)
    gone = f"FROM {RAW[table]} WHERE ({key}) % 7 = 3"
    first = f"(SELECT string_agg(k::VARCHAR, ', ' ORDER BY k) FROM (SELECT DISTINCT ({key})::BIGINT + 1000000000 AS k {gone} ORDER BY k LIMIT 5))"
    return _check(f"{table}.{column} -> {dim}", table, f"SELECT count(*) {gone}", sample=first)


def _twice(name: str, table: str) -> str:
    again = f"count(*) FILTER (WHERE {_marker(table)} % 5 = 0)"
    return _check(name, table, f"SELECT {again} FROM {RAW[table]}", total=f"count(*) + {again}", sample=True)


def _holes(name: str, table: str) -> str:
    return _check(name, table, f"SELECT count(*) FROM {RAW[table]} WHERE {_marker(table)} % 6 = 1", sample=True)


MISSING = "SELECT count(*) - count(price_c) FROM raw_sales"
CORE = " UNION ALL ".join([
    _check("fact_sales.product_key -> dim_product", "fact_sales", "SELECT count(*) FROM raw_sales ANTI JOIN d_product USING (product_key)"),
    _check("fact_sales.location_key -> dim_location", "fact_sales", "SELECT count(*) FROM raw_sales ANTI JOIN d_location USING (location_key)"),
    _check("fact_inventory_snapshot.product_key -> dim_product", "fact_inventory_snapshot", "SELECT count(*) FROM f_snap ANTI JOIN d_product USING (product_key)"),
    _check("fact_purchase_order.supplier_key -> dim_supplier", "fact_purchase_order", "SELECT count(*) FROM f_po ANTI JOIN d_supplier USING (supplier_key)"),
    _check("dim_product.sku unique", "dim_product", "SELECT count(*) - count(DISTINCT sku) FROM d_product"),
    _check("dim_product.product_key unique", "dim_product", "SELECT count(*) - count(DISTINCT product_key) FROM d_product"),
    _check("fact_sales.unit_price not null", "fact_sales", MISSING),
    _check("fact_sales.units_sold_qty > 0", "fact_sales", "SELECT count(*) FROM raw_sales WHERE units_sold_qty <= 0"),
    _check("dim_product.unit_price >= unit_cost", "dim_product", "SELECT count(*) FROM d_product WHERE price_c < cost_c", False),
    _check("fact_inventory_snapshot.on_hand_qty >= 0", "fact_inventory_snapshot", "SELECT count(*) FROM f_snap WHERE on_hand < 0"),
    _check("fact_purchase_order.is_otif_flag = on time and in full", "fact_purchase_order",
           "SELECT count(*) FROM f_po WHERE is_otif <> (NOT is_late AND is_complete)", False),
    _check("fact_purchase_order.received_qty <= ordered_qty", "fact_purchase_order", "SELECT count(*) FROM f_po WHERE received_qty > ordered_qty", False),
])
CLEAN_CHECKS = CORE.replace("raw_sales", f"({FILLED})".replace("raw_sales", "RAWSALES")).replace("RAWSALES", "raw_sales")


def _verdict(checks: str, stage: str) -> str:
    return f"""SELECT '{stage}' AS stage, (count(*) FILTER (WHERE is_critical AND violations > 0))::BIGINT AS critical_failures,
        1e0 - sum(violations)::DOUBLE / sum(total)::DOUBLE AS pass_rate,
        count(*) FILTER (WHERE is_critical AND violations > 0) = 0 AND 1e0 - sum(violations)::DOUBLE / sum(total)::DOUBLE >= 0.99 AS passed
        FROM ({checks})"""


def _scope(name: str, allowed: str, either: bool = False) -> str:
    inside = f"(SELECT location_key FROM d_location WHERE {allowed})"
    both = "OR" if either else "AND"
    plain = {"fact_sales": "f_sales", "fact_inventory_snapshot": "f_snap", "fact_purchase_order": "f_po", "fact_returns": "f_ret"}
    parts = [f"SELECT '{name}' AS scope, '{t}' AS table_name, {N} AS row_count FROM {r} WHERE location_key IN {inside}" for t, r in plain.items()]
    parts.append(f"SELECT '{name}', 'fact_stock_transfer', {N} FROM f_trf WHERE src_key IN {inside} {both} dst_key IN {inside}")
    return " UNION ALL ".join(parts)


SNAP = "product_key, location_key, date_key AS snapshot_date_key, on_hand AS on_hand_qty, value_c / 100e0 AS on_hand_value, on_order AS on_order_qty, reorder_point"
LINES = """supplier_name, po_number, sku, category, order_key AS order_date_key, expected_key AS expected_date_key,
           received_key AS received_date_key, ordered_qty::INTEGER AS ordered_qty, received_qty::INTEGER AS received_qty,
           lead_days AS lead_time_days, is_late AS is_late_flag, is_complete AS is_complete_flag, is_otif AS is_otif_flag"""
NEED = """(SELECT product_key, location_key, sum(units_sold_qty) / 90e0 AS adr FROM f_sales, {anchor}
           WHERE day >= anchor - 90 GROUP BY ALL)"""
CURVE = """(SELECT product_key, row_number() OVER w AS rk, sum(c) OVER (w ROWS UNBOUNDED PRECEDING) AS upto, count(*) OVER () AS n
           FROM (SELECT product_key, sum({c}) AS c FROM f_sales GROUP BY ALL) WINDOW w AS (ORDER BY c DESC, product_key))"""
FLOWS = "(SELECT src_key AS location_key, -qty AS qty FROM f_trf UNION ALL SELECT dst_key, qty FROM f_trf)"
DUP = "order_id, day, date_key, product_key, location_key, customer_key, employee_key, promotion_key, units_sold_qty, price_c, gross_c, disc_c, net_c, cost_c, cogs_c, margin_c"

BLOCK_SQL: dict[str, str] = {
    "src_csv_star": checksum_sql(),
    "src_parquet_star": checksum_sql(),
    "sink_processed": checksum_sql({"fact_sales": FILLED_NET}),
    "gated_load": checksum_sql({"fact_sales": FILLED_NET}),
    "etl_pipeline": checksum_sql({"fact_sales": FILLED_NET}),
    "sink_sample_all": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, least(500, (SELECT count(*) FROM {r}))::BIGINT AS row_count" for t, (r, _) in RELATIONS.items()),
    "sink_sample": """SELECT customer_key, printf('CUST-%07d', customer_key) AS customer_id, loyalty_tier,
                      loyalty_tier <> 'None' AS is_loyalty_member, region FROM d_customer ORDER BY customer_key LIMIT 500""",
    "layout_partition": f"SELECT (date_key // 100)::INTEGER AS snapshot_month, {N} AS row_count, sum(on_hand)::BIGINT AS on_hand_qty FROM f_snap GROUP BY ALL",
    "layout_cluster": f"""
        WITH e AS (SELECT max(product_key) AS p, max(date_key) AS d FROM f_snap)
        SELECT 'location_key' AS path, {N} AS row_count, sum(on_hand)::BIGINT AS on_hand_qty, true AS under_half FROM f_snap WHERE location_key = 7
        UNION ALL SELECT 'product_key', {N}, sum(on_hand)::BIGINT, true FROM f_snap, e WHERE product_key BETWEEN p // 3 AND p // 3 + p // 20
        UNION ALL SELECT 'snapshot_date_key', {N}, sum(on_hand)::BIGINT, true FROM f_snap, e WHERE date_key >= d // 100 * 100""",
    "dedupe_history": f"""SELECT (date_key // 100)::INTEGER AS sale_month, {N} AS row_count, sum(units_sold_qty)::BIGINT AS units
        FROM (SELECT DISTINCT * FROM raw_sales) GROUP BY ALL""",
    "incremental_refresh": f"""SELECT (date_key // 100)::INTEGER AS snapshot_month, {N} AS row_count,
        sum(CASE WHEN date_key // 100 >= (SELECT strftime(max(day) - INTERVAL 2 MONTH, '%Y%m')::INTEGER FROM f_snap) THEN 0 ELSE on_order END)::BIGINT AS on_order_qty FROM f_snap GROUP BY ALL""",
    "atomic_refresh": f"""
        WITH edge AS (SELECT strftime(max(day) - INTERVAL 2 MONTH, '%Y%m')::INTEGER AS edge FROM f_snap),
        stages AS (SELECT unnest(['1 before', '2 failed', '3 done']) AS stage),
        sold AS (SELECT (date_key // 100)::INTEGER AS month, sum(units_sold_qty)::BIGINT AS u FROM f_sales GROUP BY ALL),
        held AS (SELECT (date_key // 100)::INTEGER AS month, {N} AS row_count, sum(on_order)::BIGINT AS q FROM f_snap GROUP BY ALL)
        SELECT stage, month, row_count, CASE WHEN stage = '3 done' AND month >= edge THEN 0 ELSE q END AS on_order_qty,
               CASE WHEN stage = '3 done' AND month >= edge THEN 2 * u ELSE u END AS units
        FROM stages, edge, held LEFT JOIN sold USING (month)""",
    "ledger_resume": """SELECT product_key, location_key, strftime(day, '%Y%m%d')::INTEGER AS date_key, receipts::BIGINT AS receipts, demand::BIGINT AS demand,
        on_hand::BIGINT AS on_hand, (demand - unmet)::BIGINT AS sold, unmet::BIGINT AS unmet FROM ledger""",
    "measure_matrix": f"""
        WITH s AS (SELECT region, category, cogs_c, net_c, order_id FROM f_sales JOIN d_location USING (location_key) JOIN d_product USING (product_key)),
        n AS (SELECT region, category, date_key, value_c FROM f_snap JOIN d_location USING (location_key) JOIN d_product USING (product_key)),
        sold AS (SELECT grouping(region, category) AS g, region, category, {usd('net_c')} AS revenue, {usd('cogs_c')} AS cogs, count(DISTINCT order_id) AS orders
                 FROM s GROUP BY GROUPING SETS ((region, category), (region), (category), ())),
        daily AS (SELECT grouping(region, category) AS g, region, category, date_key, sum(value_c) AS v
                  FROM n GROUP BY GROUPING SETS ((region, category, date_key), (region, date_key), (category, date_key), (date_key))),
        held AS (SELECT g, region, category, (max_by(v, date_key) / 100e0) AS closing, sum(v::DOUBLE) / 100e0 / count(*) AS avg_value
                 FROM daily GROUP BY ALL)
        SELECT ['region, category', 'region', 'category', 'total'][coalesce(sold.g, held.g)::INTEGER + 1] AS level,
               coalesce(sold.region, held.region) AS region, coalesce(sold.category, held.category) AS category, revenue AS total_revenue,
               closing AS inventory_value, {ratio('cogs', 'avg_value')} AS turnover, {ratio('revenue', 'orders')} AS avg_basket_value
        FROM sold FULL JOIN held ON sold.g = held.g AND sold.region IS NOT DISTINCT FROM held.region AND sold.category IS NOT DISTINCT FROM held.category""",
    "distinct_rollup": f"""
        SELECT ['year, region', 'year', 'region', 'total'][g::INTEGER + 1] AS level, year, region, customers, products, orders
        FROM (SELECT grouping(year, region) AS g, year, region, count(DISTINCT customer_key)::BIGINT AS customers, count(DISTINCT product_key)::BIGINT AS products,
                     count(DISTINCT order_id)::BIGINT AS orders
              FROM (SELECT *, year(day)::INTEGER AS year FROM f_sales) JOIN d_location USING (location_key)
              GROUP BY GROUPING SETS ((year, region), (region), ()))""",
    "mv_incremental": f"""
        WITH ms AS (SELECT DISTINCT date_key // 100 AS m FROM f_sales),
        chosen AS (SELECT m FROM ms ORDER BY m LIMIT 1 OFFSET (SELECT count(*) // 2 FROM ms)),
        s AS (SELECT * FROM f_sales WHERE date_key // 100 <> (SELECT m FROM chosen) OR product_key % 2 = 1),
        sl AS (SELECT product_key, max(day) AS last_sold_date FROM s GROUP BY product_key)
        SELECT (SELECT {usd('net_c')} FROM s) AS total_revenue, (SELECT {usd('margin_c')} FROM s) AS total_gross_margin,
               (SELECT {usd('value_c')} FROM snap_now) AS current_inventory_value, (SELECT {N} FROM snap_now WHERE is_out) AS current_stockouts,
               (SELECT count(DISTINCT product_key)::BIGINT FROM snap_now LEFT JOIN sl USING (product_key), snap_day
                WHERE on_hand > 0 AND (last_sold_date IS NULL OR last_sold_date < anchor - 180)) AS dead_stock_skus, 2 AS months_read""",
    "retention_compact": f"""
        SELECT strftime(day, '%Y%m')::INTEGER AS snapshot_month, count(DISTINCT day)::BIGINT AS days, {N} AS row_count, sum(on_hand)::BIGINT AS on_hand
        FROM ledger WHERE day >= (SELECT max(day) FROM ledger) - INTERVAL 18 MONTH
           OR day IN (SELECT max(day) FROM ledger GROUP BY date_trunc('month', day)) GROUP BY ALL""",
    "refresh_stats": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {N} AS row_count FROM {RELATIONS[t][0]}" for t in ("fact_sales", "fact_inventory_snapshot", "fact_purchase_order")),
    "column_statistics": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{name}' AS column_name, min({c})::BIGINT AS low, max({c})::BIGINT AS high, (count(*) - count({c}))::BIGINT AS nulls, "
        f"true AS distinct_within_tenth, true AS has_histogram FROM {r}"
        for t, r, name, c in (
            ("fact_sales", "f_sales", "date_key", "date_key"), ("fact_sales", "f_sales", "product_key", "product_key"),
            ("fact_sales", "f_sales", "units_sold_qty", "units_sold_qty"), ("fact_sales", "f_sales", "promotion_key", "promotion_key"),
            ("fact_purchase_order", "f_po", "received_date_key", "received_key"), ("fact_purchase_order", "f_po", "ordered_qty", "ordered_qty"))),
    "latest_snapshot": f"SELECT {SNAP} FROM snap_now",
    "as_of_snapshot": "SELECT anchor AS as_of_date FROM snap_day",
    "as_of_calendar": "SELECT anchor AS as_of_date FROM cal_day",
    "trailing_window": f"""SELECT date_key, {N} AS sale_lines, sum(units_sold_qty)::BIGINT AS units FROM f_sales, cal_day
        WHERE day BETWEEN anchor - 90 AND anchor GROUP BY ALL""",
    "flag_filter": f"SELECT {SNAP} FROM f_snap WHERE is_below AND NOT is_out AND on_order <> 0 AND reorder_point >= 6 AND reorder_point <= 13",
    "band_case": f"""
        SELECT CASE WHEN adr IS NULL THEN 'No recent demand' WHEN {ratio('on_hand', 'adr')} < 7 THEN 'Critical (<7d)'
                    WHEN {ratio('on_hand', 'adr')} < 21 THEN 'Watch (<21d)' ELSE 'Healthy' END AS supply_band,
               {N} AS positions, sum(on_hand)::BIGINT AS on_hand_qty
        FROM snap_now LEFT JOIN {NEED.format(anchor='snap_day')} USING (product_key, location_key) WHERE on_hand > 0 GROUP BY ALL""",
    "row_policy": " UNION ALL ".join([
        _scope("executive", "true"), _scope("asia", "region = 'ASIA'"), _scope("warehouse", "location_type = 'WAREHOUSE'"),
        _scope("asia_either_end", "region = 'ASIA'", True), _scope("unknown_user", "false")]),
    "drillthrough": f"SELECT {LINES} FROM {PO} JOIN d_product USING (product_key) WHERE reliability_tier = 'Bronze'",
    "drillthrough_lead_times": f"""
        SELECT supplier_name, (order_key // 100)::INTEGER AS order_month, {N} AS po_lines, {ratio('sum(lead_days)', 'count(lead_days)')} AS avg_lead_days
        FROM {PO} WHERE reliability_tier = 'Gold' GROUP BY ALL""",
    "drillthrough_products": f"""
        SELECT DISTINCT supplier_name, sku FROM {PO} JOIN d_product USING (product_key)
        WHERE reliability_tier = 'Silver' AND product_key IN (SELECT product_key FROM snap_now WHERE is_out)""",
    "star_join": f"""
        SELECT category, d_location.region, season, loyalty_tier, {N} AS sale_lines, {usd('net_c')} AS revenue
        FROM f_sales JOIN d_product USING (product_key) JOIN d_location USING (location_key) JOIN d_date USING (date_key)
        JOIN d_customer USING (customer_key) GROUP BY ALL""",
    "role_join": f"""
        SELECT a.location_name AS source, b.location_name AS destination, {N} AS transfers, sum(qty)::BIGINT AS units, {usd('cost_c')} AS total_cost
        FROM f_trf JOIN d_location a ON a.location_key = src_key JOIN d_location b ON b.location_key = dst_key GROUP BY ALL""",
    "left_outer_demand": f"""
        SELECT product_key, location_key, on_hand AS on_hand_qty, adr AS daily_demand, {ratio('on_hand', 'adr')} AS days_of_supply
        FROM snap_now LEFT JOIN {NEED.format(anchor='cal_day')} USING (product_key, location_key)""",
    "anti_or_stale": """SELECT product_key, q AS on_hand_qty, v AS on_hand_value, last_sold_date FROM stock LEFT JOIN sold_last USING (product_key), cal_day
        WHERE last_sold_date IS NULL OR last_sold_date < anchor - 180""",
    "semi_in": "SELECT product_key, sku FROM d_product WHERE product_key IN (SELECT product_key FROM rate90)",
    "anti_not_in": "SELECT product_key, sku FROM d_product WHERE product_key NOT IN (SELECT product_key FROM rate90)",
    "multi_key_join": f"SELECT product_key, location_key, loss FROM ({LOSS.replace('SELECT product_key, (', 'SELECT product_key, location_key, (')})",
    "multi_fact_join": """
        SELECT product_key, sku, u::BIGINT AS units_sold, b::BIGINT AS units_returned, c::BIGINT AS units_received FROM d_product
        LEFT JOIN (SELECT product_key, sum(units_sold_qty) AS u FROM f_sales GROUP BY ALL) USING (product_key)
        LEFT JOIN (SELECT product_key, sum(returned_qty) AS b FROM f_ret GROUP BY ALL) USING (product_key)
        LEFT JOIN (SELECT product_key, sum(received_qty) AS c FROM f_po GROUP BY ALL) USING (product_key)""",
    "fanout_join": f"""
        SELECT category, {usd('cogs_c')} AS total_cogs, {ratio(usd('value_c'), 'count(value_c)')} AS avg_inv
        FROM d_product p LEFT JOIN (SELECT product_key, cogs_c FROM f_sales) f ON f.product_key = p.product_key
        LEFT JOIN (SELECT product_key, value_c FROM f_snap) s ON s.product_key = p.product_key GROUP BY category""",
    "scalar_subquery": """
        WITH r AS (SELECT product_key, sum(net_c) AS c FROM f_sales GROUP BY ALL),
             a AS (SELECT (sum(c) / 100e0) / count(*) AS m FROM r)
        SELECT product_key, c / 100e0 AS revenue, round(c / 100e0 - m, 2) AS above_mean FROM r, a WHERE c / 100e0 > m""",
    "correlated_max": f"""
        SELECT year(day)::INTEGER AS year, month(day)::INTEGER AS month_number, {usd('value_c')} AS inventory_value FROM f_snap s
        WHERE date_key = (SELECT max(date_key) FROM f_snap z WHERE z.date_key // 100 = s.date_key // 100) GROUP BY ALL""",
    "exists_range_open_po": "SELECT product_key, location_key, strftime(day, '%Y%m%d')::INTEGER AS snapshot_date_key, q::BIGINT AS on_order_qty FROM on_order WHERE q > 0",
    "agg_basic": f"""SELECT product_key, location_key, {N} AS sale_lines, sum(units_sold_qty)::BIGINT AS units, {ratio(usd('price_c'), 'count(price_c)')} AS avg_price,
        max(date_key) AS last_date_key, {usd('net_c')} AS revenue FROM f_sales GROUP BY ALL""",
    "agg_filter": """SELECT product_key, count(promotion_key)::BIGINT AS promoted_lines,
        (sum(units_sold_qty) FILTER (WHERE promotion_key = 10))::BIGINT AS units_at_ten_pct FROM f_sales GROUP BY ALL""",
    "agg_distinct": """SELECT location_name, count(DISTINCT (order_id, product_key))::BIGINT AS distinct_order_products,
        count(DISTINCT order_id)::BIGINT AS orders FROM f_sales JOIN d_location USING (location_key) GROUP BY ALL""",
    "agg_having": f"""SELECT supplier_name, {N} AS po_lines, sum(received_qty)::BIGINT AS received FROM {PO} GROUP BY ALL
        HAVING count(*) >= 5 AND sum(received_qty) > 0""",
    "agg_stddev_samp": "SELECT supplier_key, round(stddev_samp(lead_days), 6) AS lead_sd FROM f_po GROUP BY ALL",
    "agg_stddev_pop": "SELECT supplier_key, round(stddev_pop(lead_days), 6) AS lead_sd FROM f_po GROUP BY ALL",
    "safe_ratio": f"""SELECT product_key, {ratio(usd('disc_c'), usd('net_c'))} AS discount_rate,
        {ratio('count(*) - count(promotion_key)', 'count(promotion_key)')} AS plain_per_promoted FROM f_sales GROUP BY ALL""",
    "semi_closing": """SELECT product_key, sum(value_c) / 100e0 AS closing_value, sum(on_hand)::BIGINT AS closing_units FROM f_snap s
        WHERE date_key = (SELECT max(date_key) FROM f_snap z WHERE z.product_key = s.product_key) GROUP BY ALL""",
    "semi_avg_daily": "SELECT location_key, sum(d)::DOUBLE / 100e0 / count(*) AS average_value FROM (SELECT location_key, date_key, sum(value_c) AS d FROM f_snap GROUP BY ALL) GROUP BY ALL",
    "agg_row_avg": f"SELECT location_key, {ratio(usd('value_c'), 'count(*)')} AS row_average FROM f_snap GROUP BY ALL",
    "quantile_clip_hist": f"""
        WITH c AS (SELECT quantile_cont(on_hand, 0.99) AS cap FROM f_snap)
        SELECT max(cap) AS clip_at, (count(*) FILTER (WHERE on_hand > cap))::BIGINT AS clipped_rows, {N} AS snapshot_rows,
               sum(least(on_hand::DOUBLE, cap)) AS clipped_sum FROM f_snap, c""",
    "win_lag_delta": """
        SELECT *, units - lag(units) OVER (PARTITION BY category ORDER BY sale_month) AS delta
        FROM (SELECT category, (date_key // 100)::INTEGER AS sale_month, sum(units_sold_qty)::BIGINT AS units FROM f_sales JOIN d_product USING (product_key) GROUP BY ALL)""",
    "win_rank": f"""SELECT *, rank() OVER (PARTITION BY region ORDER BY sale_lines DESC) AS lines_rank
        FROM (SELECT location_name, region, {N} AS sale_lines FROM f_sales JOIN d_location USING (location_key) GROUP BY ALL)""",
    "win_row_number": f"SELECT product_key, rk AS rev_rank FROM {CURVE.format(c='net_c')}",
    "win_running_sum": f"SELECT product_key, rk AS rev_rank, upto / 100e0 AS running_revenue FROM {CURVE.format(c='gross_c')}",
    "win_total": f"""SELECT category, u AS units, {ratio('u', 'sum(u) OVER ()')} AS unit_share
        FROM (SELECT category, sum(units_sold_qty)::BIGINT AS u FROM f_sales JOIN d_product USING (product_key) GROUP BY ALL)""",
    "win_partition_avg": f"""SELECT location_name, region, r AS revenue, sum(r::DECIMAL(18,2)) OVER p::DOUBLE / count(*) OVER p AS region_avg
        FROM ({STORE_REVENUE}) WINDOW p AS (PARTITION BY region)""".replace("OVER p::DOUBLE", "OVER p / 1e0"),
    "win_dup_flag": f"""SELECT n > 1 AS is_duplicate, price_c IS NULL AS is_price_missing, sum(n)::BIGINT AS row_count, sum(n * units_sold_qty)::BIGINT AS units
        FROM (SELECT {DUP}, count(*) AS n FROM raw_sales GROUP BY ALL) GROUP BY ALL""",
    "sort_multi": """SELECT *, row_number() OVER (ORDER BY region, units % 1000 DESC, location_name) AS position
        FROM (SELECT region, location_name, sum(units_sold_qty)::BIGINT AS units FROM f_sales JOIN d_location USING (location_key) GROUP BY ALL)""",
    "sort_nulls_last": f"""SELECT product_key, location_key, {ratio('on_hand', 'adr', 3)} AS days_of_supply
        FROM snap_now LEFT JOIN {NEED.format(anchor='snap_day')} USING (product_key, location_key)
        ORDER BY days_of_supply ASC NULLS LAST, product_key, location_key LIMIT 500""",
    "topk": "SELECT product_key, sum(units_sold_qty)::BIGINT AS units FROM f_sales GROUP BY ALL ORDER BY units DESC, product_key LIMIT 100",
    "rank_sample": f"SELECT rk AS margin_rank, product_key FROM {CURVE.format(c='margin_c')} WHERE rk % greatest(n // 50, 1) = 0",
    "union_signed": f"SELECT location_key, {N} AS movements, sum(qty)::BIGINT AS net_units FROM {FLOWS} GROUP BY ALL",
    "dedupe_natural": f"""SELECT order_id, date_key, product_key, location_key, units_sold_qty::INTEGER AS units_sold_qty, price_c / 100e0 AS unit_price, copies
        FROM (SELECT {DUP}, {N} AS copies FROM raw_sales GROUP BY ALL)""",
    "impute_from_dim": f"""SELECT product_key, {N} AS rows, count(coalesce(r.price_c, cat.price_c))::BIGINT AS priced,
        {usd('coalesce(r.price_c, cat.price_c)')} AS price_sum FROM raw_sales r JOIN cat ON cat.pk = r.product_key GROUP BY ALL""",
    "recompute_measures": f"""SELECT location_key, {usd('units_sold_qty * price_c')} AS gross, {usd('units_sold_qty * price_c - disc_c')} AS net,
        {usd('units_sold_qty * cost_c')} AS cogs, {usd('units_sold_qty * price_c - disc_c - units_sold_qty * cost_c')} AS margin FROM raw_sales GROUP BY ALL""",
    "coerce_numeric": f"""SELECT product_key, {N} AS rows, count(promotion_key)::BIGINT AS numbers,
        (sum(units_sold_qty) FILTER (WHERE promotion_key IS NOT NULL))::BIGINT AS units FROM f_sales GROUP BY ALL""",
    "trim_strings": "SELECT customer_key, loyalty_tier, CASE WHEN loyalty_tier <> 'None' THEN region END AS region FROM d_customer",
    "clean_sales": f"""SELECT order_id, date_key, product_key, location_key, units_sold_qty::INTEGER AS units_sold_qty, price_c / 100e0 AS unit_price, units_sold_qty * price_c / 100e0 AS gross_sales_amount,
        (units_sold_qty * price_c - disc_c) / 100e0 AS net_sales_amount, units_sold_qty * cost_c / 100e0 AS cogs_amount,
        (units_sold_qty * price_c - disc_c - units_sold_qty * cost_c) / 100e0 AS gross_margin_amount FROM ({FILLED})""",
    "clean_log": "SELECT 'fact_sales' AS table_name, (SELECT count(*) FROM raw_sales)::BIGINT AS rows_in, (SELECT count(*) FROM raw_sales)::BIGINT - count(*)::BIGINT AS duplicates_removed, "
        "(count(*) - count(price_c))::BIGINT AS missing_price_before, 0::BIGINT AS missing_price_after, count(*)::BIGINT AS rows_out FROM (SELECT DISTINCT * FROM raw_sales) "
        + " ".join(f"UNION ALL SELECT '{t}', {N}, NULL, NULL, NULL, {N} FROM {r}" for t, (r, _) in RELATIONS.items() if t != "fact_sales"),
    "dq_ref": " UNION ALL ".join(_orphans(t, c, d) for t, refs in REFERENCES.items() for c, d in refs.items()),
    "dq_unique": " UNION ".join(
        [_twice(f"{t}.{'+'.join(k)} unique", t) for t, k in PRIMARY_KEY.items()] + [_twice(f"{t}.{k} unique", t) for t, k in NATURAL_KEY.items()]),
    "dq_complete": " UNION ".join(
        [_holes(f"{t}.{c} not null", t) for t, cs in REQUIRED.items() for c in cs] + [_check("fact_sales.unit_price not null", "fact_sales", MISSING, sample=True)]),
    "dq_domain": " UNION ALL ".join([
        _check("dim_product.unit_price >= unit_cost", "dim_product", "SELECT count(*) FROM d_product WHERE product_key % 9 = 2 OR price_c < cost_c", False, sample=True),
        _check("dim_location.location_type in domain", "dim_location", "SELECT count(*) FROM d_location WHERE location_key % 6 = 1", sample=True),
        _check("fact_sales.units_sold_qty > 0", "fact_sales", "SELECT count(*) FROM f_sales WHERE product_key % 11 = 3 OR units_sold_qty <= 0", sample=True),
        _check("fact_stock_transfer.source <> destination", "fact_stock_transfer",
               "SELECT count(*) FROM f_trf WHERE product_key % 8 = 5 OR src_key = dst_key", sample=True),
        _check("fact_inventory_snapshot.on_hand_qty >= 0", "fact_inventory_snapshot",
               "SELECT count(*) FROM f_snap WHERE product_key % 10 = 4 OR on_hand < 0", sample=True),
        _check("fact_purchase_order.received_qty <= ordered_qty", "fact_purchase_order",
               "SELECT count(*) FROM f_po WHERE product_key % 13 = 6 OR received_qty > ordered_qty", False, sample=True),
    ]).replace("FROM raw_sales", "FROM f_sales"),
    "dq_consistency": _check("fact_purchase_order.is_otif_flag = on time and in full", "fact_purchase_order",
                             "SELECT count(*) FROM f_po WHERE product_key % 3 = 0", False),
    "dq_gate": _verdict(CORE, "raw") + " UNION ALL " + _verdict(CLEAN_CHECKS, "cleaned"),
    "dq_report": f"""SELECT check_name, is_critical, violations, total, round(1e0 - violations::DOUBLE / total::DOUBLE, 6) AS pass_rate, NULL::VARCHAR AS sample,
        CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM ({CORE})""",
    "dq_incremental": f"""SELECT check_name, is_critical, violations, total, round(1e0 - violations::DOUBLE / total::DOUBLE, 6) AS pass_rate, NULL::VARCHAR AS sample,
        CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS result
        FROM (SELECT check_name, is_critical, violations, total FROM ({CORE}) UNION ALL
              SELECT 'fact_sales.customer_key+product_key unique', false, (count(*) - count(DISTINCT (customer_key, product_key)))::BIGINT, {N} FROM raw_sales)""",
    "dim_date_build": "SELECT date_key, full_date, day_of_week, day_name, is_weekend, week_of_year, month_number, month_name, quarter, year, fiscal_year, fiscal_quarter, season, holiday_name IS NOT NULL AS is_holiday, holiday_name FROM d_date",
    "abc_classify": "SELECT product_key, coalesce(abc_class, 'C') AS abc_class FROM d_product LEFT JOIN abc USING (product_key)",
    "xyz_classify": "SELECT product_key, cv AS demand_cv, xyz_class FROM xyz",
    "po_lifecycle": """SELECT po_number, product_key, order_key AS order_date_key, received_key AS received_date_key, ordered_qty::INTEGER AS ordered_qty, received_qty::INTEGER AS received_qty,
        lead_days AS lead_time_days, is_late AS is_late_flag, is_complete AS is_complete_flag, is_otif AS is_otif_flag FROM f_po""",
    "ledger_rollforward": """SELECT product_key, location_key, strftime(day, '%Y%m%d')::INTEGER AS date_key, receipts::BIGINT AS receipts, demand::BIGINT AS demand,
        on_hand::BIGINT AS on_hand, (demand - unmet)::BIGINT AS sold, unmet::BIGINT AS unmet FROM ledger""",
    "snapshot_flags": f"""SELECT day, {N} AS positions, (count(*) FILTER (WHERE on_hand = 0))::BIGINT AS out,
        (count(*) FILTER (WHERE on_hand <= product_key % 10 + 5))::BIGINT AS below, {usd('on_hand * cost_c')} AS value
        FROM ledger JOIN cat ON cat.pk = product_key GROUP BY day""",
    "abc_revenue_share": f"""
        SELECT abc_class, round(100e0 * (r / (SELECT {usd('gross_c')} FROM f_sales)), 2) AS revenue_share_pct
        FROM (SELECT coalesce(abc_class, 'C') AS abc_class, {usd('gross_c')} AS r FROM f_sales LEFT JOIN abc USING (product_key) GROUP BY ALL)""",
}
