"""DuckDB SQL for the derived star, kept independent of the Spark code.

``with_star(body)`` puts the common table expressions a query needs in front of it. Money is in whole cents (``*_c``);
queries divide by 100e0 after summing.
"""

from __future__ import annotations

import re

STAR: dict[str, str] = {
    "base": """
        SELECT l_orderkey AS okey, l_linenumber AS lno, l_partkey AS pk, l_suppkey AS sk, o_custkey AS ck,
               CAST(o_orderdate AS DATE) AS day,
               ((l_partkey * 7 + (c_nationkey % 3) * 8) % 25)::INTEGER AS place,
               CAST(l_quantity AS BIGINT)
                 * (CASE WHEN l_partkey % 20 = 0 THEN 20 WHEN l_partkey % 20 < 4 THEN 6
                         WHEN l_partkey % 20 < 9 THEN 2 ELSE 1 END) AS units,
               CAST(round(l_discount * 100) AS BIGINT) AS dpc, CAST(round(l_tax * 100) AS BIGINT) AS tpc,
               (l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7) % 100 AS draw,
               l_returnflag, l_linestatus
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey""",
    "cat": """
        SELECT p_partkey AS pk, CAST(round(p_retailprice * 100) AS BIGINT) AS price_c,
               (CAST(round(p_retailprice * 100) AS BIGINT) * (35 + p_partkey % 40)) // 100 AS cost_c FROM part""",
    "horizon": "SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders",
    "d_date": """
        SELECT strftime(g, '%Y%m%d')::INTEGER AS date_key, g::DATE AS full_date, isodow(g)::INTEGER AS day_of_week,
               dayname(g) AS day_name, isodow(g) >= 6 AS is_weekend, weekofyear(g)::INTEGER AS week_of_year,
               month(g)::INTEGER AS month_number, monthname(g) AS month_name, quarter(g)::INTEGER AS quarter,
               year(g)::INTEGER AS year,
               (CASE WHEN month(g) = 1 THEN year(g) - 1 ELSE year(g) END)::INTEGER AS fiscal_year,
               'FQ' || (((month(g) + 10) % 12) // 3 + 1) AS fiscal_quarter,
               CASE WHEN month(g) IN (12, 1, 2) THEN 'Winter' WHEN month(g) <= 5 THEN 'Spring'
                    WHEN month(g) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season,
               CASE strftime(g, '%m-%d') WHEN '01-01' THEN 'New Year' WHEN '07-04' THEN 'Summer Sale'
                    WHEN '11-28' THEN 'Black Friday' WHEN '12-25' THEN 'Christmas' WHEN '12-26' THEN 'Boxing Day'
               END AS holiday_name
        FROM horizon, generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 DAY) AS s(g)""",
    "d_product": """
        SELECT p_partkey AS product_key, printf('SKU-%06d', p_partkey) AS sku,
               p_name AS product_name, p_type AS category, p_brand AS subcategory, p_brand AS brand,
               cost_c, price_c, p_partkey % 12 <> 0 AS is_active
        FROM part JOIN cat ON pk = p_partkey""",
    "abc": """
        SELECT product_key, CASE WHEN upto / whole <= 0.8e0 THEN 'A' WHEN upto / whole <= 0.95e0 THEN 'B' ELSE 'C' END AS abc_class
        FROM (SELECT product_key,
                     (sum(g) OVER (ORDER BY g DESC, product_key ROWS UNBOUNDED PRECEDING) / 100e0) AS upto,
                     (sum(g) OVER () / 100e0) AS whole
              FROM (SELECT product_key, sum(gross_c) AS g FROM f_sales GROUP BY product_key))""",
    "xyz": """
        SELECT product_key, cv,
               CASE WHEN cv < 0.5e0 THEN 'X' WHEN cv < 1e0 THEN 'Y' ELSE 'Z' END AS xyz_class
        FROM (SELECT p.product_key, round(stddev_pop(coalesce(u, 0)) / nullif(avg(coalesce(u, 0)), 0), 6) AS cv
              FROM d_product p CROSS JOIN (SELECT DISTINCT date_key // 100 AS ym FROM d_date)
              LEFT JOIN (SELECT product_key, date_key // 100 AS ym, sum(units_sold_qty) AS u FROM f_sales GROUP BY ALL) m
                USING (product_key, ym)
              GROUP BY p.product_key)""",
    "d_location": """
        SELECT n_nationkey::INTEGER AS location_key, printf('LOC-%03d', n_nationkey) AS location_id,
               CASE WHEN n_nationkey >= 20 THEN 'WAREHOUSE' ELSE 'STORE' END AS location_type,
               n_name AS location_name, r_name AS region,
               CASE WHEN n_nationkey >= 20 THEN (200000 + 1000 * n_nationkey)::INTEGER END AS warehouse_capacity_units
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "d_supplier": """
        SELECT s_suppkey AS supplier_key, s_name AS supplier_name, n_name AS country, r_name AS region,
               CASE WHEN s_suppkey % 20 < 7 THEN 'Gold' WHEN s_suppkey % 20 < 16 THEN 'Silver' ELSE 'Bronze' END AS reliability_tier,
               CASE WHEN s_suppkey % 20 < 7 THEN 7 WHEN s_suppkey % 20 < 16 THEN 12 ELSE 20 END AS lead0,
               CASE WHEN s_suppkey % 20 < 7 THEN 5 WHEN s_suppkey % 20 < 16 THEN 18 ELSE 38 END AS late_pct,
               s_nationkey
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "d_customer": """
        SELECT c_custkey AS customer_key,
               CASE WHEN c_custkey % 20 < 11 THEN 'None' WHEN c_custkey % 20 < 17 THEN 'Silver' ELSE 'Gold' END AS loyalty_tier,
               r_name AS region
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "f_sales": """
        SELECT 'ORD-' || okey AS order_id, day, strftime(day, '%Y%m%d')::INTEGER AS date_key, base.pk AS product_key,
               place AS location_key, ck AS customer_key, (1 + okey % 120)::INTEGER AS employee_key,
               CASE WHEN dpc >= 7 THEN dpc::INTEGER END AS promotion_key, units AS units_sold_qty,
               price_c, units * price_c AS gross_c,
               CASE WHEN dpc >= 7 THEN units * price_c * dpc // 100 ELSE 0 END AS disc_c,
               units * price_c - CASE WHEN dpc >= 7 THEN units * price_c * dpc // 100 ELSE 0 END AS net_c,
               cost_c, units * cost_c AS cogs_c,
               units * price_c - CASE WHEN dpc >= 7 THEN units * price_c * dpc // 100 ELSE 0 END - units * cost_c AS margin_c,
               okey, base.pk, draw
        FROM base JOIN cat ON cat.pk = base.pk""",
    "raw_sales": """
        SELECT * EXCLUDE (okey, pk, draw) FROM (
          SELECT * REPLACE (CASE WHEN draw = 0 THEN NULL ELSE price_c END AS price_c) FROM f_sales)
        UNION ALL
        SELECT * EXCLUDE (okey, pk, draw) FROM (
          SELECT * REPLACE (CASE WHEN draw = 0 THEN NULL ELSE price_c END AS price_c) FROM f_sales
          WHERE (okey + pk) % 250 = 0)""",
    "f_po": """
        SELECT *, coalesce(received_key > expected_key, false) AS is_late, received_qty >= ordered_qty AS is_complete,
               NOT coalesce(received_key > expected_key, false) AND received_qty >= ordered_qty AS is_otif
        FROM (SELECT 'PO-' || okey AS po_number, day AS ordered_on, strftime(day, '%Y%m%d')::INTEGER AS order_key,
                     strftime(least(day + lead0::INTEGER, hi), '%Y%m%d')::INTEGER AS expected_key,
                     CASE WHEN day + lead <= hi THEN day + lead END AS received_on,
                     CASE WHEN day + lead <= hi THEN strftime(day + lead, '%Y%m%d')::INTEGER END AS received_key,
                     CASE WHEN day + lead <= hi THEN lead END AS lead_days,
                     product_key, supplier_key, place AS location_key, units AS ordered_qty,
                     CASE WHEN day + lead > hi THEN 0 WHEN draw % 17 = 0 THEN units * 85 // 100 ELSE units END AS received_qty,
                     units * cost_c AS amount_c
              FROM (SELECT b.*, s.supplier_key, s.lead0, cat.cost_c, b.pk AS product_key, hi,
                           (CASE WHEN draw < late_pct THEN lead0 + 3 + draw % 9 ELSE lead0 - draw % 3 END)::INTEGER AS lead
                    FROM (SELECT *, CASE WHEN pk % 3 = 0 THEN pk % (SELECT count(*) FROM supplier) ELSE sk END AS vendor
                          FROM base WHERE l_linestatus = 'O') b
                    JOIN d_supplier s ON s.supplier_key = b.vendor JOIN cat ON cat.pk = b.pk, horizon))""",
    "f_ret": """
        SELECT 'RET-' || okey || '-' || lno AS return_id, day, strftime(day, '%Y%m%d')::INTEGER AS date_key,
               base.pk AS product_key, place AS location_key, ck AS customer_key,
               greatest(1, units // 2) AS returned_qty, greatest(1, units // 2) * price_c AS refund_c,
               (['Defective', 'Wrong Item', 'Not As Described', 'Changed Mind', 'Damaged in Transit', 'Better Price Elsewhere'])[draw % 6 + 1] AS reason
        FROM base JOIN cat ON cat.pk = base.pk WHERE l_returnflag = 'R'""",
    "f_trf": """
        SELECT strftime(day, '%Y%m%d')::INTEGER AS date_key, base.pk AS product_key,
               s_nationkey::INTEGER AS src_key, place AS dst_key, units AS qty, units * (50 + 10 * tpc) AS cost_c
        FROM base JOIN supplier ON s_suppkey = sk WHERE dpc = 0 AND s_nationkey <> place""",
    "moves": """
        SELECT product_key, location_key, day, sum(r) AS receipts, sum(d) AS demand
        FROM (SELECT product_key, location_key, received_on AS day, received_qty AS r, 0 AS d FROM f_po WHERE received_on IS NOT NULL
              UNION ALL SELECT product_key, location_key, day, 0, units_sold_qty FROM f_sales)
        GROUP BY ALL""",
    "ledger": """
        SELECT product_key, location_key, day, receipts, demand, x - m AS on_hand,
               coalesce(lag(m) OVER (PARTITION BY product_key, location_key ORDER BY day), 0) - m AS unmet
        FROM (SELECT *, least(0, min(x) OVER (PARTITION BY product_key, location_key ORDER BY day ROWS UNBOUNDED PRECEDING)) AS m
              FROM (SELECT *, (product_key % 10) * (CASE WHEN product_key % 20 = 0 THEN 20 WHEN product_key % 20 < 4 THEN 6
                                                         WHEN product_key % 20 < 9 THEN 2 ELSE 1 END)
                       + sum(receipts - demand) OVER (PARTITION BY product_key, location_key ORDER BY day ROWS UNBOUNDED PRECEDING) AS x
                    FROM moves))""",
    "ends": """
        SELECT full_date AS day FROM d_date, (SELECT max(full_date) AS final FROM d_date)
        WHERE full_date = last_day(full_date) OR full_date >= (final - INTERVAL 4 MONTH)::DATE OR full_date = final""",
    "on_order": """
        SELECT product_key, location_key, ends.day, sum(ordered_qty) AS q
        FROM f_po JOIN ends ON ordered_on <= ends.day AND (received_on IS NULL OR ends.day < received_on) GROUP BY ALL""",
    "f_snap": """
        SELECT want.day, strftime(want.day, '%Y%m%d')::INTEGER AS date_key, want.product_key, want.location_key,
               l.on_hand::BIGINT AS on_hand, l.on_hand * cost_c AS value_c, coalesce(o.q, 0)::BIGINT AS on_order,
               (5 + want.product_key % 10)::INTEGER AS reorder_point, (2 + want.product_key % 5)::INTEGER AS safety_stock,
               l.on_hand <= 5 + want.product_key % 10 AS is_below, l.on_hand = 0 AS is_out
        FROM (SELECT product_key, location_key, ends.day FROM (SELECT DISTINCT product_key, location_key FROM moves), ends) want
        ASOF JOIN ledger l ON l.product_key = want.product_key AND l.location_key = want.location_key AND want.day >= l.day
        JOIN cat ON cat.pk = want.product_key
        LEFT JOIN on_order o ON o.product_key = want.product_key AND o.location_key = want.location_key AND o.day = want.day""",
    "snap_now": "SELECT * FROM f_snap WHERE date_key = (SELECT max(date_key) FROM f_snap)",
    "snap_day": """
        SELECT max(full_date) AS anchor FROM d_date WHERE date_key <= (SELECT max(date_key) FROM f_snap)""",
    "cal_day": "SELECT max(full_date) AS anchor FROM d_date",
    "stock": """
        SELECT product_key, sum(on_hand)::BIGINT AS q, sum(value_c) / 100e0 AS v FROM snap_now GROUP BY product_key""",
    "sold_last": "SELECT product_key, max(day) AS last_sold_date FROM f_sales GROUP BY product_key",
    "rate90": """
        SELECT product_key, sum(units_sold_qty) / 90e0 AS adr FROM f_sales, cal_day
        WHERE day >= anchor - 90 GROUP BY product_key""",
}


def _needs(text: str) -> set[str]:
    return {name for name in STAR if re.search(rf"\b{name}\b", text)}


def with_star(body: str) -> str:
    """``body`` preceded by the common table expressions it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in sorted(_needs(STAR[name]) - {name}):
            visit(other)
        order.append(name)

    for name in sorted(_needs(body)):
        visit(name)
    body = body.strip()
    if not order:
        return body
    ctes = ",\n".join(f"{name} AS ({' '.join(STAR[name].split())})" for name in order)
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def ratio(num: str, den: str, digits: int | None = None, scale: str = "") -> str:
    """Quotient in double precision, NULL on zero."""
    top = f"{scale} * ({num})::DOUBLE" if scale else f"({num})::DOUBLE"
    quotient = f"{top} / nullif(({den})::DOUBLE, 0)"
    return quotient if digits is None else f"round({quotient}, {digits})"


def pct(num: str, den: str, digits: int | None = None) -> str:
    return ratio(num, den, digits, "100e0")


def usd(cents: str) -> str:
    """Sum of cents as money."""
    return f"(sum({cents}) / 100e0)"
