"""Independent SQL statements for the registered queries.

Written for an analytic SQL engine without reference to the Spark code. Named
building blocks are put in front of a statement when it uses them.
"""

from __future__ import annotations

import re

TYPES = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}


def half_up(num: str, den: str, places: int) -> str:
    """num / den rounded half up in whole numbers; NULL for a zero denominator."""
    n, d = (f"CAST(CAST({x} AS DECIMAL(22,4)) * 10000 AS HUGEINT)" for x in (num, den))
    p = 10**places
    quotient = f"(2 * abs({n}) * {p} + abs({d})) // (2 * abs({d}))"
    return (
        f"CASE WHEN {d} = 0 THEN NULL ELSE "
        f"sign({n})::INT * sign({d})::INT * CAST({quotient} AS DOUBLE) / {p} END"
    )


def or_zero(value: str, guard: str) -> str:
    return f"CASE WHEN {guard} <> 0 THEN {value} ELSE 0 END"


def calendar_of(source: str, day: str) -> str:
    """All rows of ``source`` with the calendar attributes of its date column."""
    return f"""
    SELECT * EXCLUDE (mo_, first_, y_, reg_),
        (reg_ // 13) + 1 AS commerce_quarter,
        (reg_ // 13) * 3 + CASE WHEN reg_ % 13 < 4 THEN 1 WHEN reg_ % 13 < 8 THEN 2 ELSE 3 END
            AS commerce_month,
        y_ || '-' || lpad(((reg_ // 13) * 3 + CASE WHEN reg_ % 13 < 4 THEN 1
            WHEN reg_ % 13 < 8 THEN 2 ELSE 3 END)::VARCHAR, 2, '0') AS commerce_period,
        commerce_week - 13 * (reg_ // 13) AS quarter_week,
        y_ AS commerce_year,
        isoyear({day}) AS iso_year, week({day}) AS iso_week, isodow({day}) AS day_of_week,
        ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][isodow({day})] AS day_name,
        isodow({day}) >= 6 AS is_weekend,
        strftime({day} - 364, '%Y%m%d')::BIGINT AS date_key_sss,
        strftime({day} - INTERVAL 1 YEAR, '%Y%m%d')::BIGINT AS date_key_mc
    FROM (
        SELECT *, least(commerce_week, 52) - 1 AS reg_
        FROM (
            SELECT *, (mo_ - (first_ - (isodow(first_) - 1)::INT)) // 7 + 1 AS commerce_week
            FROM (
                SELECT *, year(mo_ + 6) AS y_, make_date(year(mo_ + 6), 1, 1) AS first_
                FROM (SELECT *, {day} - (isodow({day}) - 1)::INT AS mo_ FROM {source})
            )
        )
    )"""


def first_per(source: str, keys: str, order: str) -> str:
    """The first row per key, NULLs first."""
    by = ", ".join(f"{c.strip()} NULLS FIRST" for c in order.split(","))
    return f"""SELECT * EXCLUDE (rn_) FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {by}) AS rn_ FROM {source}
    ) WHERE rn_ = 1"""


BLOCKS = {
    "lines": """
        SELECT *, round(net_amount::DOUBLE * 0.19 / 1.19, 2)::DECIMAL(18,4) AS tax_amount
        FROM (
            SELECT *, (gross_amount - discount_amount)::DECIMAL(18,4) AS net_amount
            FROM (
                SELECT l_orderkey::VARCHAR AS txn_id, l_linenumber AS line_id,
                    l_shipdate::DATE AS txn_date,
                    strftime(l_shipdate, '%Y%m%d')::BIGINT AS date_key,
                    l_suppkey AS store_key, l_partkey AS product_key,
                    'SKU-' || l_partkey AS sku, l_quantity::INT AS unit_qty,
                    l_extendedprice::DECIMAL(18,4) AS gross_amount,
                    round(l_extendedprice::DECIMAL(18,4) * l_discount::DECIMAL(4,2), 2)
                        ::DECIMAL(18,4) AS discount_amount,
                    round(l_extendedprice::DECIMAL(18,4) * 0.6, 2)::DECIMAL(18,4) AS cost_amount,
                    l_discount::DECIMAL(4,2) > 0.05 AS is_promo, l_returnflag AS return_flag
                FROM lineitem
            )
        )""",
    "stores": """
        SELECT s_suppkey AS store_key, 'ST' || s_suppkey AS store_code, s_name AS name,
            CASE s_suppkey % 3 WHEN 0 THEN 'hyper' WHEN 1 THEN 'super' ELSE 'express' END
                AS chain_format,
            r_name AS region, n_name AS city, n_name || ' ' || s_suppkey AS address,
            CASE WHEN s_suppkey % 17 = 5 THEN 0 ELSE 400 + s_suppkey * 37 % 5000 END AS open_m2,
            DATE '1990-01-01' + (s_suppkey % 1000)::INT AS open_date,
            CASE s_suppkey % 4 WHEN 0 THEN 'Active' WHEN 1 THEN 'Planned' WHEN 2 THEN 'Closed' END
                AS status
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
            JOIN region ON n_regionkey = r_regionkey""",
    "products": """
        SELECT p_partkey AS product_key, 'SKU-' || p_partkey AS sku,
            (p_partkey * 7919 + 123456789)::VARCHAR AS ean, p_name AS name, p_brand AS brand,
            p_type AS category,
            CASE p_type WHEN 'PROMO' THEN 'Perishables' WHEN 'LARGE' THEN 'Nonfood'
                WHEN 'ECONOMY' THEN 'Textile' ELSE 'Grocery' END AS dept,
            p_retailprice::DECIMAL(18,4) AS retail_price,
            round(p_retailprice::DECIMAL(18,4) * 0.6, 2)::DECIMAL(18,4) AS unit_cost,
            CASE p_partkey % 4 WHEN 0 THEN 'KG' WHEN 1 THEN 'EA' WHEN 2 THEN 'LT' ELSE 'PACK' END
                AS uom,
            CASE WHEN p_partkey % 4 = 0
                THEN (p_size::DECIMAL(10,3) * 0.1 + 0.125)::DECIMAL(10,3) END AS barcode_weight_kg
        FROM part""",
    "calendar": calendar_of(
        """(SELECT d::DATE AS date_value, strftime(d, '%Y%m%d')::BIGINT AS date_key FROM (
            SELECT unnest(generate_series(min(l_shipdate)::DATE, max(l_shipdate)::DATE,
                INTERVAL 1 DAY)) AS d FROM lineitem))""",
        "date_value",
    ),
    "plan_calendar": calendar_of(
        """(SELECT d::DATE AS date_value FROM (
            SELECT unnest(generate_series(min(l_shipdate)::DATE, max(l_shipdate)::DATE + 400,
                INTERVAL 1 DAY)) AS d FROM lineitem))""",
        "date_value",
    ),
    "sales": """
        SELECT date_key, store_key, product_key, sku, sum(unit_qty) AS unit_qty,
            sum(gross_amount) AS gross_sales, sum(net_amount) AS net_sales,
            sum(discount_amount) AS discount_amount, sum(tax_amount) AS tax_amount,
            sum(cost_amount) AS cost_amount, count(*) AS ticket_count, count(*) AS line_count,
            count(*) FILTER (WHERE is_promo) AS promo_line_count
        FROM lines GROUP BY ALL""",
    "fact_sales": f"""
        SELECT *, net_sales - cost_amount AS margin_amount,
            {or_zero(half_up("net_sales - cost_amount", "net_sales", 6), "net_sales")} AS margin_pct
        FROM sales""",
    "store_day": """
        SELECT date_key, txn_date AS date_value, store_key, sum(unit_qty) AS unit_qty,
            sum(gross_amount) AS gross_sales, sum(net_amount) AS net_sales,
            sum(discount_amount) AS discount_amount, sum(tax_amount) AS tax_amount,
            sum(cost_amount) AS cost_amount,
            count(*) FILTER (WHERE is_promo) AS promo_line_count
        FROM lines GROUP BY ALL""",
    "kpi": f"""
        SELECT date_key, store_key, ticket_count, ticket_count AS transaction_count,
            {half_up("net_sales", "greatest(ticket_count, 1)", 2)} AS avg_basket,
            {half_up("net_sales * 1000", "greatest(open_m2, 1)", 2)} AS sales_m2,
            gross_sales, net_sales, ticket_count * 14 // 10 AS traffic_estimate
        FROM (
            SELECT date_key, store_key, count(DISTINCT txn_id) AS ticket_count,
                sum(gross_amount) AS gross_sales, sum(net_amount) AS net_sales
            FROM lines GROUP BY ALL
        ) LEFT JOIN stores USING (store_key)""",
    "sold": """
        SELECT date_key, store_key, count(DISTINCT txn_id) AS ticket_count,
            count(DISTINCT txn_id) AS transaction_count,
            count(DISTINCT txn_id) * 14 // 10 AS traffic_estimate
        FROM lines WHERE return_flag <> 'R' GROUP BY ALL""",
    "base": """
        SELECT b.*, c.* EXCLUDE (date_key, date_value), chain_format, open_m2, ticket_count,
            transaction_count, traffic_estimate
        FROM store_day b JOIN calendar c USING (date_key) JOIN stores s USING (store_key)
            LEFT JOIN sold k ON k.date_key = b.date_key AND k.store_key = b.store_key""",
    "fact_store_day": f"""
        SELECT b.*,
            sum(b.net_sales) OVER (PARTITION BY b.store_key, b.commerce_year, b.commerce_month
                ORDER BY b.date_key ROWS UNBOUNDED PRECEDING) AS mtd_sales,
            sum(b.net_sales) OVER (PARTITION BY b.store_key, b.commerce_year
                ORDER BY b.date_key ROWS UNBOUNDED PRECEDING) AS ytd_sales,
            {or_zero("b.discount_amount::DOUBLE / nullif(b.gross_sales::DOUBLE, 0)", "b.gross_sales")}
                AS discount_rate,
            {or_zero("b.net_sales::DOUBLE / nullif(b.ticket_count::DOUBLE, 0)", "b.ticket_count")}
                AS avg_basket,
            {or_zero("b.net_sales::DOUBLE / nullif(b.open_m2::DOUBLE, 0)", "b.open_m2")} AS sales_m2,
            ly.net_sales AS net_sales_sss, ly.unit_qty AS unit_qty_sss,
            ly.ticket_count AS ticket_count_sss,
            {half_up("b.net_sales - ly.net_sales", "ly.net_sales", 6)} AS sss_variation_pct,
            mc.net_sales AS net_sales_mc,
            {half_up("b.net_sales - mc.net_sales", "mc.net_sales", 6)} AS mc_variation_pct
        FROM base b
            LEFT JOIN base ly ON ly.store_key = b.store_key AND ly.date_key = b.date_key_sss
            LEFT JOIN base mc ON mc.store_key = b.store_key AND mc.date_key = b.date_key_mc""",
    "flows": """
        SELECT date_key, store_key, product_key, sku,
            sum(CASE WHEN return_flag <> 'R' THEN unit_qty END) AS sold_qty,
            sum(CASE WHEN return_flag = 'R' THEN unit_qty ELSE 0 END) AS received_qty,
            (date_key + product_key) % 7 - 3 AS adjusted_qty,
            (store_key + product_key) % 5 AS in_transit_qty
        FROM lines GROUP BY ALL""",
    "inventory": """
        SELECT * EXCLUDE (free_), round(on_hand_qty * unit_cost, 2) AS on_hand_cost,
            CASE WHEN on_hand_qty > 4 THEN 'IN_STOCK' WHEN on_hand_qty > 0 THEN 'LOW_STOCK'
                ELSE 'OUT_OF_STOCK' END AS stock_state
        FROM (
            SELECT f.*, unit_cost, retail_price,
                (free_ - least(0, min(free_) OVER (PARTITION BY store_key, product_key
                    ORDER BY date_key ROWS UNBOUNDED PRECEDING)))::BIGINT AS on_hand_qty
            FROM (
                SELECT *, (store_key * 7 + product_key * 3) % 31
                    + sum(received_qty - coalesce(sold_qty, 0) + adjusted_qty) OVER (
                        PARTITION BY store_key, product_key ORDER BY date_key
                        ROWS UNBOUNDED PRECEDING) AS free_
                FROM flows
            ) f JOIN products USING (product_key)
        )""",
    "fact_inventory": f"""
        SELECT *, {half_up("on_hand_qty", "nullif(sold_qty, 0)", 2)} AS days_on_hand,
            {or_zero(half_up("sold_qty", "on_hand_qty + sold_qty", 6), "on_hand_qty + sold_qty")}
                AS sell_through_pct,
            on_hand_qty * unit_cost AS stock_value
        FROM inventory""",
    "budget": """
        SELECT p.*, (SELECT min(date_value) FROM plan_calendar c
            WHERE c.commerce_period = p.commerce_period) AS calendar_month_start
        FROM (
            SELECT (commerce_year + 1) || '-' || lpad(commerce_month::VARCHAR, 2, '0')
                    AS commerce_period,
                store_key, dept,
                greatest(round(sum(net_amount) * 1.05 - 2000, 2), 0)::DECIMAL(18,4)
                    AS budget_amount,
                sum(unit_qty) AS budget_qty_units
            FROM lines JOIN calendar USING (date_key) JOIN products USING (product_key)
            GROUP BY commerce_year, commerce_month, store_key, dept
        ) p""",
    "fact_budget": f"""
        SELECT b.*, actual_sales,
            {half_up("actual_sales", "budget_amount", 6)} AS budget_usage_pct,
            actual_sales - budget_amount AS budget_gap
        FROM budget b LEFT JOIN (
            SELECT commerce_period, store_key, sum(net_sales) AS actual_sales
            FROM base GROUP BY ALL
        ) USING (commerce_period, store_key)""",
}


def statement(columns: str, body: str) -> str:
    """A full statement: used blocks, the body, and a typed select list.

    ``columns`` reads ``name:i name:d …`` with i, d, s, b for the four types.
    """
    used: list[str] = []

    def need(text: str) -> None:
        for name, block in BLOCKS.items():
            if name not in used and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(block)
                if name not in used:
                    used.append(name)

    need(body)
    blocks = "".join(f"{n} AS ({BLOCKS[n]}),\n" for n in used)
    picks = [c.split(":") for c in columns.split()]
    chosen = ", ".join(f'CAST("{n}" AS {TYPES[t]}) AS "{n}"' for n, t in picks)
    return f"WITH {blocks}result_ AS ({body})\nSELECT {chosen} FROM result_"
