"""DuckDB statements that say, independently of the Spark code, what each registered query should return.

Each relation is one entry of RELATIONS; a statement pulls in the relations it needs as CTEs.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-08-15'"
CUT = "DATE '2001-06-15'"
OVERLAP = "DATE '2001-05-01'"

_BREAKS = r'[!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>\s]'
_NOT_BREAKS = r'[^!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>\s]'


def _title(expr: str) -> str:
    words = f"regexp_extract_all(lower({expr}), '{_NOT_BREAKS}*{_BREAKS}|{_NOT_BREAKS}+')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), '')"


def _day(expr: str) -> str:
    # The feeds have no times of day.
    return f"CASE WHEN regexp_full_match({expr}, '\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') THEN try_cast({expr} AS DATE) END"


def _flag(expr: str) -> str:
    return f"lower({expr}) IN ('true', 't', 'yes', 'y', '1', 'on')"


def _key(expr: str) -> str:
    return f"md5(coalesce({expr}, '_dbt_utils_surrogate_key_null_'))"


def _mean(expr: str, scale: int, digits: int, result: str) -> str:
    """Exact mean of non-negative decimals, rounded half up, in integers (a plain avg is a double)."""
    units = f"CAST(sum({expr}) * {10**scale} AS HUGEINT) * {10 ** (digits - scale)}"
    return (f"CAST(CAST((2 * {units} + count({expr})) // nullif(2 * count({expr}), 0) AS DECIMAL(28,0)) "
            f"* CAST({10.0 ** -digits:.{digits}f} AS DECIMAL({digits},{digits})) AS {result})")


def _raw_orders(day: str) -> str:
    return f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_totalprice < 1500 OR o_totalprice > 3000 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_orderkey // 7 AS VARCHAR) END AS product_id,
               {day} AS order_date,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 0.001::DECIMAL(4,3) AS DECIMAL(18,6)) AS order_amount_usd,
               CASE o_orderpriority WHEN '2-HIGH' THEN 'gbp' WHEN '3-MEDIUM' THEN 'eur' WHEN '5-LOW' THEN 'jpy'
                    ELSE 'usd' END AS currency_code,
               CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'P' THEN 'RETURNED'
                    WHEN o_orderpriority = '5-LOW' THEN 'Cancelled' ELSE 'pending' END AS status,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Online' WHEN '2-HIGH' THEN 'ONLINE'
                    WHEN '3-MEDIUM' THEN 'Phone' ELSE 'Retail' END AS channel,
               CASE o_orderpriority WHEN '2-HIGH' THEN 'uk' WHEN '3-MEDIUM' THEN 'eu' WHEN '5-LOW' THEN 'jp'
                    ELSE 'us' END AS region
        FROM orders"""


def _stg_orders(source: str) -> str:
    typed = source not in ("raw_orders", "csv_orders")      # those two have dates as text
    return f"""
        SELECT order_id, customer_id, product_id,
               {"order_date" if typed else _day("order_date")} AS order_date,
               CAST(order_amount_usd AS DECIMAL(12,2)) AS order_amount_usd,
               upper(currency_code) AS currency_code, lower(status) AS order_status,
               lower(channel) AS order_channel, upper(region) AS region
        FROM {source}"""


def _stg_transactions(source: str) -> str:
    return f"""
        SELECT transaction_id, order_id, {_day("transaction_date")} AS transaction_date,
               CAST(amount_usd AS DECIMAL(12,4)) AS amount_usd, upper(currency_code) AS currency_code,
               CAST(fx_rate AS DECIMAL(10,6)) AS fx_rate,
               CAST(round(CAST(amount_usd AS DECIMAL(16,6)) * CAST(fx_rate AS DECIMAL(10,6)), 2) AS DECIMAL(18,2))
                   AS amount_local,
               lower(payment_method) AS payment_method, lower(transaction_type) AS transaction_type, gl_account,
               {_flag("is_reconciled")} AS is_reconciled
        FROM {source}"""


def _daily(source: str) -> str:
    return f"""
        SELECT transaction_date AS rate_date, currency_code,
               {_mean("fx_rate", 6, 10, "DECIMAL(14,10)")} AS fx_rate,
               count(*) AS transaction_count,
               CAST(coalesce(sum(amount_usd) FILTER (transaction_type = 'sale'), 0) AS DECIMAL(22,4))
                   AS total_sales_usd,
               CAST(coalesce(sum(amount_usd) FILTER (transaction_type = 'refund'), 0) AS DECIMAL(22,4))
                   AS total_refunds_usd,
               CAST(sum(amount_usd) AS DECIMAL(22,4)) AS net_revenue_usd,
               count(*) FILTER (is_reconciled) AS reconciled_count,
               count(*) FILTER (NOT is_reconciled) AS unreconciled_count
        FROM {source} GROUP BY ALL"""


def _customers(as_of: str) -> str:
    return f"""
        SELECT customer_id, {_title("first_name")} AS first_name, {_title("last_name")} AS last_name,
               lower(email) AS email, phone AS phone_number, upper(country) AS country_code, {_title("city")} AS city,
               {_day("signup_date")} AS signup_date, lower(customer_segment) AS customer_segment,
               {_flag("is_active")} AS is_active,
               CAST(date_diff('day', {_day("signup_date")}, {as_of}) AS INTEGER) AS days_since_signup
        FROM raw_customers"""


def _enriched(orders: str, daily: str) -> str:
    # order_status may be missing in general; here it never is, so plain comparisons do.
    return f"""
        SELECT o.order_id, o.customer_id, o.product_id, o.order_date, o.order_status, o.order_channel, o.region,
               o.order_amount_usd, o.currency_code,
               coalesce(f.fx_rate, CAST(1 AS DECIMAL(14,10))) AS fx_rate,
               CAST(round(o.order_amount_usd * coalesce(f.fx_rate, CAST(1 AS DECIMAL(14,10))), 2) AS DECIMAL(18,2))
                   AS order_amount_local,
               c.customer_segment, c.country_code AS customer_country, c.days_since_signup, p.product_name,
               p.category, p.subcategory, p.unit_cost_usd, p.list_price_usd, p.gross_margin_pct,
               o.order_status = 'completed' AS is_completed, o.order_status = 'returned' AS is_returned,
               o.order_status = 'cancelled' AS is_cancelled,
               CAST(if(o.order_status = 'completed', o.order_amount_usd, 0) AS DECIMAL(12,2)) AS recognized_revenue_usd,
               CAST(if(o.order_status = 'completed', o.order_amount_usd - p.unit_cost_usd, 0) AS DECIMAL(13,2))
                   AS gross_profit_usd
        FROM {orders} o LEFT JOIN stg_customers c USING (customer_id) LEFT JOIN stg_products p USING (product_id)
             LEFT JOIN {daily} f ON f.rate_date = o.order_date AND f.currency_code = o.currency_code"""


def _customer_360(orders: str, customers: str, as_of: str) -> str:
    return f"""
        SELECT c.customer_id, c.customer_segment, c.country_code, c.city, c.signup_date, c.days_since_signup,
               c.is_active, count(o.order_id) AS total_orders,
               count(*) FILTER (o.is_completed) AS completed_orders,
               count(*) FILTER (o.is_returned) AS returned_orders,
               count(*) FILTER (o.is_cancelled) AS cancelled_orders,
               CAST(coalesce(sum(o.recognized_revenue_usd), 0) AS DECIMAL(22,2)) AS lifetime_revenue_usd,
               CAST(coalesce(sum(o.gross_profit_usd), 0) AS DECIMAL(22,2)) AS lifetime_gross_profit_usd,
               {_mean("if(o.is_completed, o.order_amount_usd, NULL)", 2, 6, "DECIMAL(16,6)")} AS avg_order_value_usd,
               min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date,
               CAST(date_diff('day', max(o.order_date), {as_of}) AS INTEGER) AS days_since_last_order,
               max(o.order_channel) AS preferred_channel, max(o.region) AS primary_region,
               CASE WHEN max(o.order_date) >= {as_of} - 30 THEN 'active'
                    WHEN max(o.order_date) >= {as_of} - 90 THEN 'at_risk'
                    WHEN max(o.order_date) >= {as_of} - 180 THEN 'lapsed' ELSE 'churned' END AS rfm_status,
               CASE WHEN sum(o.recognized_revenue_usd) >= 1000 THEN 'high'
                    WHEN sum(o.recognized_revenue_usd) >= 300 THEN 'medium' ELSE 'low' END AS clv_band
        FROM {customers} c LEFT JOIN {orders} o ON o.customer_id = c.customer_id
        GROUP BY ALL"""


def _transaction_facts(transactions: str, daily: str) -> str:
    return f"""
        SELECT {_key("transaction_id")} AS transaction_sk, t.transaction_id, t.order_id, t.transaction_date,
               CAST(year(t.transaction_date) AS INTEGER) AS transaction_year,
               CAST(month(t.transaction_date) AS INTEGER) AS transaction_month,
               CAST(quarter(t.transaction_date) AS INTEGER) AS transaction_quarter,
               t.payment_method, t.transaction_type, t.gl_account, t.currency_code, t.is_reconciled, t.amount_usd,
               t.fx_rate, t.amount_local, d.total_sales_usd AS daily_total_sales_usd,
               d.total_refunds_usd AS daily_total_refunds_usd, d.net_revenue_usd AS daily_net_revenue_usd,
               d.transaction_count AS daily_transaction_count,
               CAST(if(t.transaction_type = 'sale', t.amount_usd, 0) AS DECIMAL(12,4)) AS sale_amount_usd,
               CAST(if(t.transaction_type = 'refund', t.amount_usd, 0) AS DECIMAL(12,4)) AS refund_amount_usd
        FROM {transactions} t
             LEFT JOIN {daily} d ON d.rate_date = t.transaction_date AND d.currency_code = t.currency_code"""


RELATIONS = {
    "raw_orders": _raw_orders(
        "CASE WHEN o_totalprice < 1300 THEN strftime(o_orderdate, '%Y') WHEN o_totalprice < 1500 THEN 'unknown' "
        "ELSE strftime(o_orderdate, '%Y-%m-%d') END"),
    "dated_orders": _raw_orders("CAST(o_orderdate AS DATE)"),
    "raw_customers": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'mary-' || lower(c_mktsegment) AS first_name,
               c_name AS last_name, 'C' || c_custkey || '@Example.com' AS email,
               '+' || c_nationkey || '-555-' || c_custkey AS phone, lower(n_name) AS country, r_name AS city,
               CASE WHEN c_acctbal < 0 THEN 'n/a'
                    ELSE strftime(DATE '1993-01-01' + CAST(floor(c_acctbal / 10) AS INTEGER), '%Y-%m-%d') END
                   AS signup_date,
               c_mktsegment AS customer_segment,
               CASE WHEN c_acctbal < 0 THEN 'off' WHEN c_acctbal < 5000 THEN 'Yes' ELSE 'true' END AS is_active
        FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "priced_parts": "SELECT *, CAST(p_retailprice AS DECIMAL(12,2)) * 0.1::DECIMAL(2,1) AS price FROM part",
    "raw_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
               p_name || '/' || lower(p_brand) AS subcategory,
               CAST(price * CAST(CAST(30 + p_size AS DECIMAL(4,0)) * 0.01::DECIMAL(3,2) AS DECIMAL(6,2))
                    AS DECIMAL(18,6)) AS unit_cost_usd,
               CAST(if(p_size = 50, 0, price) AS DECIMAL(18,6)) AS list_price_usd,
               if(p_size = 1, 'no', '1') AS is_active,
               if(p_type = 'PROMO', 'tbd', strftime(DATE '1994-01-01' + p_size, '%Y-%m-%d')) AS launch_date,
               'S' || p_size AS supplier_id
        FROM priced_parts""",
    "raw_transactions": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d'))
                   AS transaction_id,
               CAST(l_orderkey AS VARCHAR) AS order_id,
               if(l_extendedprice < 1000, 'pending', strftime(l_shipdate, '%Y-%m-%d')) AS transaction_date,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                    AS DECIMAL(18,6)) AS amount_usd,
               CASE l_linenumber WHEN 4 THEN 'gbp' WHEN 5 THEN 'eur' WHEN 6 THEN 'jpy' WHEN 7 THEN 'chf'
                    ELSE 'usd' END AS currency_code,
               CAST(1 + CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,6)) AS fx_rate,
               CASE WHEN l_discount >= 0.08::DOUBLE THEN 'PayPal' WHEN l_discount >= 0.05::DOUBLE THEN 'Bank_Transfer'
                    WHEN l_discount >= 0.02::DOUBLE THEN 'debit_card' ELSE 'CREDIT_CARD' END AS payment_method,
               CASE l_returnflag WHEN 'R' THEN 'Refund' WHEN 'N' THEN 'SALE' ELSE 'adjustment' END AS transaction_type,
               if(l_returnflag = 'R', '4200-RETURNS', '4000-REVENUE') AS gl_account,
               if(l_linestatus = 'F', 'true', 'f') AS is_reconciled
        FROM lineitem""",
    "stg_orders": _stg_orders("raw_orders"),
    "stg_customers": _customers(AS_OF),
    "stg_products": f"""
        SELECT product_id, supplier_id, product_name, {_title("category")} AS category,
               {_title("subcategory")} AS subcategory, CAST(unit_cost_usd AS DECIMAL(12,2)) AS unit_cost_usd,
               CAST(list_price_usd AS DECIMAL(12,2)) AS list_price_usd,
               CASE WHEN list_price_usd <> 0 THEN
                    CAST(round((list_price_usd - unit_cost_usd)::DOUBLE / list_price_usd::DOUBLE * 100, 2)
                         AS DECIMAL(18,2)) END AS gross_margin_pct,
               {_flag("is_active")} AS is_active, {_day("launch_date")} AS launch_date
        FROM raw_products""",
    "stg_transactions": _stg_transactions("raw_transactions"),
    "int_finance_daily": _daily("stg_transactions"),
    "int_orders_enriched": _enriched("stg_orders", "int_finance_daily"),
    "int_customer_360": _customer_360("int_orders_enriched", "stg_customers", AS_OF),
    "idle_orders": """
        SELECT * REPLACE (CAST(CAST(customer_id AS BIGINT) + if(CAST(customer_id AS BIGINT) % 3 = 0, 1, 0) AS VARCHAR)
                          AS customer_id) FROM int_orders_enriched""",
    "int_customer_360_idle": _customer_360("idle_orders", "stg_customers", AS_OF),
    "many_channels": """
        SELECT * REPLACE ('channel ' || (CAST(order_id AS BIGINT) % 997) AS order_channel) FROM int_orders_enriched""",
    "int_customer_360_many_channels": _customer_360("many_channels", "stg_customers", AS_OF),
    "fct_orders": f"""
        SELECT {_key("order_id")} AS order_sk, * EXCLUDE (product_name, days_since_signup),
               CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
               CAST(quarter(order_date) AS INTEGER) AS order_quarter
        FROM int_orders_enriched""",
    "dim_customer": f"""
        SELECT {_key("customer_id")} AS customer_sk, *,
               CASE WHEN total_orders > 0 THEN round(returned_orders::DOUBLE / total_orders * 100, 2) END
                   AS return_rate_pct,
               true AS is_current
        FROM int_customer_360""",
    "fct_transactions": _transaction_facts("stg_transactions", "int_finance_daily"),
    "dummy_test": "SELECT * FROM fct_transactions",
    "sem_revenue_metrics": """
        SELECT order_id AS "Order ID", order_date AS "Order Date", order_year AS "Year", order_month AS "Month",
               order_quarter AS "Quarter", order_channel AS "Sales Channel", region AS "Region",
               currency_code AS "Currency", category AS "Product Category", subcategory AS "Product Subcategory",
               customer_segment AS "Customer Segment", customer_country AS "Customer Country",
               order_status AS "Order Status", order_amount_usd AS "Gross Revenue (USD)",
               recognized_revenue_usd AS "Net Revenue (USD)", gross_profit_usd AS "Gross Profit (USD)",
               gross_margin_pct AS "Gross Margin %", order_amount_local AS "Revenue (Local Currency)",
               fx_rate AS "FX Rate", is_completed AS "Is Completed", is_returned AS "Is Returned",
               is_cancelled AS "Is Cancelled"
        FROM fct_orders""",
    "sem_customer_kpis": """
        SELECT customer_id AS "Customer ID", customer_segment AS "Segment", country_code AS "Country", city AS "City",
               signup_date AS "Signup Date", is_active AS "Is Active", rfm_status AS "RFM Status",
               clv_band AS "CLV Band", total_orders AS "Total Orders", completed_orders AS "Completed Orders",
               returned_orders AS "Returned Orders", cancelled_orders AS "Cancelled Orders",
               return_rate_pct AS "Return Rate %", lifetime_revenue_usd AS "Lifetime Revenue (USD)",
               lifetime_gross_profit_usd AS "Lifetime Gross Profit (USD)",
               avg_order_value_usd AS "Avg Order Value (USD)", first_order_date AS "First Order Date",
               last_order_date AS "Last Order Date", days_since_last_order AS "Days Since Last Order",
               days_since_signup AS "Days Since Signup", preferred_channel AS "Preferred Channel",
               primary_region AS "Primary Region"
        FROM dim_customer""",
    "sem_finance_summary": """
        SELECT transaction_id AS "Transaction ID", order_id AS "Order ID", transaction_date AS "Transaction Date",
               transaction_year AS "Year", transaction_month AS "Month", transaction_quarter AS "Quarter",
               payment_method AS "Payment Method", transaction_type AS "Transaction Type", gl_account AS "GL Account",
               currency_code AS "Currency", is_reconciled AS "Is Reconciled", amount_usd AS "Amount (USD)",
               fx_rate AS "FX Rate", amount_local AS "Amount (Local Currency)",
               sale_amount_usd AS "Sale Amount (USD)", refund_amount_usd AS "Refund Amount (USD)",
               daily_total_sales_usd AS "Daily Total Sales (USD)",
               daily_total_refunds_usd AS "Daily Total Refunds (USD)",
               daily_net_revenue_usd AS "Daily Net Revenue (USD)",
               daily_transaction_count AS "Daily Transaction Count"
        FROM fct_transactions""",
    # Expressions
    "cents_to_dollars": """
        SELECT o_orderkey, CAST(round(o_orderkey::DECIMAL(18,0) * 0.01::DECIMAL(3,2), 2) AS DECIMAL(18,2)) AS dollars,
               CAST(round(o_orderkey::DECIMAL(18,0) * 0.01::DECIMAL(3,2), 1) AS DECIMAL(18,1)) AS dollars_1
        FROM orders""",
    "safe_divide": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity / l_discount END AS per_discount,
               CASE WHEN l_tax = 0 THEN -1 ELSE l_quantity / l_tax END AS per_tax
        FROM lineitem""",
    "fiscal_quarter": """
        SELECT o_orderkey,
               CASE WHEN month(o_orderdate) = 1 THEN 'FY' || (year(o_orderdate) - 1) || '-Q4'
                    ELSE 'FY' || year(o_orderdate) || '-Q' || (month(o_orderdate) + 1) // 3 END AS fiscal_quarter
        FROM orders""",
    "surrogate_key": """
        SELECT order_id, md5(order_id || '-' || coalesce(customer_id, '_dbt_utils_surrogate_key_null_') || '-'
                             || coalesce(product_id, '_dbt_utils_surrogate_key_null_')) AS order_line_sk
        FROM raw_orders""",
    "pii_free_customers": """
        SELECT * EXCLUDE (first_name, last_name, email, phone_number) FROM stg_customers""",
    "high_water_mark": "SELECT max(order_date) AS latest_order_date FROM stg_orders",
    # Incremental runs. The history run sees orders up to CUT, all of them still pending.
    "history_orders": f"SELECT * REPLACE ('pending' AS status) FROM dated_orders WHERE order_date < {CUT}",
    "stg_history_orders": _stg_orders("history_orders"),
    "stg_dated_orders": _stg_orders("dated_orders"),
    "enriched_history": _enriched("stg_history_orders", "int_finance_daily"),
    "enriched_dated": _enriched("stg_dated_orders", "int_finance_daily"),
    "orders_upsert": """
        SELECT * FROM enriched_history WHERE order_date < (SELECT max(order_date) FROM enriched_history)
        UNION ALL
        SELECT * FROM enriched_dated WHERE order_date >= (SELECT max(order_date) FROM enriched_history)""",
    "stg_customers_then": _customers(CUT),
    "customer_360_then": _customer_360("enriched_history", "stg_customers_then", CUT),
    "customer_360_now": _customer_360("orders_upsert", "stg_customers", AS_OF),
    "touched_customers": """
        SELECT DISTINCT customer_id FROM enriched_dated
        WHERE order_date >= (SELECT max(order_date) FROM enriched_history) AND customer_id IS NOT NULL""",
    "customer_360_upsert": """
        SELECT * FROM customer_360_then ANTI JOIN touched_customers USING (customer_id)
        UNION ALL
        SELECT * FROM customer_360_now SEMI JOIN touched_customers USING (customer_id)""",
    "restated_transactions": f"""
        SELECT * REPLACE (CAST(fx_rate + if(is_reconciled = 'true' AND transaction_date >= '2000-01-01'
                                            AND transaction_date < '3', 0.05, 0) AS DECIMAL(18,6)) AS fx_rate)
        FROM raw_transactions""",
    "stg_restated": _stg_transactions("restated_transactions"),
    "restated_daily": _daily("stg_restated"),
    "fx_restatement": _enriched("stg_dated_orders", "restated_daily"),
    "fx_restatement_facts": f"""
        SELECT {_key("order_id")} AS order_sk, * EXCLUDE (product_name, days_since_signup),
               CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
               CAST(quarter(order_date) AS INTEGER) AS order_quarter
        FROM fx_restatement""",
    "fx_restatement_transactions": _transaction_facts("stg_restated", "restated_daily"),
    "schema_evolution_append": f"""
        SELECT coalesce(new.order_id, old.order_id) AS order_id, coalesce(new.order_date, old.order_date) AS order_date,
               coalesce(new.order_status, old.order_status) AS order_status, old.region, new.currency_code
        FROM (SELECT * FROM stg_history_orders) old
             FULL JOIN (SELECT * FROM stg_dated_orders WHERE order_date >= {OVERLAP}) new USING (order_id)""",
    "csv_orders": f"""
        SELECT * REPLACE ('pending' AS status) FROM raw_orders
        WHERE order_id IN (SELECT order_id FROM stg_orders WHERE order_date < {CUT})
        UNION ALL
        SELECT * FROM raw_orders WHERE order_id IN (SELECT order_id FROM stg_orders WHERE order_date >= {CUT})""",
    "stg_csv_orders": _stg_orders("csv_orders"),
    "orders_upsert_from_csv": _enriched("stg_csv_orders", "int_finance_daily"),
    "orders_full_refresh": "SELECT * FROM enriched_dated",
    "orders_stream_upsert": "SELECT * FROM enriched_dated",
    "orders_stream_out_of_order": "SELECT * FROM enriched_dated",
    "orders_change_feed": """
        SELECT changed.*, if(changed.order_id IN (SELECT order_id FROM enriched_history), 'update', 'insert') AS change
        FROM (SELECT * FROM orders_upsert EXCEPT SELECT * FROM enriched_history) changed""",
}

_CHECKS = {
    "stg_orders": (["order_id"], ["order_id", "customer_id", "product_id", "order_date", "order_amount_usd"]),
    "stg_customers": (["customer_id", "email"], ["customer_id", "email"]),
    "stg_products": (["product_id"], ["product_id", "list_price_usd"]),
    "stg_transactions": (["transaction_id"], ["transaction_id", "order_id", "transaction_date", "fx_rate"]),
    "int_finance_daily": ([], ["rate_date", "currency_code", "fx_rate", "net_revenue_usd"]),
    "int_orders_enriched": (["order_id"], ["order_id"]),
    "int_customer_360": (["customer_id"], ["customer_id"]),
    "fct_orders": (["order_sk", "order_id"], ["order_sk", "order_id"]),
    "dim_customer": (["customer_sk", "customer_id"], ["customer_sk", "customer_id"]),
    "fct_transactions": (["transaction_sk", "transaction_id"], ["transaction_sk", "transaction_id"]),
}

_VALUES = [
    ("stg_orders", "order_status", ["completed", "cancelled", "returned", "pending"]),
    ("stg_customers", "customer_segment", ["premium", "standard", "trial"]),
    ("int_customer_360", "rfm_status", ["active", "at_risk", "lapsed", "churned"]),
    ("int_customer_360", "clv_band", ["high", "medium", "low"]),
    ("dim_customer", "rfm_status", ["active", "at_risk", "lapsed", "churned"]),
    ("stg_transactions", "transaction_type", ["sale", "refund", "adjustment", "chargeback"]),
    ("fct_transactions", "transaction_type", ["sale", "refund", "adjustment", "chargeback"]),
]


def _report_line(relation: str, column: str, test: str, failures: str) -> str:
    return (f"SELECT '{relation}' AS relation, '{column}' AS column_name, '{test}' AS test, "
            f"({failures}) AS failures")


def _quality() -> str:
    lines = []
    for relation, (unique, filled) in _CHECKS.items():
        for c in unique:
            lines.append(_report_line(relation, c, "unique",
                                      f"SELECT count(*) FROM (SELECT {c} FROM {relation} WHERE {c} IS NOT NULL "
                                      f"GROUP BY {c} HAVING count(*) > 1)"))
        for c in filled:
            lines.append(_report_line(relation, c, "not_null", f"SELECT count(*) - count({c}) FROM {relation}"))
    return "\nUNION ALL ".join(lines)


def _accepted() -> str:
    return "\nUNION ALL ".join(
        _report_line(relation, c, "accepted_values",
                     f"SELECT count(DISTINCT {c}) FROM {relation} WHERE {c} NOT IN "
                     f"({', '.join(repr(v) for v in values)})")
        for relation, c, values in _VALUES)


RELATIONS["data_quality_report"] = _quality()
RELATIONS["accepted_values_report"] = _accepted()
RELATIONS["data_quality_by_change"] = "\nUNION ALL ".join(
    _report_line("int_orders_enriched", column, test, failures) for column, test, failures in (
        ("order_id", "unique", "SELECT count(*) - count(DISTINCT order_id) FROM orders_upsert"),
        ("order_id", "not_null", "SELECT count(*) - count(order_id) FROM orders_upsert"),
        ("customer_id", "unique", "SELECT count(*) FROM (SELECT customer_id FROM orders_upsert "
                                  "WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1)"),
        ("product_name", "not_null", "SELECT count(*) - count(product_name) FROM orders_upsert"),
        ("order_date", "not_null", "SELECT count(*) - count(order_date) FROM orders_upsert"),
        ("order_status", "accepted_values", "SELECT count(DISTINCT order_status) FROM orders_upsert "
                                            "WHERE order_status NOT IN ('completed', 'pending')")))
for _view in ("stg_orders", "stg_customers", "stg_products", "stg_transactions"):
    RELATIONS[f"catalog_{_view}"] = f"SELECT * FROM {_view}"


def _needs(name: str, seen: list[str]) -> list[str]:
    for word in re.findall(r"\w+", RELATIONS[name]):
        if word in RELATIONS and word != name and word not in seen:
            _needs(word, seen)
            if word not in seen:
                seen.append(word)
    return seen


#: The run stamp of the models, and the column that holds it.
RUN_TS = "'2001-08-15 02:00:00'"
_STAMP_COLUMNS = {
    "_dbt_loaded_at": ("stg_orders", "stg_customers", "stg_products", "stg_transactions", "pii_free_customers",
                       "catalog_stg_orders", "catalog_stg_customers", "catalog_stg_products", "catalog_stg_transactions"),
    "_dbt_updated_at": ("int_orders_enriched", "int_customer_360", "int_customer_360_idle",
                        "int_customer_360_many_channels", "fct_orders"),
    "dw_updated_at": ("dim_customer", "fct_transactions", "dummy_test"),
}


def statement(name: str) -> str:
    """The named relation as one SELECT, with the relations it is built on as CTEs."""
    needed = [n for n in _needs(name, []) if n != name]
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({RELATIONS[n]})" for n in [*needed, name])
    stamps = "".join(f", {RUN_TS} AS {column}" for column, names in _STAMP_COLUMNS.items() if name in names)
    return f"WITH {ctes}\nSELECT *{stamps} FROM {name}"
