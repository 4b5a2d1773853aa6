"""Schemas of the four raw feeds.

Ids, dates and flags arrive as text and are typed by staging. Money is decimal from the first read on, wider than the
staged type, so nothing is rounded before staging rounds it.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _feed(**columns: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


# The columns of each feed, in the order of the files.
RAW_ORDERS = _feed(
    order_id="string", customer_id="string", product_id="string", order_date="string",
    order_amount_usd="decimal(18,6)", currency_code="string", status="string", channel="string", region="string")
RAW_CUSTOMERS = _feed(
    customer_id="string", first_name="string", last_name="string", email="string", phone="string", country="string",
    city="string", signup_date="string", customer_segment="string", is_active="string")
RAW_PRODUCTS = _feed(
    product_id="string", product_name="string", category="string", subcategory="string",
    unit_cost_usd="decimal(18,6)", list_price_usd="decimal(18,6)", is_active="string", launch_date="string",
    supplier_id="string")
RAW_TRANSACTIONS = _feed(
    transaction_id="string", order_id="string", transaction_date="string", amount_usd="decimal(18,6)",
    currency_code="string", fx_rate="decimal(18,6)", payment_method="string", transaction_type="string",
    gl_account="string", is_reconciled="string")

FEEDS = {
    "raw_orders": RAW_ORDERS,
    "raw_customers": RAW_CUSTOMERS,
    "raw_products": RAW_PRODUCTS,
    "raw_transactions": RAW_TRANSACTIONS,
}

# The date of each feed, which arrives as text.
DAYS = {
    "raw_orders": "order_date",
    "raw_customers": "signup_date",
    "raw_products": "launch_date",
    "raw_transactions": "transaction_date",
}

#: Feeds that grow day by day; their tables are kept by month.
GROWING = ("raw_orders", "raw_transactions")
