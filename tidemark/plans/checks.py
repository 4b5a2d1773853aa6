"""Which column checks each relation has to pass."""

from __future__ import annotations

from tidemark.operators.quality import ACCEPTED, NOT_NULL, UNIQUE, Check


def _keys(*columns: str) -> list[Check]:
    return [Check(c, test) for c in columns for test in (UNIQUE, NOT_NULL)]


def _filled(*columns: str) -> list[Check]:
    return [Check(c, NOT_NULL) for c in columns]


DEFAULT_CHECKS = {
    "stg_orders": _keys("order_id") + _filled("customer_id", "product_id", "order_date", "order_amount_usd"),
    "stg_customers": _keys("customer_id", "email"),
    "stg_products": _keys("product_id") + _filled("list_price_usd"),
    "stg_transactions": _keys("transaction_id") + _filled("order_id", "transaction_date", "fx_rate"),
    "int_finance_daily": _filled("rate_date", "currency_code", "fx_rate", "net_revenue_usd"),
    "int_orders_enriched": _keys("order_id"),
    "int_customer_360": _keys("customer_id"),
    "fct_orders": _keys("order_sk", "order_id"),
    "dim_customer": _keys("customer_sk", "customer_id"),
    "fct_transactions": _keys("transaction_sk", "transaction_id"),
}

# The sets a column is meant to stay within. Not part of the default checks.
ORDER_STATUSES = ("completed", "cancelled", "returned", "pending")
CUSTOMER_SEGMENTS = ("premium", "standard", "trial")
RECENCY_NAMES = ("active", "at_risk", "lapsed", "churned")
VALUE_NAMES = ("high", "medium", "low")
TRANSACTION_TYPES = ("sale", "refund", "adjustment", "chargeback")

VALUE_CHECKS = {
    "stg_orders": [Check("order_status", ACCEPTED, ORDER_STATUSES)],
    "stg_customers": [Check("customer_segment", ACCEPTED, CUSTOMER_SEGMENTS)],
    "int_customer_360": [Check("rfm_status", ACCEPTED, RECENCY_NAMES), Check("clv_band", ACCEPTED, VALUE_NAMES)],
    "dim_customer": [Check("rfm_status", ACCEPTED, RECENCY_NAMES)],
    "stg_transactions": [Check("transaction_type", ACCEPTED, TRANSACTION_TYPES)],
    "fct_transactions": [Check("transaction_type", ACCEPTED, TRANSACTION_TYPES)],
}
