"""Business-named views over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column name -> display name, in display order.
REVENUE_METRICS = {
    "order_id": "Order ID",
    "order_date": "Order Date",
    "order_year": "Year",
    "order_month": "Month",
    "order_quarter": "Quarter",
    "order_channel": "Sales Channel",
    "region": "Region",
    "currency_code": "Currency",
    "category": "Product Category",
    "subcategory": "Product Subcategory",
    "customer_segment": "Customer Segment",
    "customer_country": "Customer Country",
    "order_status": "Order Status",
    "order_amount_usd": "Gross Revenue (USD)",
    "recognized_revenue_usd": "Net Revenue (USD)",
    "gross_profit_usd": "Gross Profit (USD)",
    "gross_margin_pct": "Gross Margin %",
    "order_amount_local": "Revenue (Local Currency)",
    "fx_rate": "FX Rate",
    "is_completed": "Is Completed",
    "is_returned": "Is Returned",
    "is_cancelled": "Is Cancelled",
}

CUSTOMER_KPIS = {
    "customer_id": "Customer ID",
    "customer_segment": "Segment",
    "country_code": "Country",
    "city": "City",
    "signup_date": "Signup Date",
    "is_active": "Is Active",
    "rfm_status": "RFM Status",
    "clv_band": "CLV Band",
    "total_orders": "Total Orders",
    "completed_orders": "Completed Orders",
    "returned_orders": "Returned Orders",
    "cancelled_orders": "Cancelled Orders",
    "return_rate_pct": "Return Rate %",
    "lifetime_revenue_usd": "Lifetime Revenue (USD)",
    "lifetime_gross_profit_usd": "Lifetime Gross Profit (USD)",
    "avg_order_value_usd": "Avg Order Value (USD)",
    "first_order_date": "First Order Date",
    "last_order_date": "Last Order Date",
    "days_since_last_order": "Days Since Last Order",
    "days_since_signup": "Days Since Signup",
    "preferred_channel": "Preferred Channel",
    "primary_region": "Primary Region",
}

FINANCE_SUMMARY = {
    "transaction_id": "Transaction ID",
    "order_id": "Order ID",
    "transaction_date": "Transaction Date",
    "transaction_year": "Year",
    "transaction_month": "Month",
    "transaction_quarter": "Quarter",
    "payment_method": "Payment Method",
    "transaction_type": "Transaction Type",
    "gl_account": "GL Account",
    "currency_code": "Currency",
    "is_reconciled": "Is Reconciled",
    "amount_usd": "Amount (USD)",
    "fx_rate": "FX Rate",
    "amount_local": "Amount (Local Currency)",
    "sale_amount_usd": "Sale Amount (USD)",
    "refund_amount_usd": "Refund Amount (USD)",
    "daily_total_sales_usd": "Daily Total Sales (USD)",
    "daily_total_refunds_usd": "Daily Total Refunds (USD)",
    "daily_net_revenue_usd": "Daily Net Revenue (USD)",
    "daily_transaction_count": "Daily Transaction Count",
}


#: The table that each view renames the columns of, and the names.
VIEWS = {
    "sem_revenue_metrics": ("fct_orders", REVENUE_METRICS),
    "sem_customer_kpis": ("dim_customer", CUSTOMER_KPIS),
    "sem_finance_summary": ("fct_transactions", FINANCE_SUMMARY),
}


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(column).alias(label) for column, label in names.items()])


def sem_revenue_metrics(orders_fact: DataFrame) -> DataFrame:
    return _renamed(orders_fact, REVENUE_METRICS)


def sem_customer_kpis(customer_dimension: DataFrame) -> DataFrame:
    return _renamed(customer_dimension, CUSTOMER_KPIS)


def sem_finance_summary(transactions_fact: DataFrame) -> DataFrame:
    return _renamed(transactions_fact, FINANCE_SUMMARY)
