"""Cleaned and typed feeds: one row per feed row that has a key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days_between, now_or, null_if_zero, strict_date, text_flag, title_case, today_or
from tidemark.operators.privacy import pii
from tidemark.operators.tables import HIDDEN

PRICE = "decimal(12,2)"
AMOUNT = "decimal(12,4)"
RATE = "decimal(10,6)"
TOTAL = "decimal(18,2)"


def _text(column: str) -> Column:
    return F.col(column).cast("string").alias(column)


def _date(raw: DataFrame, column: str) -> Column:
    """The typed date that a feed's table keeps beside the text, if it does."""
    if f"{HIDDEN}{column}" in raw.columns:
        return F.col(f"{HIDDEN}{column}")
    return strict_date(F.col(column), raw.schema[column].dataType)


def stg_orders(raw: DataFrame, run_ts: dt.datetime | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """``carried``: columns that come along as they are."""
    return raw.where(F.col("order_id").isNotNull()).select(
        _text("order_id"),
        _text("customer_id"),
        _text("product_id"),
        _date(raw, "order_date").alias("order_date"),
        F.col("order_amount_usd").cast(PRICE).alias("order_amount_usd"),
        F.upper("currency_code").alias("currency_code"),
        F.lower("status").alias("order_status"),
        F.lower("channel").alias("order_channel"),
        F.upper("region").alias("region"),
        now_or(run_ts).alias("_dbt_loaded_at"),
        *carried,
    )


def stg_customers(raw: DataFrame, as_of: dt.date | None = None, run_ts: dt.datetime | None = None) -> DataFrame:
    signup = _date(raw, "signup_date")
    return raw.where(F.col("customer_id").isNotNull()).select(
        _text("customer_id"),
        pii(title_case(F.col("first_name")), "first_name"),
        pii(title_case(F.col("last_name")), "last_name"),
        pii(F.lower("email"), "email"),
        pii(F.col("phone"), "phone_number"),
        F.upper("country").alias("country_code"),
        title_case(F.col("city")).alias("city"),
        signup.alias("signup_date"),
        F.lower("customer_segment").alias("customer_segment"),
        text_flag(F.col("is_active")).alias("is_active"),
        days_between(signup, today_or(as_of)).alias("days_since_signup"),
        now_or(run_ts).alias("_dbt_loaded_at"),
    )


def stg_products(raw: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    # The margin is taken from the prices as delivered, not from the rounded ones.
    cost, price = F.col("unit_cost_usd"), F.col("list_price_usd")
    return raw.where(F.col("product_id").isNotNull()).select(
        _text("product_id"),
        _text("supplier_id"),
        "product_name",
        title_case(F.col("category")).alias("category"),
        title_case(F.col("subcategory")).alias("subcategory"),
        cost.cast(PRICE).alias("unit_cost_usd"),
        price.cast(PRICE).alias("list_price_usd"),
        F.round((price - cost) / null_if_zero(price) * 100, 2).cast(TOTAL).alias("gross_margin_pct"),
        text_flag(F.col("is_active")).alias("is_active"),
        _date(raw, "launch_date").alias("launch_date"),
        now_or(run_ts).alias("_dbt_loaded_at"),
    )


def stg_transactions(raw: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    # The local amount, too, comes from the delivered amount and rate.
    amount, rate = F.col("amount_usd"), F.col("fx_rate")
    return raw.where(F.col("transaction_id").isNotNull()).select(
        _text("transaction_id"),
        _text("order_id"),
        _date(raw, "transaction_date").alias("transaction_date"),
        amount.cast(AMOUNT).alias("amount_usd"),
        F.upper("currency_code").alias("currency_code"),
        rate.cast(RATE).alias("fx_rate"),
        F.round(amount * rate, 2).cast(TOTAL).alias("amount_local"),
        F.lower("payment_method").alias("payment_method"),
        F.lower("transaction_type").alias("transaction_type"),
        "gl_account",
        text_flag(F.col("is_reconciled")).alias("is_reconciled"),
        now_or(run_ts).alias("_dbt_loaded_at"),
    )
