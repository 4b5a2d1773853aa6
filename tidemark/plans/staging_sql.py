"""The staging views as SQL text over the tables of the feeds.

A catalog keeps a view as text, so that it outlives the session that made it; what :mod:`tidemark.plans.staging` says with
expressions is said here in SQL, from the same types and spellings. Dates are the typed ones that a feed's table keeps.
"""

from __future__ import annotations

import datetime as dt

from tidemark.functions.text import AFTER_BREAK, EXTRA_FALSE, EXTRA_TRUE
from tidemark.plans.staging import AMOUNT, PRICE, RATE, TOTAL
from tidemark.sources.feeds import typed_day

#: The feed of each view, and the key that has to be there.
SOURCES = {
    "stg_orders": ("raw_orders", "order_id"),
    "stg_customers": ("raw_customers", "customer_id"),
    "stg_products": ("raw_products", "product_id"),
    "stg_transactions": ("raw_transactions", "transaction_id"),
}


def _text(*columns: str) -> dict[str, str]:
    return {c: f"cast({c} AS string)" for c in columns}


def _title(column: str) -> str:
    return f"array_join(transform(split({column}, r'{AFTER_BREAK}', -1), part -> initcap(part)), '')"


def _flag(column: str) -> str:
    word = f"lower(trim({column}))"
    return f"CASE WHEN {word} = '{EXTRA_TRUE}' THEN true WHEN {word} = '{EXTRA_FALSE}' THEN false ELSE cast({word} AS boolean) END"


def _columns(view: str, day: str, today: str) -> dict[str, str]:
    """Column and expression."""
    if view == "stg_orders":
        return {**_text("order_id", "customer_id", "product_id"), "order_date": day,
                "order_amount_usd": f"cast(order_amount_usd AS {PRICE})", "currency_code": "upper(currency_code)",
                "order_status": "lower(status)", "order_channel": "lower(channel)", "region": "upper(region)"}
    if view == "stg_customers":
        return {**_text("customer_id"), "first_name": _title("first_name"), "last_name": _title("last_name"),
                "email": "lower(email)", "phone_number": "phone", "country_code": "upper(country)", "city": _title("city"),
                "signup_date": day, "customer_segment": "lower(customer_segment)", "is_active": _flag("is_active"),
                "days_since_signup": f"datediff({today}, {day})"}
    if view == "stg_products":
        margin = "(list_price_usd - unit_cost_usd) / nullif(list_price_usd, 0) * 100"
        return {**_text("product_id", "supplier_id"), "product_name": "product_name", "category": _title("category"),
                "subcategory": _title("subcategory"), "unit_cost_usd": f"cast(unit_cost_usd AS {PRICE})",
                "list_price_usd": f"cast(list_price_usd AS {PRICE})", "gross_margin_pct": f"cast(round({margin}, 2) AS {TOTAL})",
                "is_active": _flag("is_active"), "launch_date": day}
    return {**_text("transaction_id", "order_id"), "transaction_date": day, "amount_usd": f"cast(amount_usd AS {AMOUNT})",
            "currency_code": "upper(currency_code)", "fx_rate": f"cast(fx_rate AS {RATE})",
            "amount_local": f"cast(round(amount_usd * fx_rate, 2) AS {TOTAL})", "payment_method": "lower(payment_method)",
            "transaction_type": "lower(transaction_type)", "gl_account": "gl_account",
            "is_reconciled": _flag("is_reconciled")}


def select(view: str, source: str, as_of: dt.date | None = None, run_ts: dt.datetime | None = None) -> str:
    """The view's SELECT over ``source``, the files of the feed's table; without ``as_of`` and ``run_ts`` it goes by the clock
    whenever it is read."""
    feed, key = SOURCES[view]
    today = "current_date()" if as_of is None else f"DATE'{as_of}'"
    now = "current_timestamp()" if run_ts is None else f"TIMESTAMP'{run_ts}'"
    columns = {**_columns(view, f"`{typed_day(feed)}`", today), "_dbt_loaded_at": now}
    listed = ", ".join(f"{expression} AS `{name}`" for name, expression in columns.items())
    return f"SELECT {listed} FROM {source} WHERE {key} IS NOT NULL"
