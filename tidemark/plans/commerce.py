"""Enriched orders, the customer view built on them, and their star schema."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import days_between, exact_sum, now_or, null_if_zero, surrogate_key, today_or
from tidemark.operators.joins import fits_broadcast, lookup_all

# Order states with a meaning of their own.
COMPLETED, RETURNED, CANCELLED = "completed", "returned", "cancelled"

# Fixed values: (days since the last order at most, name), then the name beyond the last bound or without orders.
RECENCY_BANDS = ((30, "active"), (90, "at_risk"), (180, "lapsed"))
RECENCY_REST = "churned"

# Fixed values: (lifetime revenue at least, name), then the name below the last bound.
VALUE_BANDS = ((1000, "high"), (300, "medium"))
VALUE_REST = "low"

# Fixed value: the rate used where a day and currency has none.
NO_RATE = Decimal("1.0")


def _first_match(tests: list[tuple[Column, str]], rest: str) -> Column:
    banded = F.when(*tests[0])
    for test, name in tests[1:]:
        banded = banded.when(test, name)
    return banded.otherwise(rest)


def _has_status(status: str) -> Column:
    return F.coalesce(F.col("order_status") == status, F.lit(False))


def repriced(orders: DataFrame, rate: Column, run_ts: dt.datetime | None = None) -> DataFrame:
    """Stored orders at another rate; all else stays as it is."""
    return orders.withColumns({
        "fx_rate": rate.cast(orders.schema["fx_rate"].dataType),
        "order_amount_local": F.round(F.col("order_amount_usd") * rate, 2).cast(
            orders.schema["order_amount_local"].dataType),
        "_dbt_updated_at": now_or(run_ts),
    })


def _measures() -> dict[str, Column]:
    """Flags, recognized revenue and profit of an order; a completed order of an unknown product has no profit."""
    completed = _has_status(COMPLETED)
    profit = F.round(F.col("order_amount_usd") - F.col("unit_cost_usd"), 2)
    return {
        "is_completed": completed,
        "is_returned": _has_status(RETURNED),
        "is_cancelled": _has_status(CANCELLED),
        "recognized_revenue_usd": F.when(completed, F.col("order_amount_usd")).otherwise(0),
        "gross_profit_usd": F.when(completed, profit).otherwise(0),
    }


def int_orders_enriched(orders: DataFrame, customers: DataFrame, products: DataFrame, daily: DataFrame,
                        run_ts: dt.datetime | None = None) -> DataFrame:
    """One row per order, with its customer, its product and the daily rate of its currency.

    ``daily`` should be a stored table: it is measured first, then joined. Columns of ``orders`` whose names begin with two
    underscores are carried along.
    """
    customer_part = customers.select(
        "customer_id", "customer_segment", F.col("country_code").alias("customer_country"), "days_since_signup")
    product_part = products.select(
        "product_id", "product_name", "category", "subcategory", "unit_cost_usd", "list_price_usd",
        "gross_margin_pct")
    rates = daily.select(F.col("rate_date").alias("order_date"), "currency_code", "fx_rate")

    joined = lookup_all(orders, [(customer_part, ["customer_id"]), (product_part, ["product_id"]),
                                 (rates, ["order_date", "currency_code"])], spread="order_id")
    rate = F.coalesce(F.col("fx_rate"), F.lit(NO_RATE))
    return joined.select(
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        "order_status",
        "order_channel",
        "region",
        "order_amount_usd",
        "currency_code",
        rate.alias("fx_rate"),
        F.round(F.col("order_amount_usd") * rate, 2).alias("order_amount_local"),
        "customer_segment",
        "customer_country",
        "days_since_signup",
        "product_name",
        "category",
        "subcategory",
        "unit_cost_usd",
        "list_price_usd",
        "gross_margin_pct",
        *[column.alias(name) for name, column in _measures().items()],
        now_or(run_ts).alias("_dbt_updated_at"),
        *[c for c in orders.columns if c.startswith("__")],
    )


_COUNTS = ("total_orders", "completed_orders", "returned_orders", "cancelled_orders", "completed_amounts")
_AMOUNTS = ("lifetime_revenue_usd", "lifetime_gross_profit_usd")


def _gathered(orders: DataFrame, *by: str) -> DataFrame:
    """Figures of the orders by channel and region.

    Spark's hash aggregate keeps fixed-width values only, and a text maximum is none. So the rows of a customer are first
    brought together per channel and region, which combines them in a hash map before the shuffle (a customer with very
    many orders costs a row per task, channel and region); the few rows left per customer then give the maxima.
    """
    return orders.groupBy(*by, "order_channel", "region").agg(
        F.count("order_id").alias("total_orders"),
        F.count(F.when(F.col("is_completed"), F.col("order_id"))).alias("completed_orders"),
        F.count(F.when(F.col("is_returned"), F.col("order_id"))).alias("returned_orders"),
        F.count(F.when(F.col("is_cancelled"), F.col("order_id"))).alias("cancelled_orders"),
        # What a completed order recognizes is its amount, so the average needs no sum of its own.
        F.count(F.when(F.col("is_completed"), F.col("order_amount_usd"))).alias("completed_amounts"),
        exact_sum(F.col("recognized_revenue_usd"), 2).alias("lifetime_revenue_usd"),
        exact_sum(F.col("gross_profit_usd"), 2).alias("lifetime_gross_profit_usd"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def _merged(parts: DataFrame, *by: str) -> DataFrame:
    """Parts added up; nothing in them has to be taken back when a part is replaced, so they can be merged in any order."""
    return parts.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in _COUNTS],
        *[F.sum(c).cast("decimal(22,2)").alias(c) for c in _AMOUNTS],
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
        F.max("order_channel").alias("order_channel"),
        F.max("region").alias("region"),
    )


def customer_order_parts(orders: DataFrame) -> DataFrame:
    """One row per customer, month of orders, channel and region, from which :func:`customer_totals` makes the totals.

    Merging them to a row per customer and month would take a sort for the text maxima and another shuffle, and the totals
    are merged from whatever rows there are.
    """
    month = F.date_format("order_date", "yyyy-MM").alias("order_month")
    return _gathered(orders.select("*", month), "customer_id", "order_month")


def customer_totals(parts: DataFrame) -> DataFrame:
    """One row per customer from parts. Channel and region are the alphabetically largest, not the most frequent."""
    average = F.col("lifetime_revenue_usd") / null_if_zero(F.col("completed_amounts"))
    return _merged(parts, "customer_id").withColumnsRenamed(
        {"order_channel": "preferred_channel", "region": "primary_region"}).withColumn(
        "avg_order_value_usd", average.cast("decimal(16,6)")).drop("completed_amounts")


def customer_order_totals(orders: DataFrame) -> DataFrame:
    """One row per customer, straight from the orders."""
    return customer_totals(_gathered(orders, "customer_id"))


def int_customer_360(customers: DataFrame, orders: DataFrame, as_of: dt.date | None = None,
                     run_ts: dt.datetime | None = None) -> DataFrame:
    """One row per customer, with or without orders; no personal data."""
    return customer_view(customers, customer_order_totals(orders), as_of, run_ts)


def customer_view(customers: DataFrame, totals: DataFrame, as_of: dt.date | None = None,
                  run_ts: dt.datetime | None = None) -> DataFrame:
    """:func:`int_customer_360` from the totals of each customer."""
    recency = days_between(F.col("last_order_date"), today_or(as_of))
    revenue = F.coalesce(F.col("lifetime_revenue_usd"), F.lit(0))

    def or_zero(*names: str) -> list[Column]:
        return [F.coalesce(F.col(n), F.lit(0)).alias(n) for n in names]

    profile = customers.select(
        "customer_id", "customer_segment", "country_code", "city", "signup_date", "days_since_signup", "is_active")
    return profile.join(totals, "customer_id", "left").select(
        *profile.columns,
        *or_zero("total_orders", "completed_orders", "returned_orders", "cancelled_orders", "lifetime_revenue_usd",
                 "lifetime_gross_profit_usd"),
        "avg_order_value_usd",
        "first_order_date",
        "last_order_date",
        recency.alias("days_since_last_order"),
        "preferred_channel",
        "primary_region",
        _first_match([(recency <= days, name) for days, name in RECENCY_BANDS], RECENCY_REST).alias("rfm_status"),
        _first_match([(revenue >= least, name) for least, name in VALUE_BANDS], VALUE_REST).alias("clv_band"),
        now_or(run_ts).alias("_dbt_updated_at"),
    )


def customer_360_of(touched: DataFrame, customers: DataFrame, parts: DataFrame, as_of: dt.date | None = None,
                    run_ts: dt.datetime | None = None) -> DataFrame:
    """The customer view of some customers only, from stored parts; ``touched`` holds each id once and should be stored.

    Few ids are broadcast and filter the parts before they are merged. Too many for that: all parts are merged, which
    combines before the shuffle.
    """
    if fits_broadcast(touched):
        theirs = parts.join(F.broadcast(touched), "customer_id", "left_semi")
        profiles = customers.join(F.broadcast(touched), "customer_id", "left_semi")
        return customer_view(profiles, customer_totals(theirs), as_of, run_ts)
    # An inner join with distinct ids, as a semi join would be pushed back below the aggregate.
    return customer_view(customers, customer_totals(parts), as_of, run_ts).join(touched, "customer_id")


def fct_orders(enriched: DataFrame) -> DataFrame:
    day = F.col("order_date")
    return enriched.select(
        surrogate_key("order_id").alias("order_sk"),
        "order_id",
        "customer_id",
        "product_id",
        "order_date",
        F.year(day).alias("order_year"),
        F.month(day).alias("order_month"),
        F.quarter(day).alias("order_quarter"),
        "order_status",
        "order_channel",
        "region",
        "currency_code",
        "category",
        "subcategory",
        "customer_segment",
        "customer_country",
        "order_amount_usd",
        "order_amount_local",
        "fx_rate",
        "unit_cost_usd",
        "list_price_usd",
        "gross_margin_pct",
        "recognized_revenue_usd",
        "gross_profit_usd",
        "is_completed",
        "is_returned",
        "is_cancelled",
        "_dbt_updated_at",
    )


def dim_customer(customer_360: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Customer dimension, overwritten on every run: only the current state is kept."""
    return_rate = F.col("returned_orders").cast("double") / null_if_zero(F.col("total_orders")) * 100
    return customer_360.select(
        surrogate_key("customer_id").alias("customer_sk"),
        "customer_id",
        "customer_segment",
        "country_code",
        "city",
        "signup_date",
        "days_since_signup",
        "is_active",
        "rfm_status",
        "clv_band",
        "total_orders",
        "completed_orders",
        "returned_orders",
        "cancelled_orders",
        "lifetime_revenue_usd",
        "lifetime_gross_profit_usd",
        "avg_order_value_usd",
        "first_order_date",
        "last_order_date",
        "days_since_last_order",
        "preferred_channel",
        "primary_region",
        F.round(return_rate, 2).alias("return_rate_pct"),
        now_or(run_ts).alias("dw_updated_at"),
        F.lit(True).alias("is_current"),
    )
