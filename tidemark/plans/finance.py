"""Daily finance figures per currency, and the transaction fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exact_avg, exact_sum, now_or, surrogate_key
from tidemark.operators.joins import lookup


def _amount_of(kind: str) -> Column:
    return F.when(F.col("transaction_type") == kind, F.col("amount_usd")).otherwise(0)


def int_finance_daily(transactions: DataFrame) -> DataFrame:
    """One row per day and currency. Refund amounts are positive, and ``net_revenue_usd`` adds them as they are."""
    return _daily(transactions)


def _daily(transactions: DataFrame, *more: Column) -> DataFrame:
    count, reconciled = F.count("transaction_id"), F.count_if(F.col("is_reconciled"))
    return transactions.groupBy(F.col("transaction_date").alias("rate_date"), "currency_code").agg(
        exact_avg(F.col("fx_rate"), 6, 10).cast("decimal(14,10)").alias("fx_rate"),
        count.alias("transaction_count"),
        exact_sum(_amount_of("sale"), 4).alias("total_sales_usd"),
        exact_sum(_amount_of("refund"), 4).alias("total_refunds_usd"),
        exact_sum(F.col("amount_usd"), 4).alias("net_revenue_usd"),
        reconciled.alias("reconciled_count"),
        (count - reconciled).alias("unreconciled_count"),
        *more,
    )


#: Hidden columns of the stored daily figures: what tells whether any transaction of a day and currency is another.
DIGESTS = ("__rows_xor", "__rows_sum")


def daily_state(transactions: DataFrame) -> DataFrame:
    """:func:`int_finance_daily` with digests over all columns of the transactions but the run stamp."""
    columns = [c for c in transactions.columns if c != "_dbt_loaded_at"]
    row = F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])
    return _daily(transactions, F.bit_xor(row).alias(DIGESTS[0]),
                  # equal rows cancel out above, and count here; 24 bits each are good for 2^39 rows
                  F.sum(row.bitwiseAND(F.lit((1 << 24) - 1))).alias(DIGESTS[1]))


def changed_days(before: DataFrame, after: DataFrame) -> DataFrame:
    """Distinct ``rate_date`` of the daily states that differ in anything; a day that came or went is one too."""
    sides = before.withColumn("__side", F.lit(-1)).unionByName(after.withColumn("__side", F.lit(1)))
    return sides.groupBy(*before.columns).agg(F.sum("__side").alias("__side")).where("__side <> 0").select("rate_date").distinct()


def fct_transactions(transactions: DataFrame, daily: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """One row per transaction with the figures of its day and currency.

    ``daily`` should be a stored table: it is measured first, then joined.
    """
    context = daily.select(
        F.col("rate_date").alias("transaction_date"),
        "currency_code",
        F.col("total_sales_usd").alias("daily_total_sales_usd"),
        F.col("total_refunds_usd").alias("daily_total_refunds_usd"),
        F.col("net_revenue_usd").alias("daily_net_revenue_usd"),
        F.col("transaction_count").alias("daily_transaction_count"),
    )
    day = F.col("transaction_date")
    return lookup(transactions, context, ["transaction_date", "currency_code"], spread="transaction_id").select(
        surrogate_key("transaction_id").alias("transaction_sk"),
        "transaction_id",
        "order_id",
        "transaction_date",
        F.year(day).alias("transaction_year"),
        F.month(day).alias("transaction_month"),
        F.quarter(day).alias("transaction_quarter"),
        "payment_method",
        "transaction_type",
        "gl_account",
        "currency_code",
        "is_reconciled",
        "amount_usd",
        "fx_rate",
        "amount_local",
        "daily_total_sales_usd",
        "daily_total_refunds_usd",
        "daily_net_revenue_usd",
        "daily_transaction_count",
        _amount_of("sale").alias("sale_amount_usd"),
        _amount_of("refund").alias("refund_amount_usd"),
        now_or(run_ts).alias("dw_updated_at"),
    )


def dummy_test(transactions_fact: DataFrame) -> DataFrame:
    """A plain copy of the transaction fact."""
    return transactions_fact
