"""The physical plans the models should get."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from tests.feeds import customer, feeds, order, product, transaction
from tidemark.operators import Partitioning, Table, joins
from tidemark.plans import commerce, finance, semantic, staging


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stored")
    raw = feeds(spark, [order("1", "C1", "P1", "2024-01-05", "250")], [customer("C1")], [product("P1", "8", "9")],
                [transaction("T1", "1", "2024-01-05", "250")])
    raw["raw_orders"] = raw["raw_orders"].withColumn("order_date", F.col("order_date").cast("date"))
    for name, df in raw.items():
        df.write.parquet(str(folder / name))
    return {name: spark.read.parquet(str(folder / name)) for name in raw}


def test_date_bound_reaches_the_scan_of_typed_feed(stored):
    recent = staging.stg_orders(stored["raw_orders"]).where(F.col("order_date") >= F.lit(dt.date(2024, 1, 1)))
    pushed = plan(recent)
    assert "GreaterThanOrEqual(order_date,2024-01-01)" in pushed and "IsNotNull(order_id)" in pushed


def test_small_lookups_do_not_shuffle_orders(stored):
    daily = finance.int_finance_daily(staging.stg_transactions(stored["raw_transactions"]))
    text = plan(commerce.int_orders_enriched(
        staging.stg_orders(stored["raw_orders"]), staging.stg_customers(stored["raw_customers"]),
        staging.stg_products(stored["raw_products"]), daily))
    assert text.count("BroadcastHashJoin LeftOuter BuildRight") >= 3 and "SortMergeJoin" not in text
    assert text.count("Exchange\n") + text.count("Exchange (") <= text.count("BroadcastExchange") * 2 + 2


def enriched(stored):
    return commerce.int_orders_enriched(
        staging.stg_orders(stored["raw_orders"]), staging.stg_customers(stored["raw_customers"]),
        staging.stg_products(stored["raw_products"]),
        finance.int_finance_daily(staging.stg_transactions(stored["raw_transactions"])))


def test_aggregates_combine_in_hash_maps(stored):
    daily = plan(finance.int_finance_daily(staging.stg_transactions(stored["raw_transactions"])))
    assert "SortAggregate" not in daily and daily.count("HashAggregate") >= 2 and "partial_sum" in daily
    # all orders pass a hash aggregate by customer, channel and region; only its result is sorted for the text maxima
    totals = plan(commerce.customer_order_totals(enriched(stored)))
    tree = totals[:totals.index("\n\n\n")]
    assert tree.index("SortAggregate") < tree.index("HashAggregate")
    assert "order_channel" in totals and "partial_sum" in totals


def test_only_needed_columns_are_read(stored):
    daily = plan(finance.int_finance_daily(staging.stg_transactions(stored["raw_transactions"])))
    assert "payment_method" not in daily and "gl_account" not in daily
    totals = plan(commerce.customer_order_totals(enriched(stored)))
    assert "subcategory" not in totals and "launch_date" not in totals


def test_upsert_of_unique_keys_looks_for_no_hot_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(joins, "hot_keys", lambda *a: pytest.fail("unique keys have no hot ones"))
    spark.conf.set(joins.BROADCAST_SETTING, "0")
    try:
        table = Table(spark, str(tmp_path / "t"), Partitioning("p", "k % 3"))
        table.upsert(spark.range(50).selectExpr("id AS k", "1 AS v"), "k")
        table.upsert(spark.range(40, 60).selectExpr("id AS k", "2 AS v"), "k")
    finally:
        spark.conf.unset(joins.BROADCAST_SETTING)
    assert table.read().groupBy().sum("v").first()[0] == 40 + 2 * 20


def test_view_reads_only_what_is_asked(spark, stored):
    orders = commerce.fct_orders(commerce.int_orders_enriched(
        staging.stg_orders(stored["raw_orders"]), staging.stg_customers(stored["raw_customers"]),
        staging.stg_products(stored["raw_products"]),
        finance.int_finance_daily(staging.stg_transactions(stored["raw_transactions"]))))
    text = plan(semantic.sem_revenue_metrics(orders).select("Order ID", "Gross Revenue (USD)"))
    assert "md5" not in text and "currency_code" not in text.split("ReadSchema")[1].split("\n")[0]


def test_no_python_in_the_plans(stored):
    text = plan(staging.stg_customers(stored["raw_customers"]))
    assert "Python" not in text and "Pandas" not in text
