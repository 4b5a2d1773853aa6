from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from tests.feeds import by_key, customer, feed, feeds, order, product, transaction
from tidemark.operators import drop_pii
from tidemark.plans import commerce, finance, semantic, staging

AS_OF = dt.date(2024, 7, 1)
STAMP = dt.datetime(2024, 7, 1, 12)


def stage(raw):
    return (staging.stg_orders(raw["raw_orders"], STAMP), staging.stg_customers(raw["raw_customers"], AS_OF, STAMP),
            staging.stg_products(raw["raw_products"], STAMP), staging.stg_transactions(raw["raw_transactions"], STAMP))


def enrich(raw):
    orders, customers, products, transactions = stage(raw)
    return commerce.int_orders_enriched(orders, customers, products, finance.int_finance_daily(transactions), STAMP)


def test_stg_orders_types_and_keeps_bad_dates(spark):
    raw = feed(spark, "raw_orders", [
        order("1", "C1", "P1", "2024-01-05", "10.005", "usd", "Completed", "ONLINE", "us"),
        order("2", "C1", "P1", "not a date", "10", status=None),
        order(None, "C1", "P1", "2024-01-05", "10"),
    ])
    rows = by_key(staging.stg_orders(raw, STAMP), "order_id")
    assert set(rows) == {"1", "2"}
    assert rows["1"].asDict() == {
        "order_id": "1", "customer_id": "C1", "product_id": "P1", "order_date": dt.date(2024, 1, 5),
        "order_amount_usd": Decimal("10.01"), "currency_code": "USD", "order_status": "completed",
        "order_channel": "online", "region": "US", "_dbt_loaded_at": STAMP}
    assert rows["2"].order_date is None and rows["2"].order_status is None


def test_amount_beyond_its_type_is_an_error(spark):
    raw = feed(spark, "raw_orders", [order("1", "C1", "P1", "2024-01-05", "10000000000")])
    with pytest.raises(PySparkException):
        staging.stg_orders(raw).collect()


def test_stg_customers(spark):
    raw = feed(spark, "raw_customers", [
        customer("C1", first_name="jean-luc", city="MIDDLE EAST", email="A@B.C", country="fr", is_active="on"),
        customer("C2", signup_date="n/a"), customer(None)])
    rows = by_key(staging.stg_customers(raw, AS_OF, STAMP), "customer_id")
    assert set(rows) == {"C1", "C2"}
    one = rows["C1"]
    assert (one.first_name, one.city, one.email, one.country_code, one.phone_number, one.is_active) == (
        "Jean-Luc", "Middle East", "a@b.c", "FR", "+1", True)
    assert one.customer_segment == "premium" and one.days_since_signup == (AS_OF - dt.date(2023, 1, 1)).days
    assert rows["C2"].signup_date is None and rows["C2"].days_since_signup is None


def test_pii_marks_survive_parquet(spark, tmp_path):
    staged = staging.stg_customers(feed(spark, "raw_customers", [customer("C1")]), AS_OF)
    staged.write.parquet(str(tmp_path / "c"))
    left = drop_pii(spark.read.parquet(str(tmp_path / "c"))).columns
    assert left == [c for c in staged.columns if c not in ("first_name", "last_name", "email", "phone_number")]


def test_stg_products_margin(spark):
    raw = feed(spark, "raw_products", [
        product("P1", "12.30", "41.00"), product("P2", "7.05", "19.99"), product("P3", "1.00", "8.00"),
        product("P4", "1.00", "0"), product("P5", None, "10")])
    margins = {k: r.gross_margin_pct for k, r in by_key(staging.stg_products(raw), "product_id").items()}
    assert margins == {"P1": Decimal("70.00"), "P2": Decimal("64.73"), "P3": Decimal("87.50"), "P4": None, "P5": None}


def test_stg_transactions_local_amount_is_decimal(spark):
    raw = feed(spark, "raw_transactions", [
        transaction("T1", "1", "2024-01-05", "330.32", "gbp", "1.1875"),    # a product that ends in 5: 392.255
        transaction("T2", "1", "2024-01-05", "815.00", "eur", "1.4790", is_reconciled="off"),    # 1205.385
        transaction(None, "1", "2024-01-05", "1")])
    rows = by_key(staging.stg_transactions(raw), "transaction_id")
    assert rows["T1"].amount_local == Decimal("392.26") and rows["T2"].amount_local == Decimal("1205.39")
    assert rows["T1"].currency_code == "GBP" and rows["T2"].is_reconciled is False and len(rows) == 2


def test_local_amount_uses_the_amount_as_delivered(spark):
    raw = feed(spark, "raw_transactions", [transaction("T1", "1", "2024-01-05", "100.00005", rate="100")])
    row = staging.stg_transactions(raw).first()
    assert row.amount_usd == Decimal("100.0001") and row.amount_local == Decimal("10000.01")
    raw = feed(spark, "raw_transactions", [transaction("T1", "1", "2024-01-05", "100.00004", rate="1000")])
    assert staging.stg_transactions(raw).first().amount_local == Decimal("100000.04")


def test_finance_daily(spark):
    day = "2024-01-05"
    raw = feed(spark, "raw_transactions", [
        transaction("T1", "1", day, "100", "gbp", "1.20"), transaction("T2", "2", day, "50", "gbp", "1.30", "refund"),
        transaction("T3", "3", day, "7", "gbp", "1.40", "adjustment", is_reconciled="false"),
        transaction("T4", "4", day, "9", "usd"), transaction("T5", "5", "bad", "1", "usd")])
    rows = {(r.rate_date, r.currency_code): r for r in
            finance.int_finance_daily(staging.stg_transactions(raw)).collect()}
    gbp = rows[dt.date(2024, 1, 5), "GBP"]
    assert (gbp.fx_rate, gbp.transaction_count, gbp.reconciled_count, gbp.unreconciled_count) == (
        Decimal("1.3000000000"), 3, 2, 1)
    assert (gbp.total_sales_usd, gbp.total_refunds_usd, gbp.net_revenue_usd) == (100, 50, 157)
    assert len(rows) == 3 and (None, "USD") in rows


def edge_feeds(spark):
    return feeds(
        spark,
        orders=[
            order("1", "C1", "P1", "2024-01-05", "250.00"),
            order("2", "C1", "P1", "2024-01-06", "100.00", "gbp", "returned", "retail", "uk"),
            order("3", "C1", "PX", "2024-01-07", "80.00"),
            order("4", "CX", "P1", "2024-01-08", "10.00", status="PENDING"),
            order("5", None, None, None, "10.00", status=None),
            order("6", "C1", "P1", "2024-01-06", "20.00", "gbp", "cancelled"),
        ],
        customers=[customer("C1"), customer("C2", is_active="false")],
        products=[product("P1", "85.00", "250.00")],
        transactions=[transaction("T1", "2", "2024-01-06", "100", "gbp", "1.2750"),
                      transaction("T2", "6", "2024-01-06", "20", "GBP", "1.2850", "refund")],
    )


def test_orders_enriched_edges(spark):
    rows = by_key(enrich(edge_feeds(spark)), "order_id")
    assert len(rows) == 6
    assert (rows["1"].fx_rate, rows["1"].order_amount_local) == (1, Decimal("250.00"))
    assert (rows["2"].fx_rate, rows["2"].order_amount_local) == (Decimal("1.28"), Decimal("128.00"))
    assert (rows["1"].recognized_revenue_usd, rows["1"].gross_profit_usd) == (250, 165)
    assert (rows["3"].recognized_revenue_usd, rows["3"].gross_profit_usd) == (80, None)
    for other in "2456":
        assert (rows[other].recognized_revenue_usd, rows[other].gross_profit_usd) == (0, 0)
    assert (rows["4"].is_completed, rows["5"].is_completed, rows["2"].is_returned, rows["6"].is_cancelled) == (
        False, False, True, True)
    assert rows["4"].customer_segment is None and rows["1"].customer_country == "US"


def test_customer_360_edges(spark):
    raw = edge_feeds(spark)
    rows = by_key(commerce.int_customer_360(stage(raw)[1], enrich(raw), AS_OF, STAMP), "customer_id")
    assert set(rows) == {"C1", "C2"}
    one, two = rows["C1"], rows["C2"]
    assert (one.total_orders, one.completed_orders, one.returned_orders, one.cancelled_orders) == (4, 2, 1, 1)
    assert (one.lifetime_revenue_usd, one.lifetime_gross_profit_usd, one.avg_order_value_usd) == (330, 165, 165)
    assert (one.first_order_date, one.last_order_date) == (dt.date(2024, 1, 5), dt.date(2024, 1, 7))
    assert (one.preferred_channel, one.primary_region, one.rfm_status, one.clv_band) == (
        "retail", "US", "lapsed", "medium")
    assert (two.total_orders, two.lifetime_revenue_usd, two.avg_order_value_usd, two.last_order_date,
            two.days_since_last_order, two.preferred_channel, two.rfm_status, two.clv_band) == (
        0, 0, None, None, None, None, "churned", "low")
    assert not {"first_name", "last_name", "email", "phone_number"} & set(one.asDict())


@pytest.mark.parametrize("days, status", [
    (0, "active"), (30, "active"), (31, "at_risk"), (90, "at_risk"), (91, "lapsed"), (180, "lapsed"),
    (181, "churned")])
def test_recency_bounds(spark, days, status):
    raw = feeds(spark, [order("1", "C1", "P1", str(AS_OF - dt.timedelta(days)), "1")], [customer("C1")])
    assert commerce.int_customer_360(stage(raw)[1], enrich(raw), AS_OF).first().rfm_status == status


@pytest.mark.parametrize("revenue, band", [("299.99", "low"), ("300", "medium"), ("999.99", "medium"),
                                           ("1000", "high")])
def test_value_bounds(spark, revenue, band):
    raw = feeds(spark, [order("1", "C1", "P1", "2024-01-01", revenue)], [customer("C1")])
    assert commerce.int_customer_360(stage(raw)[1], enrich(raw), AS_OF).first().clv_band == band


def test_many_channels_are_aggregated_as_text(spark):
    many = [order(str(i), "C1", "P1", "2024-01-01", "1", channel=f"channel {i:03d}") for i in range(90)]
    raw = feeds(spark, many, [customer("C1")])
    assert commerce.int_customer_360(stage(raw)[1], enrich(raw), AS_OF).first().preferred_channel == "channel 089"


def test_dim_customer_return_rate(spark):
    rows = [order(str(i), "C1", "P1", "2024-01-01", "1", status="returned" if i == 0 else "completed")
            for i in range(3)]
    raw = feeds(spark, rows, [customer("C1"), customer("C2")])
    dim = by_key(commerce.dim_customer(commerce.int_customer_360(stage(raw)[1], enrich(raw), AS_OF)), "customer_id")
    assert dim["C1"].return_rate_pct == 33.33 and dim["C2"].return_rate_pct is None
    assert dim["C1"].is_current is True and len(dim["C1"].customer_sk) == 32


def test_fct_transactions(spark):
    raw = edge_feeds(spark)
    transactions = stage(raw)[3]
    daily = finance.int_finance_daily(transactions)
    rows = by_key(finance.fct_transactions(transactions, daily, STAMP), "transaction_id")
    assert (rows["T1"].sale_amount_usd, rows["T1"].refund_amount_usd) == (100, 0)
    assert (rows["T2"].sale_amount_usd, rows["T2"].refund_amount_usd) == (0, 20)
    assert (rows["T1"].daily_net_revenue_usd, rows["T1"].daily_transaction_count) == (120, 2)
    assert (rows["T1"].transaction_year, rows["T1"].transaction_month, rows["T1"].transaction_quarter) == (2024, 1, 1)
    assert "dummy" not in rows["T1"].asDict()


def test_semantic_names(spark):
    raw = edge_feeds(spark)
    orders = semantic.sem_revenue_metrics(commerce.fct_orders(enrich(raw)))
    kpis = semantic.sem_customer_kpis(commerce.dim_customer(
        commerce.int_customer_360(stage(raw)[1], enrich(raw), AS_OF)))
    assert (len(orders.columns), len(kpis.columns)) == (22, 22)
    kpis.createOrReplaceTempView("kpis")
    assert spark.sql("SELECT max(`Return Rate %`) FROM kpis").first()[0] == 25.0
