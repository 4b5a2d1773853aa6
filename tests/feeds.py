"""Small hand-written feeds that exercise the edges."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import FEEDS


def feed(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = FEEDS[name]
    money = {f.name for f in schema.fields if f.dataType.typeName() == "decimal"}
    return spark.createDataFrame([
        tuple(Decimal(r[c]) if c in money and r.get(c) is not None else r.get(c) for c in schema.fieldNames())
        for r in rows
    ], schema)


def order(order_id, customer_id, product_id, day, amount, currency="USD", status="completed", channel="online",
          region="us") -> dict:
    return dict(order_id=order_id, customer_id=customer_id, product_id=product_id, order_date=day,
                order_amount_usd=amount, currency_code=currency, status=status, channel=channel, region=region)


def customer(customer_id, **values) -> dict:
    return {**dict(customer_id=customer_id, first_name="ann", last_name="lee", email=f"{customer_id}@X.org",
                   phone="+1", country="us", city="new york", signup_date="2023-01-01",
                   customer_segment="Premium", is_active="true"), **values}


def product(product_id, cost, price, **values) -> dict:
    return {**dict(product_id=product_id, product_name="Thing", category="home office", subcategory="lamps",
                   unit_cost_usd=cost, list_price_usd=price, is_active="true", launch_date="2023-01-01",
                   supplier_id="S1"), **values}


def transaction(transaction_id, order_id, day, amount, currency="USD", rate="1.0", kind="sale", **values) -> dict:
    return {**dict(transaction_id=transaction_id, order_id=order_id, transaction_date=day, amount_usd=amount,
                   currency_code=currency, fx_rate=rate, payment_method="PayPal", transaction_type=kind,
                   gl_account="4000-REVENUE", is_reconciled="true"), **values}


def feeds(spark: SparkSession, orders=(), customers=(), products=(), transactions=()) -> dict[str, DataFrame]:
    rows = {"raw_orders": orders, "raw_customers": customers, "raw_products": products,
            "raw_transactions": transactions}
    return {name: feed(spark, name, list(listed)) for name, listed in rows.items()}


def by_key(df: DataFrame, key: str) -> dict:
    return {row[key]: row for row in df.collect()}
