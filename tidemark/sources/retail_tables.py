"""The four raw feeds, as seen in a retail star schema (orders, lineitem, customer, part, nation, region).

Each order, customer, part and order line becomes one feed row. The mapping is a projection: apart from the two small
geography tables nothing is joined, so the feeds cost no shuffle. Values are put in the mixed spellings of a raw feed
and some are unusable (bad dates, missing ids, free items), so that staging has something to clean.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.schemas import RAW_ORDERS


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(column: str, choices: dict, default) -> Column:
    picked = None
    for value, result in choices.items():
        test = F.col(column) == value
        picked = F.when(test, result) if picked is None else picked.when(test, result)
    return picked.otherwise(default)


def _iso(day: Column) -> Column:
    return day.cast("date").cast("string")


def _money(amount: Column) -> Column:
    return amount.cast(RAW_ORDERS["order_amount_usd"].dataType)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def raw_orders(spark: SparkSession, sf_dir: str, typed_dates: bool = False) -> DataFrame:
    """``typed_dates``: dates stored as dates, all of them valid."""
    return orders_feed(_read(spark, sf_dir, "orders"), typed_dates)


def orders_feed(orders: DataFrame, typed_dates: bool = False) -> DataFrame:
    price = F.col("o_totalprice")
    text_date = (F.when(price < 1300, F.date_format("o_orderdate", "yyyy"))
                 .when(price < 1500, "unknown").otherwise(_iso(F.col("o_orderdate"))))
    status = (F.when(F.col("o_orderstatus") == "F", "Completed").when(F.col("o_orderstatus") == "P", "RETURNED")
              .when(F.col("o_orderpriority") == "5-LOW", "Cancelled").otherwise("pending"))
    return orders.select(
        _text("o_orderkey").alias("order_id"),
        F.when(price.between(1500, 3000), None).otherwise(_text("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", None)
        .otherwise(F.expr("cast(o_orderkey div 7 as string)")).alias("product_id"),
        (F.col("o_orderdate").cast("date") if typed_dates else text_date).alias("order_date"),
        _money(price.cast("decimal(12,2)") * F.lit(Decimal("0.001"))).alias("order_amount_usd"),
        _pick("o_orderpriority", {"2-HIGH": "gbp", "3-MEDIUM": "eur", "5-LOW": "jpy"}, "usd").alias("currency_code"),
        status.alias("status"),
        _pick("o_orderpriority", {"1-URGENT": "Online", "2-HIGH": "ONLINE", "3-MEDIUM": "Phone"}, "Retail")
        .alias("channel"),
        _pick("o_orderpriority", {"2-HIGH": "uk", "3-MEDIUM": "eu", "5-LOW": "jp"}, "us").alias("region"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = (_read(spark, sf_dir, "nation")
              .join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    balance = F.col("c_acctbal")
    signup = F.date_add(F.lit("1993-01-01").cast("date"), F.floor(balance / 10).cast("int"))
    return (
        _read(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            _text("c_custkey").alias("customer_id"),
            F.concat(F.lit("mary-"), F.lower("c_mktsegment")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat(F.lit("C"), _text("c_custkey"), F.lit("@Example.com")).alias("email"),
            F.concat(F.lit("+"), _text("c_nationkey"), F.lit("-555-"), _text("c_custkey")).alias("phone"),
            F.lower("n_name").alias("country"),
            F.col("r_name").alias("city"),
            F.when(balance < 0, "n/a").otherwise(_iso(signup)).alias("signup_date"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.when(balance < 0, "off").when(balance < 5000, "Yes").otherwise("true").alias("is_active"),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    price = F.col("p_retailprice").cast("decimal(12,2)") * F.lit(Decimal("0.1"))
    cost = price * (F.lit(Decimal("0.30")) + size * F.lit(Decimal("0.01")))
    launch = F.date_add(F.lit("1994-01-01").cast("date"), size)
    return _read(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_name"), F.lit("/"), F.lower("p_brand")).alias("subcategory"),
        _money(cost).alias("unit_cost_usd"),
        _money(F.when(size == 50, F.lit(Decimal("0.00"))).otherwise(price)).alias("list_price_usd"),
        F.when(size == 1, "no").otherwise("1").alias("is_active"),
        F.when(F.col("p_type") == "PROMO", "tbd").otherwise(_iso(launch)).alias("launch_date"),
        F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("supplier_id"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    discount = F.col("l_discount")
    day = _iso(F.col("l_shipdate"))
    rebate = F.lit(Decimal("1.00")) - discount.cast("decimal(4,2)")
    return _read(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day).alias("transaction_id"),
        _text("l_orderkey").alias("order_id"),
        F.when(F.col("l_extendedprice") < 1000, "pending").otherwise(day).alias("transaction_date"),
        _money(F.col("l_extendedprice").cast("decimal(12,2)") * rebate).alias("amount_usd"),
        _pick("l_linenumber", {4: "gbp", 5: "eur", 6: "jpy", 7: "chf"}, "usd").alias("currency_code"),
        _money(F.lit(Decimal("1.00")) + F.col("l_tax").cast("decimal(4,2)")).alias("fx_rate"),
        F.when(discount >= 0.08, "PayPal").when(discount >= 0.05, "Bank_Transfer")
        .when(discount >= 0.02, "debit_card").otherwise("CREDIT_CARD").alias("payment_method"),
        _pick("l_returnflag", {"R": "Refund", "N": "SALE"}, "adjustment").alias("transaction_type"),
        _pick("l_returnflag", {"R": "4200-RETURNS"}, "4000-REVENUE").alias("gl_account"),
        _pick("l_linestatus", {"F": "true"}, "f").alias("is_reconciled"),
    )


def feeds(spark: SparkSession, sf_dir: str, typed_dates: bool = False) -> dict[str, DataFrame]:
    return {
        "raw_orders": raw_orders(spark, sf_dir, typed_dates),
        "raw_customers": raw_customers(spark, sf_dir),
        "raw_products": raw_products(spark, sf_dir),
        "raw_transactions": raw_transactions(spark, sf_dir),
    }
