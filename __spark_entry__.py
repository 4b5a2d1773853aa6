"""Registered queries over the driver tables, each with its DuckDB statement where SQL can say the same.

Models run with a fixed run stamp, shown as text; results of whole-warehouse runs come without stamps.
"""

from __future__ import annotations

import datetime as dt
import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oracle.sql import statement
from tidemark import Warehouse
from tidemark.functions import cents_to_dollars, fiscal_quarter, safe_divide, strict_date, surrogate_key
from tidemark.operators import Check, Partitioning, Table, drop_pii
from tidemark.operators.quality import ACCEPTED, NOT_NULL, UNIQUE
from tidemark.plans import commerce, finance, semantic, staging
from tidemark.plans.checks import DEFAULT_CHECKS, VALUE_CHECKS
from tidemark.plans.warehouse import ORDER_MONTH, STAGING_NAMESPACES
from tidemark.session import materialize, work_path
from tidemark.sources import load_seed, read_feed_csv, retail_tables
from tidemark.sources.feeds import load_feed
from tidemark.streaming import SEQUENCE, stream_orders

AS_OF = dt.date(2001, 8, 15)
CUT = dt.date(2001, 6, 15)
OVERLAP = dt.date(2001, 5, 1)
RUN_TS = dt.datetime(2001, 8, 15, 2, 0, 0)
RESTATED_FROM = "2000-01-01"

ORDER_CHECKS = [Check("customer_id", UNIQUE), Check("product_name", NOT_NULL), Check("order_date", NOT_NULL),
                Check("order_status", ACCEPTED, ("completed", "pending"))]

STAMPS = ("_dbt_loaded_at", "_dbt_updated_at", "dw_updated_at")

Query = Callable[[SparkSession, str], DataFrame]

#: Queries whose models get the run stamp.
STAMPED = ("stg_orders", "stg_customers", "stg_products", "stg_transactions", "catalog_stg_orders", "catalog_stg_customers",
           "catalog_stg_products", "catalog_stg_transactions", "int_orders_enriched", "int_customer_360",
           "int_customer_360_idle", "int_customer_360_many_channels", "fct_orders", "dim_customer", "fct_transactions",
           "dummy_test", "pii_free_customers")


def _unstamped(query: Query) -> Query:
    return lambda spark, sf_dir: query(spark, sf_dir).drop(*STAMPS)


def _stamped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in STAMPS if c in df.columns})
    return run


# -- feeds through CSV ---------------------------------------------------------------------------------------------

def _seed(feed: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = work_path(spark, feed)
        getattr(retail_tables, feed)(spark, sf_dir).write.option("header", True).csv(folder)
        return load_seed(read_feed_csv(spark, feed, folder), work_path(spark, f"seed_{feed}"))
    return query


# -- full-refresh models -------------------------------------------------------------------------------------------

def _stg_orders(spark, sf_dir):
    return staging.stg_orders(retail_tables.raw_orders(spark, sf_dir), RUN_TS)


def _stg_customers(spark, sf_dir):
    return staging.stg_customers(retail_tables.raw_customers(spark, sf_dir), AS_OF, RUN_TS)


def _stg_products(spark, sf_dir):
    return staging.stg_products(retail_tables.raw_products(spark, sf_dir), RUN_TS)


def _stg_transactions(spark, sf_dir):
    return staging.stg_transactions(retail_tables.raw_transactions(spark, sf_dir), RUN_TS)


def _daily(spark, sf_dir):
    return finance.int_finance_daily(_stg_transactions(spark, sf_dir))


def _enriched_from(spark, sf_dir, orders: DataFrame) -> DataFrame:
    """Customers and products are projections of their feeds, cheaper to read again than to write; the rates are not."""
    return commerce.int_orders_enriched(orders, _stg_customers(spark, sf_dir), _stg_products(spark, sf_dir),
                                        materialize(_daily(spark, sf_dir), "int_finance_daily"), RUN_TS)


def _enriched(spark, sf_dir):
    return _enriched_from(spark, sf_dir, _stg_orders(spark, sf_dir))


def _customer_360_of(change: Callable[[DataFrame], DataFrame]) -> Query:
    """The customer view over enriched orders whose staged rows were changed first."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = _enriched_from(spark, sf_dir, change(_stg_orders(spark, sf_dir)))
        return commerce.int_customer_360(_stg_customers(spark, sf_dir), orders, AS_OF, RUN_TS)
    return query


def _with_idle_customers(orders: DataFrame) -> DataFrame:
    """Every third customer's orders go to the next one, so that many customers have none."""
    number = F.col("customer_id").cast("long")
    return orders.withColumn("customer_id", F.when(number % 3 == 0, (number + 1).cast("string"))
                             .otherwise(F.col("customer_id")))


def _with_many_channels(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_channel", F.concat(F.lit("channel "), (F.col("order_id").cast("long") % 997)
                                                       .cast("string")))


_customer_360 = _customer_360_of(lambda orders: orders)


def _fct_orders(spark, sf_dir):
    return commerce.fct_orders(_enriched(spark, sf_dir))


def _dim_customer(spark, sf_dir):
    return commerce.dim_customer(_customer_360(spark, sf_dir), RUN_TS)


def _fct_transactions(spark, sf_dir):
    return finance.fct_transactions(
        _stg_transactions(spark, sf_dir), materialize(_daily(spark, sf_dir), "int_finance_daily"), RUN_TS)


def _in_catalog(feed: str, view: str) -> Query:
    """A staging view over the stored feed, read by name from another session."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder, root = work_path(spark, feed), work_path(spark, "warehouse")
        getattr(retail_tables, feed)(spark, sf_dir).write.option("header", True).csv(folder)
        tables = {feed: load_feed(spark, feed, folder, f"{root}/{feed}")}
        prefix = f"q{uuid.uuid4().hex[:12]}_"
        Warehouse(spark, root, {}, AS_OF, run_ts=RUN_TS, feed_tables=tables).register_staging(prefix)
        return spark.newSession().table(f"{prefix}{STAGING_NAMESPACES[view]}.{view}")
    return query


# -- expressions ---------------------------------------------------------------------------------------------------

def _cents(spark, sf_dir):
    cents = F.col("o_orderkey")
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey",
        cents_to_dollars(cents).cast("decimal(18,2)").alias("dollars"),
        cents_to_dollars(cents, 1).cast("decimal(18,1)").alias("dollars_1"))


def _safe_divide(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        safe_divide(F.col("l_quantity"), F.col("l_discount")).alias("per_discount"),
        safe_divide(F.col("l_quantity"), F.col("l_tax"), -1).alias("per_tax"))


def _fiscal_quarter(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", fiscal_quarter(F.col("o_orderdate").cast("date")).alias("fiscal_quarter"))


def _surrogate_key(spark, sf_dir):
    return retail_tables.raw_orders(spark, sf_dir).select(
        "order_id", surrogate_key("order_id", "customer_id", "product_id").alias("order_line_sk"))


# -- whole-warehouse runs ------------------------------------------------------------------------------------------

def _checked(checks: dict) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = Warehouse(spark, work_path(spark, "warehouse"), retail_tables.feeds(spark, sf_dir), AS_OF)
        warehouse.run()
        return warehouse.check(checks)
    return query


def _checked_by_change(spark, sf_dir):
    """The report after an incremental run, from evidence kept at the check before it and that of new partitions."""
    then, now = _with_history(spark, sf_dir)
    _load_history(then, now)
    checks = {"int_orders_enriched": DEFAULT_CHECKS["int_orders_enriched"] + ORDER_CHECKS}
    now.check(checks, by_change=True).count()
    now.refresh_orders()
    return now.check(checks, by_change=True)


def _high_water_mark(spark, sf_dir):
    return _stg_orders(spark, sf_dir).agg(F.max("order_date").alias("latest_order_date"))


# -- incremental runs ----------------------------------------------------------------------------------------------

def _history_feeds(spark, sf_dir):
    """The feeds as they were before CUT: later orders are not there yet and no order is settled."""
    feeds = retail_tables.feeds(spark, sf_dir, typed_dates=True)
    past = feeds["raw_orders"].where(F.col("order_date") < F.lit(CUT)).withColumn("status", F.lit("pending"))
    return {**feeds, "raw_orders": past}


def _with_history(spark, sf_dir) -> tuple[Warehouse, Warehouse]:
    """A warehouse run up to CUT, and the same one with the feeds as they are now."""
    root = work_path(spark, "warehouse")
    then = Warehouse(spark, root, _history_feeds(spark, sf_dir), CUT)
    now = Warehouse(spark, root, retail_tables.feeds(spark, sf_dir, typed_dates=True), AS_OF)
    now.refresh_finance_daily()
    return then, now


def _load_history(then: Warehouse, now: Warehouse) -> None:
    Warehouse(then.spark, then.root, then.feeds, now.as_of).refresh_orders()


def _orders_upsert(spark, sf_dir):
    then, now = _with_history(spark, sf_dir)
    _load_history(then, now)
    now.refresh_orders()
    return now.relation("int_orders_enriched")


def _orders_full_refresh(spark, sf_dir):
    then, now = _with_history(spark, sf_dir)
    _load_history(then, now)
    now.refresh_orders(full_refresh=True)
    return now.relation("int_orders_enriched")


def _orders_upsert_from_csv(spark, sf_dir):
    """Orders come in CSV files: a history of pending ones, then new files with the later days."""
    folder, root = work_path(spark, "incoming"), work_path(spark, "warehouse")
    feeds = retail_tables.feeds(spark, sf_dir)
    orders = feeds.pop("raw_orders")
    day = strict_date(F.col("order_date"), orders.schema["order_date"].dataType)
    feeds["raw_orders"] = orders.where(day < F.lit(CUT)).withColumn("status", F.lit("pending"))
    for feed, rows in feeds.items():
        rows.write.option("header", True).csv(f"{folder}/{feed}.csv")
    before = Warehouse.from_csv(spark, root, folder, as_of=AS_OF)
    before.refresh_finance_daily()
    before.refresh_orders()
    orders.where(day >= F.lit(CUT)).write.mode("append").option("header", True).csv(f"{folder}/raw_orders.csv")
    after = Warehouse.from_csv(spark, root, folder, as_of=AS_OF)
    after.refresh_orders()
    return after.relation("int_orders_enriched")


def _customer_360_upsert(spark, sf_dir):
    then, now = _with_history(spark, sf_dir)
    _load_history(then, now)
    then.refresh_customers()
    now.refresh_orders()
    now.refresh_customers()
    return now.relation("int_customer_360")


def _restated(spark, sf_dir, *facts: str) -> Warehouse:
    """A warehouse whose rates were raised after it was built, with some of the fact tables."""
    feeds = retail_tables.feeds(spark, sf_dir, typed_dates=True)
    root = work_path(spark, "warehouse")
    before = Warehouse(spark, root, feeds, AS_OF)
    before.refresh_finance_daily()
    before.refresh_orders()
    before.refresh_facts(*facts)
    day = F.col("transaction_date")
    restated = (F.col("is_reconciled") == "true") & (day >= RESTATED_FROM) & (day < "3")
    transactions = feeds["raw_transactions"].withColumn(
        "fx_rate", F.when(restated, F.col("fx_rate") + F.lit("0.05").cast("decimal(18,6)"))
        .otherwise(F.col("fx_rate")).cast("decimal(18,6)"))
    after = Warehouse(spark, root, {**feeds, "raw_transactions": transactions}, AS_OF)
    after.restate_rates()
    return after


def _fx_restatement(spark, sf_dir):
    return _restated(spark, sf_dir, "fct_orders").relation("int_orders_enriched")


def _fx_restatement_facts(spark, sf_dir):
    return _restated(spark, sf_dir, "fct_orders").relation("fct_orders")


def _fx_restatement_transactions(spark, sf_dir):
    return _restated(spark, sf_dir, "fct_transactions").relation("dummy_test")


def _schema_evolution(spark, sf_dir):
    """The second load brings a new column and no longer carries an old one."""
    history = staging.stg_orders(_history_feeds(spark, sf_dir)["raw_orders"])
    orders = staging.stg_orders(retail_tables.raw_orders(spark, sf_dir, typed_dates=True))
    table = Table(spark, work_path(spark, "orders"),
                  Partitioning("order_month", ORDER_MONTH))
    table.overwrite(history.select("order_id", "order_date", "order_status", "region"))
    table.upsert(orders.where(F.col("order_date") >= F.lit(OVERLAP))
                 .select("order_id", "order_date", "order_status", "currency_code"), "order_id")
    return table.read()


def _orders_change_feed(spark, sf_dir):
    """What an incremental run of the orders changed in their table."""
    then, now = _with_history(spark, sf_dir)
    _load_history(then, now)
    table = now.table("int_orders_enriched")
    since = table.number()
    now.refresh_orders()
    return table.changes(since, "order_id", ignore=STAMPS)


def _streamed(spark: SparkSession, sf_dir: str, deliver: Callable[[DataFrame, DataFrame], list[DataFrame]]) -> DataFrame:
    """Orders that arrive in deliveries of many files, each as pending (1) and as it is (2), after a history was loaded.

    The stream is started anew for each delivery and goes on from its checkpoint."""
    then, now = _with_history(spark, sf_dir)
    _load_history(then, now)
    feed = retail_tables.raw_orders(spark, sf_dir, typed_dates=True)
    final = feed.withColumn(SEQUENCE, F.lit(2))
    first = feed.withColumns({"status": F.lit("pending"), SEQUENCE: F.lit(1)})
    folder, checkpoint, conflicts = (work_path(spark, name) for name in ("arriving", "stream", "conflicts"))
    for number, orders in enumerate(deliver(first, final), 1):
        orders.write.parquet(f"{folder}/number={number}")
        arriving = spark.readStream.schema(final.schema).option("recursiveFileLookup", True).parquet(folder)
        stream_orders(now, arriving, checkpoint, SEQUENCE, conflicts).awaitTermination()
    return now.relation("int_orders_enriched")


def _every(n: int) -> Column:
    return F.col("order_id").cast("long") % n == 0


def _orders_stream(spark, sf_dir):
    """Each order comes as pending and then as it is, most in one delivery; every seventh comes again in a second one."""
    late = _every(7)
    return _streamed(spark, sf_dir, lambda first, final: [
        first.union(final.where(~late)), first.where(late).union(final.where(late))])


def _orders_stream_out_of_order(spark, sf_dir):
    """Of every second order the last version comes first, and the older one only later; some come a third time."""
    ahead = _every(2)
    return _streamed(spark, sf_dir, lambda first, final: [
        final.where(ahead).union(first.where(~ahead)), first.where(ahead).union(final.where(~ahead)),
        first.where(_every(3)).union(final.where(_every(5)))])


# -- driver contract -----------------------------------------------------------------------------------------------

def entry(spark: SparkSession) -> DataFrame:
    """Enriched orders: orders, customers, products and daily rates brought together."""
    return queries()["int_orders_enriched"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    plain: dict[str, Query] = {
        "raw_orders": _seed("raw_orders"),
        "raw_customers": _seed("raw_customers"),
        "raw_products": _seed("raw_products"),
        "raw_transactions": _seed("raw_transactions"),
        "stg_orders": _stg_orders,
        "stg_customers": _stg_customers,
        "stg_products": _stg_products,
        "stg_transactions": _stg_transactions,
        "catalog_stg_orders": _in_catalog("raw_orders", "stg_orders"),
        "catalog_stg_customers": _in_catalog("raw_customers", "stg_customers"),
        "catalog_stg_products": _in_catalog("raw_products", "stg_products"),
        "catalog_stg_transactions": _in_catalog("raw_transactions", "stg_transactions"),
        "int_finance_daily": _daily,
        "int_orders_enriched": _enriched,
        "int_customer_360": _customer_360,
        "int_customer_360_idle": _customer_360_of(_with_idle_customers),
        "int_customer_360_many_channels": _customer_360_of(_with_many_channels),
        "fct_orders": _fct_orders,
        "dim_customer": _dim_customer,
        "fct_transactions": _fct_transactions,
        "dummy_test": lambda spark, sf_dir: finance.dummy_test(_fct_transactions(spark, sf_dir)),
        "sem_revenue_metrics": lambda spark, sf_dir: semantic.sem_revenue_metrics(_fct_orders(spark, sf_dir)),
        "sem_customer_kpis": lambda spark, sf_dir: semantic.sem_customer_kpis(_dim_customer(spark, sf_dir)),
        "sem_finance_summary": lambda spark, sf_dir: semantic.sem_finance_summary(_fct_transactions(spark, sf_dir)),
        "cents_to_dollars": _cents,
        "safe_divide": _safe_divide,
        "fiscal_quarter": _fiscal_quarter,
        "surrogate_key": _surrogate_key,
        "pii_free_customers": lambda spark, sf_dir: drop_pii(_stg_customers(spark, sf_dir)),
        "data_quality_report": _checked(DEFAULT_CHECKS),
        "accepted_values_report": _checked(VALUE_CHECKS),
        "data_quality_by_change": _checked_by_change,
        "high_water_mark": _high_water_mark,
        "orders_upsert": _orders_upsert,
        "orders_upsert_from_csv": _orders_upsert_from_csv,
        "orders_full_refresh": _orders_full_refresh,
        "customer_360_upsert": _customer_360_upsert,
        "fx_restatement": _fx_restatement,
        "fx_restatement_facts": _fx_restatement_facts,
        "fx_restatement_transactions": _fx_restatement_transactions,
        "schema_evolution_append": _schema_evolution,
        "orders_stream_upsert": _orders_stream,
        "orders_stream_out_of_order": _orders_stream_out_of_order,
        "orders_change_feed": _orders_change_feed,
    }
    models = {name: (_stamped if name in STAMPED else _unstamped)(query) for name, query in plain.items()}
    return {**models, **_corpus_queries()}


def oracle_sql() -> dict[str, str]:
    corpus = _corpus_queries()
    return {**{name: statement(name) for name in queries() if name not in corpus}, **_corpus_sql()}


# -- the corpus subpackage, where it is there ----------------------------------------------------------------------

def _present(module: str) -> bool:
    try:
        return importlib.util.find_spec(module) is not None
    except ModuleNotFoundError:
        return False


def _corpus_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    if _present("tidemark.llm.queries"):
        from tidemark.llm import queries as corpus
        found.update(corpus.queries())
        if _present("corpus_pipeline"):
            import corpus_pipeline
            found["pipeline"] = corpus_pipeline.run
    return found


def _corpus_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    if _present("tidemark.llm.queries"):
        from tidemark.llm import queries as corpus
        found.update(corpus.oracle_sql())
        if _present("corpus_pipeline"):
            import corpus_pipeline
            if corpus_pipeline.ORACLE_SQL:
                found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
