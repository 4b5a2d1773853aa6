"""The whole warehouse: staging and semantic views, intermediate and star-schema tables, full and incremental runs."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import fits_broadcast, lookup
from tidemark.operators.quality import Check, check_relations, keep_evidence
from tidemark.operators.tables import NULL_PARTITION, Partitioning, Table
from tidemark.plans import commerce, finance, semantic, staging, staging_sql
from tidemark.plans.checks import DEFAULT_CHECKS
from tidemark.session import materialize, side_by_side, temporary
from tidemark.sources.feeds import load_feed
from tidemark.sources.schemas import FEEDS

SEED_LAYER, EVIDENCE_LAYER = "seeds", "evidence"

# The namespace of each stored relation.
TABLES = {
    "int_finance_daily": "finance_int",
    "fct_transactions": "finance_edw",
    "int_orders_enriched": "commerce_int",
    "int_customer_360": "commerce_int",
    "fct_orders": "commerce_edw",
    "dim_customer": "commerce_edw",
    "dummy_test": "commerce_edw",
}
VIEWS = ("stg_orders", "stg_customers", "stg_products", "stg_transactions", "sem_revenue_metrics",
         "sem_customer_kpis", "sem_finance_summary")

# The namespace of each staging view.
STAGING_NAMESPACES = {
    "stg_orders": "commerce_staging",
    "stg_customers": "commerce_staging",
    "stg_products": "commerce_staging",
    "stg_transactions": "finance_staging",
}

# The namespace of each business view.
VIEW_NAMESPACES = {
    "sem_revenue_metrics": "commerce_semantic",
    "sem_customer_kpis": "commerce_semantic",
    "sem_finance_summary": "finance_semantic",
}

# State behind the relations, brought up to date with them: figures per customer and month of orders.
STATE = {"customer_order_parts": "state"}

CUSTOMERS_PER_BUCKET = 100_000     # from which the number of buckets follows when the table is first written
ORDER_MONTH = "date_format(order_date, 'yyyy-MM')"
PARTITIONS = {
    "int_orders_enriched": Partitioning("order_month", ORDER_MONTH),
    "customer_order_parts": Partitioning("part_month", "order_month"),
    "fct_orders": Partitioning("fact_month", ORDER_MONTH),
    "fct_transactions": Partitioning("fact_month", "date_format(transaction_date, 'yyyy-MM')"),
}
DAILY = "int_finance_daily"


class Warehouse:
    """Relations under ``root``, built from the four raw feeds.

    ``feed_tables`` are the tables that hold feeds, if they do: then only months of a feed that are others than before, or
    that a bound lets through, are read.

    ``as_of`` stands in for today in the day counts; left out, it is the run date. ``run_ts`` stands in for the clock
    in the run stamps. ``customer_buckets``, if given, must be the number that the customer table was written with; left
    out, it is read from the table, or follows from the number of customers when the table is first written.
    """

    def __init__(self, spark: SparkSession, root: str, feeds: dict[str, DataFrame], as_of: dt.date | None = None,
                 customer_buckets: int | None = None, run_ts: dt.datetime | None = None,
                 feed_tables: dict[str, Table] | None = None):
        self.spark = spark
        self.root = root
        self.feeds = feeds
        self.as_of = as_of
        self.run_ts = run_ts
        self.customer_buckets = customer_buckets
        self.feed_tables = feed_tables or {}

    @classmethod
    def from_csv(cls, spark: SparkSession, root: str, folder: str, **options) -> Warehouse:
        """Load the CSV feeds into tables first, then read those; of feeds that grow, only new files."""
        with temporary(spark):
            loaded = side_by_side(spark, *[
                partial(load_feed, spark, feed, f"{folder}/{feed}.csv", f"{root}/{SEED_LAYER}/{feed}") for feed in FEEDS])
        tables = dict(zip(FEEDS, loaded))
        feeds = {feed: table.read(hidden=True) for feed, table in tables.items()}
        return cls(spark, root, feeds, feed_tables=tables, **options)

    # -- relations -------------------------------------------------------------------------------------------

    def table(self, name: str) -> Table:
        table = Table(self.spark, f"{self.root}/{(TABLES | STATE)[name]}/{name}", PARTITIONS.get(name))
        if name == "int_customer_360":
            table.partitioning = self._customer_partitioning(table)
        elif name == "dummy_test":
            table.partitioning = table.stored_partitioning()
        return table

    def _customer_partitioning(self, table: Table) -> Partitioning:
        stored = table.stored_partitioning()
        if self.customer_buckets is None and stored is not None:
            return stored
        if self.customer_buckets is None:
            self.customer_buckets = max(1, -(-self.feeds["raw_customers"].count() // CUSTOMERS_PER_BUCKET))
        return Partitioning("bucket", f"pmod(xxhash64(customer_id), {self.customer_buckets})", fixed=True)

    def relation(self, name: str) -> DataFrame:
        """A stored table, or a view computed when it is read."""
        return getattr(self, name)() if name in VIEWS else self.table(name).read()

    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.feeds["raw_orders"], self.run_ts)

    def stg_customers(self) -> DataFrame:
        return staging.stg_customers(self.feeds["raw_customers"], self.as_of, self.run_ts)

    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.feeds["raw_products"], self.run_ts)

    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.feeds["raw_transactions"], self.run_ts)

    def sem_revenue_metrics(self) -> DataFrame:
        return semantic.sem_revenue_metrics(self.relation("fct_orders"))

    def sem_customer_kpis(self) -> DataFrame:
        return semantic.sem_customer_kpis(self.relation("dim_customer"))

    def sem_finance_summary(self) -> DataFrame:
        return semantic.sem_finance_summary(self.relation("fct_transactions"))

    def create_views(self) -> None:
        """Make every relation readable by name in SQL."""
        for name in (*TABLES, *VIEWS):
            self.relation(name).createOrReplaceTempView(name)

    def register(self, prefix: str = "") -> None:
        """Make the stored tables and the business views readable in the catalog, in the namespace of their layer; and, if
        the feeds are held in tables, those and the staging views over them.

        They outlive the session wherever the catalog does, and show the tables as they are now. ``prefix`` is put before
        each namespace.
        """
        for namespace in {*TABLES.values(), *VIEW_NAMESPACES.values()}:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{namespace}")
        for name, namespace in TABLES.items():
            self.table(name).register(f"{prefix}{namespace}.{name}")
        for name, namespace in VIEW_NAMESPACES.items():
            source, names = semantic.VIEWS[name]
            columns = ", ".join(f"`{column}` AS `{label}`" for column, label in names.items())
            self.spark.sql(f"CREATE OR REPLACE VIEW {prefix}{namespace}.{name} AS SELECT {columns} "
                           f"FROM {prefix}{TABLES[source]}.{source}")
        if self.feed_tables:
            self.register_staging(prefix)

    def register_staging(self, prefix: str = "") -> None:
        """The tables of the feeds, and the staging views as SQL over them, in the catalog."""
        for namespace in {SEED_LAYER, *STAGING_NAMESPACES.values()}:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{namespace}")
        for view, namespace in STAGING_NAMESPACES.items():
            feed, _ = staging_sql.SOURCES[view]
            if feed not in self.feed_tables:
                continue
            self.feed_tables[feed].register(f"{prefix}{SEED_LAYER}.{feed}")
            text = staging_sql.select(view, f"{prefix}{SEED_LAYER}.{feed}__files", self.as_of, self.run_ts)
            self.spark.sql(f"CREATE OR REPLACE VIEW {prefix}{namespace}.{view} AS {text}")

    # -- runs ------------------------------------------------------------------------------------------------

    def run(self, full_refresh: bool = False) -> None:
        """Bring all tables up to date; ``full_refresh`` rebuilds the incremental ones too."""
        def commerce_tables() -> None:
            self.refresh_orders(full_refresh)
            self.refresh_customers(full_refresh)
            self._refresh_customer_dimension()
            self.refresh_facts("fct_orders", full_refresh=full_refresh)

        with temporary(self.spark):
            self.refresh_finance_daily()
            # neither needs what the other writes
            side_by_side(self.spark, commerce_tables, lambda: self.refresh_facts("fct_transactions", full_refresh=full_refresh))

    def expire(self, keep: int = 2) -> None:
        """Delete what only snapshots before the last ``keep`` of each table name."""
        for name in (*TABLES, *STATE):
            self.table(name).expire(keep)
        for name in TABLES:
            evidence = Table(self.spark, f"{self.root}/{EVIDENCE_LAYER}/{name}")
            if evidence.exists():
                evidence.expire(keep)
        for table in self.feed_tables.values():
            table.expire(keep)

    def refresh_finance_daily(self) -> None:
        """From all transactions, or, of a feed kept by month, from the months that are others than at the last run."""
        table, feed = self.table(DAILY), self.feed_tables.get("raw_transactions")
        if feed is None:
            table.overwrite(finance.daily_state(self.stg_transactions()), {})
            return
        loads, seen = feed.loads(), table.seen()
        if not table.exists() or not seen:
            table.overwrite(finance.daily_state(self.stg_transactions()), loads)
            return
        months = _moved(loads, seen)
        if months:
            fresh = finance.daily_state(staging.stg_transactions(feed.read(months, hidden=True), self.run_ts))
            month = F.coalesce(F.date_format("rate_date", "yyyy-MM"), F.lit(NULL_PARTITION))
            table.overwrite(table.read(hidden=True).where(~month.isin(months)).unionByName(fresh), loads)

    def refresh_orders(self, full_refresh: bool = False) -> None:
        """Orders dated on or after the latest day in the table; all of them on the first run or a full refresh.

        A table that exists but has no dated order gives no bound, and so takes no orders.
        """
        table = self.table("int_orders_enriched")
        if full_refresh or not table.exists():
            table.overwrite(self._enriched(self.stg_orders()), key="order_id")
            return
        latest = table.max_of("order_date", latest_partition_only=True)
        if latest is not None:
            self.upsert_orders(self.orders_since(latest))

    def orders_since(self, day: dt.date) -> DataFrame:
        """Staged orders dated on or after a day; of a feed kept by month, the months before are not opened."""
        orders, feed = self.stg_orders(), self.feed_tables.get("raw_orders")
        if feed is not None:
            months = [p for p in feed.partitions() if p != NULL_PARTITION and p >= f"{day:%Y-%m}"]
            orders = staging.stg_orders(feed.read(months, hidden=True), self.run_ts)
        return orders.where(F.col("order_date") >= F.lit(day))

    def upsert_orders(self, orders: DataFrame, sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame | None:
        """Enrich staged orders and replace or add them by order id.

        They may carry ``VERSION`` and ``DIGEST``: see :meth:`Table.upsert`, also for what is returned.
        """
        return self.table("int_orders_enriched").upsert(self._enriched(orders, sides), "order_id")

    def stored_sides(self) -> tuple[DataFrame, DataFrame]:
        """Staged customers and products, computed once and stored."""
        return materialize(self.stg_customers(), "stg_customers"), materialize(self.stg_products(), "stg_products")

    def refresh_customers(self, full_refresh: bool = False) -> None:
        """Customers with an order written since the table's last run; all of them on the first run or a full refresh.

        Other customers, new ones without orders included, stay as they are. Of the orders, only the partitions that were
        rewritten since are read: for the customers in them, and to replace the figures of these months, from which the
        totals of a customer are merged.
        """
        table, order_table = self.table("int_customer_360"), self.table("int_orders_enriched")
        parts = self.table("customer_order_parts")
        customers, loads = self.stg_customers(), order_table.loads()
        first = full_refresh or not table.exists()
        last_run = None if first else table.max_of("_dbt_updated_at")
        if not first and last_run is None:
            return
        if full_refresh or not _follows(parts):
            parts.overwrite(commerce.customer_order_parts(order_table.read()), loads)
        stale = _moved(loads, table.seen()) if not first else []
        months = sorted({*_moved(loads, parts.seen()), *stale})
        rewritten = order_table.read(months)
        parts.replace(months, commerce.customer_order_parts(rewritten), loads)
        if first:
            totals = commerce.customer_totals(parts.read())
            table.overwrite(commerce.customer_view(customers, totals, self.as_of, self.run_ts), loads)
            return
        recent = rewritten.where(F.expr(f"{ORDER_MONTH} IN ({_listed(stale)})" if stale else "false")
                                 | (F.lit(NULL_PARTITION in stale) & F.col("order_date").isNull()))
        recent = recent.where((F.col("_dbt_updated_at") >= F.lit(last_run)) & F.col("customer_id").isNotNull())
        touched = materialize(recent.select("customer_id").distinct(), "touched_customers")
        table.upsert(commerce.customer_360_of(touched, customers, parts.read(), self.as_of, self.run_ts), "customer_id", loads)

    def refresh_star_schema(self, full_refresh: bool = False) -> None:
        """The customer dimension, and the facts: of those, the months whose orders, or whose transactions, are others."""
        self._refresh_customer_dimension()
        self.refresh_facts(full_refresh=full_refresh)

    def _refresh_customer_dimension(self) -> None:
        self.table("dim_customer").overwrite(commerce.dim_customer(self.relation("int_customer_360"), self.run_ts))

    def refresh_facts(self, *names: str, full_refresh: bool = False) -> None:
        """Bring fact tables up to date (none named: both); the copy of the transactions goes with them."""
        if not names or "fct_orders" in names:
            self._refresh_order_facts(full_refresh)
        if not names or "fct_transactions" in names:
            self._refresh_transaction_facts(full_refresh)

    def _refresh_order_facts(self, full_refresh: bool = False) -> None:
        """Months whose partition of orders is another one than when the fact was last written."""
        fact, orders = self.table("fct_orders"), self.table("int_orders_enriched")
        loads = orders.loads()
        if full_refresh or not _follows(fact):
            fact.overwrite(commerce.fct_orders(orders.read()), loads, gathered=True)
            return
        months = _moved(loads, fact.seen())
        if months:
            fact.replace(months, commerce.fct_orders(orders.read(months)), loads, gathered=True)

    def _refresh_transaction_facts(self, full_refresh: bool = False) -> None:
        """Months with a day whose stored figures or digests are others than when the fact was last written."""
        fact, daily = self.table("fct_transactions"), self.table(DAILY)
        number, seen = daily.number(), int(fact.seen().get(DAILY, 0))
        seen_now = {DAILY: str(number)}
        if full_refresh or not _follows(fact) or seen not in daily.numbers():
            rows, gathered = self._transaction_facts(self.stg_transactions())
            fact.overwrite(rows, seen_now, gathered=gathered)
        elif seen != number:
            days = finance.changed_days(daily.read_at(seen, hidden=True), daily.read_at(number, hidden=True))
            month = F.date_format("rate_date", "yyyy-MM")
            found = [row[0] for row in days.select(month).distinct().collect()]        # months
            months = [NULL_PARTITION if m is None else m for m in found]
            if months:
                rows, gathered = self._transaction_facts(self._transactions_of(months))
                fact.replace(months, rows, seen_now, gathered=gathered)
        copy = self.table("dummy_test")
        if copy.loads() != _named_by_copy(fact):
            copy.copy_of(fact)

    def _transactions_of(self, months: list[str]) -> DataFrame:
        feed = self.feed_tables.get("raw_transactions")
        if feed is not None:
            return staging.stg_transactions(feed.read(months, hidden=True), self.run_ts)
        month = F.coalesce(F.date_format("transaction_date", "yyyy-MM"), F.lit(NULL_PARTITION))
        return self.stg_transactions().where(month.isin(months))

    def _transaction_facts(self, transactions: DataFrame) -> tuple[DataFrame, bool]:
        """The facts, and whether they are gathered by month: before their keys and daily figures make them wide, if these can
        then be joined without another shuffle."""
        daily = self.relation(DAILY)
        gathered = fits_broadcast(daily)
        if gathered:
            month = F.date_format("transaction_date", "yyyy-MM")
            transactions = transactions.withColumn("__month", month).hint("rebalance", F.col("__month")).drop("__month")
        return finance.fct_transactions(transactions, daily, self.run_ts), gathered

    def restate_rates(self) -> None:
        """Rebuild the daily rates, reprice the stored orders whose rate changed, appeared or went away, and bring the fact
        tables that are there up to date with them.

        Orders are taken as they are stored, whether or not the feed still has them. The daily rates are stored after the
        orders, and the facts know what they were made from, so that a run that fails can simply be repeated.
        """
        with temporary(self.spark):
            day_and_currency = ["rate_date", "currency_code"]
            daily = materialize(finance.daily_state(self.stg_transactions()), DAILY)
            before = self.relation(DAILY).select(*day_and_currency, F.col("fx_rate").alias("rate_before"))
            after = daily.select(*day_and_currency, F.col("fx_rate").alias("rate_after"))
            changed = materialize(
                before.join(after, day_and_currency, "full_outer")
                .where(~F.col("rate_before").eqNullSafe(F.col("rate_after")))
                .select(F.col("rate_date").alias("order_date"), "currency_code",
                        F.coalesce("rate_after", F.lit(commerce.NO_RATE)).alias("new_rate")), "changed_rates")

            orders = self.table("int_orders_enriched")
            taken_at = orders.number()
            dated = changed.where(F.col("order_date").isNotNull())
            months = [row[0] for row in dated.select(F.expr(ORDER_MONTH)).distinct().collect()]
            if months:
                affected = lookup(orders.read_at(taken_at, partitions=months), dated, ["order_date", "currency_code"], spread="order_id", how="inner")
                repriced = commerce.repriced(affected, F.col("new_rate"), self.run_ts)
                orders.upsert(repriced.drop("new_rate"), "order_id", taken_at=taken_at)
            feed = self.feed_tables.get("raw_transactions")
            self.table(DAILY).overwrite(daily, feed.loads() if feed else {})
            there = [name for name in ("fct_orders", "fct_transactions") if self.table(name).exists()]
            if there:
                self.refresh_facts(*there)

    def _enriched(self, orders: DataFrame, sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
        # once, a projection of a feed is cheaper to read again (to measure it, then to join it) than to write
        customers, products = (self.stg_customers(), self.stg_products()) if sides is None else sides
        return commerce.int_orders_enriched(orders, customers, products, self.relation(DAILY), self.run_ts)

    # -- checks ----------------------------------------------------------------------------------------------

    def check(self, checks: dict[str, list[Check]] | None = None, by_change: bool = False) -> DataFrame:
        """The report of the checks. ``by_change``: of stored tables, evidence is kept for each partition, and only partitions
        that were written since the last such check are read."""
        checks = DEFAULT_CHECKS if checks is None else checks
        kept = {name: keep_evidence(self.table(name), listed, f"{self.root}/{EVIDENCE_LAYER}/{name}")
                for name, listed in checks.items() if by_change and listed and name in TABLES}
        return check_relations({name: self.relation(name) for name in checks}, checks, kept)


def _moved(loads: dict[str, str], seen: dict[str, str]) -> list[str]:
    """Partitions that are other loads than those seen, or are gone."""
    return sorted(p for p in {*loads, *seen} if loads.get(p) != seen.get(p))


def _follows(table: Table) -> bool:
    """Whether a table can be brought up to date partition by partition."""
    return table.exists() and table.stored_partitioning() == table.partitioning


def _named_by_copy(source: Table) -> dict[str, str]:
    return {p: f"@{source.path}/data/load={load}" for p, load in source.loads().items()}


def _listed(names: list[str]) -> str:
    return ", ".join(f"'{name}'" for name in names)
