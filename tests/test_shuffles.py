"""What is shuffled and stored on the way to a result."""

from __future__ import annotations

import datetime as dt
import threading

import pytest

from tests.feeds import customer, feeds, order, product, transaction
from tidemark import Warehouse
from tidemark.operators import Table
from tidemark.operators.tables import DIGEST, VERSION, Partitioning
from tidemark.plans import commerce
from tidemark.plans import warehouse as warehouse_module
from tidemark.session import side_by_side
from tidemark.streaming.orders import latest_versions


@pytest.fixture
def gathered(spark, monkeypatch):
    """Columns of the rows that were gathered by partition."""
    kind = type(spark.range(1))
    found, hint = [], kind.hint

    def noted(self, name, *parameters):
        if name == "rebalance":
            found.append(set(self.columns))
        return hint(self, name, *parameters)

    monkeypatch.setattr(kind, "hint", noted)
    return found


def test_versions_of_a_batch_are_found_once(spark):
    rows = [("1", 1, "a"), ("1", 2, "b"), ("1", 2, "b"), ("2", 1, "a"), ("3", 1, "a"), ("3", 1, "b"), ("3", None, "c")]
    last, tied = latest_versions(spark.createDataFrame(rows, "order_id string, arrived int, status string"))
    assert sorted(last.collect()) == [("1", 2, "b"), ("2", 1, "a")]
    assert sorted(tied.collect()) == [("3", 1, "a"), ("3", 1, "b")]
    for part in (last, tied):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()


def test_versions_are_judged_without_their_rows(spark, tmp_path, monkeypatch):
    table = Table(spark, str(tmp_path / "t"), Partitioning("part", "substring(value, 1, 1)"))
    schema = f"id string, value string, {VERSION} int, {DIGEST} long"
    table.upsert(spark.createDataFrame([("1", "a1", 2, 1), ("2", "a2", 2, 2), ("3", "b3", None, 3)], schema), "id")
    stored = []
    monkeypatch.setattr("tidemark.operators.tables.materialize",
                        lambda df, name: stored.append((name, df.columns)) or df.localCheckpoint())
    delta = [("1", "a9", 1, 9), ("2", "b9", 2, 9), ("3", "b8", 1, 8), ("4", "c4", None, 4), (None, "c5", 1, 5)]
    ties = table.upsert(spark.createDataFrame(delta, schema), "id")
    assert [tuple(row) for row in ties.collect()] == [("2", "b9", 2, 9)]
    assert sorted(table.read().collect(), key=str) == sorted(
        [("1", "a1"), ("2", "a2"), ("3", "b8"), ("4", "c4"), (None, "c5")], key=str)
    assert ("versions", ["id", "__verdict"]) in stored


def test_facts_are_gathered_narrow_or_not_at_all(spark, tmp_path, gathered):
    raw = feeds(spark, orders=[order("1", "C1", "P1", "2024-01-05", "250"), order("2", "C1", "P1", "2024-02-05", "20"),
                               order("3", None, "P1", "never", "20")],
                customers=[customer("C1")], products=[product("P1", "1", "2")],
                transactions=[transaction("t1", "1", "2024-01-05", "250"), transaction("t2", "2", None, "20")])
    warehouse = Warehouse(spark, str(tmp_path), raw, dt.date(2024, 7, 1))
    warehouse.refresh_finance_daily()
    warehouse.refresh_orders()
    gathered.clear()
    warehouse.refresh_facts()
    assert len(gathered) == 1 and "transaction_sk" not in gathered[0]
    assert warehouse.table("fct_orders").partitions() == ["2024-01", "2024-02", "__HIVE_DEFAULT_PARTITION__"]
    assert warehouse.table("fct_transactions").partitions() == ["2024-01", "__HIVE_DEFAULT_PARTITION__"]
    assert warehouse.relation("fct_orders").count() == 3 and warehouse.relation("dummy_test").count() == 2


def test_customer_figures_by_month_are_not_sorted(spark):
    orders = spark.createDataFrame(
        [], "order_id string, customer_id string, order_date date, order_channel string, region string, order_amount_usd "
            "decimal(12,2), recognized_revenue_usd decimal(12,2), gross_profit_usd decimal(12,2), is_completed boolean, "
            "is_returned boolean, is_cancelled boolean")
    parts = commerce.customer_order_parts(orders)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_totals_of_a_customer_with_several_channels_in_a_month(spark, tmp_path):
    orders = [order("1", "C1", "P1", "2024-01-05", "10", channel="online", region="us"),
              order("2", "C1", "P1", "2024-01-06", "20", channel="phone", region="eu"),
              order("3", "C1", "P1", "2024-02-06", "30", channel="mail", region="uk")]
    raw = feeds(spark, orders=orders, customers=[customer("C1")], products=[product("P1", "1", "2")])
    warehouse = Warehouse(spark, str(tmp_path), raw, dt.date(2024, 7, 1))
    warehouse.run()
    assert warehouse.table("customer_order_parts").read().count() == 3
    row = warehouse.relation("int_customer_360").first()
    assert (row.total_orders, row.lifetime_revenue_usd, row.preferred_channel, row.primary_region) == (3, 60, "phone", "US")


def test_independent_steps_run_at_the_same_time(spark):
    both, ended = threading.Barrier(2, timeout=30), []

    def step(number):
        both.wait()
        if number == 0:
            raise ValueError("the first step")
        ended.append(spark.range(10).count())

    with pytest.raises(ValueError, match="the first step"):
        side_by_side(spark, lambda: step(0), lambda: step(1))
    assert ended == [10]


def test_transaction_facts_are_written_beside_the_orders(spark, tmp_path, monkeypatch):
    both, threads = threading.Barrier(2, timeout=60), set()

    def noted(name):
        own = getattr(Warehouse, name)

        def run(self, *args, **kwargs):
            threads.add(threading.get_ident())
            both.wait()
            return own(self, *args, **kwargs)
        monkeypatch.setattr(Warehouse, name, run)

    noted("refresh_orders")
    noted("_refresh_transaction_facts")
    raw = feeds(spark, orders=[order("1", "C1", "P1", "2024-01-05", "10")], customers=[customer("C1")],
                products=[product("P1", "1", "2")], transactions=[transaction("t1", "1", "2024-01-05", "250")])
    warehouse = Warehouse(spark, str(tmp_path), raw, dt.date(2024, 7, 1))
    warehouse.run()
    assert len(threads) == 2
    assert warehouse.relation("fct_orders").count() == warehouse.relation("dummy_test").count() == 1


def test_feeds_are_loaded_at_the_same_time(spark, tmp_path, monkeypatch):
    all_four, load = threading.Barrier(4, timeout=60), warehouse_module.load_feed

    def waiting(*args):
        all_four.wait()
        return load(*args)

    raw = feeds(spark, orders=[order("1", "C1", "P1", "2024-01-05", "10")], customers=[customer("C1")],
                products=[product("P1", "1", "2")], transactions=[transaction("t1", "1", "2024-01-05", "250")])
    for name, rows in raw.items():
        rows.write.option("header", True).csv(f"{tmp_path}/incoming/{name}.csv")
    monkeypatch.setattr(warehouse_module, "load_feed", waiting)
    warehouse = Warehouse.from_csv(spark, f"{tmp_path}/root", f"{tmp_path}/incoming", as_of=dt.date(2024, 7, 1))
    assert {name: rows.count() for name, rows in warehouse.feeds.items()} == dict.fromkeys(raw, 1)


def test_restated_orders_are_looked_for_in_their_own_months(spark, tmp_path, monkeypatch):
    orders = [order("1", "C1", "P1", "2024-01-05", "10", currency="eur"), order("2", "C1", "P1", "2024-02-05", "10", currency="eur"),
              order("3", "C1", "P1", "2024-01-07", "10", currency="eur")]
    paid = lambda rate: [transaction("t1", "1", "2024-01-05", "250", currency="eur", rate=rate)]
    make = lambda rate: Warehouse(spark, str(tmp_path), feeds(
        spark, orders=orders, customers=[customer("C1")], products=[product("P1", "1", "2")], transactions=paid(rate)),
        dt.date(2024, 7, 1))
    make("1.5").run()
    searched, holding = [], Table._holding
    monkeypatch.setattr(Table, "_holding", lambda self, *a, **k: searched.append(self.path) or holding(self, *a, **k))
    after = make("2.5")
    before = after.table("int_orders_enriched").loads()
    after.restate_rates()
    assert not searched
    loads = after.table("int_orders_enriched").loads()
    assert loads["2024-02"] == before["2024-02"] and loads["2024-01"] != before["2024-01"]
    rates = {row.order_id: float(row.fx_rate) for row in after.relation("fct_orders").collect()}
    assert rates == {"1": 2.5, "2": 1.0, "3": 1.0}


def test_rows_taken_from_an_older_snapshot_are_searched_for(spark, tmp_path):
    rows = lambda *values: spark.createDataFrame(values, "id string, day string, v int")
    table = Table(spark, str(tmp_path), Partitioning("month", "substring(day, 1, 7)"))
    table.overwrite(rows(("a", "2024-01-05", 1), ("b", "2024-02-05", 2)), key="id")
    number = table.number()
    table.upsert(rows(("a", "2024-03-05", 3)), "id")                 # another moves the row
    table.upsert(rows(("a", "2024-01-05", 9)), "id", taken_at=number)
    assert sorted(map(tuple, table.read().collect())) == [("a", "2024-01-05", 9), ("b", "2024-02-05", 2)]
