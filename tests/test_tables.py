from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import Partitioning, Table
from tidemark.operators.tables import NULL_PARTITION

BY_MONTH = Partitioning("month", "date_format(day, 'yyyy-MM')")
BY_BUCKET = Partitioning("bucket", "pmod(xxhash64(k), 4)", fixed=True)


def rows(spark, *values):
    return spark.createDataFrame([(k, d and dt.date.fromisoformat(d), v) for k, d, v in values],
                                 "k string, day date, v int")


def content(table):
    return sorted(((r.k, r.day and str(r.day), r.v) for r in table.read().collect()), key=str)


@pytest.fixture(params=[BY_MONTH, BY_BUCKET, None], ids=["month", "bucket", "whole"])
def table(request, spark, tmp_path):
    return Table(spark, str(tmp_path / "t"), request.param)


def test_upsert_replaces_and_adds(spark, table):
    assert not table.exists()
    table.upsert(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-02-01", 2), ("n", None, 3)), "k")
    table.upsert(rows(spark, ("b", "2024-02-01", 20), ("c", "2024-03-01", 30)), "k")
    expected = [("a", "2024-01-01", 1), ("b", "2024-02-01", 20), ("c", "2024-03-01", 30), ("n", None, 3)]
    assert content(table) == expected
    table.upsert(rows(spark, ("b", "2024-02-01", 20), ("c", "2024-03-01", 30)), "k")
    assert content(table) == expected


def test_row_that_changes_partition_leaves_the_old_one(spark, table):
    table.overwrite(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-02-01", 2), ("n", None, 3)))
    table.upsert(rows(spark, ("a", "2024-02-09", 10), ("n", "2024-05-01", 4)), "k")
    assert content(table) == [("a", "2024-02-09", 10), ("b", "2024-02-01", 2), ("n", "2024-05-01", 4)]


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), BY_MONTH)
    table.overwrite(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-02-01", 2), ("n", None, 3)))
    before = table._snapshot()["loads"]
    table.upsert(rows(spark, ("c", "2024-02-03", 3)), "k")
    after = table._snapshot()["loads"]
    assert {p for p in after if after[p] != before.get(p)} == {"2024-02"}
    assert table.partitions() == ["2024-01", "2024-02", NULL_PARTITION]
    table.upsert(rows(spark, ("b", "2024-01-03", 3), ("c", "2024-01-03", 3)), "k")
    assert table.partitions() == ["2024-01", NULL_PARTITION]


def test_repeated_key_is_an_error_and_changes_nothing(spark, table):
    table.overwrite(rows(spark, ("a", "2024-01-01", 1)))
    with pytest.raises(ValueError, match="occurs 2 times"):
        table.upsert(rows(spark, ("a", "2024-01-01", 2), ("a", "2024-01-02", 3)), "k")
    assert content(table) == [("a", "2024-01-01", 1)]


def test_failed_write_changes_nothing(spark, table):
    table.overwrite(rows(spark, ("a", "2024-01-01", 1)))
    broken = rows(spark, ("b", "2024-01-01", 2)).withColumn("v", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        table.overwrite(broken)
    assert content(table) == [("a", "2024-01-01", 1)]


def test_new_column_is_appended_and_missing_one_kept(spark, table):
    table.overwrite(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-02-01", 2), ("z", "2024-07-01", 9)))
    delta = rows(spark, ("b", "2024-02-01", 0), ("c", "2024-02-05", 0)).drop("v").withColumn("tier", F.lit("gold"))
    table.upsert(delta, "k")
    got = sorted((r.k, r.v, r.tier) for r in table.read().collect())
    assert table.read().columns == ["k", "day", "v", "tier"]
    assert sorted(got, key=str) == [("a", 1, None), ("b", 2, "gold"), ("c", None, "gold"), ("z", 9, None)]


def test_stored_type_wins(spark, table):
    table.overwrite(rows(spark, ("a", "2024-01-01", 1)))
    table.upsert(rows(spark, ("b", "2024-01-01", 2)).withColumn("v", F.col("v").cast("long")), "k")
    assert dict(table.read().dtypes)["v"] == "int" and len(content(table)) == 2


def test_empty_table_and_empty_delta(spark, table):
    table.overwrite(rows(spark, ("a", "2024-01-01", 1)).where("false"))
    assert table.exists() and content(table) == []
    assert table.max_of("day") is None
    table.upsert(rows(spark, ("a", "2024-01-01", 1)).where("false"), "k")
    assert content(table) == []
    table.upsert(rows(spark, ("a", "2024-01-01", 1)), "k")
    assert content(table) == [("a", "2024-01-01", 1)]


def test_latest_partition_gives_the_largest_date(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), BY_MONTH)
    table.overwrite(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-02-07", 2), ("n", None, 3)))
    assert table.max_of("day", latest_partition_only=True) == dt.date(2024, 2, 7)
    assert len(table.read(["2024-02"]).inputFiles()) == 1


def test_upsert_without_broadcast(spark, table):
    spark.conf.set("tidemark.broadcast.maxBytes", "0")
    try:
        table.overwrite(spark.range(500).selectExpr("cast(id as string) k", "date'2024-01-01' + int(id) day", "1 v"))
        table.upsert(spark.range(400, 700).selectExpr(
            "cast(id as string) k", "date'2024-03-01' + int(id) day", "2 v"), "k")
        got = table.read().groupBy("v").count().collect()
    finally:
        spark.conf.unset("tidemark.broadcast.maxBytes")
    assert {r.v: r["count"] for r in got} == {1: 400, 2: 300}


def test_first_load_rejects_repeated_keys_too(spark, table):
    with pytest.raises(ValueError, match="occurs 2 times"):
        table.upsert(rows(spark, ("a", "2024-01-01", 2), ("a", "2024-01-02", 3)), "k")
    assert not table.exists()


def test_other_partitioning_is_an_error(spark, tmp_path):
    Table(spark, str(tmp_path / "t"), BY_BUCKET).overwrite(rows(spark, ("a", "2024-01-01", 1)))
    with pytest.raises(ValueError, match="partitioned by"):
        Table(spark, str(tmp_path / "t"), Partitioning("bucket", "pmod(xxhash64(k), 8)", fixed=True)).upsert(
            rows(spark, ("a", "2024-01-01", 2)), "k")
    assert Table(spark, str(tmp_path / "t")).stored_partitioning() == BY_BUCKET


def test_new_column_without_rows_is_kept(spark, table):
    table.overwrite(rows(spark, ("a", "2024-01-01", 1)))
    table.upsert(rows(spark, ("b", "2024-01-01", 1)).where("false").withColumn("tier", F.lit("gold")), "k")
    assert table.read().columns == ["k", "day", "v", "tier"]
    assert [tuple(r)[2:] for r in table.read().collect()] == [(1, None)]


def test_broken_attempt_is_in_nobodys_way(spark, table, tmp_path):
    table.overwrite(rows(spark, ("a", "2024-01-01", 1)))
    (tmp_path / "t" / "snapshots" / "number=00000002").mkdir()
    (tmp_path / "t" / "snapshots" / "number=00000002-abcd").mkdir()
    table.upsert(rows(spark, ("b", "2024-01-01", 2)), "k")
    assert len(content(table)) == 2


def test_expire(spark, table, tmp_path):
    for value in range(4):
        table.upsert(rows(spark, ("a", "2024-01-01", value), ("b", f"2024-0{value + 1}-02", value)), "k")
    before = content(table)
    table.expire(keep=1)
    assert content(table) == before
    assert len(list((tmp_path / "t" / "snapshots").iterdir())) == 1
    assert {p.name for p in (tmp_path / "t" / "data").iterdir()} == {
        f"load={load}" for load in table._snapshot()["loads"].values()}
