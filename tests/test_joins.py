from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.operators.joins import BROADCAST_SETTING, fits_broadcast, hot_keys, lookup, lookup_all, payload_bytes


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set(BROADCAST_SETTING, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset(BROADCAST_SETTING)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def big(spark, n=30000):
    """A third of the rows has one key, a third has none."""
    return spark.range(n).select(
        F.col("id").cast("string").alias("row"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 5000).cast("string"))
        .alias("key"),
        F.when(F.col("id") % 3 == 2, None).otherwise(F.lit("x")).alias("other"))


def small(spark):
    named = spark.range(4000).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("other"),
                                     (F.col("id") * 2).alias("value"))
    odd = [("hot", "x", -1), (None, "x", -2)]
    return named.union(spark.createDataFrame(odd, "key string, other string, value long"))


def test_payload_counts_rows_and_text(spark):
    df = spark.createDataFrame([("ab",), ("é",), (None,)], "s string")
    assert payload_bytes(df, df.where("false")) == [3 * (joins.ROW_OVERHEAD + 16) + 4, 0]


def test_limit_decides(spark):
    df = small(spark)
    assert fits_broadcast(df)
    spark.conf.set(BROADCAST_SETTING, "1000")
    try:
        assert not fits_broadcast(df)
    finally:
        spark.conf.unset(BROADCAST_SETTING)


@pytest.mark.parametrize("on", [["key"], ["key", "other"]])
@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_salted_join_gives_the_same_rows(spark, no_broadcast, on, how):
    left, right = big(spark), small(spark)
    right = right if "other" in on else right.drop("other")
    expected = left.join(right, on, how)
    got = lookup(left, right, on, spread="row", how=how)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_hot_keys_finds_the_shares(spark):
    hashes = {r[0] for r in spark.sql(
        "SELECT xxhash64('hot') UNION ALL SELECT xxhash64(cast(null as string))").collect()}
    by_key, by_row = hot_keys(big(spark), ["key"], ["row"])
    assert {h for h, _ in by_key} == hashes and all(pieces >= 2 * 8 / 3 for _, pieces in by_key)
    assert by_row == []
    assert hot_keys(big(spark).where("false"), ["key"]) == [[]]


def test_several_lookups_with_and_without_broadcast(spark):
    left, by_key = big(spark), small(spark).drop("other")
    by_other = spark.createDataFrame([("x", 1), ("y", 2)], "other string, seen int")
    expected = left.join(by_key, "key", "left").join(by_other, "other", "left")
    for limit in ("0", "1000", "100000000"):
        spark.conf.set(BROADCAST_SETTING, limit)
        try:
            got = lookup_all(left, [(by_key, ["key"]), (by_other, ["other"])], spread="row").select(*expected.columns)
            assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
        finally:
            spark.conf.unset(BROADCAST_SETTING)


def test_salt_spreads_a_hot_key_over_partitions(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup(big(spark), small(spark).drop("other"), ["key"], spread="row")
        plain = big(spark).join(small(spark).drop("other"), "key", "left")

        def fullest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert fullest(plain) > 10000 and fullest(joined) < 0.7 * fullest(plain)
        assert "BroadcastHashJoin [key" not in joined._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
