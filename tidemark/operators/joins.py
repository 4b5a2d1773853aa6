"""Equi-joins against a lookup side whose size is measured before it is broadcast.

Within the limit the lookup side is broadcast and the big side is not shuffled at all. Beyond it both sides are
shuffled, and keys that hold a large share of the big side (a missing key counts as one) are spread over many
partitions, with the lookup rows of just those keys repeated. No row is dropped on either path.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_SETTING = "tidemark.broadcast.maxBytes"
BROADCAST_DEFAULT = 256 << 20
ROW_OVERHEAD = 32      # row header and hash-table slot
COUNTERS_PER_HOT = 8   # counters that a task keeps by the heavy-hitter sketch, for each key it may report
MOST_COUNTERS = 1_000_000    # the sketch's own limit

_HASH, _SALT, _COPIES = "__key_hash", "__salt", "__copies"


def payload_bytes(*dfs: DataFrame) -> list[int]:
    """In-memory size of each relation, from exact row counts and text lengths (one job, map-side aggregates)."""
    sizes = [_size(df).select(F.lit(i).alias("number"), "bytes") for i, df in enumerate(dfs)]
    return [row["bytes"] for row in sorted(reduce(DataFrame.unionByName, sizes).collect())]


def _size(df: DataFrame) -> DataFrame:
    fixed = ROW_OVERHEAD + 16 * len(df.columns)
    total = F.count(F.lit(1)) * fixed
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.sum(F.octet_length(F.col(field.name)).cast("long")), F.lit(0))
    return df.agg(total.alias("bytes"))


def fits_broadcast(*dfs: DataFrame) -> bool:
    limit = _limit(dfs[0].sparkSession)
    return limit > 0 and all(size <= limit for size in payload_bytes(*dfs))


def _limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_SETTING, str(BROADCAST_DEFAULT)))


def lookup(big: DataFrame, small: DataFrame, on: list[str], spread: str | None, how: str = "left") -> DataFrame:
    """Join ``small`` to ``big`` on equally named columns.

    ``spread`` is a column of ``big`` with many values, used to spread the rows of a hot key; None if the key is
    unique in ``big`` (or all but), so that no key can be hot.
    """
    return lookup_all(big, [(small, on)], spread, how)


def lookup_all(big: DataFrame, lookups: list[tuple[DataFrame, list[str]]], spread: str | None,
               how: str = "left") -> DataFrame:
    """Join several lookup sides; all are measured in one job, and one more finds the hot keys where needed.

    The smallest sides are broadcast as long as their sum is within the limit. Sides that need a shuffle are joined
    first, while the rows of ``big`` are still narrow.
    """
    limit = _limit(big.sparkSession)
    sizes = payload_bytes(*[small for small, _ in lookups]) if limit > 0 else [1] * len(lookups)
    large, fitting, total = [], [], 0
    for size, _, pair in sorted(zip(sizes, range(len(lookups)), lookups), key=lambda item: item[:2]):
        total += size
        (fitting if total <= limit else large).append(pair)
    joined = big
    none_hot = [[] for _ in large]
    for (small, on), hot in zip(large, hot_keys(big, *[on for _, on in large]) if large and spread else none_hot):
        joined = _salted(joined, small, on, spread, how, hot) if hot else joined.join(small, on, how)
    for small, on in fitting:
        joined = joined.join(F.broadcast(small), on, how)
    return joined


def hot_keys(df: DataFrame, *keys: list[str]) -> list[list[tuple[int, int]]]:
    """For each key: (key hash, number of pieces) of the values that hold more rows than half a shuffle partition.

    At most twice as many as there are partitions do. A mergeable frequent-items sketch finds them in one pass without
    shuffling keys. It only steers the physical layout, never the result.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = min(2 * partitions, MOST_COUNTERS // COUNTERS_PER_HOT)

    def sketch(key: list[str]) -> Column:
        columns = ", ".join(f"`{c}`" for c in key)
        return F.expr(f"approx_top_k(xxhash64({columns}), {most}, {most * COUNTERS_PER_HOT})")

    row = df.agg(F.count(F.lit(1)).alias("rows"), *[sketch(key).alias(f"top{i}") for i, key in enumerate(keys)]).first()
    return [
        [(item["item"], max(2, math.ceil(2 * partitions * item["count"] / row["rows"])))
         for item in row[f"top{i}"] or [] if item["count"] * most > row["rows"]]
        for i in range(len(keys))
    ]


def _salted(big: DataFrame, small: DataFrame, on: list[str], spread: str, how: str,
            hot: list[tuple[int, int]]) -> DataFrame:
    pieces = F.broadcast(big.sparkSession.createDataFrame(hot, f"{_HASH} long, {_COPIES} int"))

    def with_copies(df: DataFrame) -> DataFrame:
        return (df.withColumn(_HASH, F.xxhash64(*on)).join(pieces, _HASH, "left")
                .withColumn(_COPIES, F.coalesce(_COPIES, F.lit(1))))

    salt = F.pmod(F.xxhash64(F.col(spread), F.lit(1)), F.col(_COPIES)).cast("int")
    salted_big = with_copies(big).withColumn(_SALT, salt).drop(_HASH, _COPIES)
    every_salt = F.explode(F.sequence(F.lit(0), F.col(_COPIES) - 1))
    salted_small = with_copies(small).withColumn(_SALT, every_salt).drop(_HASH, _COPIES)
    return salted_big.join(salted_small, [*on, _SALT], how).drop(_SALT)
