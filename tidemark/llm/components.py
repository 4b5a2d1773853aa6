"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import file_count, materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node it is linked with, over any number of links) of all linked nodes.

    ``links`` has two columns of longs. Each step links the neighbours of a node to its smallest one, found by a
    combined minimum, so a node of very many links is no group in one task.
    """
    a, b = links.columns
    # two longs each; no step makes more edges than there are links
    files = file_count(links.sparkSession, 16 * links.count())
    edges = materialize(links.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
                        .where("u < v").distinct(), "edges", files)
    state = _state(edges)
    while state[0]:
        # large star: larger neighbours of a node point to its smallest neighbour, or to itself
        both = edges.union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = materialize(both.where("u > v").join(least, "v")
                            .select(F.col("u").alias("v"), F.col("m").alias("u")).distinct(), "edges", files)
        # small star: smaller neighbours of a node, and itself, point to the smallest
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        edges = materialize(joined.select(F.col("u").alias("v"), F.col("m").alias("u")).union(
            joined.select("v", F.col("m").alias("u"))).where("u < v").distinct(), "edges", files)
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.groupBy("v").agg(F.min("u").alias("root")).select(F.col("v").alias("node"), "root").union(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("v", "u")),
                           F.bit_xor(F.xxhash64("u", "v"))).first())
