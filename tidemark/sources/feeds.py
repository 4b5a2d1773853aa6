"""Readers for the raw feeds, and the tables that hold them.

A feed's date arrives as text. Its table keeps the typed date beside it, in a hidden column, so that a bound on the date
reaches the scan; staging takes it from there. Feeds that grow are kept by month, and a load takes only the files that were not
there before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import strict_date
from tidemark.operators.tables import HIDDEN, NULL_PARTITION, Partitioning, Table
from tidemark.session import file_states, materialize
from tidemark.sources.schemas import DAYS, FEEDS, GROWING


def read_feed_csv(spark: SparkSession, feed: str, *paths: str) -> DataFrame:
    """Comma-separated files (or folders of files) with a header; a value that does not fit its type is an error."""
    return (spark.read.schema(FEEDS[feed])
            .options(header=True, mode="FAILFAST", enforceSchema=False)
            .csv(list(paths)))


def read_csv_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {feed: read_feed_csv(spark, feed, f"{folder}/{feed}.csv") for feed in FEEDS}


def load_seed(raw: DataFrame, path: str) -> DataFrame:
    """Load a feed into a table of its own and return that table."""
    table = Table(raw.sparkSession, path)
    table.overwrite(raw)
    return table.read()


def typed_day(feed: str) -> str:
    """The hidden column that holds the typed date."""
    return f"{HIDDEN}{DAYS[feed]}"


def with_typed_day(raw: DataFrame, feed: str) -> DataFrame:
    day = DAYS[feed]
    return raw.withColumn(typed_day(feed), strict_date(F.col(day), raw.schema[day].dataType))


def feed_table(spark: SparkSession, path: str, feed: str) -> Table:
    by_month = Partitioning("feed_month", f"date_format({typed_day(feed)}, 'yyyy-MM')")
    return Table(spark, path, by_month if feed in GROWING else None)


def load_feed(spark: SparkSession, feed: str, source: str, path: str) -> Table:
    """Bring the table of a feed up to date with its CSV files, and return it.

    Files that were not there at the last load are read, and only the months of their rows rewritten. If a known file is
    gone or another, or a feed that is not kept by month has a new one, everything is loaded again.
    """
    table = feed_table(spark, path, feed)
    states = file_states(spark, read_feed_csv(spark, feed, source).inputFiles())
    seen = table.seen()
    new = sorted(f for f in states if f not in seen)
    if not table.exists() or any(states.get(f) != state for f, state in seen.items()) or new and feed not in GROWING:
        table.overwrite(with_typed_day(read_feed_csv(spark, feed, source), feed), states)
    elif new:
        rows = materialize(with_typed_day(read_feed_csv(spark, feed, *new), feed), f"new_{feed}")
        month = F.expr(table.partitioning.value).alias("month")
        found = [NULL_PARTITION if row[0] is None else row[0] for row in rows.select(month).distinct().collect()]   # months
        table.replace(found, table.read(found, hidden=True).unionByName(rows), states)
    return table
