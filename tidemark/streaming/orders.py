"""Orders that arrive as a stream of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from tidemark.operators.joins import lookup
from tidemark.operators.tables import DIGEST, VERSION
from tidemark.plans import staging
from tidemark.plans.warehouse import Warehouse
from tidemark.session import materialize

SEQUENCE = "arrived"


def latest_versions(orders: DataFrame, sequence: str = SEQUENCE) -> tuple[DataFrame, DataFrame]:
    """The last version of each order by ``sequence``, and orders whose last versions tie but differ.

    Equal rows are one version. Tied orders are in the second result only, with all their tied versions. The versions are
    found once and stored, as both results are read more than once.
    """
    # dealt by order once: both the distinct rows and the windows can stay there
    versions = orders.repartition("order_id").distinct()
    last = Window.partitionBy("order_id").orderBy(F.col(sequence).desc_nulls_last())
    ranked = versions.withColumn("__rank", F.rank().over(last)).where("__rank = 1").drop("__rank")
    ties = materialize(ranked.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("order_id"))), "batch")
    return ties.where("__n = 1").drop("__n"), ties.where("__n > 1").drop("__n")


def _digest(orders: DataFrame, sequence: str) -> Column:
    columns = sorted(c for c in orders.columns if c != sequence)
    return F.xxhash64(*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def stream_orders(warehouse: Warehouse, raw_orders: DataFrame, checkpoint: str, sequence: str | None = None,
                  conflicts: str | None = None) -> StreamingQuery:
    """Upsert each micro-batch of raw orders by order id and stop when the input is used up.

    A batch that is replayed after a failure replaces its own rows, so the table comes out the same. With ``sequence``
    (a column of the feed that grows with time, such as the time its file was written), the last version of an order
    counts, in whatever batch it comes: the version is stored with the order, and an older one, or one seen before, changes
    nothing later on. Versions that tie but differ go to Parquet files under ``conflicts``, one folder per batch, and the
    order is left as it was. Without ``sequence``, an order may come only once in a batch, and the last batch wins.

    An order written by a batch run keeps the version it had, if any; one without a version is replaced by any.
    """
    sides = warehouse.stored_sides()

    def apply(batch: DataFrame, number: int) -> None:
        if sequence is None:
            warehouse.upsert_orders(staging.stg_orders(batch), sides=sides)
            return
        last, tied = latest_versions(batch.where(F.col("order_id").isNotNull()), sequence)
        versions = {VERSION: F.col(sequence), DIGEST: _digest(last, sequence)}
        staged = staging.stg_orders(last.withColumns(versions).drop(sequence), carried=(VERSION, DIGEST))
        unclear = warehouse.upsert_orders(staged, sides)
        if unclear is not None:
            tied = tied.unionByName(lookup(last, unclear.select("order_id"), ["order_id"], spread=None, how="left_semi"))
        if conflicts is not None:
            tied.write.mode("overwrite").parquet(f"{conflicts}/batch={number}")
        elif not tied.isEmpty():
            raise ValueError("versions of an order tie; give a folder for conflicts")

    return (raw_orders.writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
