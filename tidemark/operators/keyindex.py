"""Which partitions of a table can hold a key, told without opening their files.

For every partition of a load there is the range of its keys, kept with the snapshot, and their prints, kept as Parquet beside
the load. A range is that of the key's place: its length and first bytes (or its value, if it is a whole number), so ids that
grow with time have ranges that do not overlap. A print is 48 bits of the key's hash: 16 of them order the file and pack to
next to nothing, 32 are stored, so a print takes about four bytes. Both may name a partition too many, never one too few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARD, PRINT = "__shard", "__print"
_FIRST_BYTES = 7


def place(key: str, kind: T.DataType) -> Column:
    """A long that does not fall as the key grows, by length first, then by bytes."""
    value = F.col(f"`{key}`")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("long")
    text = value.cast("string")
    first = F.rpad(F.hex(F.substring(text.cast("binary"), 1, _FIRST_BYTES)), 2 * _FIRST_BYTES, "0")
    return F.least(F.octet_length(text), F.lit(126)).cast("long") * F.lit(1 << 8 * _FIRST_BYTES) + F.conv(
        first, 16, 10).cast("long")


def prints(key: str) -> list[Column]:
    hashed = F.xxhash64(F.col(f"`{key}`").cast("string"))
    return [F.shiftrightunsigned(hashed, 48).cast("int").alias(SHARD),
            F.expr(f"cast(pmod(xxhash64(cast(`{key}` as string)), 4294967296) - 2147483648 as int)").alias(PRINT)]


def write(keyed: DataFrame, key: str, partition: str, folder: str) -> dict[str, list[int]]:
    """Write the prints of ``keyed`` (key and partition of new rows); returns the range of each partition."""
    known = keyed.where(F.col(f"`{key}`").isNotNull())
    at = place(key, keyed.schema[key].dataType)
    found = known.groupBy(partition).agg(F.min(at).alias("low"), F.max(at).alias("high")).collect()    # a row a partition
    (known.select(partition, *prints(key)).sortWithinPartitions(partition, SHARD, PRINT)
     .write.partitionBy(partition).parquet(folder))
    return {row[0]: [row["low"], row["high"]] for row in found}


def read(spark: SparkSession, partition: str, folders: list[tuple[str, str]]) -> DataFrame:
    """Prints in (base folder, folder) pairs, with the partition of each."""
    schema = T.StructType([T.StructField(SHARD, T.IntegerType()), T.StructField(PRINT, T.IntegerType()),
                           T.StructField(partition, T.StringType())])
    found = spark.createDataFrame([], schema)
    for base in sorted({base for base, _ in folders}):
        found = found.union(spark.read.schema(schema).option("basePath", base)
                            .parquet(*sorted(f for b, f in folders if b == base)).select(*schema.fieldNames()))
    return found
