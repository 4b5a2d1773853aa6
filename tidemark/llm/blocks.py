"""Shuffling many small items as few binary rows.

Tasks gather items (columns of numbers), deal them to buckets by a hash, and emit one row per bucket and gathering:
``bucket``, ``n`` (items) and ``payload`` (the columns one after another). Spark sends each bucket to a partition of its
own, so its size follows ``spark.sql.shuffle.partitions`` as that of any partition does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "bucket int, n int, payload binary"
ITEMS = 1 << 20             # items gathered before they are emitted

Items = Iterator[tuple[np.ndarray, ...]]      # bucket of each item, then the columns


def bucket_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def of_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bucket of unsigned hashes."""
    return ((hashes >> np.uint64(13)) % np.uint64(n)).astype(np.int32)


def of_row(rows: np.ndarray, n: int) -> np.ndarray:
    """Bucket of signed row keys, as ``pmod(row, n)`` has it."""
    return (rows % n).astype(np.int32)


def deal(items: Items) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for item in items:
        held.append(item)
        size += len(item[0])
        if size >= ITEMS:
            yield _rows(held)
            held, size = [], 0
    if size:
        yield _rows(held)


def _rows(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    bucket, *columns = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    present, starts = np.unique(bucket, return_index=True)
    ends = np.append(starts[1:], len(bucket))
    payload = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(starts, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(present, pa.int32()), pa.array(ends - starts, pa.int32()), pa.array(payload, pa.binary())],
        names=["bucket", "n", "payload"])


def unpack(payload: list[bytes], n: list[int], kinds: list[str]) -> list[np.ndarray]:
    """The columns of several rows, joined."""
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for block, count in zip(payload, n):
        at = 0
        for part, kind in zip(parts, kinds):
            part.append(np.frombuffer(block, kind, count, at))
            at += part[-1].nbytes
    return [np.concatenate(p) if p else np.zeros(0, kind) for p, kind in zip(parts, kinds)]


def whole_buckets(batches: Iterator[pa.RecordBatch], kinds: list[str]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Each bucket with its columns, from rows sorted by bucket."""
    current, payload, counts = None, [], []
    for batch in batches:
        for bucket, n, block in zip(*(batch.column(c).to_pylist() for c in ("bucket", "n", "payload"))):
            if bucket != current and payload:
                yield current, unpack(payload, counts, kinds)
                payload, counts = [], []
            current = bucket
            payload.append(block)
            counts.append(n)
    if payload:
        yield current, unpack(payload, counts, kinds)


def gather(df: DataFrame, n: int, *then: str) -> DataFrame:
    """Rows sent to the partition of their bucket (numbers of ``n`` and more, or below 0, go round), sorted by it."""
    return df.repartitionById(n, F.pmod("bucket", F.lit(n))).sortWithinPartitions("bucket", *then)
