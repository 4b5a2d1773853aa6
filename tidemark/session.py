"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

TARGET_PARTITION_BYTES = 128 << 20
TARGET_FILE_BYTES = 32 << 20
_local_dirs: dict[str, str] = {}
_recorded: list[list[str]] = []


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Enough shuffle partitions that each holds about one target size, and no fewer than the cores."""
    return max(cores, -(-input_bytes // TARGET_PARTITION_BYTES))


def settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run over ``input_bytes``: AQE merges what turns out small and splits what turns out hot."""
    n = str(shuffle_partitions(input_bytes, cores))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TARGET_PARTITION_BYTES),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": n,
        "spark.sql.shuffle.partitions": n,
        "spark.sql.files.maxPartitionBytes": str(TARGET_PARTITION_BYTES),
    }


def spark_session(app: str = "tidemark", master: str | None = None, input_bytes: int = 0, cores: int = 8,
                  **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**settings(input_bytes, cores), **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder all executors share (``spark.checkpoint.dir``)."""
    app = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
        shared = _local_dirs[app]
    return f"{shared}/tidemark/{app}/{name}-{uuid.uuid4().hex[:12]}"


def file_count(spark: SparkSession, n_bytes: int) -> int:
    """Enough files that each holds about one target size, and no fewer than the cores."""
    return max(spark.sparkContext.defaultParallelism, -(-n_bytes // TARGET_FILE_BYTES))


def materialize(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; lost executors do not lose it.

    With ``files``, for rows that come out of a shuffle, its partitions are merged to so many tasks and files: a small result
    is not written as a file per shuffle partition."""
    path = work_path(df.sparkSession, name)
    for paths in _recorded[-1:]:
        paths.append(path)
    if files is not None:
        df = df.coalesce(files)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is materialized inside is deleted at the end; for runs whose results are all in tables of their own."""
    _recorded.append([])
    try:
        yield
    finally:
        for path in _recorded.pop():
            delete(spark, path)


def side_by_side(spark: SparkSession, *steps: Callable[[], Any]) -> list:
    """Results of steps that don't depend on each other, run at the same time: the tasks of one fill the cores that the other
    leaves idle. All of them end before an error of one is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark can write one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def file_states(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """Length and time of writing of each file, wherever Spark can read one."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {}
    for file in files:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(file))
        status = path.getFileSystem(conf).getFileStatus(path)
        found[file] = f"{status.getLen()}:{status.getModificationTime()}"
    return found
