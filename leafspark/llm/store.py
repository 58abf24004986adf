"""Cut points: tables written to the folder that driver and executors share.

A written table survives lost executors, ends the lineage above it and forgets the partitioning of its
plan, so that later joins may split skewed partitions.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder named by spark.checkpoint.dir; where unset (tests on one machine) a temporary one."""
    conf = spark.sparkContext.getConf()
    folder = conf.get("spark.checkpoint.dir") or spark.conf.get("leafspark.shared.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="leafspark-")
        spark.conf.set("leafspark.shared.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/leafspark/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Texts go to Python workers a few at a time: Arrow batches live outside the heap, in both processes."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables cut inside are deleted at the end; those cut with keep=True live as long as what is around it."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN.remove(paths)
        for path in paths:
            drop_path(spark, path)


def own_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path that goes with the tables cut here."""
    path = new_path(spark, name)
    owners = _OPEN[:-1] if keep else _OPEN
    if owners:
        owners[-1].append(path)
    return path


def cut(df: DataFrame, name: str, codec: str = "snappy", keep: bool = False) -> DataFrame:
    """Write df once and go on from the written table."""
    spark = df.sparkSession
    path = own_path(spark, name, keep)
    with small_batches(spark):
        df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of plans that nothing refers to any more."""
    for _ in range(2):  # what the first round drops in Python is dropped in the JVM by the second
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def give_back() -> None:
    """In a Python worker: return memory that the allocators hold but nothing uses."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def tidy(run: Callable[[Iterable[Any]], Iterator[Any]]) -> Callable[[Iterable[Any]], Iterator[Any]]:
    """A function of batches that gives its worker's memory back when a task ends; idle workers then hold little."""

    def tidied(batches: Iterable[Any]) -> Iterator[Any]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def bounded_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of ``total`` rows, by a hash of their key, and twice that at most; all if there are fewer.

    A filter, so no task sends more than its share, as ordering and cutting would. The cut at twice the
    number only acts where few keys hold many rows.
    """
    if total <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) < int(rows / total * (1 << 30))).limit(2 * rows)
