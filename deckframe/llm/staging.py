"""Staged tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset (tests) a
    folder beside the session's tables."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stage"
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """While it lasts Arrow batches are of ``BATCH_BYTES`` at most: they lie outside
    the heap, several to a task, and their buffers are kept for the next job."""
    before = spark.conf.get(BATCH_KEY)
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(BATCH_KEY, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts
    lineage, survives lost executors, and prunes columns on every later read."""
    path = fresh_path(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
