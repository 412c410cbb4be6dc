"""Incremental ingest with Structured Streaming.

* R1 polling with a high-water mark -> a file stream over the landing folder;
  the stream's checkpoint records which files were consumed, so no mark query.
* R2 micro-batch keyed upsert -> a streaming aggregation in update mode keeps the
  newest row of each key in Spark's state store; each batch gives the rows of
  the keys that changed, and they replace those of the keyed table
  (:func:`~deckframe.sources.tables.upsert_table`: only the touched buckets).
* R3 late data -> a row older than the state of its key never replaces it.
* R4 duplicates, in a batch or across batches -> the state of a key is one row.

A batch that is repeated after a failure gives the same rows again, and
replacing rows by themselves changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from deckframe.operators.latest import dedupe_keep_last
from deckframe.operators.util import as_list
from deckframe.session import staged
from deckframe.sources.tables import upsert_table


def landing_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over a landing folder (or glob) of ``fmt`` files."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(path)


def latest_state(stream: DataFrame, keys, version: str) -> DataFrame:
    """The newest row per key as a streaming aggregation: the largest row by
    ``version``, ties by the other columns, whatever the order of arrival."""
    return dedupe_keep_last(stream, as_list(keys), [version])


def latest_state_batch(batch: DataFrame, state: DataFrame | None, keys, version: str) -> DataFrame:
    """:func:`latest_state` for a batch and a state at hand."""
    rows = batch if state is None else state.select(*batch.columns).unionByName(batch)
    return latest_state(rows, keys, version)


def run_upsert_stream(stream: DataFrame, table: str, keys, version: str, checkpoint: str,
                      available_now: bool = True, buckets: int = 256):
    """Keep ``table`` at the newest row per key of ``stream``.

    ``available_now=True`` processes what has landed and stops (a scheduled
    job); otherwise the query keeps polling.  Returns the StreamingQuery.
    """
    def replace(batch: DataFrame, batch_id: int) -> None:
        # the changed keys are computed, and the state advanced, once
        upsert_table(staged(batch, "changed-keys"), table, keys, buckets)

    writer = (latest_state(stream, keys, version).writeStream.outputMode("update").foreachBatch(replace)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
