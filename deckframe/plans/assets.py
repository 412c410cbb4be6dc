"""Loading a configured asset end to end (S15): mark, read, filter, cap, dedupe,
run partition, table, history.

An asset has three tables in a database: ``<asset>_runs`` (every load as it
landed, partitioned by run), ``<asset>`` (the current rows) and
``<asset>_history`` (SCD2 of snapshot assets that keep history).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from deckframe.operators.incremental import high_water_mark
from deckframe.operators.latest import dedupe_keep_last
from deckframe.sources.readers import read_asset
from deckframe.sources.tables import apply_snapshot, land_partition, read_table, upsert_table, write_snapshot
from deckframe.sources.writers import AssetSpec


def load_asset(spark: SparkSession, spec: AssetSpec, source: str, database: str, end_ts: int,
               full: bool = False, buckets: int = 256) -> DataFrame:
    """One load of ``spec`` from the documents at ``source``; returns the asset's
    current rows.

    Incremental assets read what is newer than the newest ``tombstone`` of the
    table (``full``: everything) and upsert the newest row per key.  Snapshot
    assets read everything and replace the table; rows are compared with the
    history where the asset keeps one.  A repeated load replaces its run and
    changes nothing else.
    """
    return load_rows(spark, spec, lambda mark: read_asset(spark, source, spec, mark), database, end_ts, full, buckets)


def load_rows(spark: SparkSession, spec: AssetSpec, read, database: str, end_ts: int,
              full: bool = False, buckets: int = 256) -> DataFrame:
    """:func:`load_asset` where ``read(mark)`` gives the rows."""
    name = f"{database}.{spec.name}"
    incremental = spec.nature == "incremental"
    table = read_table(spark, name)
    mark = high_water_mark(table, spec.tombstone) if incremental and spec.tombstone and not full else None
    rows = dedupe_keep_last(read(mark), spec.unique_key, [spec.tombstone] if spec.tombstone else [])
    batch = land_partition(rows, f"{name}_runs", end_ts)
    if incremental:
        upsert_table(batch, name, spec.unique_key, buckets)
    else:
        write_snapshot(batch, name)
        if spec.history:
            now = dt.datetime.fromtimestamp(int(end_ts), tz=dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
            apply_snapshot(batch, f"{name}_history", spec.unique_key, now)
    return read_table(spark, name)
