"""High-water marks, incremental filters and keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deckframe.operators.util import as_list


def high_water_mark(target: DataFrame | None, col: str, default=None, runs: DataFrame | None = None):
    """``MAX(col)`` of ``target`` as a Python scalar (``default`` if empty/missing).

    One aggregated row reaches the driver; returning a literal lets the next
    filter be pushed into the Parquet scan (row-group skipping).  ``runs``: the
    landed run folders read as one table (``run`` partition column holding the
    unix end time of each run); the newest run end also counts as a mark, the
    later of the two wins.
    """
    mark = None
    if target is not None and col in target.columns:
        row = target.agg(F.max(col).alias("m")).first()
        mark = None if row is None else row["m"]
    if runs is not None and "run" in runs.columns:
        row = runs.agg(F.max("run").alias("r")).first()
        if row is not None and row["r"] is not None:
            import datetime as _dt
            run_end = _dt.datetime.fromtimestamp(int(row["r"]), tz=_dt.timezone.utc).replace(tzinfo=None)
            mark = run_end if mark is None or run_end > mark else mark
    return default if mark is None else mark


def newer_than(df: DataFrame, col: str, mark) -> DataFrame:
    """Rows strictly newer than ``mark`` (equal timestamps are dropped too).

    ``mark=None`` means first run: everything passes.
    """
    if mark is None:
        return df
    return df.filter(F.col(col) > F.lit(mark))


def upsert(target: DataFrame | None, batch: DataFrame, keys) -> DataFrame:
    """Keyed upsert (delete + insert): target rows whose key appears in ``batch``
    are replaced by the batch rows; other target rows stay.  Duplicates inside
    one batch are all kept.  Returns the new full state; the caller writes it to
    a new location (never overwrite the path being read)."""
    keys = as_list(keys)
    if target is None:
        return batch
    batch_keys = batch.select(*keys).distinct()
    kept = target.join(batch_keys, on=keys, how="left_anti")
    return kept.unionByName(batch.select(*target.columns), allowMissingColumns=False)
