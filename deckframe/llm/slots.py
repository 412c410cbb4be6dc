"""Gapless numbering inside groups of any size, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import shuffle_width


def dense_slots(df: DataFrame, group: list[str], order: list[str], slot: str) -> DataFrame:
    """Add ``slot``: 0, 1, 2, ... inside each ``group``.

    Rows of a group are dealt into as many hash buckets as the session has
    shuffle partitions; bucket counts become offsets, and only rows of one
    bucket are ranked together.  ``df`` is read twice, so pass a staged table.
    ``group`` columns must not be null.  Rows alike in ``order`` get distinct
    slots in no particular order.
    """
    buckets = shuffle_width(df.sparkSession)
    dealt = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__n"))
               .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
               .drop("__n"))
    inside = Window.partitionBy(*group, "__b").orderBy(*order)
    ranked = dealt.withColumn("__rank", F.row_number().over(inside) - 1)
    return (ranked.join(offsets, [*group, "__b"])
            .withColumn(slot, (F.col("__rank") + F.col("__before")).cast("long"))
            .drop("__b", "__rank", "__before"))
