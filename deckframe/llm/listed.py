"""A table parted by a list of ids, so that most of its rows stay where they are.

A list that grows with the table can't be broadcast whole, and joined as it is
it would have every text shuffled.  A sieve of its ids can be: a bitmap of
``BITS`` bits for each id and ``BITS_MOST`` at most.  Rows that it lets through,
the listed ones and about one in ``BITS`` of the others, go on to be compared
with the list itself.  Where the list is too long for ``BITS_MOST`` more of the
others go along; the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

BITS = 16
BITS_MOST = 1 << 24


def parted(table: DataFrame, key: Column, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose ``key`` may stand in the one column of ``ids`` (a staged
    table) and those whose key does not; null is a key like any other."""
    n, bits = ids.count(), 1 << 6
    while bits < BITS * n and bits < BITS_MOST:
        bits *= 2
    spot = lambda x: F.xxhash64(x).bitwiseAND(F.lit(bits - 1))
    sieve = staged(ids.toDF("__id").select(spot(F.col("__id")).alias("__spot"))
                   .groupBy(F.shiftright("__spot", 6).alias("__word"))
                   .agg(F.expr("bit_or(shiftleft(1L, int(__spot & 63)))").alias("__mask")), "sieve")
    met = (table.withColumn("__spot", spot(key)).withColumn("__word", F.shiftright("__spot", 6))
           .join(F.broadcast(sieve), "__word", "left"))
    through = F.expr("coalesce(getbit(__mask, int(__spot & 63)), 0) = 1")
    return tuple(met.where(x).drop("__spot", "__word", "__mask") for x in (through, ~through))


def without(docs: DataFrame, bad: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` without the rows of the staged table ``bad`` (__id, __key: the MD5
    of the text), all columns unchanged."""
    own = F.col(id_col).cast("long")
    listed, rest = parted(docs, own, bad.select("__id"))
    key = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    return rest.unionByName(listed.join(bad, own.eqNullSafe(F.col("__id")) & (key == F.col("__key")), "left_anti"))
