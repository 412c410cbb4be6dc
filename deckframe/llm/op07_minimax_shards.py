"""Sharding by minimax contiguous partition.

Rows of equal text form one atomic group.  Groups lie in the order of their
smallest ``doc_id`` and are cut into contiguous shards so that the largest
shard is as small as possible.  The smallest feasible capacity is found by
binary search with a greedy check.

The ordered group sizes never reach the driver as a whole.  It starts from one
block that spans all ids and searches twice: once as if blocks could be cut
anywhere (a lower bound of the capacity), once as if they could not be cut at
all (an upper bound).  Only blocks that may hold a cut between those bounds are
split into ``FAN`` parts by a grouped aggregation, until both bounds meet.  So
a round returns a bounded number of block sums whatever the size of the table.

Null texts count as empty and have size 1.  Rows with a null ``doc_id`` (in
groups that have no other) join the group with the smallest id.  Groups whose
smallest ids are equal are one unit.  An empty table gives no rows.  Extra
columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slots import dense_slots
from .staging import staged

FAN = 256


class Block(NamedTuple):
    """Units with keys from ``lo`` to ``hi`` and their bytes; one unit if lo == hi."""

    lo: int
    hi: int
    size: int


def greedy(blocks: list[Block], shards: int, capacity: int, divisible: bool) -> list[int] | None:
    """Index of the block where each shard but the last ends, or None if
    ``shards`` shards of ``capacity`` don't hold everything.

    ``divisible``: a block of several units may be cut at any byte, and the
    index is that of the block in which the cut lies; otherwise blocks are
    taken whole and the index is that of the first block left out.
    """
    ends = list(accumulate(b.size for b in blocks))
    cuts, done, at = [], 0, 0
    for _ in range(shards):
        reach = done + capacity
        at = bisect_right(ends, reach)
        if at == len(blocks):
            return cuts + [at] * (shards - 1 - len(cuts))
        whole = ends[at - 1] if at else 0
        done = reach if divisible and blocks[at].lo < blocks[at].hi else whole
        cuts.append(at)
    return None


def smallest_capacity(blocks: list[Block], shards: int, divisible: bool) -> int:
    total = sum(b.size for b in blocks)
    low, high = -(-total // shards), total
    while low < high:
        mid = (low + high) // 2
        if greedy(blocks, shards, mid, divisible) is None:
            low = mid + 1
        else:
            high = mid
    return low


def _split(units: DataFrame, blocks: list[Block]) -> dict[Block, list[Block]]:
    """Each of ``blocks`` as up to FAN smaller ones, by one aggregation."""
    key = F.col("unit").cast("decimal(20,0)")
    which, part = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, b in enumerate(blocks):
        here = F.col("unit").between(b.lo, b.hi)
        width = -(-(b.hi - b.lo + 1) // FAN)
        which = F.when(here, F.lit(i)).otherwise(which)
        part = F.when(here, F.floor((key - F.lit(b.lo).cast("decimal(20,0)")) / F.lit(width)).cast("int")).otherwise(part)
    rows = (units.withColumn("which", which).withColumn("part", part)
            .where("which IS NOT NULL").groupBy("which", "part")
            .agg(F.min("unit").alias("lo"), F.max("unit").alias("hi"), F.sum("size").alias("size"))
            .orderBy("which", "part").collect())
    out: dict[Block, list[Block]] = {b: [] for b in blocks}
    for r in rows:
        out[blocks[r["which"]]].append(Block(r["lo"], r["hi"], r["size"]))
    return out


def minimax_cuts(units: DataFrame, shards: int) -> list[int]:
    """Smallest key of each shard after the first; ``units`` has ``unit`` (key)
    and ``size`` and may hold several rows of a unit."""
    whole = units.agg(F.min("unit").alias("lo"), F.max("unit").alias("hi"), F.sum("size").alias("size")).first()
    if whole["lo"] is None:
        return []
    blocks = [Block(*whole)]
    while True:
        low = smallest_capacity(blocks, shards, True)
        high = smallest_capacity(blocks, shards, False)
        first = greedy(blocks, shards, low, False) or _stuck(blocks, shards, low)
        last = greedy(blocks, shards, high, True)
        unsure = [b for i, j in zip(first, last) for b in blocks[i:j + 1] if b.lo < b.hi]
        if low == high or not unsure:
            break
        finer = _split(units, list(dict.fromkeys(unsure)))
        blocks = [x for b in blocks for x in finer.get(b, [b])]
    cuts = greedy(blocks, shards, high, False)
    return [blocks[i].lo for i in cuts if i < len(blocks)]


def _stuck(blocks: list[Block], shards: int, capacity: int) -> list[int]:
    """Where whole-block shards of ``capacity`` would end; a block above the
    capacity stops them for good."""
    ends = list(accumulate(b.size for b in blocks))
    cuts, done = [], 0
    for _ in range(shards - 1):
        at = bisect_right(ends, done + capacity)
        done = ends[at - 1] if at else 0
        cuts.append(at)
    return cuts


def minimax_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its size, group key, shard and slot in the shard."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    meta = staged(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key")), "shard-meta")
    # stored first, so that both sides of the join are shuffled for it and a text
    # with very many copies can be split
    firsts = staged(meta.groupBy("text_key").agg(F.min("doc_id").alias("unit")), "shard-firsts")
    placed = staged(meta.join(firsts, "text_key").drop("text_key"), "shard-units")
    lowest = placed.agg(F.min("unit")).first()[0]
    placed = placed.withColumn("unit", F.coalesce("unit", F.lit(0 if lowest is None else lowest).cast("long")))
    shard = F.lit(0)
    for cut in minimax_cuts(placed.select("unit", "size"), shards):
        shard = shard + (F.col("unit") >= F.lit(cut)).cast("int")
    dealt = placed.withColumn("shard", shard.cast("int")).drop("unit")
    return dense_slots(dealt, ["shard"], ["doc_id", "text_crc32", "size"], "slot")


def op7_minimax_shards(spark, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes over the whole ``documents`` table."""
    out = minimax_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
